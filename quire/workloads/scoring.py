"""Evaluation workloads over ``documents`` x ``labels``.

Stand-in mapping (FIXTURES.md §B): source = model, lang = task, label = correct.

* Result files: per model two files — ``results_1_quality.json`` (accuracy = share of
  ``quality = 1`` per ``mmlu:<lang>|0`` task) and ``results_2_toxic.json`` (accuracy =
  share of ``toxic = 0`` for the same tasks plus ``truthfulqa:mc|0``); both carry an
  ``all`` row that merging drops. Versions are 0 and 1 (last file wins).
* Token scores: each labelled document is a multiple-choice request whose choices are
  its non-blank lines and whose gold index is ``quality``; tokens are byte ids scored
  by the model's own byte-unigram LM (``quire.operators.unigram``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import scoring as sc
from quire.functions.tokenizers import ByteTokenizer
from quire.operators.unigram import fit_unigram, score_tokens
from quire.sources.corpus import clean_corpus, corpus_from_table, read_table
from quire.workloads.common import sql_strip

CAP = 5


def _r9(c):
    return F.round(c, 9)


# ---------------------------------------------------------------- Spark side


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    docs = clean_corpus(read_table(spark, sf, "documents").select("source", "doc_id", "text", "lang"))
    return docs.join(read_table(spark, sf, "labels"), "doc_id", "inner")


def result_rows(spark, sf) -> DataFrame:
    lab = labeled(spark, sf)
    task = F.concat(F.lit("mmlu:"), F.col("lang"), F.lit("|0"))

    def stats(df, value, keys):
        return df.groupBy(*keys).agg(
            F.avg(value).alias("acc"),
            F.coalesce(F.stddev_samp(value) / F.sqrt(F.count(F.lit(1))), F.lit(0.0)).alias("acc_stderr"),
        )

    q = stats(lab.withColumn("task", task), F.col("quality"), ["source", "task"])
    q_all = stats(lab, F.col("quality"), ["source"]).withColumn("task", F.lit("all"))
    t = stats(lab.withColumn("task", task), F.lit(1) - F.col("toxic"), ["source", "task"])
    t_tq = stats(lab, F.lit(1) - F.col("toxic"), ["source"]).withColumn("task", F.lit("truthfulqa:mc|0"))
    t_all = stats(lab, F.lit(1) - F.col("toxic"), ["source"]).withColumn("task", F.lit("all"))
    cols = ["source", "task", "acc", "acc_stderr"]
    f1 = q.select(*cols).unionByName(q_all.select(*cols)).withColumn("file", F.lit("results_1_quality.json")).withColumn("version", F.lit(0))
    f2 = (
        t.select(*cols).unionByName(t_tq.select(*cols)).unionByName(t_all.select(*cols))
        .withColumn("file", F.lit("results_2_toxic.json")).withColumn("version", F.lit(1))
    )
    rows = f1.unionByName(f2)
    return rows.select(F.col("source").alias("model"), F.concat_ws("/", "source", "file").alias("file"), "task", "acc", "acc_stderr", "version")


def merged(spark, sf) -> DataFrame:
    return sc.merge_results(result_rows(spark, sf))


def summaries(spark, sf) -> DataFrame:
    return sc.with_summaries(merged(spark, sf))


def lm(spark, sf) -> DataFrame:
    docs = clean_corpus(corpus_from_table(read_table(spark, sf, "documents")))
    return fit_unigram(docs)


def choice_tokens(spark, sf) -> DataFrame:
    lab = labeled(spark, sf)
    lines = F.filter(F.transform(F.split(F.col("text"), "\n"), lambda x: F.btrim(x, F.lit(sql_ws_chars()))), lambda x: x != F.lit(""))
    req = lab.select(
        F.col("source").alias("model"),
        F.concat(F.lit("mmlu:"), F.col("lang"), F.lit("|0")).alias("task"),
        F.col("doc_id").alias("request_id"),
        F.col("quality").alias("gold"),
        lines.alias("choices"),
    ).where(F.size("choices") >= 2)
    ch = req.select("model", "task", "request_id", "gold", F.posexplode("choices").alias("choice", "line"))
    ids = ByteTokenizer().encode(F.col("line"), template=False)
    tok = ch.select("model", "task", "request_id", "gold", "choice", F.posexplode(ids).alias("pos", "token_id"))
    return tok.withColumn("is_choice", F.lit(True))


def sql_ws_chars():
    from quire.functions.text import PY_WHITESPACE

    return PY_WHITESPACE


def token_scores(spark, sf) -> DataFrame:
    return score_tokens(choice_tokens(spark, sf), lm(spark, sf))


def lls(spark, sf) -> DataFrame:
    return sc.choice_loglik(token_scores(spark, sf))


def q_merge_results(spark, sf):
    m = merged(spark, sf)
    return m.select("model", "task", "file", _r9(F.col("acc")).alias("acc"), _r9(F.col("acc_stderr")).alias("acc_stderr"), F.col("version").cast("long").alias("version"))


def q_overall_accuracy(spark, sf):
    o = sc.overall_accuracy(merged(spark, sf))
    return o.select("model", "task", _r9(F.col("acc")).alias("acc"), _r9(F.col("acc_stderr")).alias("acc_stderr"), "tasks")


def q_group_accuracy(spark, sf):
    o = sc.group_accuracy(merged(spark, sf))
    return o.select("model", "task", _r9(F.col("acc")).alias("acc"), _r9(F.col("acc_stderr")).alias("acc_stderr"), "tasks")


def q_comparison(spark, sf):
    c = sc.comparison(spark, summaries(spark, sf))
    return c.select("model", "label", "metric", F.col("metric_pos").cast("long").alias("metric_pos"), "value")


def q_write_comparison(spark, sf):
    """Write the comparison as CSV + Markdown, read the CSV back."""
    from quire.session import posix_scratch
    from quire.sources.eval_results import write_comparison

    out = posix_scratch(spark, "comparison")
    table = sc.comparison_table(sc.comparison(spark, summaries(spark, sf)))
    write_comparison(table, out, ["Model"] + [lab for _, lab in sc.METRIC_KEYS])
    back = spark.read.option("header", "true").csv(f"{out}/comparison_table_csv")
    return back.select(
        F.col("Model").alias("model"),
        F.col("`TruthfulQA-MC`").cast("double").alias("truthfulqa_mc"),
        F.col("`MMLU (avg)`").cast("double").alias("mmlu_avg"),
        F.col("HellaSwag").cast("double").alias("hellaswag"),
    )


def q_read_eval_results(spark, sf):
    """Write the stand-in result files (one JSON per model and run) and read them back
    recursively."""
    from quire.session import posix_scratch
    from quire.sources.eval_results import read_eval_results, write_eval_results

    root = posix_scratch(spark, "eval-results")
    write_eval_results(result_rows(spark, sf), root)
    r = read_eval_results(spark, root)
    return r.select("model", "file", "task", _r9(F.col("acc")).alias("acc"), _r9(F.col("acc_stderr")).alias("acc_stderr"),
                    F.col("version").cast("long").alias("version"))


def q_merge_documents(spark, sf):
    """Write the stand-in result files, merge them to one document a model, and lay the merged
    documents open."""
    from quire.session import posix_scratch
    from quire.sources import eval_documents as ed
    from quire.sources.eval_results import write_eval_results

    root, out = posix_scratch(spark, "eval-documents"), posix_scratch(spark, "eval-merged")
    write_eval_results(result_rows(spark, sf), root)
    ed.write_documents(ed.merge_result_files(spark, root, group_depth=1), out)
    back = spark.read.text(out).select("group", F.lit("merged").alias("file"), F.try_parse_json("value").alias("doc"))
    rows = ed.entries(back).withColumn("v", F.try_parse_json("value"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    text = (
        F.when(F.col("section") == "config_tasks", get("$.file", "string"))
        .when(F.col("section") == "summary_tasks", get("$.version", "string"))
        .when(F.col("section") == "versions", get("$", "string"))
        .when(F.col("section") == "config_general", get("$.model_name", "string"))
    )
    return rows.select(
        F.col("group").alias("model"), "section", "key", _r9(get("$.acc", "double")).alias("acc"), _r9(get("$.acc_stderr", "double")).alias("acc_stderr"), text.alias("text")
    )


def q_scoring_mode(spark, sf):
    r = result_rows(spark, sf).select("task").distinct()
    return r.select("task", sc.scoring_mode("task").alias("mode"))


def q_select_tasks(spark, sf):
    per_model = result_rows(spark, sf).groupBy("model").agg(
        F.concat_ws(",", F.array_sort(F.collect_set("task"))).alias("tasks")
    )
    lists = per_model.withColumn("tasks", F.concat(F.col("tasks"), F.lit(", gsm8k ,truthfulqa:gen,,")))
    return sc.select_tasks(spark, lists).select("model", "task", F.col("task_pos").cast("long").alias("task_pos"))


def q_choice_loglik(spark, sf):
    return lls(spark, sf).select("model", "task", "request_id", F.col("choice").cast("long").alias("choice"),
                                 F.col("gold").cast("long").alias("gold"), "ll", "n_tokens")


def q_choice_accuracy(spark, sf):
    a = sc.choice_accuracy(lls(spark, sf))
    return a.select("model", "task", _r9(F.col("acc")).alias("acc"), _r9(F.col("acc_stderr")).alias("acc_stderr"), "samples")


def q_cap_samples(spark, sf):
    capped = sc.cap_samples(lls(spark, sf), CAP)
    return capped.select("model", "task", "request_id").distinct()


def q_rolling_loglik(spark, sf):
    lab = labeled(spark, sf)
    tok = lab.select(
        F.col("source").alias("model"),
        F.concat(F.lit("mmlu:"), F.col("lang"), F.lit("|0")).alias("task"),
        F.col("doc_id").alias("request_id"),
        F.posexplode(ByteTokenizer().encode(F.col("text"), template=False)).alias("pos", "token_id"),
    )
    r = sc.rolling_loglik(score_tokens(tok, lm(spark, sf)))
    return r.select("model", "task", "request_id", "ll", "n_tokens")


def q_fit_unigram(spark, sf):
    return lm(spark, sf).select("model", F.col("token_id").cast("long").alias("token_id"), "logprob")


QUERIES = {
    "merge_results": q_merge_results,
    "merge_documents": q_merge_documents,
    "overall_accuracy": q_overall_accuracy,
    "group_accuracy": q_group_accuracy,
    "comparison": q_comparison,
    "write_comparison": q_write_comparison,
    "read_eval_results": q_read_eval_results,
    "scoring_mode": q_scoring_mode,
    "select_tasks": q_select_tasks,
    "choice_loglik": q_choice_loglik,
    "choice_accuracy": q_choice_accuracy,
    "cap_samples": q_cap_samples,
    "rolling_loglik": q_rolling_loglik,
    "fit_unigram": q_fit_unigram,
}

# ---------------------------------------------------------------- SQL side


def sql_byte_ids(expr: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), lambda x: CAST(('0x' || x) AS INTEGER) + 4)"


def sql_results_ctes() -> str:
    s = sql_strip
    return f"""
WITH lab AS (
  SELECT d.source, d.doc_id, d.lang, {s('d.text')} AS text, l.quality, l.toxic
  FROM documents d JOIN labels l USING (doc_id)
  WHERE d.text IS NOT NULL AND {s('d.text')} <> ''),
rows AS (
  SELECT source, 'mmlu:' || lang || '|0' AS task, avg(quality) AS acc,
         coalesce(stddev_samp(quality) / sqrt(count(*)), 0.0) AS acc_stderr, 'results_1_quality.json' AS file, 0 AS version
  FROM lab GROUP BY source, lang
  UNION ALL
  SELECT source, 'all', avg(quality), coalesce(stddev_samp(quality) / sqrt(count(*)), 0.0), 'results_1_quality.json', 0
  FROM lab GROUP BY source
  UNION ALL
  SELECT source, 'mmlu:' || lang || '|0', avg(1 - toxic), coalesce(stddev_samp(1 - toxic) / sqrt(count(*)), 0.0), 'results_2_toxic.json', 1
  FROM lab GROUP BY source, lang
  UNION ALL
  SELECT source, 'truthfulqa:mc|0', avg(1 - toxic), coalesce(stddev_samp(1 - toxic) / sqrt(count(*)), 0.0), 'results_2_toxic.json', 1
  FROM lab GROUP BY source
  UNION ALL
  SELECT source, 'all', avg(1 - toxic), coalesce(stddev_samp(1 - toxic) / sqrt(count(*)), 0.0), 'results_2_toxic.json', 1
  FROM lab GROUP BY source),
res AS (SELECT source AS model, source || '/' || file AS file, task, acc, acc_stderr, version FROM rows),
merged AS (
  SELECT model, task, file, acc, acc_stderr, version FROM (
    SELECT *, row_number() OVER (PARTITION BY model, task ORDER BY file) AS rk,
           last_value(version) OVER (PARTITION BY model, task ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lv
    FROM res WHERE task <> 'all') WHERE rk = 1),
merged_v AS (
  SELECT m.model, m.task, m.file, m.acc, m.acc_stderr, v.version FROM merged m
  JOIN (SELECT model, task, arg_max(version, file) AS version FROM res WHERE task <> 'all' GROUP BY model, task) v USING (model, task)),
overall AS (
  SELECT model, 'all' AS task, avg(acc) AS acc, sqrt(avg(pow(coalesce(acc_stderr, 0.0), 2))) AS acc_stderr, count(*) AS tasks
  FROM merged_v WHERE acc IS NOT NULL GROUP BY model),
grp AS (
  SELECT model, 'mmlu|0' AS task, avg(acc) AS acc, sqrt(avg(pow(coalesce(acc_stderr, 0.0), 2))) AS acc_stderr, count(*) AS tasks
  FROM merged_v WHERE acc IS NOT NULL AND starts_with(task, 'mmlu:') GROUP BY model),
summ AS (
  SELECT model, task, acc, acc_stderr FROM merged_v WHERE task <> 'mmlu|0'
  UNION ALL SELECT model, task, acc, acc_stderr FROM overall
  UNION ALL SELECT model, task, acc, acc_stderr FROM grp),
grid AS (
  SELECT model, c.task, c.metric, c.metric_pos FROM (
    SELECT model, unnest([{", ".join("{'task': '%s', 'metric': '%s', 'metric_pos': %d}" % (k, lab, i) for i, (k, lab) in enumerate(sc.METRIC_KEYS))}]) AS c
    FROM (SELECT DISTINCT model FROM summ))),
cmp AS (
  SELECT g.model, g.model AS label, g.metric, CAST(g.metric_pos AS BIGINT) AS metric_pos, round(s.acc * 100, 2) AS value
  FROM grid g LEFT JOIN summ s USING (model, task))
"""


def sql_lm_ctes(model: str = "source") -> str:
    """``model``: the SQL expression that says which model a document is learned by."""
    s = sql_strip
    return f"""
WITH cdocs AS (SELECT source, doc_id, lang, {s('text')} AS text FROM documents WHERE text IS NOT NULL AND {s('text')} <> ''),
toks AS (SELECT {model} AS model, unnest({sql_byte_ids('text')}) AS token_id FROM cdocs),
cnt AS (
  SELECT model, token_id, count(*) AS c FROM toks GROUP BY model, token_id
  UNION ALL SELECT {model}, 1, count(*) FROM cdocs GROUP BY ALL
  UNION ALL SELECT {model}, 2, count(*) FROM cdocs GROUP BY ALL),
cnt2 AS (SELECT model, token_id, sum(c) AS c FROM cnt GROUP BY model, token_id),
tot AS (SELECT model, sum(c) AS total FROM cnt2 GROUP BY model),
grid AS (SELECT model, total, unnest(range(260)) AS token_id FROM tot),
lm AS (
  SELECT g.model, CAST(g.token_id AS BIGINT) AS token_id,
         round(ln(CAST(coalesce(c.c, 0) + 1 AS DOUBLE) / CAST(g.total + 260 AS DOUBLE)) * 1048576.0) / 1048576.0 AS logprob
  FROM grid g LEFT JOIN cnt2 c ON c.model = g.model AND c.token_id = g.token_id),
lab AS (
  SELECT d.source, d.doc_id, d.lang, d.text, l.quality, l.toxic FROM cdocs d JOIN labels l USING (doc_id)),
req AS (
  SELECT source AS model, 'mmlu:' || lang || '|0' AS task, doc_id AS request_id, quality AS gold,
         list_filter(list_transform(string_split(text, chr(10)), lambda x: {s('x')}), lambda x: x <> '') AS choices
  FROM lab),
chs AS (
  SELECT model, task, request_id, gold, unnest(choices) AS line, unnest(range(len(choices))) AS choice
  FROM req WHERE len(choices) >= 2),
ctok AS (
  SELECT model, task, request_id, gold, choice, unnest(ids) AS token_id, unnest(range(len(ids))) AS pos
  FROM (SELECT *, {sql_byte_ids('line')} AS ids FROM chs)),
scores AS (SELECT t.*, lm.logprob FROM ctok t LEFT JOIN lm ON lm.model = t.model AND lm.token_id = t.token_id),
lls AS (
  SELECT model, task, request_id, CAST(choice AS BIGINT) AS choice, CAST(gold AS BIGINT) AS gold, sum(logprob) AS ll,
         CAST(count(*) AS BIGINT) AS n_tokens
  FROM scores GROUP BY model, task, request_id, choice, gold),
pred AS (
  SELECT model, task, request_id, gold, choice AS pred FROM (
    SELECT *, row_number() OVER (PARTITION BY model, task, request_id ORDER BY ll DESC, choice) AS rk FROM lls) WHERE rk = 1)
"""


def _sql():
    R = sql_results_ctes()
    L = sql_lm_ctes()
    gen = "'gsm8k', 'truthfulqa:gen'"
    ll_tasks = ", ".join(f"'{t}'" for t in sc.LIKELIHOOD_TASKS)
    return {
        "merge_results": R + """SELECT model, task, file, round(acc, 9) AS acc, round(acc_stderr, 9) AS acc_stderr,
                                   CAST(version AS BIGINT) AS version FROM merged_v""",
        "merge_documents": R + """SELECT model, 'results' AS section, task AS key, round(acc, 9) AS acc, round(acc_stderr, 9) AS acc_stderr, CAST(NULL AS VARCHAR) AS text FROM summ
            UNION ALL SELECT model, 'config_tasks', task, NULL, NULL, min(file) FROM res GROUP BY model, task
            UNION ALL SELECT model, 'summary_tasks', task, NULL, NULL, CAST(arg_min(version, file) AS VARCHAR) FROM res GROUP BY model, task
            UNION ALL SELECT model, 'versions', task, NULL, NULL, CAST(arg_max(version, file) AS VARCHAR) FROM res GROUP BY model, task
            UNION ALL SELECT DISTINCT model, 'config_general', '', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), model FROM res
            UNION ALL SELECT DISTINCT model, 'summary_general', '', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR) FROM res""",
        "overall_accuracy": R + "SELECT model, task, round(acc, 9) AS acc, round(acc_stderr, 9) AS acc_stderr, CAST(tasks AS BIGINT) AS tasks FROM overall",
        "group_accuracy": R + "SELECT model, task, round(acc, 9) AS acc, round(acc_stderr, 9) AS acc_stderr, CAST(tasks AS BIGINT) AS tasks FROM grp",
        "comparison": R + "SELECT model, label, metric, metric_pos, value FROM cmp",
        "write_comparison": R + """SELECT label AS model,
              max(CASE WHEN metric = 'TruthfulQA-MC' THEN value END) AS truthfulqa_mc,
              max(CASE WHEN metric = 'MMLU (avg)' THEN value END) AS mmlu_avg,
              max(CASE WHEN metric = 'HellaSwag' THEN value END) AS hellaswag
            FROM cmp GROUP BY label""",
        "read_eval_results": R + """SELECT model, file, task, round(acc, 9) AS acc, round(acc_stderr, 9) AS acc_stderr,
                                   CAST(version AS BIGINT) AS version FROM res""",
        "scoring_mode": R + f"""SELECT task, CASE WHEN starts_with(split_part(task, '|', 1), 'mmlu:')
              OR split_part(task, '|', 1) IN ({ll_tasks}) THEN 'loglikelihood' ELSE 'generative' END AS mode
            FROM (SELECT DISTINCT task FROM res)""",
        "select_tasks": R + f"""SELECT model, task, task_pos FROM (
              SELECT model, trim(t) AS task, CAST(pos - 1 AS BIGINT) AS task_pos FROM (
                SELECT model, unnest(parts) AS t, unnest(range(1, len(parts) + 1)) AS pos FROM (
                  SELECT model, string_split(string_agg(task, ',' ORDER BY task) || ', gsm8k ,truthfulqa:gen,,', ',') AS parts
                  FROM (SELECT DISTINCT model, task FROM res) GROUP BY model)))
            WHERE task <> '' AND task NOT IN ({gen})""",
        "choice_loglik": L + "SELECT model, task, request_id, choice, gold, ll, n_tokens FROM lls",
        "choice_accuracy": L + """SELECT model, task, round(avg(CAST(pred = gold AS DOUBLE)), 9) AS acc,
              round(coalesce(stddev_samp(CAST(pred = gold AS DOUBLE)) / sqrt(count(*)), 0.0), 9) AS acc_stderr,
              CAST(count(*) AS BIGINT) AS samples FROM pred GROUP BY model, task""",
        "cap_samples": L + f"""SELECT model, task, request_id FROM (
              SELECT model, task, request_id, row_number() OVER (PARTITION BY model, task ORDER BY request_id) AS rk
              FROM (SELECT DISTINCT model, task, request_id FROM lls)) WHERE rk <= {CAP}""",
        "rolling_loglik": L + """, rt AS (
              SELECT source AS model, 'mmlu:' || lang || '|0' AS task, doc_id AS request_id,
                     unnest(ids) AS token_id, unnest(range(len(ids))) AS pos
              FROM (SELECT *, """ + sql_byte_ids("text") + """ AS ids FROM lab))
            SELECT r.model, r.task, r.request_id, coalesce(sum(CASE WHEN r.pos >= 1 THEN lm.logprob END), 0.0) AS ll,
                   CAST(count(*) AS BIGINT) AS n_tokens
            FROM rt r LEFT JOIN lm ON lm.model = r.model AND lm.token_id = r.token_id
            GROUP BY r.model, r.task, r.request_id""",
        "fit_unigram": L + "SELECT model, token_id, logprob FROM lm",
    }


SQL = _sql()
