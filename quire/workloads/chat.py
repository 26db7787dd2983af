"""Chat workloads over ``conversations`` (Spark side and the matching SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import ChatConfig, ChatSourceConfig
from quire.operators import chat as ch
from quire.sources.chat import scan_chat_mix
from quire.sources.corpus import read_table
from quire.workloads.common import SEED, sql_strip

SEQ_LEN = 1024
MIN_SUP = 16
VAL_EXAMPLES = 10
MAX_TRAIN = 40
BATCH = 8
ACCUM = 4
EPOCH = 1
QUOTA_TOTAL = 60
CHAT_SOURCES = [
    ChatSourceConfig(source_name="system_led", weight=0.3, row_filters={"opening_role": "system"}),
    ChatSourceConfig(source_name="user_led", weight=0.7, row_filters={"opening_role": "user"}),
]


def chat_config() -> ChatConfig:
    return ChatConfig(val_examples=VAL_EXAMPLES, min_supervised_tokens=MIN_SUP, sources=list(CHAT_SOURCES))


# ---------------------------------------------------------------- Spark side


def dialogs(spark: SparkSession, sf: str) -> DataFrame:
    """One row per conversation with its raw message list and opening role."""
    d = ch.assemble_dialogs(read_table(spark, sf, "conversations"))
    return d.withColumn("opening_role", F.col("messages")[0]["role"])


def normalized(spark, sf) -> DataFrame:
    d = dialogs(spark, sf).withColumn("messages", ch.normalize_messages("messages"))
    return ch.drop_empty_dialogs(d)


def mixed(spark, sf) -> DataFrame:
    d = dialogs(spark, sf)
    return scan_chat_mix({s.source_name: d for s in CHAT_SOURCES}, chat_config())


def examples(spark, sf, label_alignment="next_token") -> DataFrame:
    """Examples built from head/tail-window turns only (``window_turns``): the same
    result as assembling whole dialogs, with groups bounded by the window size."""
    t = read_table(spark, sf, "conversations")
    opening = t.groupBy("conv_id").agg(F.min_by("role", "turn").alias("opening_role"))
    d = ch.window_turns(t, SEQ_LEN).join(opening, "conv_id")
    d = scan_chat_mix({s.source_name: d for s in CHAT_SOURCES}, chat_config())
    d = ch.drop_empty_dialogs(d.withColumn("messages", ch.normalize_messages("messages")))
    return ch.build_examples(d, SEQ_LEN, MIN_SUP, label_alignment=label_alignment, total_col="n_total")


def _md5_ids(c):
    return F.md5(F.array_join(c, ","))


def _pairs(spark, sf) -> DataFrame:
    """Prompt/response rows: each user turn with the next turn's text when that turn
    is an assistant reply (null otherwise), plus the dialog's system text."""
    t = read_table(spark, sf, "conversations")
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next_role"), F.col("text").alias("next_text"))
    system = t.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system_text"))
    users = t.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    joined = users.join(nxt, ["conv_id", "turn"], "left").join(system, "conv_id", "left")
    return joined.withColumn("response", F.when(F.col("next_role") == "assistant", F.col("next_text")))


def q_scan_chat(spark, sf):
    d = dialogs(spark, sf)
    return d.select("conv_id", F.size("messages").cast("long").alias("n_messages"), "opening_role")


def q_assemble_dialogs(spark, sf):
    d = dialogs(spark, sf)
    return d.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\u0001")).alias("content_md5"),
    )


def q_normalize_messages(spark, sf):
    d = dialogs(spark, sf).withColumn("messages", ch.normalize_messages("messages"))
    return d.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_kept"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\u0001")).alias("content_md5"),
    )


def q_normalize_mixed_messages(spark, sf):
    """Dialogs as JSON whose odd turns hold their lines as parts and whose even turns hold a
    string, read as one variant column."""
    t = read_table(spark, sf, "conversations")
    parts = F.to_json(F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"))))
    quoted = F.to_json(F.struct(F.col("text").alias("content")))
    body = F.when(F.col("turn") % 2 == 1, F.concat(F.lit('{"content":'), parts, F.lit("}"))).otherwise(quoted)
    role = F.concat(F.lit(',"role":'), F.regexp_extract(F.to_json(F.array("role")), r"^\[(.*)\]$", 1), F.lit("}"))
    message = F.concat(F.regexp_replace(body, r"\}$", ""), role)
    d = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))).alias("ms"))
    read = ch.normalize_mixed_messages(F.parse_json(F.concat(F.lit("["), F.array_join(F.col("ms.m"), ","), F.lit("]"))))
    d = d.withColumn("messages", read)
    return d.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_kept"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\u0001")).alias("content_md5"),
    )


def q_drop_empty_messages(spark, sf):
    d = dialogs(spark, sf)
    kept = F.size(ch.normalize_messages("messages"))
    return d.select("conv_id", (F.size("messages") - kept).cast("long").alias("n_dropped"))


def q_drop_empty_dialogs(spark, sf):
    d = normalized(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("dialogs"), F.sum(F.size("messages")).cast("long").alias("messages"))


def q_render_chat(spark, sf):
    d = normalized(spark, sf).withColumn("r", ch.render_chat("messages"))
    return d.select("conv_id", F.md5("r").alias("rendered_md5"), F.octet_length("r").cast("long").alias("rendered_bytes"))


def q_mask_labels(spark, sf):
    d = normalized(spark, sf).withColumn("p", ch.mask_labels("messages"))
    return d.select(
        "conv_id",
        F.size("p.input_ids").cast("long").alias("n_tokens"),
        ch.supervised_count("p.labels").cast("long").alias("n_supervised"),
        _md5_ids(F.col("p.input_ids")).alias("ids_md5"),
        _md5_ids(F.col("p.labels")).alias("labels_md5"),
    )


def q_mask_labels_same_position(spark, sf):
    d = normalized(spark, sf).withColumn("p", ch.mask_labels("messages", label_alignment="same_position"))
    return d.select(
        "conv_id",
        ch.supervised_count("p.labels").cast("long").alias("n_supervised"),
        _md5_ids(F.col("p.labels")).alias("labels_md5"),
    )


def q_pad_or_truncate(spark, sf):
    e = examples(spark, sf)
    return e.select("conv_id", "source", _md5_ids(F.col("input_ids")).alias("ids_md5"), _md5_ids(F.col("labels")).alias("labels_md5"))


def q_attention_mask(spark, sf):
    e = examples(spark, sf)
    return e.select("conv_id", "source", F.aggregate(ch.attention_mask("input_ids"), F.lit(0), lambda a, x: a + x).cast("long").alias("mask_sum"))


def q_tail_window(spark, sf):
    e = examples(spark, sf)
    return e.select("conv_id", "source", "n_tokens", "used_tail", F.col("supervised").cast("long").alias("supervised"))


def q_min_supervised(spark, sf):
    e = ch.min_supervised_filter(examples(spark, sf), MIN_SUP)
    return e.select("conv_id", "source", F.col("supervised").cast("long").alias("supervised"))


def _ranked(spark, sf):
    e = ch.min_supervised_filter(examples(spark, sf), MIN_SUP)
    return ch.shuffle_rank(e, SEED, "conv_id")


def q_val_first_n(spark, sf):
    return ch.val_first_n(_ranked(spark, sf), VAL_EXAMPLES).select("conv_id", "split", "shuffle_rank")


def q_max_train_examples(spark, sf):
    out = ch.val_first_n(_ranked(spark, sf), VAL_EXAMPLES, MAX_TRAIN)
    return out.select("conv_id", "split", "shuffle_rank")


def q_sft_report(spark, sf):
    out = ch.val_first_n(_ranked(spark, sf), VAL_EXAMPLES)
    r = ch.sft_report(out, SEQ_LEN)
    return r.select("split", "source", "num_examples", F.col("supervised_tokens").cast("long").alias("supervised_tokens"), F.col("seq_len").cast("long").alias("seq_len"))


def q_supervision_stats(spark, sf):
    s = ch.supervision_stats(examples(spark, sf))
    return s.select(
        "source", "examples",
        F.col("supervised_tokens").cast("long").alias("supervised_tokens"),
        F.col("tokens").cast("long").alias("tokens"),
        F.col("min_supervised").cast("long").alias("min_supervised"),
        F.col("max_supervised").cast("long").alias("max_supervised"),
    )


def q_quota_examples(spark, sf):
    e = ch.min_supervised_filter(examples(spark, sf), MIN_SUP)
    q = ch.quota_examples(e, spark, {s.source_name: s.weight for s in CHAT_SOURCES}, QUOTA_TOTAL, SEED, "conv_id")
    return q.select("source", "conv_id", "source_rank", F.col("quota").cast("long").alias("quota"))


def q_row_filters(spark, sf):
    m = mixed(spark, sf)
    return m.groupBy("source").agg(F.count(F.lit(1)).alias("dialogs"))


def q_scan_chat_mix(spark, sf):
    return mixed(spark, sf).select("source", "conv_id")


def q_epoch_batches(spark, sf):
    e = ch.min_supervised_filter(examples(spark, sf), MIN_SUP)
    b = ch.epoch_batches(e, SEED, EPOCH, BATCH, "conv_id")
    return b.select("conv_id", "epoch_rank", "batch")


def q_step_batches(spark, sf):
    e = ch.min_supervised_filter(examples(spark, sf), MIN_SUP)
    b = ch.step_batches(ch.epoch_batches(e, SEED, EPOCH, BATCH, "conv_id"), BATCH, ACCUM)
    return b.select("conv_id", "step", "micro_step")


def q_normalize_prompt_response(spark, sf):
    p = _pairs(spark, sf).where(F.col("response").isNotNull())
    m = ch.normalize_prompt_response("prompt", "response", system_prompt="You are a helpful assistant.")
    d = p.withColumn("messages", m).withColumn("p", ch.mask_labels("messages"))
    return d.select("conv_id", "turn", _md5_ids(F.col("p.input_ids")).alias("ids_md5"), ch.supervised_count("p.labels").cast("long").alias("n_supervised"))


def q_normalize_alpaca(spark, sf):
    p = _pairs(spark, sf).where(F.col("response").isNotNull())
    d = p.withColumn("messages", ch.normalize_alpaca("prompt", "system_text", "response"))
    r = ch.render_chat("messages")
    return d.select("conv_id", "turn", F.md5(r).alias("rendered_md5"))


def q_validate_chat_row(spark, sf):
    p = _pairs(spark, sf)
    cfg = ChatConfig(format="prompt_response")
    good, bad = ch.validate_chat_rows(p, cfg, policy="quarantine")
    return bad.select("conv_id", "turn", "reason")


def q_flatten_content_parts(spark, sf):
    t = read_table(spark, sf, "conversations")
    parts = F.transform(F.split(F.col("text"), "\n"), lambda x: F.struct(x.alias("text")))
    flat = ch.flatten_content_parts(parts)
    return t.select("conv_id", "turn", F.md5(flat).alias("flat_md5"), F.length(flat).cast("long").alias("flat_chars"))


STOPS = ["\n", ", "]


def q_prompt_strip(spark, sf):
    from quire.functions.text import prompt_strip

    t = read_table(spark, sf, "conversations").where(F.col("role") == "user")
    p = prompt_strip("text")
    return t.select("conv_id", "turn", F.md5(p).alias("prompt_md5"), F.length(p).cast("long").alias("prompt_chars"))


def q_truncate_at_stops(spark, sf):
    from quire.functions.text import truncate_at_stops

    t = read_table(spark, sf, "conversations").where(F.col("role") == "assistant")
    cut = truncate_at_stops("text", STOPS)
    return t.select("conv_id", "turn", F.md5(cut).alias("cut_md5"), F.length(cut).cast("long").alias("cut_chars"))


QUERIES = {
    "prompt_strip": q_prompt_strip,
    "truncate_at_stops": q_truncate_at_stops,
    "scan_chat": q_scan_chat,
    "assemble_dialogs": q_assemble_dialogs,
    "normalize_messages": q_normalize_messages,
    "normalize_mixed_messages": q_normalize_mixed_messages,
    "drop_empty_messages": q_drop_empty_messages,
    "drop_empty_dialogs": q_drop_empty_dialogs,
    "render_chat": q_render_chat,
    "mask_labels": q_mask_labels,
    "mask_labels_same_position": q_mask_labels_same_position,
    "pad_or_truncate": q_pad_or_truncate,
    "attention_mask": q_attention_mask,
    "tail_window": q_tail_window,
    "min_supervised": q_min_supervised,
    "val_first_n": q_val_first_n,
    "max_train_examples": q_max_train_examples,
    "sft_report": q_sft_report,
    "supervision_stats": q_supervision_stats,
    "quota_examples": q_quota_examples,
    "row_filters": q_row_filters,
    "scan_chat_mix": q_scan_chat_mix,
    "epoch_batches": q_epoch_batches,
    "step_batches": q_step_batches,
    "normalize_prompt_response": q_normalize_prompt_response,
    "normalize_alpaca": q_normalize_alpaca,
    "validate_chat_row": q_validate_chat_row,
    "flatten_content_parts": q_flatten_content_parts,
}

# ---------------------------------------------------------------- SQL side


def _ids(piece: str) -> str:
    """Byte ids of a text column ``piece`` whose hex is in column ``h`` (see _with_hex)."""
    return f"list_transform(regexp_extract_all(hex(encode({piece})), '..'), lambda x: CAST(('0x' || x) AS INTEGER) + 4)"


def sql_labels_ctes() -> str:
    s = sql_strip
    return f"""
WITH dial AS (
  SELECT conv_id, arg_min(role, turn) AS opening_role FROM conversations GROUP BY conv_id),
msgs AS (
  SELECT c.conv_id, c.turn, c.role, {s('c.text')} AS content, d.opening_role
  FROM conversations c JOIN dial d USING (conv_id)
  WHERE c.role IS NOT NULL AND c.text IS NOT NULL AND {s('c.text')} <> ''),
pieces AS (
  SELECT *, lower({s('role')}) = 'assistant' AS sup,
         '<|' || lower({s('role')}) || '|>' || chr(10) || content || chr(10) AS piece FROM msgs),
hexed AS (SELECT *, hex(encode(piece)) AS h FROM pieces),
pids AS (SELECT conv_id, turn, sup, opening_role, {_ids('piece')} AS ids, piece FROM hexed),
packed AS (
  SELECT conv_id, any_value(opening_role) AS opening_role,
    list_concat([1], flatten(list(ids ORDER BY turn)), [2]) AS input_ids,
    list_concat([-100], flatten(list(CASE WHEN sup THEN ids ELSE list_transform(ids, lambda x: -100) END ORDER BY turn)), [2]) AS same_labels,
    string_agg(piece, '' ORDER BY turn) AS rendered
  FROM pids GROUP BY conv_id),
aligned AS (
  SELECT *, list_concat(list_slice(same_labels, 2, len(same_labels)), [-100]) AS labels,
         CASE WHEN opening_role = 'system' THEN 'system_led' WHEN opening_role = 'user' THEN 'user_led' END AS source
  FROM packed),
windowed AS (
  SELECT *,
    len(input_ids) > {SEQ_LEN} AND len(list_filter(list_slice(labels, 1, {SEQ_LEN}), lambda x: x <> -100)) < {MIN_SUP} AS used_tail,
    greatest(len(input_ids) - {SEQ_LEN} + 1, 1) AS tstart
  FROM aligned WHERE source IS NOT NULL),
ex AS (
  SELECT conv_id, source, CAST(len(input_ids) AS BIGINT) AS n_tokens, used_tail,
    list_slice(list_concat(CASE WHEN used_tail THEN list_slice(input_ids, tstart, tstart + {SEQ_LEN} - 1) ELSE input_ids END,
                           list_transform(range({SEQ_LEN}), lambda i: 0)), 1, {SEQ_LEN}) AS ids,
    list_slice(list_concat(CASE WHEN used_tail THEN list_slice(labels, tstart, tstart + {SEQ_LEN} - 1) ELSE labels END,
                           list_transform(range({SEQ_LEN}), lambda i: -100)), 1, {SEQ_LEN}) AS labs
  FROM windowed),
ex2 AS (SELECT *, CAST(len(list_filter(labs, lambda x: x <> -100)) AS BIGINT) AS supervised FROM ex),
kept AS (SELECT * FROM ex2 WHERE supervised >= {MIN_SUP}),
ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY md5('{SEED}:' || CAST(conv_id AS VARCHAR)), conv_id) AS BIGINT) AS shuffle_rank,
         CAST(row_number() OVER (ORDER BY md5('{SEED}:{EPOCH}:' || CAST(conv_id AS VARCHAR)), conv_id) AS BIGINT) AS epoch_rank,
         CAST(row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || source || ':' || CAST(conv_id AS VARCHAR)), conv_id) AS BIGINT) AS source_rank
  FROM kept)
"""


def sql_pairs() -> str:
    return """
WITH pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt,
         CASE WHEN n.role = 'assistant' THEN n.text END AS response, s.system_text
  FROM conversations u
  LEFT JOIN conversations n ON n.conv_id = u.conv_id AND n.turn = u.turn + 1
  LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations WHERE role = 'system' GROUP BY conv_id) s
    ON s.conv_id = u.conv_id
  WHERE u.role = 'user')
"""


def _sql_quota() -> str:
    from quire.workloads.common import sql_allocate, sql_double

    tot = 0.0
    for s in CHAT_SOURCES:
        tot += s.weight
    rows = ", ".join(f"('{s.source_name}', {sql_double(s.weight / tot)})" for s in CHAT_SOURCES)
    return sql_labels_ctes() + f""",
qsrc AS (SELECT * FROM (VALUES {rows}) AS t(source, share)),
quotas AS ({sql_allocate('qsrc', str(QUOTA_TOTAL), 'quota')})
SELECT k.source, k.conv_id, k.source_rank, q.quota FROM ranked k JOIN quotas q USING (source) WHERE k.source_rank <= q.quota"""


def _sql():
    s = sql_strip
    L = sql_labels_ctes()
    sys_prompt = "You are a helpful assistant."
    pr_piece = (
        f"'<|system|>' || chr(10) || '{sys_prompt}' || chr(10) || "
        f"CASE WHEN {s('prompt')} <> '' THEN '<|user|>' || chr(10) || {s('prompt')} || chr(10) ELSE '' END"
    )
    return {
        "prompt_strip": f"""SELECT conv_id, turn, md5({s('text')}) AS prompt_md5, CAST(length({s('text')}) AS BIGINT) AS prompt_chars
                            FROM conversations WHERE role = 'user'""",
        "truncate_at_stops": """SELECT conv_id, turn, md5(c) AS cut_md5, CAST(length(c) AS BIGINT) AS cut_chars FROM (
                            SELECT conv_id, turn, split_part(split_part(text, chr(10), 1), ', ', 1) AS c
                            FROM conversations WHERE role = 'assistant')""",
        "scan_chat": """SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, arg_min(role, turn) AS opening_role
                        FROM conversations GROUP BY conv_id""",
        "assemble_dialogs": """SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
                                md5(string_agg(text, chr(1) ORDER BY turn)) AS content_md5 FROM conversations GROUP BY conv_id""",
        "normalize_messages": f"""SELECT conv_id,
              CAST(count(*) FILTER (WHERE role IS NOT NULL AND text IS NOT NULL AND {s('text')} <> '') AS BIGINT) AS n_kept,
              md5(coalesce(string_agg(CASE WHEN role IS NOT NULL AND text IS NOT NULL AND {s('text')} <> '' THEN {s('text')} END,
                  chr(1) ORDER BY turn), '')) AS content_md5
            FROM conversations GROUP BY conv_id""",
        "normalize_mixed_messages": f"""SELECT conv_id,
              CAST(count(*) FILTER (WHERE role IS NOT NULL AND x <> '') AS BIGINT) AS n_kept,
              md5(coalesce(string_agg(CASE WHEN role IS NOT NULL AND x <> '' THEN x END, chr(1) ORDER BY turn), '')) AS content_md5
            FROM (SELECT conv_id, turn, role, {s('t')} AS x FROM (
              SELECT *, CASE WHEN turn % 2 = 1 THEN array_to_string(list_filter(string_split(text, chr(10)), lambda p: p <> ''), chr(10)) ELSE text END AS t FROM conversations))
            GROUP BY conv_id""",
        "drop_empty_messages": f"""SELECT conv_id,
              CAST(count(*) FILTER (WHERE NOT (role IS NOT NULL AND text IS NOT NULL AND {s('text')} <> '')) AS BIGINT) AS n_dropped
            FROM conversations GROUP BY conv_id""",
        "drop_empty_dialogs": f"""SELECT CAST(count(DISTINCT conv_id) AS BIGINT) AS dialogs, CAST(count(*) AS BIGINT) AS messages
            FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL AND {s('text')} <> ''""",
        "render_chat": L + "SELECT conv_id, md5(rendered) AS rendered_md5, CAST(strlen(rendered) AS BIGINT) AS rendered_bytes FROM packed",
        "mask_labels": L + """SELECT conv_id, CAST(len(input_ids) AS BIGINT) AS n_tokens,
              CAST(len(list_filter(labels, lambda x: x <> -100)) AS BIGINT) AS n_supervised,
              md5(array_to_string(input_ids, ',')) AS ids_md5, md5(array_to_string(labels, ',')) AS labels_md5 FROM aligned""",
        "mask_labels_same_position": L + """SELECT conv_id, CAST(len(list_filter(same_labels, lambda x: x <> -100)) AS BIGINT) AS n_supervised,
              md5(array_to_string(same_labels, ',')) AS labels_md5 FROM aligned""",
        "pad_or_truncate": L + """SELECT conv_id, source, md5(array_to_string(ids, ',')) AS ids_md5,
              md5(array_to_string(labs, ',')) AS labels_md5 FROM ex2""",
        "attention_mask": L + "SELECT conv_id, source, CAST(len(list_filter(ids, lambda x: x <> 0)) AS BIGINT) AS mask_sum FROM ex2",
        "tail_window": L + "SELECT conv_id, source, n_tokens, used_tail, supervised FROM ex2",
        "min_supervised": L + "SELECT conv_id, source, supervised FROM kept",
        "val_first_n": L + f"SELECT conv_id, CASE WHEN shuffle_rank <= {VAL_EXAMPLES} THEN 'val' ELSE 'train' END AS split, shuffle_rank FROM ranked",
        "max_train_examples": L + f"""SELECT conv_id, CASE WHEN shuffle_rank <= {VAL_EXAMPLES} THEN 'val' ELSE 'train' END AS split, shuffle_rank
              FROM ranked WHERE shuffle_rank <= {VAL_EXAMPLES + MAX_TRAIN}""",
        "sft_report": L + f"""SELECT CASE WHEN shuffle_rank <= {VAL_EXAMPLES} THEN 'val' ELSE 'train' END AS split, source,
              CAST(count(*) AS BIGINT) AS num_examples, CAST(sum(supervised) AS BIGINT) AS supervised_tokens,
              CAST({SEQ_LEN} AS BIGINT) AS seq_len FROM ranked GROUP BY 1, 2""",
        "supervision_stats": L + """SELECT source, CAST(count(*) AS BIGINT) AS examples, CAST(sum(supervised) AS BIGINT) AS supervised_tokens,
              CAST(sum(len(list_filter(ids, lambda x: x <> 0))) AS BIGINT) AS tokens,
              CAST(min(supervised) AS BIGINT) AS min_supervised, CAST(max(supervised) AS BIGINT) AS max_supervised
            FROM ex2 GROUP BY source""",
        "quota_examples": _sql_quota(),
        "row_filters": """SELECT CASE opening_role WHEN 'system' THEN 'system_led' ELSE 'user_led' END AS source,
              CAST(count(*) AS BIGINT) AS dialogs
            FROM (SELECT conv_id, arg_min(role, turn) AS opening_role FROM conversations GROUP BY conv_id)
            WHERE opening_role IN ('system', 'user') GROUP BY 1""",
        "scan_chat_mix": """SELECT CASE opening_role WHEN 'system' THEN 'system_led' ELSE 'user_led' END AS source, conv_id
            FROM (SELECT conv_id, arg_min(role, turn) AS opening_role FROM conversations GROUP BY conv_id)
            WHERE opening_role IN ('system', 'user')""",
        "epoch_batches": L + f"SELECT conv_id, epoch_rank, CAST((epoch_rank - 1) // {BATCH} AS BIGINT) AS batch FROM ranked",
        "step_batches": L + f"""SELECT conv_id, CAST((epoch_rank - 1) // {BATCH * ACCUM} AS BIGINT) AS step,
              CAST(((epoch_rank - 1) % {BATCH * ACCUM}) // {BATCH} AS BIGINT) AS micro_step FROM ranked""",
        "normalize_prompt_response": sql_pairs() + f""",
          pr AS (SELECT conv_id, turn, {pr_piece} AS pre, '<|assistant|>' || chr(10) || {s('response')} || chr(10) AS asst
                 FROM pairs WHERE response IS NOT NULL),
          hx AS (SELECT *, hex(encode(pre)) AS hp, hex(encode(asst)) AS ha FROM pr),
          ids AS (SELECT conv_id, turn,
                   list_transform(range(strlen(pre)), lambda i: CAST(('0x' || substr(hp, 2 * i + 1, 2)) AS INTEGER) + 4) AS pi,
                   list_transform(range(strlen(asst)), lambda i: CAST(('0x' || substr(ha, 2 * i + 1, 2)) AS INTEGER) + 4) AS ai
                  FROM hx)
          SELECT conv_id, turn, md5(array_to_string(list_concat([1], pi, CASE WHEN {s('response')} <> '' THEN ai ELSE [] END, [2]), ',')) AS ids_md5,
                 CAST(CASE WHEN {s('response')} <> '' THEN len(ai) ELSE 0 END + 1 AS BIGINT) AS n_supervised
          FROM ids JOIN pairs USING (conv_id, turn)""",
        "normalize_alpaca": sql_pairs() + f"""
          SELECT conv_id, turn, md5(
            CASE WHEN {s('u')} <> '' THEN '<|user|>' || chr(10) || {s('u')} || chr(10) ELSE '' END ||
            CASE WHEN a <> '' THEN '<|assistant|>' || chr(10) || a || chr(10) ELSE '' END) AS rendered_md5
          FROM (SELECT conv_id, turn,
                  CASE WHEN system_text IS NOT NULL AND {s('system_text')} <> '' THEN {s('prompt')} || chr(10) || chr(10) || {s('system_text')}
                       ELSE {s('prompt')} END AS u,
                  {s('response')} AS a
                FROM pairs WHERE response IS NOT NULL)""",
        "validate_chat_row": sql_pairs() + """SELECT conv_id, turn, 'field prompt/response is missing' AS reason
            FROM pairs WHERE prompt IS NULL OR response IS NULL""",
        "flatten_content_parts": """SELECT conv_id, turn, md5(f) AS flat_md5, CAST(length(f) AS BIGINT) AS flat_chars FROM (
              SELECT conv_id, turn, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10)) AS f
              FROM conversations)""",
    }


SQL = _sql()
