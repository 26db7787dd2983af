"""Benchmark scoring and result merging.

Inputs are ``token_scores(model, task, request_id, choice, gold, pos, token_id,
logprob, is_choice)`` rows produced by any scorer (see ``score``), and eval-result
rows ``(file, model, task, acc, acc_stderr, version)``. Everything is grouped
aggregation; the only ordering-sensitive steps (keep-first, argmax) are rank
filters or ``max_by`` with an explicit tie-break.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Task names scored by log-likelihood (besides the ``mmlu:`` prefix),
# generative tasks skipped in classification mode, the comparison's metric keys and
# display labels, and the short model names.
LIKELIHOOD_TASKS = ("hellaswag", "arc:challenge", "arc:easy", "winogrande", "truthfulqa:mc")
LIKELIHOOD_PREFIX = "mmlu:"
GENERATIVE_TASKS = ("gsm8k", "truthfulqa:gen")
METRIC_KEYS = (
    ("hellaswag|0", "HellaSwag"),
    ("arc:challenge|0", "ARC-Challenge"),
    ("arc:easy|0", "ARC-Easy"),
    ("winogrande|0", "WinoGrande"),
    ("truthfulqa:mc|0", "TruthfulQA-MC"),
    ("mmlu|0", "MMLU (avg)"),
)
MODEL_LABELS = {
    "openai-community-gpt2": "GPT-2",
    "EleutherAI-gpt-neo-125m": "GPT-Neo 125M",
    "EleutherAI-pythia-160m-deduped": "Pythia 160M",
    "HuggingFaceTB-SmolLM2-135M": "SmolLM2 135M",
}
OVERALL_KEY = "all"
GROUP_KEY = "mmlu|0"
PERPLEXITY_CAP = 20.0

# ---------------------------------------------------------------- scoring hook


def score(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Bring-your-own model: ``scorer`` turns request token rows into ``token_scores``
    (typically a ``mapInPandas`` that loads the model once per worker)."""
    return scorer(requests)


# ---------------------------------------------------------------- log-likelihoods

REQUEST_KEYS = ("model", "task", "request_id")


def choice_loglik(token_scores: DataFrame) -> DataFrame:
    """Sum of token log-probs over each choice span: ``model, task, request_id,
    choice, gold, ll, n_tokens``."""
    return (
        token_scores.where(F.col("is_choice"))
        .groupBy(*REQUEST_KEYS, "choice", "gold")
        .agg(F.sum("logprob").alias("ll"), F.count(F.lit(1)).alias("n_tokens"))
    )


def rolling_loglik(token_scores: DataFrame) -> DataFrame:
    """Whole-text log-likelihood: every token after the first is predicted; a text of
    at most one token scores 0.0."""
    return token_scores.groupBy(*REQUEST_KEYS).agg(
        F.coalesce(F.sum(F.when(F.col("pos") >= 1, F.col("logprob"))), F.lit(0.0)).alias("ll"),
        F.count(F.lit(1)).alias("n_tokens"),
    )


def predictions(lls: DataFrame) -> DataFrame:
    """Predicted choice per request: highest log-likelihood, ties to the lowest index."""
    key = F.struct(F.col("ll"), (-F.col("choice")).alias("neg_choice"))
    return lls.groupBy(*REQUEST_KEYS).agg(F.max_by("choice", key).alias("pred"), F.first("gold", ignorenulls=True).alias("gold"))


def choice_accuracy(lls: DataFrame) -> DataFrame:
    """Per (model, task): accuracy and its standard error (sample std / sqrt(n))."""
    correct = (F.col("pred") == F.col("gold")).cast("double")
    return (
        predictions(lls)
        .withColumn("correct", correct)
        .groupBy("model", "task")
        .agg(
            F.avg("correct").alias("acc"),
            F.coalesce(F.stddev_samp("correct") / F.sqrt(F.count(F.lit(1))), F.lit(0.0)).alias("acc_stderr"),
            F.count(F.lit(1)).alias("samples"),
        )
    )


def cap_samples(df: DataFrame, n: int, keys: Sequence[str] = ("model", "task"), order: str = "request_id") -> DataFrame:
    """At most ``n`` requests per task (the first by ``order``). The rank filter is
    planned as a per-partition group limit before the shuffle."""
    firsts = df.select(*keys, order).distinct()
    w = Window.partitionBy(*keys).orderBy(order)
    kept = firsts.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= F.lit(n)).drop("__r")
    return df.join(kept, [*keys, order], "left_semi")


def eval_loss(token_nll: DataFrame, keys: Sequence[str] = (), batch: str = "batch", nll: str = "nll") -> DataFrame:
    """Unweighted mean of per-batch mean losses."""
    per_batch = token_nll.groupBy(*keys, batch).agg(F.avg(nll).alias("batch_loss"))
    return per_batch.groupBy(*keys).agg(F.avg("batch_loss").alias("val_loss"), F.count(F.lit(1)).alias("eval_batches"))


def perplexity(loss: str | Column) -> Column:
    c = F.col(loss) if isinstance(loss, str) else loss
    return F.exp(F.least(c, F.lit(PERPLEXITY_CAP)))


# ---------------------------------------------------------------- task selection


def scoring_mode(task: str | Column) -> Column:
    t = F.col(task) if isinstance(task, str) else task
    base = F.split(t, r"\|")[0]
    is_ll = base.startswith(LIKELIHOOD_PREFIX) | base.isin(*LIKELIHOOD_TASKS)
    return F.when(is_ll, F.lit("loglikelihood")).otherwise(F.lit("generative"))


def select_tasks(spark: SparkSession, task_lists: DataFrame, col: str = "tasks", classification_only: bool = True) -> DataFrame:
    """Comma-separated task lists → one row per task (trimmed, non-empty); in
    classification mode generative tasks are removed (left-anti join against the
    small fixed set)."""
    others = [c for c in task_lists.columns if c != col]
    exploded = task_lists.select(*others, F.posexplode(F.split(F.col(col), ",")).alias("task_pos", "task"))
    exploded = exploded.withColumn("task", F.btrim("task")).where(F.col("task") != "")
    if not classification_only:
        return exploded
    gen = spark.createDataFrame([(t,) for t in GENERATIVE_TASKS], "task string")
    return exploded.join(F.broadcast(gen), "task", "left_anti")


# ---------------------------------------------------------------- results


def merge_results(rows: DataFrame) -> DataFrame:
    """Rows ``(model, file, task, acc, acc_stderr, version)`` from many result files →
    one row per (model, task): the first file in path order wins; incoming ``all``
    rows are dropped; ``version`` is that of the last file that gives one."""
    clean = rows.where(F.col("task") != F.lit(OVERALL_KEY))
    by_task = Window.partitionBy("model", "task")
    ranked = (
        clean.withColumn("__first", F.min("file").over(by_task))
        .withColumn("__version", F.max_by("version", F.when(F.col("version").isNotNull(), F.col("file"))).over(by_task))
    )
    return ranked.where(F.col("file") == F.col("__first")).select(
        "model", "task", "file", "acc", "acc_stderr", F.col("__version").alias("version")
    )


def _pooled(df: DataFrame, key: str) -> DataFrame:
    has = df.where(F.col("acc").isNotNull())
    return has.groupBy("model").agg(
        F.avg("acc").alias("acc"),
        F.sqrt(F.avg(F.pow(F.coalesce(F.col("acc_stderr"), F.lit(0.0)), 2))).alias("acc_stderr"),
        F.count(F.lit(1)).alias("tasks"),
    ).withColumn("task", F.lit(key))


def overall_accuracy(merged: DataFrame) -> DataFrame:
    """Mean task accuracy and pooled error ``sqrt(mean(stderr^2))`` per model."""
    return _pooled(merged.where(F.col("task") != F.lit(OVERALL_KEY)), OVERALL_KEY)


def group_accuracy(merged: DataFrame, prefix: str = LIKELIHOOD_PREFIX, key: str = GROUP_KEY) -> DataFrame:
    """Same over the tasks whose name starts with ``prefix`` (reported as ``key``)."""
    return _pooled(merged.where(F.col("task").startswith(prefix)), key)


def with_summaries(merged: DataFrame) -> DataFrame:
    """Merged per-task rows plus the ``all`` and ``mmlu|0`` summary rows."""
    cols = ["model", "task", "acc", "acc_stderr"]
    return (
        merged.where(F.col("task") != F.lit(GROUP_KEY)).select(*cols)
        .unionByName(overall_accuracy(merged).select(*cols))
        .unionByName(group_accuracy(merged).select(*cols))
    )


def comparison(spark: SparkSession, results: DataFrame, metric_keys=METRIC_KEYS, model_labels=None) -> DataFrame:
    """Long table ``model, label, metric, value``: accuracy x 100 rounded to 2 for
    every (model, metric) pair; a missing metric is null. Models are labelled by
    their short name when known."""
    labels = MODEL_LABELS if model_labels is None else model_labels
    cells = F.array(*[
        F.struct(F.lit(k).alias("task"), F.lit(lab).alias("metric"), F.lit(i).alias("metric_pos"))
        for i, (k, lab) in enumerate(metric_keys)
    ])
    # One row per (model, metric) cell, generated from the fixed metric list.
    grid = results.select("model").distinct().select("model", F.inline(cells))
    joined = grid.join(results.select("model", "task", "acc"), ["model", "task"], "left")
    label_map = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]) if labels else None
    label = F.coalesce(label_map[F.col("model")], F.col("model")) if label_map is not None else F.col("model")
    return joined.select(
        "model", label.alias("label"), "metric", "metric_pos", F.round(F.col("acc") * 100, 2).alias("value")
    )


def comparison_table(long: DataFrame, metric_keys=METRIC_KEYS) -> DataFrame:
    """Wide table: one row per model, one column per metric label (fixed order)."""
    labels = [lab for _, lab in metric_keys]
    return long.groupBy("label").pivot("metric", labels).agg(F.first("value")).withColumnRenamed("label", "Model")
