"""Whole evaluation result documents: read, merge, write.

``read_entries`` parses every ``results_*.json`` as a variant and lays its sections open as
rows ``(group, file, section, key, value)``, whatever a value holds (any metric, any nesting).
``merge_entries`` merges the files of a group by plain grouped aggregation:

* ``results``, ``config_tasks``, ``summary_tasks``: the first file that has a key wins; a
  file's own ``all`` row is left out of ``results``;
* ``versions``: the last file wins;
* ``config_general``, ``summary_general``: from the first file;
* ``results`` gains ``all`` (mean accuracy of the tasks that have one, and the root of the
  mean squared standard error, a missing one counting as zero) and, over the tasks
  named ``mmlu:…``, ``mmlu|0``.

``merged_documents`` puts the rows of a group together to one JSON text and
``write_documents`` writes each as a one-line file through Spark, so any file system will do.
A file that isn't a JSON object has no rows; null keys and sections that aren't objects are
left out. Objects come out with their keys in order, which JSON doesn't mind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.paths import plain_path

# The sections of a result document, by how files are merged, and the names of
# the summary rows.
FIRST_WINS = ("results", "config_tasks", "summary_tasks")
LAST_WINS = ("versions",)
FROM_FIRST_FILE = ("config_general", "summary_general")
OVERALL, GROUP, GROUP_PREFIX = "all", "mmlu|0", "mmlu:"


def read_documents(spark: SparkSession, root: str, group_depth: int = 0) -> DataFrame:
    """``group, file, doc``: every ``results_*.json`` below ``root`` as a variant (null where it
    isn't JSON). ``file`` is the path below ``root``, ``group`` its first ``group_depth`` folders."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "results_*.json")
    raw = reader.text(root, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    base = plain_path(spark, root)
    bare = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    whole = F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))
    file = F.ltrim(F.substring(whole, len(base) + 1, 1 << 30), F.lit("/"))
    group = F.array_join(F.slice(F.split("file", "/"), 1, group_depth), "/") if group_depth else F.lit("")
    return raw.select(file.alias("file"), F.try_parse_json("value").alias("doc")).withColumn("group", group).select("group", "file", "doc")


def entries(documents: DataFrame) -> DataFrame:
    """Rows ``group, file, section, key, value`` (JSON text); a section that stands for itself (see ``FROM_FIRST_FILE``) is one row
    with an empty key, ``{}`` where the file lacks it."""
    spark = documents.sparkSession
    sections = [F.struct(F.lit(s).alias("section"), F.try_variant_get("doc", f"$.{s}", "variant").alias("part")) for s in (*FIRST_WINS, *LAST_WINS)]
    flat = documents.where(F.schema_of_variant("doc").startswith("OBJECT")).select("group", "file", F.explode(F.array(*sections)).alias("s"))
    flat = flat.select("group", "file", "s.section", "s.part").where(F.schema_of_variant("part").startswith("OBJECT"))
    open_rows = flat.lateralJoin(spark.tvf.variant_explode(F.col("part").outer()))
    keyed = open_rows.where(F.col("key").isNotNull()).select("group", "file", "section", "key", F.coalesce(F.to_json("value"), F.lit("null")).alias("value"))
    whole = [F.struct(F.lit(s).alias("section"), F.coalesce(F.to_json(F.try_variant_get("doc", f"$.{s}", "variant")), F.lit("{}")).alias("value")) for s in FROM_FIRST_FILE]
    single = documents.where(F.schema_of_variant("doc").startswith("OBJECT")).select("group", "file", F.explode(F.array(*whole)).alias("s"))
    return keyed.unionByName(single.select("group", "file", "s.section", F.lit("").alias("key"), "s.value"))


def _summary(results: DataFrame, name: str) -> DataFrame:
    doc = F.try_parse_json("value")
    acc = F.try_variant_get(doc, "$.acc", "double")
    err = F.coalesce(F.try_variant_get(doc, "$.acc_stderr", "double"), F.lit(0.0))
    scored = results.select("group", acc.alias("acc"), err.alias("err")).where(F.col("acc").isNotNull())
    value = F.to_json(F.struct(F.avg("acc").alias("acc"), F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("acc_stderr")))
    return scored.groupBy("group").agg(value.alias("value")).select("group", F.lit("results").alias("section"), F.lit(name).alias("key"), "value")


def merge_entries(rows: DataFrame) -> DataFrame:
    """Entries of any number of files → ``group, section, key, value``, merged."""
    summed = (F.col("section") == "results") & (F.col("key") == OVERALL)
    merged = rows.where(~summed).groupBy("group", "section", "key").agg(
        F.when(F.col("section").isin(*LAST_WINS), F.max_by("value", "file")).otherwise(F.min_by("value", "file")).alias("value")
    )
    results = merged.where(F.col("section") == "results")
    some = _summary(results.where(F.col("key").startswith(GROUP_PREFIX)), GROUP)
    overall = _summary(results, OVERALL)
    # A task of the group row's own name gives way to the computed row.
    kept = merged.join(some.select("group", "section", "key"), ["group", "section", "key"], "left_anti")
    return kept.unionByName(overall).unionByName(some)


def _quoted(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def merged_documents(merged: DataFrame) -> DataFrame:
    """``group, document``: the merged rows of a group as one JSON text, every section present."""
    pair = F.when(F.col("key") == "", F.col("value")).otherwise(F.concat(_quoted(F.col("key")), F.lit(": "), F.col("value")))
    parts = merged.groupBy("group", "section").agg(F.array_join(F.array_sort(F.collect_list(pair)), ", ").alias("body"))
    body = F.when(F.col("section").isin(*FROM_FIRST_FILE), F.col("body")).otherwise(F.concat(F.lit("{"), F.col("body"), F.lit("}")))
    by = parts.groupBy("group").agg(F.map_from_entries(F.collect_list(F.struct("section", body))).alias("m"))
    order = ("config_general", "results", "config_tasks", "summary_tasks", "summary_general", "versions")
    sections = [F.concat(F.lit(f'"{s}": '), F.coalesce(F.col("m")[s], F.lit("{}"))) for s in order]
    return by.select("group", F.concat(F.lit("{"), F.concat_ws(", ", *sections), F.lit("}")).alias("document"))


def write_documents(documents: DataFrame, out: str) -> None:
    """Every group's document as one line below ``out/group=<name>/``."""
    documents.select("group", "document").write.mode("overwrite").partitionBy("group").text(out)


def merge_result_files(spark: SparkSession, root: str, group_depth: int = 0) -> DataFrame:
    """``group, document`` of all result files below ``root``."""
    return merged_documents(merge_entries(entries(read_documents(spark, root, group_depth))))
