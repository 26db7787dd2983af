"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII white space and with A-Z lowered; its 128-bit
hash stands for it. What is known of the corpus is a few *runs*: tables of ``(h1, h2,
docs, keeper)``, bucketed by hash and sorted inside each bucket, with the number of
documents that hold the key (counted up to ``min_docs``) and the largest id among them.

Documents arrive in batches. A batch is reduced to one row a key, merge-anti-joined with
every run there is (a key that a run already shows in ``min_docs`` documents with a
keeper at least as large has nothing to add) and what is left is added as a run of level
0. When a level holds ``fanout`` runs, they are merged to one run of the next level, so
there are fewer than ``fanout`` runs on each of a logarithmic number of levels. Runs and
batches are bucketed alike, so neither an anti-join nor a merge moves a run again. A table that
is there as a whole is dealt in ``batches`` by id from the largest to the smallest: a
key is settled as soon as ``min_docs`` documents hold it.

A key held by very many documents is counted in two steps (by key and document, then by
key with partial sums in every task), and its lines meet the frequent keys in a merge
join whose large partitions Spark splits. Only numbers are shuffled up to there; texts
move once, to the places of their dropped lines.

Defined results: a null or empty text is one empty line; rows without an id count as one
document, smaller than all others; rows that repeat an id are one document, each judged
by its own text; a line repeated inside the keeper stays there each time; keys shorter
than ``min_chars`` code points always stay; only the id and the text column are read; an
empty table gives no rows. In ``LineRuns`` an id must not come in two batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.batches import documents, prepared
from quire.plans.materialize import checkpointed
from quire.session import scratch_path

#: The ASCII white space that is stripped, and the letters that are lowered.
BLANKS = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def split_lines(text: str | Column) -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n", -1)


def lowered(key: Column) -> Column:
    """A-Z lowered and nothing else; ``lower`` does just that where all is ASCII."""
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``docs(doc_id, text)`` → ``doc_id, text_key, place, h1, h2`` of every line whose key has
    ``min_chars`` code points."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(split_lines("text")).alias("place", "line"))
    keys = lines.select("doc_id", "text_key", "place", F.btrim("line", F.lit(BLANKS)).alias("key")).where(F.length("key") >= min_chars)
    keys = keys.withColumn("key", lowered(F.col("key")))
    # The second hash starts from another seed, so the two are independent.
    return keys.select("doc_id", "text_key", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


class LineRuns:
    """The runs of one corpus. ``add`` takes a batch of line hashes; ``frequent`` gives
    the keys in ``min_docs`` documents; ``close`` forgets the runs' tables."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, max(2, fanout)
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _written(self, run: DataFrame) -> str:
        """``run`` as a table bucketed and sorted by hash, below the checkpoint folder."""
        name = f"quire_line_run_{uuid.uuid4().hex[:12]}"
        write = run.select(*HASH, "docs", "keeper").write.format("parquet").option("path", scratch_path(self.spark, "line-run"))
        write.bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def _merged(self, names: list[str]) -> str:
        """Some runs as one, two at a time: a full outer merge join of equally bucketed
        tables, written where it was joined."""
        names = list(names)
        while len(names) > 1:
            a, b, *rest = names
            more = self.spark.table(b).select(*HASH, F.col("docs").alias("__docs"), F.col("keeper").alias("__keeper"))
            docs = F.least(F.coalesce("docs", F.lit(0)) + F.coalesce("__docs", F.lit(0)), F.lit(self.min_docs))
            both = self.spark.table(a).join(more.hint("merge"), HASH, "full")
            merged = self._written(both.select(*HASH, docs.alias("docs"), F.greatest("keeper", "__keeper").alias("keeper")))
            self._drop([a, b])
            names = [*rest, merged]
        return names[0]

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def add(self, lines: DataFrame) -> None:
        """Add the batch's keys that the runs don't settle yet."""
        once = lines.select(*HASH, "doc_id").distinct()
        new = once.groupBy(*HASH).agg(
            F.least(F.count(F.lit(1)), F.lit(self.min_docs)).cast("int").alias("docs"), F.max("doc_id").alias("keeper")
        )
        for name in (x for level in self.levels for x in level):
            settled = self.spark.table(name).where(F.col("docs") >= self.min_docs).select(*HASH, F.col("keeper").alias("__keeper"))
            same = [new[h] == settled[h] for h in HASH] + [new["keeper"] <= settled["__keeper"]]
            new = new.join(settled.hint("merge"), same, "left_anti")
        self._push(0, self._written(new))

    def _push(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._merged(full))

    def frequent(self) -> DataFrame:
        """``h1, h2, keeper`` of the keys that ``min_docs`` documents hold; compacts all
        runs to one."""
        names = [x for level in self.levels for x in level]
        if not names:
            return self.spark.createDataFrame([], "h1 long, h2 long, keeper long")
        self.levels = [[] for _ in self.levels[1:]] + [[self._merged(names)]]
        return self.spark.table(self.levels[-1][0]).where(F.col("docs") >= self.min_docs).select(*HASH, "keeper")

    def close(self) -> None:
        self._drop([x for level in self.levels for x in level])
        self.levels = []


def dedup_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 6,
    fanout: int = 4,
) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept, kept_sha256``. Keys of
    ``min_chars`` code points in ``min_docs`` documents stay in the largest id only."""
    spark = prepared(df.sparkSession)
    docs = documents(df, id_col, text_col)
    # Batch 0 has the largest ids; the bounds are only where batches part.
    cuts = docs.agg(F.percentile_approx("doc_id", [1 - i / batches for i in range(1, batches)], 1000).alias("c")).first().c or []
    batch = sum((F.coalesce(F.col("doc_id") <= c, F.lit(True)).cast("int") for c in sorted(set(cuts), reverse=True)), F.lit(0))
    lines = line_hashes(docs, min_chars).withColumn("batch", batch)
    path = scratch_path(spark, "table-lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, text_key long, place int, h1 long, h2 long, batch int").parquet(path)

    runs = LineRuns(spark, min_docs, fanout)
    for i in range(len(set(cuts)) + 1):
        runs.add(lines.where(F.col("batch") == i))
    frequent = checkpointed(runs.frequent(), "frequent-lines")
    runs.close()

    late = ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    gone = lines.join(frequent.hint("merge"), HASH).where(late)
    # A set: a row that is there many times over names the same places again.
    gone = gone.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("gone")).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "gone")
    rows = docs.withColumn("text_key", F.xxhash64("text"))
    rows = rows.join(gone, rows["doc_id"].eqNullSafe(gone["__id"]) & (rows["text_key"] == gone["__key"]), "left")
    rows = rows.select("doc_id", "text", "gone", split_lines("text").alias("lines"))
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    rest = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(rest)
    dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    out = rows.select("doc_id", n.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"), kept.alias("kept"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256))
