"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. *Document evidence.* Dense counts of a text (symbols, capitals, digits, repeated
   words and lines, lengths) give a logistic probability of good quality, fitted on at
   most ``sample`` labelled rows of the training folds. Divided by the prior odds it
   was fitted under, it is the document's likelihood ratio.
2. *Sites.* Over all documents, a grouped sum of these probabilities per path, then per
   host, then overall. The spread of host means around the global mean, and of path
   means around their host's, beyond what chance explains, gives the strength of each
   prior by the method of moments. A host's posterior is shrunk toward the global
   mean, a path's toward its host's, so sparse sites say little.
3. *Decision.* Likelihood ratio times the odds of the path's posterior, from which the
   document's own evidence is left out, on the path and on its host alike: a document
   alone on its host has the global mean as its site. Below ``threshold`` it is rejected.

Group sums are combined before the shuffle, so one site may hold most rows.

Defined results: a null text is empty and has a probability like any other; a null host
or path is a site named ''; labels that are null, or that contradict each other for one
id, are not learned from; without two classes of labels the evidence is neutral; repeated
rows count each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import fold, pieces_of, raw_texts, sampled
from quire.plans.materialize import checkpointed

FOLDS, HELD_OUT = 3, 1
FEATURES = (
    "log_words", "mean_word", "capitals", "digits", "closing_marks", "odd_marks", "bars", "not_ascii",
    "repeated_words", "repeated_lines", "words_a_line", "longest_word",
)

_CLASSES = np.zeros((256, 7), "f8")
for _chars, _col in (
    (range(ord("A"), ord("Z") + 1), 0), (range(ord("a"), ord("z") + 1), 1), (range(ord("0"), ord("9") + 1), 2),
    (b".,;:!?", 3), (b"#$%&*@^~_=+<>\\{}[]", 4), (b"|", 5), (range(128, 256), 6),
):
    _CLASSES[list(_chars), _col] = 1


def features(raws: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    out = np.zeros((len(raws), len(FEATURES)))
    for i, raw in enumerate(raws):
        words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
        upper, lower, digits, marks, odd, bars, high = np.bincount(np.frombuffer(raw, "u1"), minlength=256) @ _CLASSES
        n, size = max(len(words), 1), max(len(raw), 1)
        out[i] = (
            np.log1p(len(words)), size / n, upper / max(upper + lower, 1), digits / size, marks / n, odd / n, bars / n, high / size,
            1 - len(set(words)) / n, 1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)),
            np.log1p(max(map(len, words), default=0)),
        )
    return out


class Logistic:
    """Ridge logistic regression by Newton steps on standardised, squared-extended rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._rows(x)
        self.prior = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        self.w = np.zeros(z.shape[1])
        self.w[0] = np.log(self.prior / (1 - self.prior))
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-9
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * self.w)
            self.w += step
            if np.abs(step).max() < 1e-8:
                break

    def _rows(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate((np.ones((len(z), 1)), z, z * z), axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._rows(x) @ self.w, -30, 30)))


def one_label(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, label`` for ids whose labels agree."""
    rows = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
    both = rows.agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
    return both.where("label = other").select("doc_id", F.col("label").cast("int").alias("label"))


def url_site(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a URL column, for tables that have one."""
    return F.lower(F.parse_url(url, F.lit("HOST"))), F.regexp_extract(F.parse_url(url, F.lit("PATH")), "^/([^/]*)", 1)


def with_features(df: DataFrame, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"),
    ).withColumn("text_key", F.xxhash64("text"))

    def run(batches):
        for big in batches:
            for b in pieces_of(big):
                x = features(raw_texts(b.column(1)))
                offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), b.column(4), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))],
                    names=["doc_id", "host", "path", "text_key", "x"],
                )

    return rows.mapInArrow(run, "doc_id long, host string, path string, text_key long, x array<double>")


def fitted(rows: DataFrame, labels: DataFrame, sample: int) -> Logistic | None:
    """Fit on at most ``sample`` labelled rows of the training folds, chosen by hash."""
    known = rows.where(fold("doc_id", FOLDS) != HELD_OUT).join(labels, "doc_id").select("label", "x", F.xxhash64("doc_id", "text_key").alias("h"), "doc_id", "text_key")
    few = known.where(sampled(F.col("h"), sample, known.count()))
    got = few.orderBy("h", "doc_id", "text_key").limit(sample).select("label", "x").toPandas()  # bounded by ``sample``
    if got["label"].nunique() < 2:
        return None
    return Logistic(np.stack(got["x"].to_numpy()), got["label"].to_numpy().astype("f8"))


def _strength(mean: float, within: float, spread: float, most: float = 1e6) -> float:
    """Pseudo-counts of a beta prior with the given mean whose draws spread as observed
    beyond chance (``spread`` minus ``within``)."""
    extra = spread - within
    return most if extra <= 0 else float(np.clip(mean * (1 - mean) / extra - 1, 1.0, most))


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    label_col: str = "quality",
    threshold: float = 0.5,
    sample: int = 20_000,
) -> DataFrame:
    """One row per document: ``doc_id, text_key`` (hash of the text, with the id the row's
    key), ``held_out, evidence`` (probability from the text alone), ``host_mean,
    site_mean`` (posteriors) and ``score, kept``. Host and path default to the columns
    ``source`` and ``lang``."""
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    rows = checkpointed(with_features(df, id_col, text_col, host, path), "quality-features")
    model = fitted(rows, one_label(labels, label_col), sample)

    def judge(batches):
        for b in batches:
            x = np.array(b.column(4).to_pylist(), "f8").reshape(b.num_rows, len(FEATURES))
            p = np.full(len(x), 0.5) if model is None else model.probability(x)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(p)], names=["doc_id", "host", "path", "text_key", "p"])

    judged = checkpointed(rows.mapInArrow(judge, "doc_id long, host string, path string, text_key long, p double"), "quality-evidence")
    paths = judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("k"), F.sum(F.col("p") * F.col("p")).alias("q"))
    paths = checkpointed(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("k").alias("host_k"), F.sum("q").alias("host_q"))

    def moments(t: DataFrame, n: str, k: str, q: str, centre: Column):
        """Weighted squared distance of group means from their centre, and how much of it
        sampling alone explains."""
        mean = F.col(k) / F.col(n)
        noise = F.greatest(F.col(q) / F.col(n) - mean * mean, F.lit(0.0)) / F.col(n)
        return t.where(F.col(n) > 1).agg(
            F.sum(F.col(n) * (mean - centre) * (mean - centre)) / F.sum(n), F.sum(F.col(n) * noise) / F.sum(n)
        ).first()

    total, good = hosts.agg(F.sum("host_n"), F.sum("host_k")).first()
    mean = float(np.clip((good or 0.0) / (total or 1), 1e-6, 1 - 1e-6))
    spread, within = (x or 0.0 for x in moments(hosts, "host_n", "host_k", "host_q", F.lit(mean)))
    host_strength = _strength(mean, within, spread)
    sites = paths.join(hosts, "host").withColumn("host_mean", (F.col("host_k") + F.lit(host_strength * mean)) / (F.col("host_n") + F.lit(host_strength)))
    spread, within = (x or 0.0 for x in moments(sites, "n", "k", "q", F.col("host_mean")))
    path_strength = F.lit(_strength(mean, within, spread))
    prior = 0.5 if model is None else model.prior

    def logit(c: Column) -> Column:
        c = F.greatest(F.least(c, F.lit(1 - 1e-9)), F.lit(1e-9))
        return F.log(c / (1 - c))

    others = (F.col("host_k") - F.col("p") + F.lit(host_strength * mean)) / (F.col("host_n") - 1 + F.lit(host_strength))
    site = (F.col("k") - F.col("p") + path_strength * F.col("host_mean")) / (F.col("n") - 1 + path_strength)
    odds = logit(F.col("p")) - F.lit(float(np.log(prior / (1 - prior)))) + logit(F.col("site_mean"))
    return (
        judged.join(sites.select("host", "path", "n", "k", "host_n", "host_k"), ["host", "path"])
        .withColumn("host_mean", others)
        .withColumn("site_mean", site)
        .withColumn("score", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id", "text_key", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("p").alias("evidence"),
            "host_mean", "site_mean", "score", (F.col("score") >= threshold).alias("kept"),
        )
    )
