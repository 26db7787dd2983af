"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

1. *Lexicon.* In half of all labelled training texts, document counts of words and word
   beginnings by label (combined per task, then summed); those far more frequent in
   toxic texts, by smoothed log-odds, are the lexicon: at most ``lexicon`` entries, in a
   strong and a weak tier. It is learned in any language; labels, language, source and
   id are never inputs of a score. Ids and hashes are joined with the labels and sent to
   the texts, at most ``ids_a_pass`` at once, so texts are never shuffled.
2. *Features*, one pass over whole texts: densities and counts of lexicon words per tier,
   hits that only show after undoing obfuscation (digits and signs for letters, letters
   spaced by signs), hits of either tier near second-person words, capitals of any
   script, all marks, all signs that stand for letters or space them, lengths.
3. *Trees* of bounded depth fitted to the log loss on quantile bins, on a quarter of the
   texts that the lexicon hasn't seen.
4. *Calibration* by isotonic regression on the last quarter, which neither has seen.
   Trees and calibration together take at most ``sample`` of the labelled training rows
   that have a document, chosen by hash.

Texts, not rows, are dealt to the parts, so copies of a text stay in one part.

Defined results: a null or empty text has the features of no words and is scored like
any other; labels that are null or contradict each other for an id are not learned from;
without both labels in every part the score is the share of toxic training rows (0 if
there are none); a null ``doc_id`` is in fold 0 and has no label; repeated rows are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import documents, fold, pieces_of, raw_texts, sampled
from quire.llm.site_bayes import one_label
from quire.plans.materialize import checkpointed

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
FEATURES = (
    "strong_density", "strong_hits", "strong_kinds", "weak_density", "weak_hits", "highest", "hidden_hits", "hidden_density",
    "near_second_person", "second_person", "capitals", "shouted_words", "marks", "exclamations", "signs_in_words", "log_words",
)

# Second-person words, lower case.
SECOND_PERSON = {w.encode() for w in "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vos".split()}

# Signs that stand for letters in disguised words, and that space them.
AS_LETTERS, SPACING = b"0134578@$!", b".-_*'+~^#%&"
DISGUISE = bytes.maketrans(AS_LETTERS, b"oieastbasi")
MARKS = b".,;:!?\"'()[]{}<>-_*#%&/\\|~`+=^"
BEGINNINGS = (4, 5, 6)
NEAR = 5
ORDINARY = b".-'!"  # signs that disguise only between letters

_UPPER, _LOWER, _MARK, _SIGN = range(4)
_CLASSES = np.zeros((256, 4), "f8")
for _chars, _col in ((range(ord("A"), ord("Z") + 1), _UPPER), (range(ord("a"), ord("z") + 1), _LOWER), (MARKS, _MARK), (set(AS_LETTERS + SPACING) - set(ORDINARY), _SIGN)):
    _CLASSES[list(_chars), _col] = 1
_LETTER = (_CLASSES[:, _UPPER] + _CLASSES[:, _LOWER] > 0) | (np.arange(256) >= 128)
_BETWEEN = np.isin(np.arange(256), list(ORDINARY))
_NOT_ASCII = re.compile("[^\x00-\x7f]+")
_PLAIN = (0.0, False, False)


def byte_classes(raw: bytes) -> tuple[float, float, float, float]:
    """How many capitals and small letters (of any script), marks, and signs that stand for
    letters or space them (of ``ORDINARY`` only those between letters) the text has."""
    codes = np.frombuffer(raw, "u1")
    upper, lower, marks, signs = (np.bincount(codes, minlength=256) @ _CLASSES).tolist()
    at = np.flatnonzero(_BETWEEN[codes])
    at = at[(at > 0) & (at < len(codes) - 1)]
    signs += int((_LETTER[codes[at - 1]] & _LETTER[codes[at + 1]]).sum())
    if not raw.isascii():
        for c, n in Counter("".join(_NOT_ASCII.findall(raw.decode("utf-8", "replace")))).items():
            upper += n * (c.isupper() or c.istitle())
            lower += n * c.islower()
    return upper, lower, marks, signs


def shouted(word: bytes) -> bool:
    return word.isupper() if word.isascii() else word.decode("utf-8", "replace").isupper()


def terms(word: bytes):
    """The word and its beginnings (bytes), as lexicon keys."""
    yield word
    for n in BEGINNINGS:
        if len(word) > n:
            yield word[:n] + b"*"


def plain_words(raw: bytes) -> list[bytes]:
    return [w.strip(MARKS) for w in raw.lower().split()]


def undisguised(word: bytes) -> bytes:
    """Signs read as letters, other signs inside the word dropped, long runs shortened."""
    word = word.translate(DISGUISE, SPACING)
    out = bytearray()
    for b in word:
        if len(out) < 2 or out[-1] != b or out[-2] != b:
            out.append(b)
    return bytes(out)


def term_counts(rows: DataFrame, most: int = 150_000) -> DataFrame:
    """``term, toxic, clean``: texts of each label that have the term. ``rows``:
    ``text, label, n``; each of the ``n`` rows of a repeated text counts for one in ``n``."""

    def batch(counts: dict[int, Counter]):
        keys = list(counts[1].keys() | counts[0].keys())
        return pa.RecordBatch.from_pydict({
            "term": pa.array(keys, pa.binary()),
            "toxic": pa.array([counts[1][k] for k in keys], pa.float64()),
            "clean": pa.array([counts[0][k] for k in keys], pa.float64()),
        })

    def run(batches):
        counts = {0: Counter(), 1: Counter()}
        for big in batches:
            for b in pieces_of(big):
                for raw, label, n in zip(raw_texts(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    found = {t for w in set(plain_words(raw)) if w for t in terms(w)}
                    counts[label].update(found if n == 1 else dict.fromkeys(found, 1 / n))
                if len(counts[0]) + len(counts[1]) > most:
                    yield batch(counts)
                    counts = {0: Counter(), 1: Counter()}
        yield batch(counts)

    parts = rows.mapInArrow(run, "term binary, toxic double, clean double")
    return parts.groupBy("term").agg(*[F.round(F.sum(c)).cast("long").alias(c) for c in ("toxic", "clean")])


def all_term_counts(docs: DataFrame, rows: DataFrame, ids_a_pass: int) -> DataFrame:
    """``term_counts`` of every text in ``rows`` (``doc_id, text_key, label, n``). Copies of
    a text would count a word many times over: one id a text and label. Only ids and keys
    reach the tasks, by ranges of their hash, so that none holds many more than
    ``ids_a_pass``."""
    one = checkpointed(rows.groupBy("text_key", "label").agg(F.min_by(F.struct("doc_id", "n"), "doc_id").alias("first")).select(
        "first.doc_id", "text_key", "label", "first.n"), "toxic-texts")
    passes = max(1, -(-one.count() // ids_a_pass))
    turn = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(3)), F.lit(passes))
    counts = []
    for i in range(passes):
        texts = docs.join(F.broadcast(one.where(turn == i)), ["doc_id", "text_key"]).select("text", "label", "n")
        counts.append(term_counts(texts))
        if passes > 1:
            counts[i] = checkpointed(counts[i], f"toxic-terms-{i}")
    if passes == 1:
        return counts[0]
    return reduce(DataFrame.unionByName, counts).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_lexicon(counts: DataFrame, toxic: int, clean: int, least: int, weak: float, most: int) -> dict[bytes, float]:
    """Terms of at least ``least`` toxic texts by log-odds, the ``most`` telling ones. A
    beginning is left out where the word itself explains it."""
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    rows = (
        counts.where(F.col("toxic") >= least).withColumn("odds", odds).where(F.col("odds") >= weak)
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(most).collect()
    )  # fmt: skip  bounded by ``most``
    return {bytes(r.term): float(r.odds) for r in rows}


class Reader:
    """Features of texts under a lexicon."""

    def __init__(self, lexicon: dict[bytes, float], strong: float):
        self.lexicon, self.strong = lexicon, strong
        self.memo: dict[bytes, tuple[float, bool, bool]] = {}

    def weight(self, word: bytes) -> tuple[float, bool, bool]:
        """Highest log-odds of the word's terms (0: none), whether it was hidden, and
        whether it is a second-person word."""
        got = self.memo.get(word)
        if got is None:
            get = self.lexicon.get
            plain = word.strip(MARKS)
            best = max([get(t, 0.0) for t in terms(plain)]) if plain else 0.0
            hidden = False
            if best < self.strong and plain and not plain.isalpha():
                best2 = get(undisguised(word.strip(b".,;:?\"'()")), 0.0)
                hidden = best2 >= self.strong
                best = max(best, best2)
            you = word in SECOND_PERSON or plain in SECOND_PERSON
            got = (best, hidden, you) if best or you else _PLAIN
            if len(self.memo) > 150_000:
                self.memo.clear()
            if len(word) <= 64:
                self.memo[word] = got
        return got

    def features(self, raw: bytes) -> list[float]:
        cased = raw.split()
        words = raw.lower().split()
        memo = self.memo.get
        got = [memo(w) or self.weight(w) for w in words]
        told = [i for i, g in enumerate(got) if g is not _PLAIN]
        hits = [i for i in told if got[i][0]]
        strong = [i for i in hits if got[i][0] >= self.strong]
        hidden = sum(got[i][1] for i in hits)
        you, at = np.array([i for i in told if got[i][2]], "i8"), np.array(hits, "i8")
        near = int((np.searchsorted(you, at - NEAR) < np.searchsorted(you, at + NEAR, side="right")).sum())
        n, size = max(len(words), 1), max(len(raw), 1)
        upper, lower, marks, signs = byte_classes(raw)
        return [
            len(strong) / n, np.log1p(len(strong)), np.log1p(len({words[i] for i in strong})), (len(hits) - len(strong)) / n,
            np.log1p(len(hits) - len(strong)), max([got[i][0] for i in hits], default=0.0), np.log1p(hidden), hidden / n,
            near / n, len(you) / n, upper / max(upper + lower, 1), sum(map(shouted, cased)) / n, marks / n, raw.count(b"!") / n,
            signs / size, np.log1p(len(words)),
        ]


class Trees:
    """Gradient boosting of the log loss with small regression trees on quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 5.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.start = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        binned = self._bins(x)
        f = np.full(len(y), self.start)
        width = bins + 1
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            gradient, curve = y - p, p * (1 - p)
            feature = np.full(2**depth - 1, -1, "i4")
            cut = np.zeros(2**depth - 1, "i4")
            node = np.zeros(len(y), "i8")
            for level in range(depth):
                first, n = 2**level - 1, 2**level
                best = np.full(n, 1e-6)
                for j in range(x.shape[1]):
                    key = (node - first) * width + binned[:, j]
                    g = np.bincount(key, gradient, n * width).reshape(n, width).cumsum(1)
                    h = np.bincount(key, curve, n * width).reshape(n, width).cumsum(1)
                    gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain[(hl < least / 20) | (ht - hl < least / 20)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(n), at]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + n][better] = j
                    cut[first : first + n][better] = at[better]
                node = self._down(binned, feature, cut, node)
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, gradient, 2**depth) / (np.bincount(leaf, curve, 2**depth) + 1)
            f = f + value[leaf]
            self.trees.append((feature, cut, value))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1)

    @staticmethod
    def _down(binned, feature, cut, node):
        j = feature[node]
        right = (j >= 0) & (binned[np.arange(len(node)), np.maximum(j, 0)] > cut[node])
        return 2 * node + 1 + right

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, f = self._bins(x), np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), "i8")
            depth = len(value).bit_length() - 1
            for _ in range(depth):
                node = self._down(binned, feature, cut, node)
            f = f + value[node - (len(value) - 1)]
        return f


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of ``y`` on ``x`` by pooling adjacent violators; knots for
    linear interpolation. Each block's share is drawn in by half a row of each label."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of x, sum of y, rows
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    at = np.array([b[0] / b[2] for b in blocks])
    share = np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks])
    return at, np.maximum.accumulate(share)


class Model:
    def __init__(self, trees: Trees, knots: tuple[np.ndarray, np.ndarray]):
        self.trees, self.knots = trees, knots

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a little of the margin keeps the order inside flat parts."""
        m = self.trees.margin(x)
        return np.clip(0.999 * np.interp(m, *self.knots) + 0.001 / (1 + np.exp(-m)), 0, 1)


def score_toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    sample: int = 40_000,
    lexicon: int = 4096,
    least: int = 2,
    weak: float = 1.5,
    strong: float = 3.0,
    ids_a_pass: int = 1_000_000,
) -> DataFrame:
    """One row per document: ``doc_id, text_key`` (hash of the text, with the id the row's
    key), ``held_out, score, predicted``. ``sample`` bounds the rows that trees and
    calibration learn from; the lexicon counts all labelled training texts."""
    docs = documents(df, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    known = one_label(labels, label_col).where(F.col("label").isin(0, 1)).where(fold("doc_id", FOLDS) != HELD_OUT)
    part = F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(7)), F.lit(4))
    keys = docs.where(F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "text_key", part.alias("part"))
    keys = keys.groupBy("doc_id", "text_key", "part").agg(F.count(F.lit(1)).alias("n"))
    train = checkpointed(keys.join(known, "doc_id"), "toxic-train")  # no texts
    sizes = {(r.part, r.label): r.n for r in train.groupBy("part", "label").agg(F.sum("n").alias("n")).collect()}
    seen = [sum(sizes.get((p, y), 0) for p in (0, 1)) for y in (0, 1)]
    words = choose_lexicon(all_term_counts(docs, train.where("part < 2"), ids_a_pass), seen[1], seen[0], least, weak, lexicon) if all(seen) else {}

    def read(texts: DataFrame, keep: list[str], schema: str, of=None) -> DataFrame:
        """``keep`` and the features ``x``, or what ``of`` makes of them."""

        def run(batches):
            reader = Reader(words, strong)
            for big in batches:
                for b in pieces_of(big, 512):
                    x = np.array([reader.features(t) for t in raw_texts(b.column(0))], "f8").reshape(b.num_rows, len(FEATURES))
                    offsets = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                    last = pa.array(of(x)) if of else pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([*b.columns[1:], last], names=[*keep, "score" if of else "x"])

        return texts.select("text", *keep).mapInArrow(run, schema)

    rows = train.where("part > 1").count()
    order = F.xxhash64("text_key", "doc_id")
    few = train.where("part > 1").where(sampled(order, sample, rows)).orderBy(order, "doc_id", "text_key").limit(sample)  # bounded, so broadcast
    taught = docs.join(F.broadcast(few.drop("n")), ["doc_id", "text_key"])
    taught = read(taught, ["doc_id", "text_key", "label", "part"], "doc_id long, text_key long, label int, part long, x array<double>")
    picked = taught.orderBy(order, "doc_id", "text_key").limit(sample).toPandas()  # bounded by ``sample``
    model, share = None, seen[1] / sum(seen) if sum(seen) else 0.0
    if len(picked):
        x, y, p = np.stack(picked["x"].to_numpy()), picked["label"].to_numpy().astype("f8"), picked["part"].to_numpy()
        if len(set(y[p == 2])) == 2 and len(set(y[p == 3])) == 2:
            trees = Trees(x[p == 2], y[p == 2])
            model = Model(trees, isotonic(trees.margin(x[p == 3]), y[p == 3]))
    judge = (lambda x: np.full(len(x), share)) if model is None else model.score
    scored = read(docs, ["doc_id", "text_key"], "doc_id long, text_key long, score double", judge)
    return scored.select(
        "doc_id", "text_key", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
