"""Brown class-based n-gram language model.

``P(text) = prod P(class(w) | class(previous)) * P(w | class(w))``, over the words of a
text and one end token, which also opens it and is a class of its own.

1. *Counts.* One pass counts all training words (combined inside each task, then by a
   shuffled sum). The ``lexicon`` most frequent words are a bounded table every task
   holds; all others stay a distributed table and are joined by word when scoring.
2. *Classes.* Words of the lexicon that occur at least ``least`` times are exchanged one
   by one; only words too rare to move go with the words of their ending (``pools`` pools
   by a hash of the last three bytes), and so do those beyond the lexicon. Exchange clustering moves such a unit to the class that raises the
   likelihood of the class bigrams most. The unit bigram table (all training bigrams) is
   turned into a list of neighbours per unit once; each round sums the lists by class,
   rates all moves in parallel against the class matrix, and moves half the units, chosen by hash, as in
   distributed exchange (Uszkoreit and Brants, 2008); the best round is kept. Neighbours
   travel and rest packed, a bucket of units a row, so a round reads arrays, not rows.
3. *Probabilities.* Class transitions interpolate bigram and unigram class counts;
   emissions add one to each word and keep one share per class for unseen words, so
   unknown words get their pool's class and a share of it.
4. *Scores.* What needs only the bounded tables is summed in the scan; the logarithms
   of rarer words' counts are joined by word and summed by document.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` is in
fold 0 (training); repeated rows count and are scored each; with no training text every
count is zero and every base probability one; an empty table gives no rows; other
columns are ignored; equal counts order by word, equal gains by class number.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import blocks_of, documents, fold, lower_words, raw_texts
from quire.plans.materialize import checkpointed

FOLDS, HELD_OUT = 7, 2
BLOCK = 2 << 20  # bytes of text whose words a task holds as objects


@dataclass(frozen=True)
class Settings:
    lexicon: int = 131_072  # words whose counts every task holds
    singles: int = 131_072  # words exchanged one by one, of the lexicon
    least: int = 4  # times such a word occurs
    pools: int = 512  # units for the endings of all other words
    classes: int = 64  # including the end token's
    rounds: int = 8
    weight: float = 16.0  # of the unigram class distribution in a transition


def _count_words(train: DataFrame, most: int = 250_000) -> DataFrame:
    """``word, n`` over the texts of ``train`` (end tokens are counted by rows)."""
    from collections import Counter

    def run(batches):
        counts: Counter = Counter()
        for big in batches:
            for b in blocks_of(big, size=BLOCK):
                for raw in raw_texts(b.column(1)):
                    counts.update(lower_words(raw))
                if len(counts) > most:
                    yield pa.RecordBatch.from_pydict({"word": pa.array(counts, pa.binary()), "n": pa.array(counts.values(), pa.int64())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"word": pa.array(counts, pa.binary()), "n": pa.array(counts.values(), pa.int64())})

    parts = train.mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent words, ties by word. Words too rare to be among them
    (by the numbers of words of each count up to 2**16) go first, so that tasks don't each
    send ``most`` candidates to the driver."""
    low = F.least("n", F.lit(1 << 16)).alias("low")
    sizes = sorted((tuple(r) for r in words.groupBy(low).count().collect()), reverse=True)  # at most 2**16 rows
    have, least = 0, 0
    for n, k in sizes:
        have, least = have + k, n
        if have >= most:
            break
    return words.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most)


class Lexicon:
    """The bounded word table of a task: numbers, counts and units. The end token has
    number ``len(words)`` and unit 0."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, settings: Settings):
        self.number = {w: i for i, w in enumerate(words)}
        self.counts = np.array([*counts, ends], "f8")
        self.settings = settings
        self.singles = sum(n >= settings.least for n in counts[: settings.singles])  # counts fall
        units = [i + 1 if i < self.singles else self.pool(w) for i, w in enumerate(words)]
        self.units = np.array([*units, 0], "i4")

    def pool(self, word: bytes) -> int:
        return 1 + self.singles + crc32(word[-3:]) % self.settings.pools

    @property
    def n_units(self) -> int:
        return 1 + self.singles + self.settings.pools

    def read(self, raws: list[bytes]):
        """Numbers (-1: not in the table), units, text starts, and the other words, of the
        texts laid end to end, each closed by the end token."""
        get, end = self.number.get, len(self.number)
        numbers, rare, starts = [], [], []
        for raw in raws:
            starts.append(len(numbers))
            words = lower_words(raw)
            got = [get(w, -1) for w in words]
            if -1 in got:
                rare += [w for w, g in zip(words, got) if g < 0]
            numbers += got
            numbers.append(end)
        num = np.array(numbers, "i4")
        units = self.units[num]
        units[num < 0] = [self.pool(w) for w in rare]
        return num, units, np.array(starts, "i8"), rare


PACKED = "bucket int, pairs int, places binary, beside binary, n binary"


@dataclass(frozen=True)
class Places:
    """How units are dealt over buckets: unit ``u`` is number ``u // buckets`` of bucket
    ``u % buckets``, so units of like frequency go to different buckets. A neighbour is
    ``2 x other + side``: 0 it follows the unit, 1 it precedes it. A unit that follows
    itself stands once. At most ``2 x units`` neighbours a unit bound every bucket."""

    units: int
    buckets: int

    @staticmethod
    def for_tokens(units: int, tokens: int) -> Places:
        return Places(units, int(min(8192, max(64, tokens >> 21))))

    @property
    def each(self) -> int:
        return -(-self.units // self.buckets)

    def keys(self, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (place and neighbour) and counts of bigrams, seen from both units."""
        u, v = u.astype("i8"), v.astype("i8")
        two = u != v
        unit = np.concatenate((u, v[two]))
        beside = np.concatenate((2 * v, 2 * u[two] + 1))
        keys = (unit % self.buckets * self.each + unit // self.buckets) * (2 * self.units) + beside
        return summed(keys, np.concatenate((n, n[two])))

    def packed(self, keys: np.ndarray, n: np.ndarray, most: int = 1 << 20):
        """Rows of ``PACKED``, a bucket each; buckets of more than ``most`` pairs in several
        rows, cut between units."""
        for bucket, at, to in self._cuts(keys, most):
            place, beside = np.divmod(keys[at:to], 2 * self.units)
            parts = np.diff(place, prepend=0).astype("<i4"), beside.astype("<i4"), n[at:to].astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([to - at], pa.int32()), *(pa.array([pa.compress(x.tobytes(), "zstd", asbytes=True)], pa.binary()) for x in parts)],
                names=["bucket", "pairs", "places", "beside", "n"],
            )

    def _cuts(self, keys: np.ndarray, most: int):
        place = keys // (2 * self.units)
        first = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(keys))  # of every unit
        bucket = place[first[:-1]] // self.each
        i = 0
        while i < len(bucket):
            j = int(min(np.searchsorted(bucket, bucket[i], "right"), max(i + 1, np.searchsorted(first, first[i] + most, "right") - 1)))
            yield int(bucket[i]), int(first[i]), int(first[j])
            i = j

    def read(self, batch):
        """``bucket, place, beside, n`` of every row of a batch of ``PACKED``."""
        for r in batch.to_pylist():
            size = r["pairs"]
            place, beside, n = (np.frombuffer(pa.decompress(r[c], size * w, "zstd"), t) for c, w, t in (("places", 4, "<i4"), ("beside", 4, "<i4"), ("n", 8, "<i8")))
            yield r["bucket"], np.cumsum(place, dtype="i8"), beside, n

    def unit(self, place: np.ndarray) -> np.ndarray:
        return place % self.each * self.buckets + place // self.each


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


def _neighbours(parts: DataFrame, places: Places, most: int = 4_000_000) -> DataFrame:
    """Neighbours of all units: rows of ``PACKED`` of many tasks, dealt by bucket and added
    up, every unit's in one row. A task holds one bucket's sums and ``most`` pairs more."""

    def run(batches):
        now, held, size = None, [], 0

        def total():
            return summed(*(np.concatenate(x) for x in zip(*held)))

        for b in batches:
            for bucket, place, beside, n in places.read(b):
                if bucket != now and held:
                    yield from places.packed(*total())
                    held, size = [], 0
                now = bucket
                held.append((place * (2 * places.units) + beside, n))
                size += len(n)
                if size > most and len(held) > 1:
                    held, size = [total()], 0
        if held:
            yield from places.packed(*total())

    dealt = parts.repartition("bucket").sortWithinPartitions("bucket")
    return checkpointed(dealt.mapInArrow(run, PACKED), "unit-neighbours")


def _text_neighbours(train: DataFrame, lexicon: Lexicon, places: Places, most: int = 1_000_000) -> DataFrame:
    """Neighbours in the training texts, summed in the task up to ``most`` distinct bigrams and
    packed in a few rows a bucket, so that no row of the shuffle is a single bigram. Words
    are read block by block; a block's keys are summed before the next is read."""

    def run(batches):
        keys, counts = np.empty(0, "i8"), np.empty(0, "i8")
        for big in batches:
            for b in blocks_of(big, size=BLOCK):
                _, units, _, _ = lexicon.read(raw_texts(b.column(1)))
                before = np.concatenate(([0], units[:-1]))  # each text is closed by unit 0, which opens the next
                k, n = np.unique(before.astype("i8") * places.units + units, return_counts=True)
                keys, counts = summed(np.concatenate((keys, k)), np.concatenate((counts, n)))
                if len(keys) > most:
                    yield from places.packed(*places.keys(keys // places.units, keys % places.units, counts))
                    keys, counts = keys[:0].copy(), counts[:0].copy()
            pa.default_memory_pool().release_unused()
        if len(keys):
            yield from places.packed(*places.keys(keys // places.units, keys % places.units, counts))

    return _neighbours(train.mapInArrow(run, PACKED), places)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def gains(own: int, after: np.ndarray, before: np.ndarray, itself: float, matrix: np.ndarray) -> np.ndarray:
    """Change of the likelihood for moving a unit to each class. ``after[c]``,
    ``before[c]``: how often class c follows, precedes the unit (other units only);
    ``itself``: how often the unit follows itself."""
    left = matrix.copy()
    left[own] -= after
    left[:, own] -= before
    left[own, own] -= itself
    rows, cols = left.sum(1) + before, left.sum(0) + after  # the unit's neighbours keep their classes
    out, into = after.sum() + itself, before.sum() + itself
    # Adding the unit to class c changes row c, column c and their crossing.
    row_gain = (_xlogx(left + after) - _xlogx(left)).sum(1)
    col_gain = (_xlogx(left + before[:, None]) - _xlogx(left)).sum(0)
    d = np.diagonal(left)
    crossing = _xlogx(d + after + before + itself) - _xlogx(d) - (_xlogx(d + after) - _xlogx(d)) - (_xlogx(d + before) - _xlogx(d))
    total = row_gain + col_gain + crossing - (_xlogx(rows + out) - _xlogx(rows)) - (_xlogx(cols + into) - _xlogx(cols))
    return total - total[own]


def all_gains(own: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """``gains`` of many units, a row each; only classes beside a unit are added up."""
    every = np.arange(len(own))

    def beside(m, near, far):
        """What adding ``near`` to each class's row of ``m`` changes, the unit taken out."""
        u, j = np.nonzero(near)
        add, left = near[u, j], m.T[j]
        at = np.flatnonzero(own[u] == j)
        left[at] -= far[u[at]]
        left[np.arange(len(u)), own[u]] -= add
        left[at, own[u[at]]] -= itself[u[at]]
        out = np.zeros(near.shape)
        if len(u):
            starts = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
            out[u[starts]] = np.add.reduceat(_xlogx(left + add[:, None]) - _xlogx(left), starts)
        return out

    out, into = (after.sum(1) + itself)[:, None], (before.sum(1) + itself)[:, None]
    rows, cols, d = (np.tile(x, (len(own), 1)) for x in (matrix.sum(1), matrix.sum(0), np.diagonal(matrix)))
    rows[every, own] -= out[:, 0]
    cols[every, own] -= into[:, 0]
    d[every, own] -= after[every, own] + before[every, own] + itself
    crossing = _xlogx(d + after + before + itself[:, None]) - _xlogx(d + after) - _xlogx(d + before) + _xlogx(d)
    total = beside(matrix, after, before) + beside(matrix.T, before, after) + crossing
    total -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(cols + into) - _xlogx(cols)
    return total - total[every, own][:, None]


def _class_matrix(lists: DataFrame, places: Places, classes: np.ndarray, n: int) -> np.ndarray:
    def run(batches):
        total = np.zeros(n * n)
        for b in batches:
            for _, place, beside, k in places.read(b):
                after = beside & 1 == 0  # each bigram once
                total += np.bincount(classes[places.unit(place[after])].astype("i8") * n + classes[beside[after] >> 1], k[after], n * n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": at.astype("i4"), "n": total[at].astype("i8")})

    out = np.zeros(n * n)
    for r in lists.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # n x n rows at most
        out[r.at] = r.n
    return out.reshape(n, n)


def _half(unit: np.ndarray, step: int) -> np.ndarray:
    """Whether a unit may move in a round: a bit of a multiplicative hash."""
    h = (unit.astype("u8") + np.uint64(step << 32)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)) & np.uint64(1) == 0


def exchange(bigrams: DataFrame, settings: Settings, units: int) -> tuple[np.ndarray, np.ndarray]:
    """``exchange_lists`` of a table ``u, v, n``: how often unit v follows unit u."""
    places = Places.for_tokens(units, 0)

    def run(batches):
        for b in batches:
            yield from places.packed(*places.keys(*(c.to_numpy() for c in b.columns)))

    return exchange_lists(_neighbours(bigrams.select("u", "v", "n").mapInArrow(run, PACKED), places), settings, places)


def exchange_lists(lists: DataFrame, settings: Settings, places: Places) -> tuple[np.ndarray, np.ndarray]:
    """Class of every unit (unit 0, the end token, keeps class 0 to itself) and the class
    bigram counts. Tables on the driver have a row per unit or class, both bounded."""
    n = settings.classes
    classes = (1 + np.arange(places.units) % (n - 1)).astype("i4")
    classes[0] = 0
    best, best_matrix, best_value = classes, None, -np.inf
    for step in range(settings.rounds + 1):
        matrix = _class_matrix(lists, places, classes, n)
        value = likelihood(matrix)
        if value > best_value:
            best, best_matrix, best_value = classes, matrix, value
        if step == settings.rounds or not matrix.any():
            break
        now = classes

        def rate(batches, now=now, matrix=matrix, step=step):
            for big in batches:
                for _, place, beside, k in places.read(big):
                    whose = places.unit(place)
                    mine = (whose > 0) & _half(whose, step)
                    whose, beside, k = whose[mine], beside[mine], k[mine]
                    starts = np.append(np.flatnonzero(np.diff(whose, prepend=-1)), len(whose))
                    for i in range(0, len(starts) - 1, 256):
                        edge = starts[i : i + 257]
                        at = slice(edge[0], edge[-1])
                        unit, row = whose[edge[:-1]], np.repeat(np.arange(len(edge) - 1), np.diff(edge))
                        other, side = beside[at] >> 1, beside[at] & 1
                        loop = other == unit[row]
                        sides = np.bincount((row * 2 + side) * n + now[other], k[at] * ~loop, len(unit) * 2 * n).reshape(-1, 2, n)
                        g = all_gains(now[unit], sides[:, 0], sides[:, 1], np.bincount(row, k[at] * loop, len(unit)), matrix)
                        g[:, 0] = -np.inf
                        to = g.argmax(1).astype("i4")
                        moved = g.max(1) > 1e-9
                        yield pa.RecordBatch.from_pydict({"unit": unit[moved].astype("i4"), "c": to[moved]})

        classes = classes.copy()
        for r in lists.mapInArrow(rate, "unit int, c int").collect():
            classes[r.unit] = r.c
        if (classes == now).all():
            break
    return best, best_matrix


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10 probabilities) and ``perplexity`` per token."""
    docs = documents(df, id_col, text_col)
    train = docs.where(fold("doc_id", FOLDS) != HELD_OUT)
    words = checkpointed(_count_words(train), "words")
    ends = train.count()
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = total + ends, distinct + (ends > 0)
    top = most_frequent(words, settings.lexicon).collect()  # bounded by the setting
    lexicon = Lexicon([bytes(r.word) for r in top], [r.n for r in top], ends, settings)

    places = Places.for_tokens(lexicon.n_units, total)
    classes, matrix = exchange_lists(_text_neighbours(train, lexicon, places), settings, places)
    n = settings.classes
    class_of_unit = classes.astype("i4")

    # Words and tokens of each class; words that aren't single go by their pool.
    singles = {bytes(r.word): i + 1 for i, r in enumerate(top[: lexicon.singles])}
    spark = df.sparkSession
    single = spark.createDataFrame([(bytearray(w), int(class_of_unit[u])) for w, u in singles.items()], "word binary, single int")
    pool_class = F.array(*[F.lit(int(c)) for c in class_of_unit[1 + lexicon.singles :]])
    ending = F.expr("substring(word, greatest(length(word) - 2, 1), 3)")
    pool = F.element_at(pool_class, (F.crc32(ending) % settings.pools + 1).cast("int"))
    sizes = (
        words.join(F.broadcast(single), "word", "left").groupBy(F.coalesce("single", pool).alias("c"))
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    )  # fmt: skip  a row per class
    tokens, types = np.zeros(n), np.zeros(n)
    for r in sizes:
        tokens[r.c], types[r.c] = r.n, r.v
    tokens[0], types[0] = ends, 0
    matrix = np.zeros((n, n)) if matrix is None else matrix
    unigram = (tokens + 1) / (tokens.sum() + n)
    transition = np.log10((matrix + settings.weight * unigram) / (matrix.sum(1, keepdims=True) + settings.weight))
    share = np.log10(tokens + types + 1)
    share[0] = np.log10(ends + 1)  # the end token is its class: probability one
    base_share = np.log10(total + distinct + 1)

    def run(batches):
        for big in batches:
            for b in blocks_of(big, size=BLOCK, column=2):
                num, units, starts, rare = lexicon.read(raw_texts(b.column(2)))
                c = class_of_unit[units]
                before = np.concatenate(([0], c[:-1]))
                known = np.log10(np.where(num < 0, 0.0, lexicon.counts[num]) + 1)
                step = transition[before, c] + known - share[c]
                text = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(num))))
                n_tokens = np.bincount(text, minlength=len(starts))
                n_rare = np.bincount(text[num < 0], minlength=len(starts))
                offsets = pa.array(np.concatenate(([0], np.cumsum(n_rare))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n_tokens, pa.int64()),
                     pa.array(np.bincount(text, (num >= 0) & (lexicon.counts[num] > 0), len(starts)).astype("i8")),
                     pa.array(np.bincount(text, known, len(starts)) - n_tokens * base_share),
                     pa.array(np.bincount(text, step, len(starts))),
                     pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary()))],
                    names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare"],
                )

    local = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        run, "row long, doc_id long, n_tokens long, n_known long, base double, score double, rare array<binary>"
    )
    local = checkpointed(local, "scores")
    rare = (
        local.select("row", F.explode("rare").alias("word")).groupBy("row", "word").count()
        .join(words, "word").groupBy("row").agg(F.sum(F.col("count") * F.log10(F.col("n") + 1)).alias("logs"), F.sum("count").alias("more"))
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return local.join(rare, "row", "left").select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
        F.pow(F.lit(10.0), -(F.col("score") + logs) / F.col("n_tokens")).alias("perplexity"),
    )
