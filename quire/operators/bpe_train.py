"""Byte-level BPE training by deltas.

What training knows is kept in three tables below the checkpoint folder:

* *words*: the distinct words as symbol arrays with their counts. Rounds that rewrite many of
  them look at all in place and write the table anew, without a shuffle; once a round has
  rewritten fewer than one in ``WIDE``, the table stays as a base and each round adds a
  layer of rewritten words (the highest version of a word counts);
* *pairs*: the count of every adjacent pair, kept by signed deltas: a round takes the
  pairs of the words it rewrites away as they were and adds them as they are now;
* *postings*: pair → word ids, the inverted index by which a round on layers finds the words
  that hold a pair without looking at the others. Postings are only added; stale ones cost
  a look at a word, and go when layers are folded into a new base.

A round makes as many merges as it can without counting again. With the pairs ranked by
(count desc, left id, right id), the first ``hot`` of them are linked; every word falls into
*chains*, maximal runs of symbols whose neighbours are linked. A merge of a linked pair can
only make pairs whose counts are bounded by those of the pairs around it, so one that is not
inside a chain ranks behind the first pair that is not linked (the cutoff: with equal counts
its ids are larger too, since a new id is larger than all others). So the distinct chains
with their counts, summed by Spark, decide every merge that ranks before the cutoff, in the
order in which counting after each single merge would find them. A merge whose token
exists already ends its round: counts of pairs outside the chains may then grow. ``hot`` is
halved until there are at most ``chains`` distinct chains (each is a run of frequent pairs),
which is all that reaches the driver, and grows again in later rounds; one look at the words
tells how often to halve it.

The rounds' merges are applied inside tasks, to all words of a block at once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import SPECIAL_TOKENS
from quire.operators.vocab import BPEModel, byte_to_unicode
from quire.plans.materialize import checkpointed

SHIFT = 21  # pair key = left << 21 | right (ids stay below 2**21)
LOW = (1 << SHIFT) - 1
WIDE = 32  # a round that rewrites more than this part of the words looks at all of them in place
WORD = "word_id long, version int, sym array<int>, count long"


def flat_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list array, one after the other, and the place where each list begins
    (one more for the end)."""
    ends = np.asarray(lists.offsets).astype("i8")
    return np.asarray(lists.values).astype("i8")[ends[0] : ends[-1]], ends - ends[0]


def list_array(flat: np.ndarray, ends: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()), mask=None if mask is None else pa.array(mask))


def pair_keys(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the adjacent pairs of all words, repeats included, and the place of each pair's
    left symbol."""
    inside = np.ones(max(len(flat) - 1, 0), bool)
    inside[ends[1:-1] - 1] = False  # no pair reaches from a word into the next
    at = np.flatnonzero(inside)
    return flat[at] << SHIFT | flat[at + 1], at


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, with the sum of their ``n``."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def merge_symbols(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Apply the merge of lowest rank (``key: (rank, new id)``), leftmost first, until none is
    left: a heap over a linked list, n log n steps for a word of any length."""
    parts: list[int] = list(symbols)
    n = len(parts)
    heap = [(*m, i) for i in range(n - 1) if (m := merges.get(parts[i] << SHIFT | parts[i + 1]))]
    if not heap:
        return parts
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, new, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] < 0 or j >= n or merges.get(parts[i] << SHIFT | parts[j]) != (rank, new):
            continue  # one of the two was merged meanwhile
        parts[i], parts[j] = new, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x in (before[i], i):
            if x >= 0 and after[x] < n and (m := merges.get(parts[x] << SHIFT | parts[after[x]])):
                heapq.heappush(heap, (*m, x))
    return [p for p in parts if p >= 0]


def merge_words(flat: np.ndarray, ends: np.ndarray, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
    """``merge_symbols`` for all words of a block at once. ``keys``: sorted; ``ranks``: their
    ranks; ``made``: the new id of a rank. A pass merges, in every word, its pair of lowest
    rank at all places; words without one leave. Returns the words that changed (indexes),
    their symbols and sizes. A merge must not make a symbol that a lower rank merges."""
    never = np.iinfo("i8").max

    def ranked(flat, size):
        pairs = flat[:-1] << SHIFT | flat[1:]
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        found = np.full(len(flat), never)
        found[:-1] = np.where(keys[at] == pairs, ranks[at], never)
        found[np.cumsum(size) - 1] = never  # the last symbol of a word
        return found

    size = np.diff(ends)
    which = np.arange(len(size))
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(which[:0], flat[:0], size[:0])]
    untouched = True
    while len(which):
        rank = ranked(flat, size)
        low = np.minimum.reduceat(rank, np.cumsum(size) - size)
        more = low < never
        if not more.all():
            kept = np.repeat(more, size)
            if not untouched:
                done.append((which[~more], flat[~kept], size[~more]))
            which, size, low, flat, rank = which[more], size[more], low[more], flat[kept], rank[kept]
            if not len(which):
                break
        untouched = False
        at = np.flatnonzero(rank == np.repeat(low, size))
        # In a run of one symbol places overlap: every second one, from the left.
        i = np.arange(len(at))
        start = np.maximum.accumulate(np.where(np.concatenate(([True], np.diff(at) != 1)), i, 0))
        at = at[(i - start) % 2 == 0]
        flat[at] = made[rank[at]]
        gone = np.zeros(len(flat), bool)
        gone[at + 1] = True
        size = size - np.add.reduceat(gone, np.cumsum(size) - size, dtype="i8")
        flat = flat[~gone]
    parts = [np.concatenate(x) for x in zip(*done)]
    order = np.argsort(parts[0])
    begin = np.cumsum(parts[2]) - parts[2]
    size = parts[2][order]
    ends = np.concatenate(([0], np.cumsum(size)))
    return parts[0][order], parts[1][np.repeat(begin[order] - ends[:-1], size) + np.arange(ends[-1])], size


def _runs(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of linked symbols start, and their numbers of symbols."""
    edge = np.diff(np.concatenate(([0], linked.astype("i1"), [0])))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start + 1


def _places(flat: np.ndarray, ends: np.ndarray, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For every symbol but the last: the place of its pair with the next among the linked
    ones (``keys`` sorted, ``places`` theirs), or one behind the last."""
    pairs = flat[:-1] << SHIFT | flat[1:]
    at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    place = np.where(keys[at] == pairs, places[at], len(keys))
    place[ends[1:-1] - 1] = len(keys)  # no link from a word to the next
    return place


def _chains(words: DataFrame, hot: np.ndarray) -> DataFrame:
    """``sym, count`` → ``chain, count``: the runs of two and more symbols whose neighbours are
    linked by a pair of ``hot`` (sorted keys), summed."""
    any_place = np.zeros(len(hot), "i8")

    def run(batches):
        for batch in batches:
            flat, ends = flat_lists(batch.column(0))
            if len(flat) < 2:
                continue
            start, size = _runs(_places(flat, ends, hot, any_place) == 0)
            offsets = np.concatenate(([0], np.cumsum(size)))
            at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
            of = np.asarray(batch.column(1))[np.searchsorted(ends, start, "right") - 1]
            yield pa.RecordBatch.from_arrays([list_array(flat[at], offsets), pa.array(of, pa.int64())], names=["chain", "count"])

    cut = words.select("sym", "count").mapInArrow(run, "chain array<int>, count long")
    return cut.groupBy("chain").agg(F.sum("count").alias("count"))


def _most_links(words: DataFrame, ranked: list[int], links: int, chains: int) -> int:
    """How many of the pairs ``ranked`` to link: ``links`` or the first of its halves that has
    about ``chains`` distinct chains at most, by one look at all words. Chains are counted
    by those whose hash a number divides, which leaves a thousand or more of ``chains``; the
    rounds' results don't depend on the choice."""
    levels = [links >> i for i in range(links.bit_length())]
    every = max(1, chains // 1000)
    order = np.argsort(np.array(ranked[:links], "i8"))
    keys = np.array(ranked[:links], "i8")[order]

    def run(batches):
        for batch in batches:
            flat, ends = flat_lists(batch.column(0))
            if len(flat) < 2:
                continue
            place = _places(flat, ends, keys, order)
            for level in levels:
                start, size = _runs(place < level)
                if not len(start):
                    continue
                offsets = np.cumsum(size) - size
                nth = np.arange(int(size.sum())) - np.repeat(offsets, size)
                mixed = _mixed(flat[np.repeat(start, size) + nth].astype("u8") << np.uint64(32) | nth.astype("u8"))
                found = np.unique(_mixed(np.add.reduceat(mixed, offsets)))
                found = found[found % np.uint64(every) == 0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), level), pa.int32()), pa.array(found.view("i8"), pa.int64())], names=["level", "chain"])

    seen = words.select("sym").mapInArrow(run, "level int, chain long").distinct().groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    n = {r.level: r.n * every for r in seen.collect()}  # a row a level
    return next((x for x in levels if n.get(x, 0) <= chains * (1 if every == 1 else 0.9)), 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The bits of unsigned 64-bit numbers mixed (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def decide(chains: list[tuple[list[int], int]], cutoff: tuple[int, int] | None, room: int, least: int, vocab: list[str], index: dict[str, int]):
    """The next merges ``(left, right, id)`` in order, from the chains alone: those that rank
    before ``cutoff`` (count, key). ``vocab`` and ``index`` get the new tokens."""
    words = [list(c) for c, _ in chains]
    weight = [n for _, n in chains]
    counts: dict[int, int] = {}
    where: dict[int, set[int]] = {}
    for i, w in enumerate(words):
        for a, b in zip(w, w[1:]):
            k = a << SHIFT | b
            counts[k] = counts.get(k, 0) + weight[i]
            where.setdefault(k, set()).add(i)
    heap = [(-n, k) for k, n in counts.items()]
    heapq.heapify(heap)
    out: list[tuple[int, int, int]] = []
    while heap and len(out) < room:
        n, key = heapq.heappop(heap)
        if counts.get(key) != -n:
            continue  # its count has changed; the present one is in the heap too
        if -n < least or (cutoff is not None and (n, key) >= (-cutoff[0], cutoff[1])):
            break
        a, b = key >> SHIFT, key & LOW
        token = vocab[a] + vocab[b]
        known = token in index
        if not known:
            index[token] = len(vocab)
            vocab.append(token)
        new = index[token]
        out.append((a, b, new))
        if known:
            break
        changed: set[int] = set()
        for i in where.pop(key):
            old, c = words[i], weight[i]
            now: list[int] = []
            j = 0
            while j < len(old):
                if j + 1 < len(old) and old[j] == a and old[j + 1] == b:
                    now.append(new)
                    j += 2
                else:
                    now.append(old[j])
                    j += 1
            for x, y in zip(old, old[1:]):
                k = x << SHIFT | y
                counts[k] -= c
                changed.add(k)
            for x, y in zip(now, now[1:]):
                k = x << SHIFT | y
                counts[k] = counts.get(k, 0) + c
                changed.add(k)
                where.setdefault(k, set()).add(i)
            words[i] = now
        for k in changed:
            if counts[k] > 0:
                heapq.heappush(heap, (-counts[k], k))
    return out


class TrainingTables:
    """The words, pairs and postings of one training; see the module's docstring."""

    def __init__(self, words: DataFrame, least: int):
        """``words(sym, count)``: distinct words of two symbols and more."""
        self.spark, self.least = words.sparkSession, least
        self._fold(words.select(F.monotonically_increasing_id().alias("word_id"), F.lit(0).alias("version"), "sym", "count"))
        self.pairs = checkpointed(self._counted(self.layers[0], {"sym": 1}), "bpe-pairs")
        self.version, self.touched, self.wide = 0, [], True

    @staticmethod
    def _counted(words: DataFrame, signs: dict[str, int]) -> DataFrame:
        """``key, n``: the pairs of the symbol columns, their counts taken by the columns' signs."""

        def run(batches):
            for batch in batches:
                n = np.asarray(batch.column(0))
                found = []
                for i, sign in enumerate(signs.values(), 1):
                    flat, ends = flat_lists(batch.column(i))
                    keys, at = pair_keys(flat, ends)
                    found.append((keys, np.repeat(n, np.diff(ends))[at] * sign))
                keys, sums = summed(*(np.concatenate(x) for x in zip(*found)))
                yield pa.RecordBatch.from_arrays([pa.array(keys[sums != 0], pa.int64()), pa.array(sums[sums != 0], pa.int64())], names=["key", "n"])

        return words.select("count", *signs).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))

    def _fold(self, words: DataFrame) -> None:
        base = checkpointed(words, "bpe-words")
        self.layers, self.size, self.extra = [base], base.count(), 0
        self.postings: list[DataFrame] = []

    @staticmethod
    def _posted(words: DataFrame, new: list[int] | None = None) -> DataFrame:
        """Postings of the pairs (with ``new``: of those that hold one of these symbols) sorted
        by pair, so that a scan for some pairs skips most row groups."""
        fresh = None if new is None else np.array(sorted(new), "i8")

        def run(batches):
            for batch in batches:
                flat, ends = flat_lists(batch.column(1))
                keys, at = pair_keys(flat, ends)
                word = np.repeat(np.arange(batch.num_rows), np.diff(ends))[at]
                if fresh is not None:
                    hit = np.isin(flat, fresh)
                    hit = hit[at] | hit[at + 1]
                    keys, word = keys[hit], word[hit]
                order = np.lexsort((word, keys))
                keys, word = keys[order], word[order]
                once = np.concatenate(([True], (keys[1:] != keys[:-1]) | (word[1:] != word[:-1])))[: len(keys)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[once], pa.int64()), batch.column(0).take(pa.array(word[once]))], names=["key", "word_id"])

        return checkpointed(words.select("word_id", "sym").mapInArrow(run, "key long, word_id long").sortWithinPartitions("key"), "bpe-postings")

    def words_with(self, keys: list[int]) -> DataFrame:
        """The present form of the words that hold (or once held) one of ``keys``, others not
        excluded: of all words while rounds rewrite many of them."""
        if self.wide:
            return self.layers[0]
        if not self.postings:
            self.postings = [self._posted(self.layers[0])]
        wanted = F.broadcast(self.spark.createDataFrame(pa.table({"key": pa.array(keys, pa.int64())})))  # at most ``hot`` rows
        span = F.col("key").between(min(keys), max(keys))
        ids = [p.where(span).join(wanted, "key", "left_semi").select("word_id") for p in self.postings]
        found = ids[0]
        for more in ids[1:]:
            found = found.unionAll(more)
        found = found.distinct()
        rows = self.layers[0].join(found, "word_id", "left_semi")
        if len(self.layers) == 1:
            return rows
        for layer in self.layers[1:]:
            rows = rows.unionAll(layer.select(*rows.columns).join(found, "word_id", "left_semi"))
        return self._latest(rows)

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        last = rows.groupBy("word_id").agg(F.max_by(F.struct("version", "sym", "count"), "version").alias("w"))
        return last.select("word_id", "w.version", "w.sym", "w.count")

    def ranked(self, n: int) -> list[tuple[int, int]]:
        """The first ``n`` pairs that occur often enough: ``(count, key)``."""
        top = self.pairs.where(F.col("n") >= self.least).orderBy(F.desc("n"), "key").limit(n)
        return sorted(((r.n, r.key) for r in top.collect()), key=lambda p: (-p[0], p[1]))

    def apply(self, merges: list[tuple[int, int, int]]) -> None:
        """Rewrite the words that hold a merged pair; keep pairs and postings by deltas."""
        self.version += 1
        version, wide = self.version, self.wide
        ranks = {a << SHIFT | b: (r, new) for r, (a, b, new) in enumerate(merges)}
        keys = np.array(sorted(ranks), "i8")
        places, made = np.array([ranks[int(k)][0] for k in keys], "i8"), np.array([new for _, _, new in merges], "i8")
        # Only the last merge can make a token that was there before, and so a part of another.
        tangled = any(merges[-1][2] in (a, b) for a, b, _ in merges)

        def rewritten(flat, ends):
            if not tangled:
                return merge_words(flat, ends, keys, places, made)
            old = [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
            now = [merge_symbols(w, ranks) for w in old]
            hit = [i for i, (a, b) in enumerate(zip(old, now)) if len(a) != len(b)]
            return np.array(hit, "i8"), np.array([x for i in hit for x in now[i]], "i8"), np.array([len(now[i]) for i in hit], "i8")

        def rewrite(batches):
            for batch in batches:
                flat, ends = flat_lists(batch.column(1))
                hit, now, size = rewritten(flat, ends)
                at, offsets = pa.array(hit, pa.int64()), np.concatenate(([0], np.cumsum(size)))
                names = ["word_id", "version", "sym", "count", "old"]
                kept = batch.take(at)
                yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(np.full(len(hit), version), pa.int32()), list_array(now, offsets), kept.column(2), kept.column(1)], names=names)
                if wide:  # words of one symbol hold no pair and aren't needed any more
                    rest = np.diff(ends) > 1
                    rest[hit] = False
                    kept = batch.take(pa.array(np.flatnonzero(rest)))
                    n = kept.num_rows
                    yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(np.full(n, version), pa.int32()), kept.column(1), kept.column(2), pa.nulls(n, kept.column(1).type)], names=names)

        found = self.words_with([int(k) for k in keys]).select("word_id", "sym", "count")
        table = checkpointed(found.mapInArrow(rewrite, WORD + ", old array<int>"), "bpe-words" if wide else "bpe-layer")
        layer = table.where(F.col("old").isNotNull())
        pairs = self.pairs.unionAll(self._counted(layer, {"old": -1, "sym": 1})).groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
        self.pairs = checkpointed(pairs, "bpe-pairs")
        n = layer.count()
        self.touched.append(n)
        if wide:
            self.layers = [table.drop("old")]
            self.wide = n * WIDE > self.size
            return
        self.layers.append(layer)
        self.extra += n
        if 2 * self.extra > self.size or len(self.layers) > 8:
            rows = self.layers[0]
            for x in self.layers[1:]:
                rows = rows.unionAll(x.select(*rows.columns))
            self._fold(self._latest(rows).where(F.size("sym") > 1))
        else:
            self.postings.append(self._posted(layer, [new for _, _, new in merges]))


def _word_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
    """The UTF-8 bytes of a batch's words (column 0), where each begins, and the batch without
    null words."""
    batch = batch.filter(batch.column(0).is_valid())
    words = batch.column(0).cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, "u1"), np.zeros(1, "i8"), batch
    ends = np.frombuffer(words.buffers()[1], "i8", len(words) + 1, words.offset * 8)
    data = words.buffers()[2]
    flat = np.zeros(0, "u1") if data is None else np.frombuffer(data, "u1")[ends[0] : ends[-1]]
    return flat, ends - ends[0], batch


def _bytes_seen(words: DataFrame) -> list[int]:
    """The byte values that occur in ``words(word)``, sorted: at most 256."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_word_bytes(batch)[0]), pa.int32())], names=["b"])

    return sorted(r.b for r in words.select("word").mapInArrow(run, "b int").distinct().collect())


def _symbols(words: DataFrame, lookup: list[int]) -> DataFrame:
    """``word, count`` → ``sym, count``: the words of two bytes and more as symbols."""
    table = np.array(lookup, "i4")

    def run(batches):
        for batch in batches:
            flat, ends, batch = _word_bytes(batch)
            long_enough = pa.array(np.diff(ends) > 1)
            yield pa.RecordBatch.from_arrays([list_array(table[flat], ends).filter(long_enough), batch.column(1).filter(long_enough)], names=["sym", "count"])

    return words.select("word", F.col("count").cast("long").alias("count")).mapInArrow(run, "sym array<int>, count long")


def train_bpe(
    spark: SparkSession,
    words: DataFrame,
    vocab_size: int,
    min_frequency: int = 2,
    specials: list[str] | None = None,
    hot: int = 4096,
    chains: int = 50_000,
    full_alphabet: bool = False,
) -> BPEModel:
    """``words(word, count)`` (byte-level pieces) → trained model.

    Ids: special tokens first, then the byte alphabet seen in the sample ordered by code
    point of its byte-level character, then merges. Ties between equal counts go to the
    smaller (left id, right id). The model's ``rounds`` and ``touched`` (words rewritten, a
    round) say what it took."""
    specials = list(SPECIAL_TOKENS if specials is None else specials)
    b2u = byte_to_unicode()
    present = list(range(256)) if full_alphabet else _bytes_seen(words)
    alphabet = sorted(present, key=lambda b: ord(b2u[b]))
    vocab = specials + [b2u[b] for b in alphabet]
    index = {t: i for i, t in enumerate(vocab)}
    lookup = [index.get(b2u[b], -1) for b in range(256)]
    tables = TrainingTables(_symbols(words, lookup), max(1, min_frequency))
    merges: list[tuple[str, str]] = []
    rounds, links = 0, max(1, hot)
    while len(vocab) < vocab_size:
        top = tables.ranked(links + 1)
        if not top:
            break
        rounds += 1
        links = min(links, len(top))
        if rounds == 1 or links < hot:
            links = _most_links(tables.words_with([k for _, k in top[:links]]), [k for _, k in top], links, chains)
        while True:
            linked, cutoff = top[:links], top[links] if links < len(top) else None
            keys = np.sort(np.array([k for _, k in linked], "i8"))
            found = _chains(tables.words_with([int(k) for k in keys]), keys)
            rows = (found if links == 1 else found.limit(chains + 1)).collect()
            if links == 1 or len(rows) <= chains:
                break
            links = max(1, links // 2)
        made = decide([(r.chain, r["count"]) for r in rows], cutoff, vocab_size - len(vocab), tables.least, vocab, index)
        merges += [(vocab[a], vocab[b]) for a, b, _ in made]
        tables.apply(made)
        links = min(hot, 4 * links)
    model = BPEModel(vocab, merges, specials)
    model.rounds, model.touched = rounds, tables.touched  # type: ignore[attr-defined]
    return model
