"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document. A word is removed when some
window over it also starts in a document with a smaller id.

1. *Anchors.* Of the ``window - phrase + 1`` phrases inside a window the one with the
   smallest hash is its anchor, so equal windows have equal anchors at equal places,
   and about one phrase in sixteen is an anchor of anything. Only anchors (hash, not
   text) are shuffled.
2. *Confirm.* An anchor seen in two documents of different content recurs. Windows over
   recurring anchors are hashed (128 bits) and grouped: a window's owner is the smallest
   document that has it. Groups are combined before the shuffle. Documents of equal
   content count once, through the smallest id.
3. *Automata.* The passages that owners lend (merged runs of windows first seen there)
   are dealt to shards; each shard compiles its passages, cut in blocks of
   ``window // 2`` words, into an Aho-Corasick automaton over word numbers, so every
   window of a passage contains a whole block. The borrowing stretches of the documents
   stream through their shard's automaton; every hit is extended word by word against
   the passage, and stretches of at least ``window`` equal words are occurrences.
   Hash equality proposes, words decide.
4. Covered words are dropped from the texts.

Nothing is broadcast or collected; a passage that very many documents share is
combined before each shuffle and its borrowers are salted over tasks.

Defined results: a null or empty text has no words; texts shorter than a window lose
none; rows without ``doc_id`` are compared under an id above all others; rows that
repeat a ``doc_id`` are one document's parts: windows are never matched inside one id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import documents, pieces_of, raw_texts, tasks_for
from quire.plans.materialize import checkpointed

LAST_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MEMO_LIMIT = 150_000


@lru_cache(4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    up = np.full(n, base, "u8")
    down = np.full(n, pow(base, -1, 1 << 64), "u8")
    up[:1] = down[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _size(n: int) -> int:
    return 1 << max(10, int(n).bit_length())


def word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words; ``memo`` keeps some for the next texts."""
    h, out = xxhash.xxh3_64_intdigest, []
    if len(memo) > _MEMO_LIMIT:
        memo.clear()
    for w in words:
        x = memo.get(w)
        if x is None:
            x = h(w)
            if len(w) <= 64:
                memo[w] = x
        out.append(x)
    return np.array(out, "u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def rolling(hashes: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, "u8")
    up, down = (p[:n] for p in _powers(_size(n), base))
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, "u8"), np.cumsum(hashes * up, dtype="u8")))
        return _mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])


def anchors(phrases: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash (leftmost on ties) of every ``span`` neighbours."""
    n = len(phrases) - span + 1
    if n <= 0:
        return np.zeros(0, "i8")
    view = np.lib.stride_tricks.sliding_window_view(phrases, span)
    return view.argmin(axis=1) + np.arange(n)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype("i1"), [0]))))
    return edge[::2], edge[1::2]


def _anchor_rows(df: DataFrame, window: int, phrase: int) -> DataFrame:
    """Per row: its word count, digests of its words, and its anchors' hashes."""

    def run(batches):
        memo: dict[bytes, int] = {}
        for big in batches:
            for b in pieces_of(big):
                n_words, content, kept, found = [], [], [], []
                for raw in raw_texts(b.column(2)):
                    words = raw.split()
                    joined = b" ".join(words)
                    n_words.append(len(words))
                    content.append(xxhash.xxh3_128_digest(joined))
                    kept.append(hashlib.sha256(joined).hexdigest())
                    hashes = rolling(word_hashes(words, memo), phrase)
                    found.append(np.unique(hashes[anchors(hashes, window - phrase + 1)]).view("i8"))
                digest = np.frombuffer(b"".join(content), "i8").reshape(-1, 2)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in found])))
                flat = np.concatenate([*found, np.zeros(0, "i8")])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(digest[:, 0].copy()),
                     pa.array(digest[:, 1].copy()), pa.array(kept), lists],
                    names=["key", "doc_id", "n_words", "c0", "c1", "whole_sha256", "anchors"],
                )

    return df.select("key", "doc_id", "text").mapInArrow(
        run, "key long, doc_id long, n_words long, c0 long, c1 long, whole_sha256 string, anchors array<long>"
    )


def _window_rows(df: DataFrame, window: int, phrase: int) -> DataFrame:
    """Windows over recurring anchors: 128-bit hash, document, place."""

    def run(batches):
        memo: dict[bytes, int] = {}
        for big in batches:
            for b in pieces_of(big, 256):
                owner, places, lo, hi = [], [], [], []
                rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2)), b.column(3).to_pylist())
                for key, doc, raw, recurring in rows:
                    hashes = word_hashes(raw.split(), memo)
                    short = rolling(hashes, phrase)
                    of = anchors(short, window - phrase + 1)
                    at = np.flatnonzero(np.isin(short, np.array(recurring, "i8").view("u8"))[of])
                    lo.append(rolling(hashes, window)[at])
                    hi.append(rolling(_mixed(hashes), window)[at])
                    places.append(at)
                    owner.append(np.repeat(np.array([[key, doc]], "i8"), len(at), axis=0))
                ids = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lo).view("i8")), pa.array(np.concatenate(hi).view("i8")),
                     pa.array(ids[:, 0].copy()), pa.array(ids[:, 1].copy()), pa.array(np.concatenate(places).astype("i4"))],
                    names=["lo", "hi", "key", "doc_id", "place"],
                )

    return df.select("key", "doc_id", "text", "recurring").mapInArrow(run, "lo long, hi long, key long, doc_id long, place int")


def _stretches(df: DataFrame, window: int) -> DataFrame:
    """Runs of windows with one owner, as words: the owner's own (``owner = doc_id``,
    passages it lends) and those of later documents that have them too."""

    def run(batches):
        for big in batches:
            for b in pieces_of(big, 256):
                rows: list[tuple] = []
                cols = [b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2)), b.column(3).to_pylist(), b.column(4).to_pylist()]
                for key, doc, raw, owners, places in zip(*cols):
                    words = raw.split()
                    owner = np.full(len(words) - window + 1, -1, "i8")
                    mine = np.zeros(len(owner), bool)
                    at = np.array(places, "i8")
                    mine[at], owner[at] = True, owners
                    cuts = [0, *(np.flatnonzero((np.diff(owner) != 0) | (np.diff(mine) != 0)) + 1).tolist(), len(owner)]
                    for a, z in zip(cuts, cuts[1:]):
                        if mine[a]:
                            n = z - a + window - 1
                            rows.append((int(owner[a]), key, doc, a, n, b" ".join(words[a : a + n])))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)],
                    names=["owner", "key", "doc_id", "start", "n", "words"],
                )

    return df.select("key", "doc_id", "text", "owners", "places").mapInArrow(
        run, "owner long, key long, doc_id long, start int, n int, words binary"
    )


def _cut_long(passages, most: int, window: int):
    """Passages of at most ``most`` words; neighbours share all but one window's words."""
    for owner, words in passages:
        for a in range(0, max(len(words) - window + 1, 1), most - window + 1):
            yield owner, words[a : a + most]


def occurrences(passages, stretches, window: int, most: int = 200_000):
    """``(tag, start, end)`` of every run of words of a stretch that is covered by places
    where ``window`` or more words of a passage stand. Passages are ``(owner, words)``, stretches
    ``(owner, tag, start, words)``; a stretch is compared with its owner's passages.
    One automaton holds at most about ``2 * most`` words."""
    held: list = []
    size = 0
    for p in _cut_long(passages, most, window):
        held.append(p)
        size += len(p[1])
        if size >= most:
            yield from _stream(held, stretches, window)
            held, size = [], 0
    if held:
        yield from _stream(held, stretches, window)


def _stream(passages, stretches, window: int):
    import ahocorasick

    number: dict[bytes, str] = {}  # one character for every word
    texts = ["".join([number.setdefault(w, chr(0x10000 + len(number))) for w in words]) for _, words in passages]
    block = window // 2
    where: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(texts):
        for at in range(0, len(t) - block + 1, block):
            where.setdefault(t[at : at + block], []).append((k, at))
    automaton = ahocorasick.Automaton()
    for phrase, places in where.items():
        automaton.add_word(phrase, places)
    automaton.make_automaton()
    lenders = {o for o, _ in passages}
    for owner, tag, start, words in stretches:
        if owner not in lenders:
            continue
        t = "".join([number.get(w, "\0") for w in words])
        done: dict[tuple[int, int], int] = {}  # (passage, diagonal) → end of the match found there
        spans: list[tuple[int, int]] = []
        for last, places in automaton.iter(t):
            a = last - block + 1
            for k, at in places:
                if passages[k][0] != owner or done.get((k, a - at), -1) > a:
                    continue
                p, i, j = texts[k], a, at
                while i and j and t[i - 1] == p[j - 1]:
                    i, j = i - 1, j - 1
                z, e = last + 1, at + block
                while z < len(t) and e < len(p) and t[z] == p[e]:
                    z, e = z + 1, e + 1
                done[k, a - at] = z
                if z - i >= window:
                    spans.append((i, z))
        # A text that repeats itself matches on many diagonals: one row a covered run.
        spans.sort(reverse=True)
        while spans:
            a, z = spans.pop()
            while spans and spans[-1][0] <= z:
                z = max(z, spans.pop()[1])
            yield tag, start + a, start + z


def _located(lent: DataFrame, borrowed: DataFrame, window: int, shard_words: int, salt_words: int) -> DataFrame:
    """Deal passages, and the stretches that name their owner, to shards; find occurrences."""
    total = borrowed.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    shards = max(tasks_for(lent.sparkSession), -(-total // shard_words))
    # An owner with many borrowers has its passages copied to as many salts as needed.
    salts = borrowed.groupBy("owner").agg(F.ceil(F.sum(F.col("n").cast("long")) / F.lit(salt_words)).cast("int").alias("salts"))
    shard = F.pmod(F.xxhash64("owner", "salt"), F.lit(shards))
    left = lent.join(salts, "owner").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select(shard.alias("at"), F.col("owner").alias("lender"), F.col("words").alias("passage"))
    right = (
        borrowed.join(salts, "owner")
        .withColumn("salt", F.pmod(F.xxhash64("key", "start"), F.col("salts")).cast("int"))
        .select(shard.alias("shard"), "owner", "key", "start", "words")
    )

    def find(lend: pd.DataFrame, borrow: pd.DataFrame) -> pd.DataFrame:
        passages = [(o, w.split(b" ")) for o, w in zip(lend["lender"], lend["passage"])]
        asked = [(o, k, s, w.split(b" ")) for o, k, s, w in zip(borrow["owner"], borrow["key"], borrow["start"], borrow["words"])]
        found = list(occurrences(passages, asked, window))
        return pd.DataFrame({c: pd.Series([x[i] for x in found], dtype="int64") for i, c in enumerate(("key", "start", "end"))})

    return left.groupBy("at").cogroup(right.groupBy("shard")).applyInPandas(find, "key long, start long, end long")


def _without(df: DataFrame) -> DataFrame:
    """Drop the words of the found spans."""

    def run(batches):
        for big in batches:
            for b in pieces_of(big, 256):
                removed, kept = [], []
                for raw, spans in zip(raw_texts(b.column(2)), b.column(3).to_pylist()):
                    words = raw.split()
                    gone = np.zeros(len(words) + 1, "i4")
                    for s in spans:
                        gone[s["start"]] += 1
                        gone[s["end"]] -= 1
                    stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                    removed.append(len(words) - len(stay))
                    kept.append(b" ".join([words[i] for i in stay]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["key", "doc_id", "n_removed", "kept"],
                )

    return df.select("key", "doc_id", "text", "found").mapInArrow(run, "key long, doc_id long, n_removed long, kept string")


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), F.col(text_col).cast("string"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``df`` with the repeated words cut out of its texts; all columns and rows stay."""
    cut = dedup_substrings(df, id_col, text_col, **settings).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("kept").alias("__kept")).dropDuplicates(["__id", "__key"])
    # The id beside the key: texts that share a 64-bit hash by chance stay apart.
    same = (row_key(id_col, text_col) == F.col("__key")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
    return df.join(cut, same, "left").withColumn(text_col, F.coalesce("__kept", text_col)).drop("__id", "__key", "__kept")


def dedup_substrings(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    phrase: int = 20,
    shard_words: int = 500_000,
    salt_words: int = 20_000,
) -> DataFrame:
    """One row per document: ``doc_id, key`` (hash of id and text, the row's key),
    ``n_words, n_removed, kept_sha256`` and ``kept``, the words that stay, joined by one
    space (null where none was removed: the text stands as it was). ``shard_words``: borrowed words dealt to a shard on average;
    ``salt_words``: borrowed words of one owner beyond which it is dealt to several."""
    docs = documents(df, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)))
    docs = docs.withColumn("key", row_key("doc_id", "text"))
    facts = checkpointed(_anchor_rows(docs, window, phrase), "anchors")

    # Documents of equal words are one content, named by the smallest id that has it.
    named = facts.drop("anchors").join(facts.groupBy("c0", "c1").agg(F.min("doc_id").alias("first_id")), ["c0", "c1"])
    named = checkpointed(named.select("key", "doc_id", "first_id", "n_words", "whole_sha256"), "contents")
    recurring = (
        facts.select(F.explode("anchors").alias("anchor"), "c0")
        .groupBy("anchor").agg(F.min("c0").alias("a"), F.max("c0").alias("b")).where("a <> b").select("anchor")
    )
    hit = (
        facts.select("key", F.explode("anchors").alias("anchor")).join(recurring, "anchor", "left_semi")
        .groupBy("key").agg(F.collect_set("anchor").alias("recurring"))
        .join(named.where("doc_id = first_id").select("key"), "key", "left_semi")
    )
    suspects = checkpointed(docs.join(hit, "key").select("key", "doc_id", "text", "recurring"), "suspects")

    windows = checkpointed(_window_rows(suspects, window, phrase), "windows")
    owners = windows.groupBy("lo", "hi").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).where("owner <> other")
    owned = (
        windows.join(owners.select("lo", "hi", "owner"), ["lo", "hi"])
        .groupBy("key", "doc_id").agg(F.collect_list(F.struct("place", "owner")).alias("own"))
        .select("key", "doc_id", F.col("own.owner").alias("owners"), F.col("own.place").alias("places"))
    )
    texts = suspects.select("key", "doc_id", "text")
    stretches = checkpointed(_stretches(texts.join(owned, ["key", "doc_id"]), window), "stretches")
    lent, borrowed = stretches.where("owner = doc_id"), stretches.where("owner < doc_id")
    found = _located(lent, borrowed, window, shard_words, salt_words)
    spans = found.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    trimmed = _without(texts.join(spans, "key")).dropDuplicates(["key", "doc_id"])

    # A later copy of a content loses everything: each of its windows starts earlier.
    judged = named.join(trimmed, ["key", "doc_id"], "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= window)
    kept = F.when(copy, F.lit("")).when(F.col("doc_id") == F.col("first_id"), F.col("kept"))
    return judged.select(
        F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"),
        "key",
        "n_words",
        F.when(copy, F.col("n_words")).when(kept.isNotNull(), F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.sha2(kept, 256), "whole_sha256").alias("kept_sha256"),
        kept.alias("kept"),
    )
