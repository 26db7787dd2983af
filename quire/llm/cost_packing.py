"""Cost-balanced packing of tokenized documents into fixed-length training sequences.

Documents are tokenized inside the scan's tasks, ended by a separator id, and packed
task by task in blocks of a bounded number of tokens, so nothing is shuffled, no task
holds more than one block, and adding data adds blocks. Inside a block:

1. what fills whole sequences is cut off long documents;
2. the rests, longest first, go to the sequence of lowest cost that has room for them
   (cost of a piece: ``linear * n + quadratic * n * n``, the work of attention inside a
   document), else to the cheapest sequence with any room, cut there;
3. the last ``tokens mod seq_len`` tokens of the block fill sequences of
   power-of-two lengths, which need no padding.

Every sequence is therefore full, or a power of two long.

Defined results: a null or empty text is the separator alone; a null ``doc_id`` stays
null; repeated rows are packed as separate documents; equal lengths keep the order of
the input; an empty table gives no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quire.llm.batches import blocks_of, documents, scratch_free_env
from quire.llm.words_memo import WordBlocks

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_CODECS: dict[str, WordBlocks] = {}


def piece_cost(n: int, linear: float, quadratic: float) -> float:
    return linear * n + quadratic * n * n


class Rooms:
    """Open sequences by their free room. Each room has a heap of ``(cost, sequence)``; a
    binary tree over the rooms holds the least of them, so the cheapest sequence with room
    for ``n`` is found in log time."""

    def __init__(self, seq_len: int):
        self.leaves = 1 << seq_len.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.leaves)]
        self.least: list[tuple[float, int, int] | None] = [None] * (2 * self.leaves)

    def _settle(self, room: int) -> None:
        top = self.heaps[room][0] if self.heaps[room] else None
        i, least = self.leaves + room, self.least
        least[i] = (*top, room) if top else None
        while i > 1:
            a, b = least[i & ~1], least[i | 1]
            i >>= 1
            least[i] = a if b is None or (a is not None and a < b) else b

    def add(self, cost: float, sequence: int, room: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        self._settle(room)

    def cheapest(self, n: int) -> tuple[float, int, int] | None:
        """Take out ``cost, sequence, room`` of the cheapest with room for ``n``."""
        best, lo, hi = None, self.leaves + n, 2 * self.leaves
        while lo < hi:
            for at in ([lo] if lo & 1 else []) + ([hi - 1] if hi & 1 else []):
                x = self.least[at]
                if x is not None and (best is None or x < best):
                    best = x
            lo, hi = (lo + 1) >> 1, hi >> 1
        if best is not None:
            heapq.heappop(self.heaps[best[2]])
            self._settle(best[2])
        return best


def pack_lengths(lengths: list[int], seq_len: int, linear: float, quadratic: float):
    """Pieces ``(document, start, length, sequence, offset)`` of documents of the given
    lengths; sequences are numbered from 0."""
    out: list[tuple[int, int, int, int, int]] = []
    rests: list[tuple[int, int, int]] = []  # (-length, document, start)
    seq = 0
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= seq_len:
            out.append((d, at, seq_len, seq, 0))
            seq += 1
            at += seq_len
        if n > at:
            rests.append((at - n, d, at))
    total = -sum(r[0] for r in rests)
    full, tail = divmod(total, seq_len)
    rooms = Rooms(seq_len)
    for i in range(full):
        rooms.add(0.0, seq + i, seq_len)
    seq += full
    heapq.heapify(rests)
    left: list[tuple[int, int, int]] = []
    while rests:
        neg, d, at = heapq.heappop(rests)
        n = -neg
        chosen = rooms.cheapest(n) or rooms.cheapest(1)
        if chosen is None:
            left.append((d, at, n))
            continue
        cost, s, room = chosen
        take = min(n, room)
        out.append((d, at, take, s, seq_len - room))
        if take < room:
            rooms.add(cost + piece_cost(take, linear, quadratic), s, room - take)
        if take < n:
            heapq.heappush(rests, (take - n, d, at + take))
    sizes = [1 << b for b in range(seq_len.bit_length(), -1, -1) if tail >> b & 1]
    at_seq = 0
    for d, at, n in left:
        while n:
            take = min(n, sizes[0] - at_seq)
            out.append((d, at, take, seq, at_seq))
            at, n, at_seq = at + take, n - take, at_seq + take
            if at_seq == sizes[0]:
                sizes.pop(0)
                seq, at_seq = seq + 1, 0
    return out


def _codec(path: str) -> WordBlocks:
    if path not in _CODECS:
        scratch_free_env()
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        specials = tuple(t.content for t in tok.get_added_tokens_decoder().values())

        def encode_text(text: str) -> list[int]:
            return tok.encode_batch_fast([text], add_special_tokens=False)[0].ids

        _CODECS[path] = WordBlocks(encode_text, specials, limit=300_000)
    return _CODECS[path]


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = 1024,
    separator: int = 0,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    block_tokens: int = 2_000_000,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and
    the piece's ``ids`` (little-endian unsigned 32-bit). ``sequence_id`` is unique over
    all tasks (task number in the high bits). ``seq_len`` must be a power of two."""
    if seq_len < 1 or seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    end = np.array([separator], "<u4").tobytes()

    def packed(doc_ids: list, ids: list[bytes], base: int):
        rows = pack_lengths([len(x) // 4 for x in ids], seq_len, linear, quadratic)
        cols = list(zip(*rows))
        doc, start, length, seq, offset = (np.array(c, "i8") for c in cols)
        sizes = np.array([len(x) // 4 for x in ids], "i8")
        return 1 + int(seq.max()), pa.RecordBatch.from_arrays(
            [
                pa.array([doc_ids[i] for i in cols[0]], pa.int64()),
                pa.array(start),
                pa.array(length),
                pa.array(sizes[doc]),
                pa.array(seq + base),
                pa.array(offset),
                pa.array([ids[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in rows], pa.binary()),
            ],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
        )

    def run(batches):
        codec = _codec(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        held_ids: list = []
        held: list[bytes] = []
        tokens = 0
        for big in batches:
            for b in blocks_of(big):
                encoded = [x + end for x in codec.encode(b.column(1))]
                for i, x in zip(b.column(0).to_pylist(), encoded):
                    held_ids.append(i)
                    held.append(x)
                    tokens += len(x) // 4
                    if tokens >= block_tokens:
                        n, out = packed(held_ids, held, base)
                        base += n
                        held_ids, held, tokens = [], [], 0
                        yield out
        if held:
            yield packed(held_ids, held, base)[1]
        pa.default_memory_pool().release_unused()

    return documents(df, id_col, text_col).mapInArrow(run, SCHEMA)
