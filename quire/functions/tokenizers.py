"""Tokenizer plug-ins.

Every tokenizer offers a token *count* as a Column (used by budgets, mixing and
packing) and an *encode* Column returning ``array<int>``.

* ``ByteTokenizer``: id = 4 + UTF-8 byte value; count is pure Catalyst
  (``octet_length``), ids come from an Arrow UDF that works on the raw Arrow
  buffers (no per-row Python).
* ``WhitespaceTokenizer``: pieces split on Python whitespace; count is pure Catalyst.
* ``BPETokenizer`` (``quire.operators.bpe_encode``): learned byte-level BPE.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.config import BOS_ID, EOS_ID
from quire.functions.text import PY_WHITESPACE, PY_WHITESPACE_CLASS, col_of

BYTE_OFFSET = 4  # ids 0..3 are the special tokens
BLOCK = 1 << 20  # bytes of text, or ids, that are turned at once


def _as_plain_binary(texts: pa.Array) -> pa.Array:
    arr = texts.cast(pa.large_binary())
    if arr.offset != 0:
        arr = pa.concat_arrays([arr])  # materialize a slice so buffers start at 0
    return arr


def blocks_of(array: pa.Array, size: int = 0) -> Iterator[pa.Array]:
    """Slices of a string, binary or list array with at most about ``size`` bytes of text or
    list values each (one row at least)."""
    size = size or BLOCK
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    listed = pa.types.is_list(array.type) or pa.types.is_large_list(array.type)
    lengths = pc.list_value_length(array) if listed else pc.binary_length(array)
    ends = np.cumsum(np.asarray(pc.fill_null(lengths, 0)), dtype="i8")
    i = 0
    while i < len(array):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield array.slice(i, j - i)
        i = j


def byte_encode_arrow(texts: pa.Array, template: bool, offset: int = BYTE_OFFSET) -> pa.Array:
    """UTF-8 bytes + ``offset``, optionally wrapped as ``[bos] ... [eos]``, as ``list<int32>``."""
    arr = _as_plain_binary(texts)
    n = len(arr)
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64, count=n + 1)
    data, first = arr.buffers()[2], int(offsets[0])  # a slice may share its array's bytes
    values = (np.frombuffer(data, dtype=np.uint8, count=int(offsets[-1]) - first, offset=first) if data is not None and offsets[-1] > first
              else np.zeros(0, dtype=np.uint8)).astype(np.int32)
    values += offset
    offsets = offsets - first
    valid = np.asarray(arr.is_valid())
    if template:
        extra = np.where(valid, 2, 0).astype(np.int64)
        new_offsets = offsets + np.concatenate([[0], np.cumsum(extra)])
        out = np.empty(int(new_offsets[-1]), dtype=np.int32)
        special = np.zeros(len(out), dtype=bool)
        starts = new_offsets[:-1][valid]
        ends = new_offsets[1:][valid]
        out[starts] = BOS_ID
        out[ends - 1] = EOS_ID
        special[starts] = True
        special[ends - 1] = True
        out[~special] = values
        offsets, values = new_offsets, out
    mask = pa.array(~valid)
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values, pa.int32()), mask=mask).cast(
        pa.list_(pa.int32()))


def by_block(batches: Iterator[pa.Array], turn: Callable[[pa.Array], pa.Array]) -> Iterator[pa.Array]:
    """``turn`` over the blocks of all batches, each handed on before the next is turned: ids
    take four times the room of their text, and a task holds those of one block instead of
    those of a batch. What Arrow's allocator keeps for later goes back after every block."""
    for batch in batches:
        for block in blocks_of(batch):
            yield turn(block)
            pa.default_memory_pool().release_unused()


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_encode_template(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return by_block(batches, lambda texts: byte_encode_arrow(texts, True))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _byte_encode_plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return by_block(batches, lambda texts: byte_encode_arrow(texts, False))


def byte_decode_list(ids: list[int] | None, skip_special: bool) -> str | None:
    if ids is None:
        return None
    from quire.config import SPECIAL_TOKENS

    out = bytearray()
    for i in ids:
        if i >= BYTE_OFFSET:
            out.append(i - BYTE_OFFSET)
        elif not skip_special:
            out.extend(SPECIAL_TOKENS[i].encode())
    return out.decode("utf-8", errors="replace")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _utf8_bytes(texts: pa.Array) -> pa.Array:
    return byte_encode_arrow(texts, False, 0)


def byte_encode_many_arrow(lists: pa.Array) -> pa.Array:
    """``list<string>`` → ``list<list<int32>>``: every string encoded (no template),
    nesting kept; one pass over the flattened strings."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lists = pa.concat_arrays([lists]) if lists.offset != 0 else lists
    inner = byte_encode_arrow(lists.values, False)
    outer_offsets = lists.offsets
    return pa.ListArray.from_arrays(outer_offsets, inner, mask=pa.array(~np.asarray(lists.is_valid())))


@F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _byte_encode_many(lists: pa.Array) -> pa.Array:
    return byte_encode_many_arrow(lists)


def utf8_bytes(text: str | Column) -> Column:
    """Raw UTF-8 byte values (0..255) as ``array<int>``."""
    return _utf8_bytes(col_of(text))


def byte_decode_arrow(lists: pa.Array) -> pa.Array:
    """``list<int>`` ids → text, specials skipped, on the Arrow buffers; lists whose
    bytes are not valid UTF-8 fall back to a per-row decode with replacement."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lists = pa.concat_arrays([lists]) if lists.offset != 0 else lists
    n = len(lists)
    offsets = np.asarray(lists.offsets)
    values = np.asarray(lists.values[int(offsets[0]) : int(offsets[-1])].fill_null(0), dtype=np.int64)  # a slice has all its array's
    offsets = offsets - offsets[0]
    keep = values >= BYTE_OFFSET
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    new_offsets = kept_before[offsets].astype(np.int64)
    data = (values[keep] - BYTE_OFFSET).astype(np.uint8)
    # Same row count and offset 0 as ``lists``, so its validity bitmap carries over.
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [lists.buffers()[0], pa.py_buffer(new_offsets.tobytes()), pa.py_buffer(data.tobytes())],
        null_count=lists.null_count,
    )
    try:
        return binary.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if b is None else b.decode("utf-8", errors="replace") for b in binary.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _byte_decode_skip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return by_block(batches, byte_decode_arrow)


@F.pandas_udf(T.StringType())
def _byte_decode_keep(ids):
    return ids.map(lambda v: byte_decode_list(None if v is None else v.tolist(), False))


class ByteTokenizer:
    name = "byte"
    vocab_size = 256 + BYTE_OFFSET

    def count(self, text: str | Column, template: bool = True) -> Column:
        return F.octet_length(col_of(text)).cast("long") + F.lit(2 if template else 0)

    def encode(self, text: str | Column, template: bool = True) -> Column:
        return (_byte_encode_template if template else _byte_encode_plain)(col_of(text))

    def encode_many(self, texts: str | Column) -> Column:
        """``array<string>`` → ``array<array<int>>`` (no template)."""
        return _byte_encode_many(col_of(texts))

    def decode(self, ids: str | Column, skip_special: bool = True) -> Column:
        return (_byte_decode_skip if skip_special else _byte_decode_keep)(col_of(ids))


class WhitespaceTokenizer:
    """Pieces are maximal runs of non-whitespace (Python's ``str.split()``)."""

    name = "whitespace"

    def pieces(self, text: str | Column) -> Column:
        parts = F.split(F.btrim(col_of(text), F.lit(PY_WHITESPACE)), PY_WHITESPACE_CLASS + "+")
        return F.filter(parts, lambda p: p != F.lit(""))

    def count(self, text: str | Column, template: bool = True) -> Column:
        return F.size(self.pieces(text)).cast("long") + F.lit(2 if template else 0)


def get_tokenizer(name_or_obj):
    if not isinstance(name_or_obj, str):
        return name_or_obj
    if name_or_obj == "byte":
        return ByteTokenizer()
    if name_or_obj == "whitespace":
        return WhitespaceTokenizer()
    raise ValueError(f"unknown tokenizer {name_or_obj!r}; load a BPE model with quire.operators.bpe_encode")
