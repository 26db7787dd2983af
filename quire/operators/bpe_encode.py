"""Byte-level BPE encoding and decoding.

``encode_documents`` encodes a corpus through a dictionary made by Spark: texts are cut into
pieces by a Spark expression, the distinct pieces are counted, and the merges are applied once
to each of the most frequent ones. Pieces follow a Zipf law, so this bounded dictionary, which
goes to every task, has most places; the other pieces are encoded where they stand, once a
block of documents. No text, piece or id is shuffled but the pieces that are counted.

``BPETokenizer`` offers the same ids as Column expressions: pieces are cut by Spark, and an
Arrow block encodes the distinct pieces of a batch once and gathers. Decoding takes the
tokens' bytes from one table by Arrow gathers. There is no loop over rows.

Special tokens typed in a text become their ids, as the public library does it, unless they
are escaped; a null text has null ids; a byte outside the alphabet is ``<unk>``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import col_of
from quire.operators.bpe_train import SHIFT, merge_symbols
from quire.operators.vocab import GPT2_PATTERN, BPEModel, byte_to_unicode, check_specials

MEMO, LONG, BLOCK = 200_000, 64, 1_000_000


def load_tokenizer(folder: str) -> "BPETokenizer":
    """A tokenizer from a folder written by ``save_tokenizer`` (or by the library)."""
    with open(os.path.join(folder, "tokenizer.json"), encoding="utf-8") as f:
        doc = json.load(f)
    vocab = dict(doc["model"]["vocab"]) | {t["content"]: t["id"] for t in doc.get("added_tokens", [])}
    merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in doc["model"]["merges"]]
    specials = [t["content"] for t in doc.get("added_tokens", []) if t.get("special")]
    model = BPEModel(sorted(vocab, key=vocab.get), merges, specials)
    check_specials(model)
    return BPETokenizer(model)


def piece_pattern(specials: list[str]) -> str:
    """The byte-level pieces, special tokens being pieces of their own that no other piece
    reaches into (a text is cut at them first)."""
    if not specials:
        return "(?U)" + GPT2_PATTERN
    any_special = "|".join("\\Q" + s + "\\E" for s in sorted(specials, key=len, reverse=True))
    short, spaces = GPT2_PATTERN.split("| ?\\p{L}+", 1)[0], f"\\s+(?:(?!\\S)|(?={any_special}))|\\s+"
    runs = "|".join(f" ?(?:(?!{any_special}){kind})+" for kind in ("\\p{L}", "\\p{N}", "[^\\s\\p{L}\\p{N}]"))
    return f"(?U)(?:{any_special})|{short}|{runs}|{spaces}"


class PieceCoder:
    """Piece → ids, inside tasks; remembers a bounded number of short pieces."""

    def __init__(self, model: BPEModel, escape: bool):
        ids = model.token_to_id
        b2u = byte_to_unicode()
        unk = ids.get("<unk>", 0)
        self.of_byte = [ids.get(c, unk) for c in b2u]
        self.specials = {} if escape else {s: ids[s] for s in model.specials if s in ids}
        self.merges = {ids[a] << SHIFT | ids[b]: (r, ids[a + b]) for r, (a, b) in enumerate(model.merges)}
        self.memo: dict[str, list[int]] = {}

    def __call__(self, piece: str) -> list[int]:
        known = self.memo.get(piece)
        if known is None:
            if piece in self.specials:
                return [self.specials[piece]]
            known = merge_symbols([self.of_byte[b] for b in piece.encode("utf-8")], self.merges)
            if len(piece) <= LONG:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = known
        return known


def gathered(pieces: pa.Array, coder: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after the other, and the place where each piece's begin (one
    more for the end). Every distinct piece of the block is encoded once."""
    coded = pieces.dictionary_encode()
    each = [coder(p) for p in coded.dictionary.to_pylist()]
    size = np.array([len(e) for e in each], "i8")
    begin = np.cumsum(size) - size
    flat = np.array([i for e in each for i in e], "i4")
    codes = np.asarray(coded.indices)
    n = size[codes]
    ends = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(begin[codes] - ends[:-1], n) + np.arange(ends[-1])
    return flat[at], ends


def wrapped(ends: np.ndarray, values: np.ndarray, valid: np.ndarray, around: tuple[int, int] | None) -> pa.Array:
    """Lists from their ends and values, each valid one put between the ids ``around``."""
    if around is not None:
        extra = np.concatenate(([0], np.cumsum(np.where(valid, 2, 0))))
        out = np.empty(len(values) + int(extra[-1]), "i4")
        to = ends + extra
        inner = np.repeat(extra[:-1] + valid, np.diff(ends)) + np.arange(len(values))
        out[inner] = values
        out[to[:-1][valid]], out[to[1:][valid] - 1] = around
        ends, values = to, out
    lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values, pa.int32()), mask=pa.array(~valid))
    return lists.cast(pa.list_(pa.int32()))


def _whole(lists: pa.Array) -> pa.Array:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return pa.concat_arrays([lists]) if lists.offset else lists


def encode_pieces(lists: pa.Array, coder, around: tuple[int, int] | None) -> pa.Array:
    """``list<string>`` pieces → ``list<int32>`` ids, by blocks of about ``BLOCK`` pieces."""
    lists = _whole(lists)
    starts = np.asarray(lists.offsets).astype("i8")
    cuts = np.flatnonzero(np.diff(starts[:-1] // BLOCK)) + 1 if len(lists) else []
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(lists)]):
        part = lists.values.slice(starts[a], starts[b] - starts[a])
        values, ends = gathered(part, coder)
        out.append(wrapped(ends[starts[a : b + 1] - starts[a]], values, np.asarray(lists.slice(a, b - a).is_valid()), around))
    return pa.concat_arrays(out)


def decode_ids(lists: pa.Array, table: pa.Array, shown: np.ndarray) -> pa.Array:
    """``list<int32>`` → text; ``table`` has the tokens' bytes, ``shown`` tells which ids are
    shown. Bytes that aren't UTF-8 come out as replacement characters."""
    lists = _whole(lists)
    ids = np.asarray(lists.values.fill_null(-1)).astype("i8")
    known = (ids >= 0) & (ids < len(table))
    known[known] = shown[ids[known]]
    before = np.concatenate(([0], np.cumsum(known)))
    taken = table.take(pa.array(ids[known]))
    places = np.frombuffer(taken.buffers()[1], "i8", len(taken) + 1) if len(taken) else np.zeros(1, "i8")
    data = taken.buffers()[2] if len(taken) else None
    rows = places[before[np.asarray(lists.offsets)]]
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [lists.buffers()[0], pa.py_buffer(rows.tobytes()), data or pa.py_buffer(b"")], null_count=lists.null_count)
    try:
        return out.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if b is None else b.decode("utf-8", errors="replace") for b in out.to_pylist()], pa.string())


_CODERS: dict[tuple[str, bool], PieceCoder] = {}


def _coder(model_json: str, escape: bool) -> PieceCoder:
    """The worker's coder of a model; the last two are kept."""
    if (model_json, escape) not in _CODERS:
        while len(_CODERS) > 1:
            _CODERS.pop(next(iter(_CODERS)))
        _CODERS[model_json, escape] = PieceCoder(BPEModel.from_json(model_json), escape)
    return _CODERS[model_json, escape]


class BPETokenizer:
    """Learned byte-level BPE as a ``quire`` tokenizer."""

    name = "bpe"

    def __init__(self, model: BPEModel, escape_specials: bool = False):
        self.model, self.escape = model, escape_specials
        self.model_json = model.to_json()
        self.vocab_size = len(model.vocab)
        ids = model.token_to_id
        self.around = (ids["<bos>"], ids["<eos>"]) if "<bos>" in ids and "<eos>" in ids else None

    def pieces(self, text: str | Column) -> Column:
        pattern = piece_pattern([] if self.escape else [s for s in self.model.specials if s in self.model.token_to_id])
        return F.regexp_extract_all(col_of(text), F.lit(pattern), 0)

    def encode(self, text: str | Column, template: bool = True) -> Column:
        model, escape, around = self.model_json, self.escape, self.around if template else None

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def enc(lists: pa.Array) -> pa.Array:
            return encode_pieces(lists, _coder(model, escape), around)

        return enc(self.pieces(text))

    def encode_many(self, texts: str | Column) -> Column:
        """``array<string>`` → ``array<array<int>>`` (no template), for chat pieces."""
        model, escape = self.model_json, self.escape

        @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
        def enc(lists: pa.Array) -> pa.Array:
            lists = _whole(lists)
            inner = encode_pieces(lists.values, _coder(model, escape), None)
            return pa.ListArray.from_arrays(lists.offsets, inner, mask=pa.array(~np.asarray(lists.is_valid())))

        return enc(F.transform(col_of(texts), self.pieces))

    def typed_specials(self, text: str | Column) -> Column:
        """How many special tokens are typed in a text."""
        t = col_of(text)
        return sum((F.regexp_count(t, F.lit("\\Q" + s + "\\E")) for s in self.model.specials), F.lit(0)).cast("long")

    def count(self, text: str | Column, template: bool = True) -> Column:
        return F.size(self.encode(text, template)).cast("long")

    def decode(self, ids: str | Column, skip_special: bool = True) -> Column:
        of_char = {c: b for b, c in enumerate(byte_to_unicode())}
        specials = set(self.model.specials)
        tokens = [t.encode() if t in specials else bytes(of_char[c] for c in t) for t in self.model.vocab]
        table = pa.array(tokens, pa.large_binary())
        shown = np.array([not (skip_special and t in specials) for t in self.model.vocab])

        @F.arrow_udf(T.StringType())
        def dec(lists: pa.Array) -> pa.Array:
            return decode_ids(lists, table, shown)

        return dec(col_of(ids))


def dictionary(pieces: DataFrame, tokenizer: BPETokenizer, frequent: int | None = None) -> DataFrame:
    """``pieces(pieces array<string>)`` → ``piece, n, ids``: every distinct piece, how often it
    occurs, and its ids; with ``frequent`` the most frequent ones of up to ``LONG`` characters."""
    # explode_outer: see vocab.word_counts
    each = pieces.select(F.explode_outer("pieces").alias("piece")).where(F.col("piece").isNotNull())
    counted = each.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    if frequent is not None:
        counted = counted.where(F.length("piece") <= LONG).orderBy(F.desc("n"), "piece").limit(frequent)
    model, escape = tokenizer.model_json, tokenizer.escape

    def run(batches):
        for batch in batches:
            values, ends = gathered(batch.column(0), _coder(model, escape))
            ids = wrapped(ends, values, np.ones(batch.num_rows, bool), None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], names=["piece", "n", "ids"])

    return counted.mapInArrow(run, "piece string, n long, ids array<int>")


def encode_documents(docs: DataFrame, tokenizer: BPETokenizer, text_col: str = "text", template: bool = True, frequent: int = 32_768) -> DataFrame:
    """``docs`` with ``ids``. ``frequent``: pieces of up to 64 characters whose ids come from
    the dictionary; all others are encoded where they stand."""
    model, escape, around = tokenizer.model_json, tokenizer.escape, tokenizer.around if template else None
    often = dictionary(docs.select(tokenizer.pieces(text_col).alias("pieces")), tokenizer, frequent) if frequent else None
    known = {r.piece: r.ids for r in often.collect()} if often is not None else {}  # at most ``frequent`` short pieces

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def enc(lists: pa.Array) -> pa.Array:
        coder = _coder(model, escape)

        def ids_of(piece: str) -> list[int]:
            ids = known.get(piece)
            return coder(piece) if ids is None else ids

        return encode_pieces(lists, ids_of, around)

    # A deterministic call would be made again in every expression on the ids.
    return docs.withColumn("ids", enc.asNondeterministic()(tokenizer.pieces(text_col)))
