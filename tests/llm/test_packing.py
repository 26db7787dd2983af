"""Placement against a search of all sequences, and block encoding against the library."""

import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from quire.llm.batches import blocks_of
from quire.llm.cost_packing import _codec, pack_lengths
from quire.llm.words_memo import WordBlocks

PATH = P.path("byte_bpe_50k.json")


def plain(lengths, seq_len, linear, quadratic):
    """Every sequence is asked for room; the cheapest that has it takes the document."""
    out, rests, seq = [], [], 0
    for d, n in enumerate(lengths):
        for at in range(0, n - n % seq_len, seq_len):
            out.append((d, at, seq_len, seq, 0))
            seq += 1
        if n % seq_len:
            rests.append((n % seq_len, d, n - n % seq_len))
    total = sum(r[0] for r in rests)
    cost, fill = {}, {}
    for s in range(seq, seq + total // seq_len):
        cost[s], fill[s] = 0.0, 0
    left = []
    while rests:
        rests.sort(key=lambda r: (-r[0], r[1], r[2]))
        n, d, at = rests.pop(0)
        fits = [s for s in fill if fill[s] + n <= seq_len] or [s for s in fill if fill[s] < seq_len]
        if not fits:
            left.append((d, at, n))
            continue
        s = min(fits, key=lambda s: (cost[s], s))
        take = min(n, seq_len - fill[s])
        out.append((d, at, take, s, fill[s]))
        fill[s] += take
        cost[s] += linear * take + quadratic * take * take
        if take < n:
            rests.append((n - take, d, at + take))
    return out, left


def test_the_cheapest_sequence_with_room_takes_the_document():
    rng = random.Random(6)
    for seq_len in (8, 64, 1024):
        for _ in range(12):
            lengths = [rng.randint(1, rng.choice([seq_len // 4, seq_len, 3 * seq_len])) for _ in range(rng.randint(0, 150))]
            want, left = plain(lengths, seq_len, 1.0, 1 / 1024)
            got = pack_lengths(lengths, seq_len, 1.0, 1 / 1024)
            assert got[: len(want)] == want
            assert sum(n for _, _, n, _, _ in got[len(want) :]) == sum(n for *_, n in left)


def texts_of(rng):
    letters = "abcdeé漢Ω's1,.-"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 8)))
    out = ["\n".join(" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 5))) for _ in range(200)]
    odd = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb", "a \nb", "a\n b", "a\tb", "a b", "a b", "a\x1cb", "a\r\nb", "x<|endoftext|>y", "a　", "\x00", "w" * 5000, "​ x"]
    return out + odd + [rng.choice(out) + rng.choice([" ", "\n", "  ", ""]) + rng.choice(odd) for _ in range(100)]


def test_blocks_encode_as_the_library():
    lib = Tokenizer.from_file(PATH)
    texts = texts_of(random.Random(3))
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    base = _codec(PATH)
    for limit, together in ((600_000, 20_000), (0, 3), (20, 7)):
        codec = WordBlocks(base.encode_text, base.specials, limit, 6, together)
        assert codec.encode(pa.array(texts)) == want
        assert codec.encode(pa.array([None, *texts[::-1]]).slice(1)) == want[::-1]
        assert codec.encode(pa.array([None, "a"], pa.string())) == [b"", want[texts.index("a")] if "a" in texts else np.array(lib.encode("a").ids, "<u4").tobytes()]
        assert len(codec.led) <= limit
    assert base.encode(pa.array([], pa.string())) == []


def test_blocks_are_bounded_and_lose_nothing():
    texts = ["x" * n for n in (0, 5, 300, 1, 1, 1, 250, 0, 0)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(11)), pa.array(texts)], names=["doc_id", "text"])
    blocks = list(blocks_of(batch, rows=4, size=260))
    assert [i for b in blocks for i in b.column(0).to_pylist()] == list(range(11))
    assert all(b.num_rows <= 4 and (b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= 260) for b in blocks)
    assert list(blocks_of(batch.slice(0, 0))) == []
