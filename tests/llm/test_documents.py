"""Operators on texts against plain-Python statements of their contracts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm.bpe_transducer import Lockstep, Transducer, Utf8Stream, decode_documents, encode_documents, read_ranks
from quire.llm.brown_classes import PACKED, Lexicon, Places, Settings, _neighbours, all_gains, exchange, gains, likelihood, score_documents
from quire.llm.cost_packing import pack_documents, pack_lengths
from quire.llm.license_diagonals import scan_licenses, templates
from quire.llm.phrase_automata import dedup_substrings, occurrences, without_repeats
from quire.llm.simhash_pivots import block_masks, keep_one_per_group, near_duplicates

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MULTI = P.path("byte_bpe_multi_50k.tiktoken")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, k=3):
    w = words((text or "").translate(ASCII))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    ones = Counter(b for s in shingles for h in [xxhash.xxh64(s.encode(), seed=42).intdigest()] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(n, linked):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)]


# ---------------------------------------------------------------- language model


def brute_base(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [words((t or "").translate(ASCII)) + [None] for _, t in rows]
    counts = Counter(x for (i, _), w in zip(rows, tokens) if not held(i) for x in w)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        ((-1 if i is None else i, held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for (i, _), w in zip(rows, tokens)),
    )


def test_brown_base_matches_brute_force_with_a_tiny_lexicon(edge_docs, edge_rows):
    """Words beyond the bounded lexicon go through the join and must count the same."""
    out = score_documents(edge_docs, settings=Settings(lexicon=40, singles=10, pools=8, classes=6, rounds=3)).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    want = brute_base([(r[0], r[1]) for r in edge_rows])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-4) for g, w in zip(got, want))
    assert all(r.score <= 1e-9 for r in out)


def test_brown_empty_table(no_docs):
    assert score_documents(no_docs, settings=Settings(rounds=2)).count() == 0


def test_brown_is_a_distribution_over_next_words(spark):
    """Probabilities of all one-word texts, unknown words of each class included, sum to
    at most one."""
    rows = [(i, t) for i, t in enumerate(["a b", "a c", "b a", "c", "a", "d d b a", "zz a"] * 3)]
    docs = spark.createDataFrame(rows + [(1000 + k, w) for k, w in enumerate(["a", "b", "c", "d", "zz", ""])], "doc_id long, text string")
    out = score_documents(docs, settings=Settings(singles=3, pools=4, classes=4, rounds=3)).where("doc_id >= 1000").collect()
    assert 0.2 < sum(10**r.score for r in out) <= 1 + 1e-9


def test_exchange_gains_equal_the_change_of_the_likelihood():
    rng = np.random.default_rng(0)
    units, n = 9, 4
    big = rng.integers(0, 6, (units, units)).astype(float)
    classes = np.array([0, 1, 2, 3, 1, 2, 3, 1, 2])

    def matrix(c):
        m = np.zeros((n, n))
        np.add.at(m, (c[:, None].repeat(units, 1), c[None].repeat(units, 0)), big)
        return m

    for u in range(1, units):
        after, before = (np.bincount(np.delete(classes, u), np.delete(v, u), n) for v in (big[u], big[:, u]))
        g = gains(classes[u], after, before, big[u, u], matrix(classes))
        for c in range(n):
            moved = classes.copy()
            moved[u] = c
            assert isclose(g[c], likelihood(matrix(moved)) - likelihood(matrix(classes)), abs_tol=1e-6)


def test_gains_of_many_units_equal_those_of_each():
    rng = np.random.default_rng(2)
    units, n = 30, 5
    big = rng.integers(0, 4, (units, units)) * (rng.random((units, units)) < 0.3).astype(float)
    classes = np.append(0, 1 + np.arange(units - 1) % (n - 1))
    big[7], big[:, 7] = 0, 0  # no neighbours
    m = np.zeros((n, n))
    np.add.at(m, (classes[:, None].repeat(units, 1), classes[None].repeat(units, 0)), big)
    sides = [[np.bincount(np.delete(classes, u), np.delete(v, u), n) for v in (big[u], big[:, u])] for u in range(1, units)]
    got = all_gains(classes[1:], np.array([a for a, _ in sides]), np.array([b for _, b in sides]), np.diagonal(big)[1:], m)
    for u in range(1, units):
        assert np.allclose(got[u - 1], gains(classes[u], *sides[u - 1], big[u, u], m), atol=1e-6)


def test_words_beyond_the_most_frequent_are_exchanged(spark):
    """Words of rank over 2,048 have units and get classes from their own contexts."""
    lexicon = Lexicon([b"w%d" % i for i in range(6000)], [4] * 5000 + [3] * 1000, 9, Settings())
    assert len(set(lexicon.units[:5000].tolist())) == 5000 and lexicon.units[:5000].max() == 5000 < lexicon.units[5000:6000].min()
    rows = [(0, 1, 400), (0, 2, 400)] + [(1 + i % 2, 3 + i, 2) for i in range(3000)] + [(3 + i, 0, 1) for i in range(3000)]
    bigrams = spark.createDataFrame(rows, "u int, v int, n long")
    classes, _ = exchange(bigrams, Settings(classes=5, rounds=8), 3003)
    even, odd = (Counter(classes[3 + k :: 2].tolist()) for k in (0, 1))
    assert sum(min(even[c], odd[c]) for c in range(5)) < 300


def test_packed_neighbours_are_the_sums_of_all_bigrams(spark):
    """Repeated bigrams of many tasks add up; a unit with most pairs stays in one row."""
    rng = random.Random(8)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(500), rng.randrange(500), rng.choice([1, 7, 1 << 40])) for _ in range(6000)] + [(3, 3, 5)] * 2
    places = Places(500, 7)

    def run(batches):
        for b in batches:
            yield from places.packed(*places.keys(*(c.to_numpy() for c in b.columns)), most=50)

    lists = _neighbours(spark.createDataFrame(rows, "u int, v int, n long").repartition(5).mapInArrow(run, PACKED), places, most=100)
    want = Counter()
    for u, v, n in rows:
        want[u, 2 * v] += n
        if u != v:
            want[v, 2 * u + 1] += n
    got, homes = {}, {}
    for i, r in enumerate(lists.toArrow().to_batches()):
        for j, (_, place, beside, n) in enumerate(places.read(r)):
            for u, b, k in zip(places.unit(place).tolist(), beside.tolist(), n.tolist()):
                assert (u, b) not in got and homes.setdefault(u, (i, j)) == (i, j)
                got[u, b] = k
    assert got == dict(want)


# ---------------------------------------------------------------- SimHash


def test_simhash_components_match_brute_force(edge_docs, edge_rows, spark):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in edge_rows] + [(100 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    fps = [fingerprint(t) for _, t in rows]
    root = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 3])
    smallest = {g: min((rows[i][0] for i in range(len(rows)) if root[i] == g and rows[i][0] is not None), default=None) for g in set(root)}
    key = lambda t: tuple(-1 if x is None else x for x in t)
    want = sorted((key((rows[i][0], f"{fps[i]:016x}", smallest[root[i]])) for i in range(len(rows))))
    assert sorted(key(tuple(r)) for r in near_duplicates(docs).collect()) == want


def test_simhash_tiles_lose_no_link(spark):
    """A dense group cut into tiny tiles stays one component; all links found."""
    from quire.llm.simhash_pivots import links

    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    got = links(spark.createDataFrame([(f,) for f in fps], "fp long"), 3, tile=16).collect()
    bits = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1")
    assert all(bits(r.u, r.v) <= 3 for r in got)
    want = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bits(fps[i], fps[j]) <= 3])
    at = {f: i for i, f in enumerate(fps)}
    assert groups(len(fps), [(at[r.u], at[r.v]) for r in got]) == want


def test_block_masks_cover_every_pattern_of_three_differences():
    masks, rng = block_masks(3), random.Random(2)
    for _ in range(2000):
        diff = sum({1 << rng.randrange(64) for _ in range(3)})
        assert any(diff & m == 0 for m in masks)


def test_simhash_empty_and_kept_columns(no_docs, edge_docs):
    assert near_duplicates(no_docs).count() == 0
    kept = keep_one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 0 in ids and 1 not in ids and 19 not in ids and 7 in ids


def test_one_row_of_a_group_stays_when_ids_repeat(spark):
    a, b, c = ("alpha beta gamma delta " * 30, "one two three four five " * 30, "sun moon star sky cloud rain " * 30)
    rows = [(3, a, "x"), (9, a, "x"), (9, b, "x"), (9, b, "y"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (12, b, "z")]
    kept = keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, a), (9, b), (None, c)], key=str)
    assert kept.columns == ["doc_id", "text", "fp"]


# ---------------------------------------------------------------- BPE


def test_transducer_equals_the_library(spark):
    import tiktoken

    ranks = read_ranks(MULTI)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    machine, rng, tokens = Transducer(ranks, limit=500), random.Random(4), list(ranks)
    for i in range(3000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5))) if i % 2 else bytes(rng.choice(b"aeinrst ") for _ in range(rng.randint(1, 40)))
        assert np.frombuffer(machine.encode(piece), "<u4").tolist() == lib._encode_single_piece(piece)


def test_states_that_share_a_hash_stay_apart(monkeypatch):
    import tiktoken

    weak = Lockstep._name
    monkeypatch.setattr(Lockstep, "_name", staticmethod(lambda *a: weak(*a) & 15))
    ranks, rng = read_ranks(MULTI), random.Random(9)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [bytes(rng.choice(b"aeinrst ") for _ in range(rng.randint(1, 30))) for _ in range(120)]
    found = Lockstep(Transducer(ranks)).encode(pieces)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [lib._encode_single_piece(p) for p in pieces]


def test_one_very_long_piece_in_bounded_memory():
    import tiktoken

    ranks, rng = read_ranks(MULTI), random.Random(10)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    machine = Transducer(ranks, limit=2000)
    piece = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(60_000))
    assert np.frombuffer(machine.encode(piece), "<u4").tolist() == lib._encode_single_piece(piece)
    assert len(machine.moves) <= 2000 and len(machine.final) <= 2002


def test_encode_and_decode_round_trip(edge_docs, edge_rows, no_docs):
    import tiktoken

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(MULTI), special_tokens={})
    out = decode_documents(encode_documents(edge_docs, MULTI, P.PATTERN), MULTI, block=7).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out)
    want = sorted((r[0] is None, r[0] or 0, lib.encode_ordinary(r[1] or ""), r[1] or "") for r in edge_rows)
    assert got == want
    assert encode_documents(no_docs, MULTI, P.PATTERN).count() == 0


def test_utf8_stream_agrees_with_the_whole_decode():
    rng = random.Random(6)
    for _ in range(500):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x82, 0xFF, 0xED, 0xA0, 0x80]) for _ in range(rng.randint(0, 30)))
        stream, out, at = Utf8Stream(), "", 0
        while at < len(data):
            n = rng.randint(1, 4)
            out += stream.feed(data[at : at + n])
            at += n
        assert out + stream.finish() == data.decode("utf-8", "replace")


# ---------------------------------------------------------------- licenses

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def test_license_places_match_brute_force(edge_docs, edge_rows, no_docs):
    want = []
    for r in edge_rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").translate(ASCII))
        at = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
        first, last = (min(at)[0], max(at)[0]) if at else (-1, -1)
        want.append((-1 if r[0] is None else r[0], len(w), len(at), first, last, ",".join(sorted({x for _, x in at}))))
    out = scan_licenses(edge_docs).collect()
    none = lambda x: -1 if x is None else x
    assert sorted((none(r.doc_id), r.n_words, r.n_base, none(r.first_word), none(r.last_word), r.base_labels) for r in out) == sorted(want)
    assert all(0 <= r.score <= 1 for r in out)
    assert scan_licenses(no_docs).count() == 0


def test_edited_notice_is_found_over_neighbouring_diagonals(spark):
    text = (
        "x y z. Permission is hereby granted, entirely free of charge, to any person obtaining a fresh copy of this software and associated files. "
        "Licensed under CC BY-NC 4.0."
    )
    docs = spark.createDataFrame([(1, text), (2, "permission is given to any person of this world")], "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert out[1].labels == "cc-by-nc,mit" and out[1].n_base == 0 and out[1].base_labels == ""
    assert out[2].labels == "" and out[2].score == 0 and out[2].first_word is None


def test_a_notice_split_by_words_put_in_is_found_and_repeated_pieces_are_not(spark):
    split = "Permission is hereby granted, free of charge, by the holders named below here, to any person obtaining a copy of this software and files"
    pieces = "free of charge " * 4 + "of this software " * 3 + "to any person " * 2 + "hereby granted"
    docs = spark.createDataFrame([(1, split), (2, pieces)], "doc_id long, text string")
    out = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert out[1].labels == "mit"
    assert out[2].labels == "" and out[2].score == 0


def test_bands_equal_brute_force(spark):
    rng, ts = random.Random(6), templates()
    texts = []
    for _ in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            _, _, _, t = rng.choice(ts)
            a = rng.randrange(len(t))
            w += [x for x in t[a : a + rng.randint(2, len(t))] if rng.random() < 0.93] + [rng.choice(["of", "this", "copy", "zz"]) for _ in range(rng.randint(0, 9))]
        texts.append(" ".join(w))
    want = []
    for i, text in enumerate(texts):
        w, labels, score = text.split(), set(), 0.0
        for _, label, phrase, t in ts:
            hits = [(p - k, k) for p in range(len(w) - 1) for k in range(len(t) - 1) if w[p : p + 2] == t[k : k + 2]]
            wide = 0 if phrase else max(4, 2 ** int(math.log2(max(1, (len(t) - 1) // 2))))
            best = max([len({k for e, k in hits if d <= e <= d + wide}) / (len(t) - 1) for d, _ in hits], default=0)
            if best >= (1 if phrase else 0.6):
                labels.add(label)
                score = max(score, best)
        want.append((i, ",".join(sorted(labels)), score))
    out = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.labels, r.score) for r in out) == want
    assert sum(bool(x) for _, x, _ in want) > 10


# ---------------------------------------------------------------- packing


def test_packing_invariants(edge_docs, edge_rows, no_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = pack_documents(edge_docs, P.path("byte_bpe_50k.json"), seq_len=64, block_tokens=5000).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        assert 1 <= r.length <= 64 and len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or at & (at - 1) == 0
    want = Counter((r[0], tuple(tok.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in edge_rows)
    # Pieces of one id come from rows with that id; ids of one text are put together.
    by_size = {}
    for r in rows:
        by_size.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(tuple(np.frombuffer(r.ids, "<u4").tolist()))
    for (doc, ids), n in want.items():
        pieces = by_size[doc, len(ids)]
        at = 0
        while at < len(ids):
            options = [p for p in pieces[at] if ids[at : at + len(p)] == p]
            assert options
            at += len(options[0])
    assert sum(r.length for r in rows) == sum(len(k[1]) * n for k, n in want.items())
    assert pack_documents(no_docs, P.path("byte_bpe_50k.json")).count() == 0


def test_pack_lengths_balances_cost():
    rng = random.Random(8)
    lengths = [rng.randint(1, 900) for _ in range(800)]
    pieces = pack_lengths(lengths, 1024, 1.0, 1 / 1024)
    cost = Counter()
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
    fill = Counter()
    for _, _, n, s, _ in pieces:
        fill[s] += n
    assert all(f == 1024 or f & (f - 1) == 0 for f in fill.values())
    full = [cost[s] for s in fill if fill[s] == 1024]
    assert np.std(full) / np.mean(full) < 0.25
    with pytest.raises(ValueError):
        pack_documents(None, "x", seq_len=1000)


# ---------------------------------------------------------------- substring dedup


def brute_cut(rows, window):
    last = 1 << 62
    first, out = {}, []
    for i, t in sorted(((last if i is None else i, t) for i, t in rows), key=lambda r: r[0]):
        w = words(t)
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, last), i)
    for i, t in rows:
        me, w = last if i is None else i, words(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < me:
                gone[p : p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window,phrase", [(50, 20), (6, 3)])
def test_cut_words_match_brute_force(edge_docs, edge_rows, window, phrase):
    out = dedup_substrings(edge_docs, window=window, phrase=phrase, shard_words=2000, salt_words=200).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out)
    assert got == brute_cut([(r[0], r[1]) for r in edge_rows], window)


def test_cut_words_on_random_overlaps(spark):
    """Small alphabet: windows recur everywhere, inside one text too, in any order."""
    rng = random.Random(9)
    pool = [" ".join(rng.choice("ab") for _ in range(12)) for _ in range(6)]
    rows = [(rng.randint(0, 25), " ".join(rng.choice(pool) for _ in range(rng.randint(0, 4)))) for _ in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = dedup_substrings(docs, window=8, phrase=4, salt_words=50).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute_cut(rows, 8)


def test_automata_cut_long_passages_without_loss():
    rng = random.Random(10)
    text = [b"w%d" % rng.randrange(300) for _ in range(3000)]
    found = list(occurrences([(1, text)], [(1, 7, 5, [b"x", *text[400:1900], b"y"]), (2, 8, 0, text)], 50, most=200))
    covered = {i for tag, a, z in found if tag == 7 for i in range(a, z)}
    assert covered == set(range(6, 1506)) and all(tag == 7 for tag, _, _ in found)


def test_texts_without_repeats_keep_rows_and_columns(edge_docs, edge_rows, no_docs):
    cut = without_repeats(edge_docs)
    assert cut.columns == edge_docs.columns and cut.count() == len(edge_rows)
    assert without_repeats(no_docs).count() == 0
    same = {r.doc_id: r.text for r in cut.collect()}
    assert same[7] == edge_rows[7][1] and same[19] == ""


def test_text_neighbours_flush_by_distinct_bigrams(spark):
    from collections import Counter

    from quire.llm import brown_classes as bc

    rows = [(i, "a b " * 300 + f"c{i % 3} d") for i in range(8)] + [(8, None), (9, "")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    lexicon = bc.Lexicon([b"a", b"b"], [2400, 2400], 10, bc.Settings())
    places = bc.Places.for_tokens(lexicon.n_units, 5000)
    want = Counter()
    for _, text in rows:
        words = (text or "").split()
        units = [0, *[{"a": 1, "b": 2}.get(w) or lexicon.pool(w.encode()) for w in words], 0]
        for u, v in zip(units, units[1:]):
            want[u, 2 * v] += 1
            if u != v:
                want[v, 2 * u + 1] += 1
    for most in (2, 1_000_000):
        got = Counter()
        for b in bc._text_neighbours(texts, lexicon, places, most).toArrow().to_batches():
            for _, place, beside, n in places.read(b):
                got.update({(int(u), int(x)): int(k) for u, x, k in zip(places.unit(place), beside, n)})
        assert got == want
