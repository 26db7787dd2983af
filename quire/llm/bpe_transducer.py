"""Byte-level BPE as a lazily determinised finite-state transducer.

Merges are compiled, not replayed. A token sequence is the BPE encoding of its bytes
exactly when every two neighbours encode to themselves, so an encoding can be grown
byte by byte: a configuration is a place in the vocabulary's trie, the token before it
and the tokens found since the last output. Reading a byte moves every configuration
down the trie; the one that completes a token compatible with the token before it
opens the configuration that starts anew. The set of configurations is a state of the
determinised machine. What all of them agree on is emitted at once; they can differ for
no longer than the longest token, which bounds the lookahead and the state. States and
transitions are made when first met and kept (``limit`` transitions, then forgotten).

Decoding streams blocks of ids through an incremental UTF-8 state machine that holds
back at most three bytes of an unfinished character.

Defined results: a null text is empty (no ids, empty decoded text); a null ``doc_id``
stays null; repeated rows are encoded each; an empty table gives no rows; other columns
are ignored. Bytes that are no UTF-8 decode to U+FFFD, one per maximal subpart.
"""

from __future__ import annotations

import base64
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import documents, pieces_of
from quire.llm.words_memo import WordMemo

_MACHINES: dict[str, "Transducer"] = {}
_CODECS: dict[tuple[str, str], WordMemo] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """``base64 token, rank`` lines of a public rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Transducer:
    """``_configurations[state]``: ``(trie node, token before it, tokens since the last
    output)``, oldest first. What the oldest has read and the token before it determine
    the others, so that pair of numbers names the state."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 200_000):
        self.ranks, self.limit = ranks, limit
        self.token = {r: t for t, r in ranks.items()}
        self.packed = {r: pack("<I", r) for r in self.token}
        self.child: dict[int, int] = {}  # node << 8 | byte → node
        self.ends: list[int] = [-1]  # token that ends at a trie node
        for t, r in ranks.items():
            node = 0
            for b in t:
                node = self.child.setdefault(node << 8 | b, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = r
        self.inner = bytearray(len(self.ends))  # nodes that lead on
        for k in self.child:
            self.inner[k >> 8] = 1
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self._forget()

    def _forget(self, state: int = 0) -> int:
        """Forget all states but the first and ``state``, which gets the number returned."""
        kept = (self._configurations[state], self.final[state]) if state else None
        self._configurations = [((0, -1, ()),)]
        self._number = {0: 0}
        self.final: list[bytes] = [b""]
        self.moves: dict[int, tuple[int, bytes]] = {}
        if len(self._fits) > self.limit:
            self._fits.clear()
        if kept is None:
            return 0
        self._configurations.append(kept[0])
        self.final.append(kept[1])
        return 1

    def halves(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge makes the token; None for a byte. A token that merging
        its own bytes doesn't reach has no pair and is never used: ``(-1, -1)``."""
        if token not in self._halves:
            text = self.token[token]
            parts, rank = [text[i : i + 1] for i in range(len(text))], self.ranks.get
            while len(parts) > 2:
                merged = [rank(x + y, token) for x, y in zip(parts, parts[1:])]
                low = min(merged)
                if low >= token:
                    break
                i = merged.index(low)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            pair = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (-1, -1)
            self._halves[token] = None if len(text) == 1 else pair
        return self._halves[token]

    def fits(self, before: int, token: int) -> bool:
        """May ``token`` follow ``before`` (-1: open a text) in an encoding? Undo the
        merges of the two on both sides of their border, latest first; they may not if
        some pair across the border would have merged earlier."""
        if before < 0:
            return self.halves(token) != (-1, -1)
        key = before << 32 | token
        known = self._fits.get(key)
        if known is None:
            known = self._fits[key] = self.halves(token) != (-1, -1) and self._apart(before, token)
        return known

    def _apart(self, left: int, right: int) -> bool:
        token, rank = self.token, self.ranks.get
        # Merges made on the left before time ``t`` are those of rank below ``t``; at equal
        # rank the leftmost merge comes first.
        time = 1 << 40
        while True:
            across = rank(token[left] + token[right])
            if across is not None and across < time:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                time, left = left, a[1]
            else:
                time, right = right + 1, b[0]

    def _move(self, state: int, byte: int) -> tuple[int, bytes]:
        child, ends, inner = self.child.get, self.ends, self.inner
        alive, opened = [], None
        for node, before, found in self._configurations[state]:
            nxt = child(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                alive.append((nxt, before, found))
            if opened is None:
                token = ends[nxt]
                if token >= 0:
                    fit = self._fits.get(before << 32 | token)
                    if self.fits(before, token) if fit is None else fit:
                        opened = (0, token, (*found, token))
        if opened is None:
            raise ValueError("the vocabulary lacks a byte of the text")
        alive.append(opened)
        node, before, first = alive[0]
        out = b""
        if first:  # the oldest configuration ended: some tokens may be certain now
            sure = len(first)
            for _, _, found in alive[1:]:
                n = 0
                while n < min(sure, len(found)) and found[n] == first[n]:
                    n += 1
                sure = n
            out = b"".join([self.packed[t] for t in first[:sure]])
            alive = [(node, before, found[sure:]) for node, before, found in alive]
            first = first[sure:]
        n = len(self._configurations)
        number = n if first else self._number.setdefault((before + 1) * len(ends) + node, n)
        if number == n:
            self._configurations.append(tuple(alive))
            self.final.append(b"".join([self.packed[t] for t in alive[-1][2]]))
        move = self.moves[state << 8 | byte] = (number, out)
        return move

    def encode(self, piece: bytes) -> bytes:
        """Ids of one piece of the split pattern, packed as ``<u4``."""
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token stands for itself
            return self.packed[whole]
        state, out, moves = 0, [], self.moves.get
        for b in piece:
            move = moves(state << 8 | b)
            if move is None:
                if len(self.moves) >= self.limit:  # inside a piece, too: memory stays bounded
                    state = self._forget(state)
                    moves = self.moves.get
                move = self._move(state, b)
            state, sure = move
            if sure:
                out.append(sure)
        out.append(self.final[state])
        return b"".join(out)


class Lockstep:
    """The same determinised machine, read by many short pieces at once: one step moves all
    pieces by a byte. States are runs of ``(trie node, token before it)`` in flat arrays,
    transitions are sorted keys ``state << 8 | byte`` with the next state and the last
    token of the text read so far; those missing at a step are made together. Where the
    oldest configuration starts, all that lies before is certain; pieces are short, so
    their tokens are read back from the last ones when a piece ends."""

    LONGEST = 128

    def __init__(self, machine: Transducer, limit: int = 2_000_000):
        self.machine, self.limit = machine, limit
        keys = np.fromiter(machine.child.keys(), "i8", len(machine.child))
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.fromiter(machine.child.values(), "i4", len(keys))[order]
        self.ends, self.inner = np.array(machine.ends, "i4"), np.frombuffer(bytes(machine.inner), "u1").astype(bool)
        self.length = np.ones(max(machine.token) + 1, "i8")
        for r, t in machine.token.items():
            self.length[r] = len(t)
        self._forget()

    def _forget(self) -> None:
        self.first, self.count = np.zeros(1, "i8"), np.ones(1, "i8")
        self.node, self.before = np.zeros(1, "i4"), np.full(1, -1, "i4")
        zero = np.zeros(1, "i8")
        self.state_key, self.state = self._name(self.node, self.before, zero, zero), np.zeros(1, "i4")
        self.move_key = np.full(1, 1 << 62, "i8")  # sorted; a sentinel ends them
        self.move_to, self.move_token = np.zeros(1, "i4"), np.zeros(1, "i4")

    def _fit(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        pairs, at = np.unique((before.astype("i8") + 1) << 32 | token, return_inverse=True)
        fits = self.machine.fits
        return np.array([fits((p >> 32) - 1, p & 0xFFFFFFFF) for p in pairs.tolist()], bool)[at]

    @staticmethod
    def _name(node: np.ndarray, before: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each state's configurations, in order."""
        with np.errstate(over="ignore"):
            x = node.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + (before + 2).astype("u8") * np.uint64(0xC2B2AE3D27D4EB4F)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(32))) * (2 * place.astype("u8") + np.uint64(0x94D049BB133111EB))
            return np.add.reduceat(x ^ (x >> np.uint64(31)), first).view("i8")

    def _make(self, moves: np.ndarray) -> None:
        """Make the transitions ``moves`` (distinct keys, ascending)."""
        state, byte = moves >> 8, moves & 255
        count = self.count[state]
        owner = np.repeat(np.arange(len(moves)), count)
        row = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + self.first[state][owner]
        key = self.node[row].astype("i8") << 8 | byte[owner]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        goes = self.keys[at] == key
        owner, node, before = owner[goes], self.nodes[at[goes]], self.before[row[goes]]
        token = self.ends[node]
        ending = np.flatnonzero(token >= 0)
        ending = ending[self._fit(before[ending], token[ending])]
        opened = np.full(len(moves), -1, "i4")
        opened[owner[ending]] = token[ending]
        if (opened < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        on = self.inner[node]
        owner = np.concatenate((owner[on], np.arange(len(moves))))  # the one opened is the youngest
        node = np.concatenate((node[on], np.zeros(len(moves), "i4")))
        before = np.concatenate((before[on], opened))
        order = np.argsort(owner, kind="stable")
        owner, node, before = owner[order], node[order], before[order]
        count = np.bincount(owner, minlength=len(moves))
        first = np.cumsum(count) - count
        key = self._name(node, before, np.arange(len(node)) - first[owner], first)
        keys, example, of = np.unique(key, return_index=True, return_inverse=True)
        at = np.searchsorted(self.state_key, keys)
        known = (at < len(self.state_key)) & (self.state_key[np.minimum(at, len(self.state_key) - 1)] == keys)
        number = np.where(known, self.state[np.minimum(at, len(self.state) - 1)], 0)
        new = np.flatnonzero(~known)
        number[new] = len(self.first) + np.arange(len(new))
        took = example[new]
        rows = np.repeat(first[took] - (np.cumsum(count[took]) - count[took]), count[took]) + np.arange(count[took].sum())
        self.first = np.concatenate((self.first, len(self.node) + np.cumsum(count[took]) - count[took]))
        self.count = np.concatenate((self.count, count[took]))
        self.node, self.before = np.concatenate((self.node, node[rows])), np.concatenate((self.before, before[rows]))
        self.state_key, self.state = np.insert(self.state_key, at[new], keys[new]), np.insert(self.state, at[new], number[new])
        number = number[of]
        # Equal hashes are no proof: the configurations are compared, and a state that only
        # shares another's hash gets a number of its own.
        other = self.first[number][owner] + np.arange(len(node)) - first[owner]
        other = np.minimum(other, len(self.node) - 1)
        same = np.logical_and.reduceat((self.node[other] == node) & (self.before[other] == before), first) & (self.count[number] == count)
        for k in np.flatnonzero(~same).tolist():
            number[k] = len(self.first)
            rows = slice(first[k], first[k] + count[k])
            self.first, self.count = np.append(self.first, len(self.node)), np.append(self.count, count[k])
            self.node, self.before = np.append(self.node, node[rows]), np.append(self.before, before[rows])
        at = np.searchsorted(self.move_key, moves)
        self.move_key = np.insert(self.move_key, at, moves)
        self.move_to, self.move_token = np.insert(self.move_to, at, number), np.insert(self.move_token, at, opened)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece (not empty, at most ``LONGEST`` bytes), packed as ``<u4``."""
        if not pieces:
            return []
        if len(self.move_key) > self.limit:
            self._forget()
        size = np.array([len(p) for p in pieces])
        order = np.argsort(-size, kind="stable")
        start = (np.cumsum(size) - size)[order]
        text, left = np.frombuffer(b"".join(pieces), "u1").astype("i8"), np.sort(size)
        state, last = np.zeros(len(pieces), "i8"), np.zeros(len(text), "i4")
        for i in range(int(left[-1])):
            n = len(pieces) - int(np.searchsorted(left, i, side="right"))
            at = start[:n] + i
            key = state[:n] << 8 | text[at]
            found = np.searchsorted(self.move_key, key)
            missing = self.move_key[found] != key
            if missing.any():
                self._make(np.unique(key[missing]))
                found = np.searchsorted(self.move_key, key)
            state[:n], last[at] = self.move_to[found], self.move_token[found]
        begin, at = np.cumsum(size) - size, np.cumsum(size)
        rounds, going = [], np.arange(len(pieces))
        n_tokens = np.zeros(len(pieces), "i8")
        while len(going):
            token = last[at[going] - 1]
            rounds.append((going, token))
            at[going] -= self.length[token]
            n_tokens[going] += 1
            going = going[at[going] > begin[going]]
        close = np.cumsum(n_tokens)
        out = np.zeros(int(close[-1]), "<u4")
        for k, (going, token) in enumerate(rounds):
            out[close[going] - 1 - k] = token
        raw, cut = out.tobytes(), (4 * close).tolist()
        return [raw[a:z] for a, z in zip([0, *cut], cut)]


class Utf8Stream:
    """Incremental UTF-8 state machine: the state is the unfinished character's bytes."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many last bytes may still become a character."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b < 0x80:
                return 0
            if b >= 0xC0:  # a lead byte: 2, 3 or 4 bytes long, second byte limited
                need = 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0
                if back >= need:
                    return 0
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
                return back if back == 1 or low <= data[-back + 1] <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def _machine(path: str) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(read_ranks(path))
    return _MACHINES[path]


def _codec(path: str, pattern: str) -> WordMemo:
    if (path, pattern) not in _CODECS:
        import regex

        split, machine = regex.compile(pattern).findall, _machine(path)
        ranks, packed, short = machine.ranks, machine.packed, Lockstep(machine)

        def encode_many(texts: list[str]) -> list[bytes]:
            cut = [[p.encode() for p in split(t)] for t in texts]
            new = list({p for pieces in cut for p in pieces if p not in ranks})  # a piece that is a token stands for itself
            small = [p for p in new if len(p) <= short.LONGEST]
            ids = dict(zip(small, short.encode(small)))
            ids.update((p, machine.encode(p)) for p in new if len(p) > short.LONGEST)
            return [b"".join([packed[ranks[p]] if p in ranks else ids[p] for p in pieces]) for pieces in cut]

        _CODECS[path, pattern] = WordMemo(encode_many)
    return _CODECS[path, pattern]


class Decoder:
    """Bytes of many ids at once, gathered from the vocabulary laid end to end."""

    def __init__(self, token: dict[int, bytes]):
        n = max(token) + 1
        texts = [token.get(i, b"") for i in range(n)]
        self.size = np.array([len(t) for t in texts], "i8")
        self.at = np.cumsum(self.size) - self.size
        self.text = np.frombuffer(b"".join(texts), "u1")

    def __call__(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        shift = self.at[ids] - (np.cumsum(size) - size)
        return self.text[np.arange(int(size.sum())) + np.repeat(shift, size)].tobytes()


def _text_of(ids: bytes, decode: Decoder, block: int) -> str:
    numbers, stream = np.frombuffer(ids, "<u4"), Utf8Stream()
    return "".join([*(stream.feed(decode(numbers[i : i + block])) for i in range(0, len(numbers), block)), stream.finish()])


def encode_documents(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, block: int = 4096
) -> DataFrame:
    """``doc_id, ids``: the ids of the whole text, little-endian unsigned 32-bit. With
    ``decoded``, also the text that the ids decode to, streamed ``block`` ids at a time."""

    def run(batches):
        codec = _codec(ranks_path, pattern)
        decode = Decoder(_machine(ranks_path).token) if decoded else None
        for big in batches:
            for b in pieces_of(big, 2048):
                ids = codec.encode(["" if t is None else t for t in b.column(1).to_pylist()])
                out = {"doc_id": b.column(0), "ids": pa.array(ids, pa.binary())}
                if decode:
                    out["decoded"] = pa.array([_text_of(x, decode, block) for x in ids], pa.string())
                yield pa.RecordBatch.from_pydict(out)

    return documents(df, id_col, text_col).mapInArrow(run, "doc_id long, ids binary" + ", decoded string" * decoded)


def decode_documents(encoded: DataFrame, ranks_path: str, block: int = 4096) -> DataFrame:
    """``doc_id, ids`` → the same and ``decoded``, streamed ``block`` ids at a time; null
    ids decode to an empty text."""

    def run(batches):
        decode = Decoder(_machine(ranks_path).token)
        for big in batches:
            for b in pieces_of(big):
                texts = [_text_of(x, decode, block) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(run, "doc_id long, ids binary, decoded string")
