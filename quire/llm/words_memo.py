"""Splitting a text into chunks that a byte-level BPE treats independently.

The published byte-level pattern always starts a new piece at a single space or a
single newline between two visible characters, so such a text is the concatenation of
its space-led words and its newlines, and each word can be encoded once and reused.
A text with any other white space, or with two spaces in a row, is encoded whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_IRREGULAR = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")


def regular(text: str, specials: tuple[str, ...] = ()) -> bool:
    return bool(text) and not _IRREGULAR.search(text) and not any(s in text for s in specials)


class WordMemo:
    """Bounded memo word → encoded bytes; ``encode_many(list[str]) -> list[bytes]`` is the
    real codec. ``limit`` bounds the entries kept: a word met once the memo is full is
    encoded again in each batch that has it, so the bound changes speed only."""

    def __init__(self, encode_many, specials: tuple[str, ...] = (), limit: int = 400_000, longest: int = 64):
        self.encode_many, self.specials, self.limit, self.longest = encode_many, specials, limit, longest
        self.led: dict[str, bytes] = {}  # words after a space
        self.first: dict[str, bytes] = {}  # words that open a line
        self.newline = encode_many(["\n"])[0]

    def _learn(self, memo: dict[str, bytes], words: set[str], lead: str) -> dict[str, bytes]:
        """Encode the words the memo lacks; those it doesn't keep are returned."""
        new = [w for w in words if w not in memo]
        room = self.limit - len(memo)
        passing = {}
        for w, ids in zip(new, self.encode_many([lead + w for w in new])):
            if room > 0 and len(w) <= self.longest:
                memo[w] = ids
                room -= 1
            else:
                passing[w] = ids
        return passing

    def encode(self, texts: list[str]) -> list[bytes]:
        """Encoded bytes of every text, in order."""
        out: list[bytes | None] = [None] * len(texts)
        split: list[tuple[int, list[list[str]]]] = []
        whole: list[int] = []
        led: set[str] = set()
        first: set[str] = set()
        for i, t in enumerate(texts):
            if regular(t, self.specials):
                lines = [x.split(" ") for x in t.split("\n")]
                for words in lines:
                    first.add(words[0])
                    led.update(words[1:])
                split.append((i, lines))
            else:
                whole.append(i)
        passing_led = self._learn(self.led, led, " ")
        passing_first = self._learn(self.first, first, "")
        kept_led, kept_first = self.led.get, self.first.get
        for i, lines in split:
            parts = []
            for k, words in enumerate(lines):
                if k:
                    parts.append(self.newline)
                parts.append(passing_first[words[0]] if words[0] in passing_first else kept_first(words[0]))
                if passing_led:
                    parts.extend([passing_led[w] if w in passing_led else kept_led(w) for w in words[1:]])
                else:
                    parts.extend(map(kept_led, words[1:]))
            out[i] = b"".join(parts)
        for i, ids in zip(whole, self.encode_many([texts[i] for i in whole])):
            out[i] = ids
        return out


#: White space besides the blank and the line feed, as a class of code points.
_OTHER_SPACE = r"\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = rf"[{_OTHER_SPACE}]|[ \n][ \n]|\A[ \n]|[ \n]\z"


class WordBlocks:
    """Encodes a block of texts by its distinct words: Arrow splits the texts and numbers the
    words, every distinct word is looked up once a block, and the ids are gathered in one
    step. Words the memo lacks are encoded as the lines of one text, at whose line feeds the
    ids are parted again. ``encode_text(str) -> list[int]`` is the real codec; ``limit``
    bounds the words kept and changes speed only."""

    def __init__(self, encode_text, specials: tuple[str, ...] = (), limit: int = 600_000, longest: int = 64, together: int = 20_000):
        self.encode_text, self.specials, self.limit, self.longest, self.together = encode_text, specials, limit, longest, together
        self.led: dict[str, bytes] = {}  # words after a blank
        self.first: dict[str, bytes] = {}  # words that open a line
        self.newline = np.array(encode_text("\n"), "<u4")
        assert len(self.newline) == 1

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Texts that aren't just words with one blank or line feed between them."""
        found = pc.match_substring_regex(texts, _ODD)
        for s in self.specials:
            found = pc.or_(found, pc.match_substring(texts, s))
        found = pc.or_(found, pc.equal(pc.binary_length(texts), 0))
        return np.asarray(found.to_numpy(zero_copy_only=False), bool)

    def _learned(self, words: list[str], lead: str) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), self.together):
            some = words[i : i + self.together]
            ids = np.array(self.encode_text("\n".join([lead + w for w in some])), "<u4")
            ends = np.append(np.flatnonzero(ids == self.newline[0]), len(ids))
            assert len(ends) == len(some)
            begin = np.append(0, ends[:-1] + 1)
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), ends.tolist())]
        return out

    def _looked_up(self, memo: dict[str, bytes], words: list[str], lead: str) -> list[bytes]:
        found = list(map(memo.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        room = self.limit - len(memo)
        for i, ids in zip(new, self._learned([words[i] for i in new], lead)):
            found[i] = ids
            if room > 0 and len(words[i]) <= self.longest:
                memo[words[i]] = ids
                room -= 1
        return found

    def _regular(self, texts: pa.Array) -> list[bytes]:
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        starts = np.asarray(pieces.offsets)
        coded = pieces.values.dictionary_encode()
        codes, words = np.asarray(coded.indices), coded.dictionary
        breaks = np.flatnonzero(np.asarray(pc.equal(words, "\n")))
        is_break = codes == breaks[0] if len(breaks) else np.zeros(len(codes), bool)
        opens = np.zeros(len(codes), bool)
        opens[starts[:-1]] = True
        opens[1:] |= is_break[:-1]
        n = len(words)
        # Entries: words after a blank, words that open a line, the line feed.
        entry = np.where(is_break, 2 * n, codes + n * opens)
        used = np.zeros(2 * n + 1, bool)
        used[entry] = True
        led, first = np.flatnonzero(used[:n]), np.flatnonzero(used[n : 2 * n])
        parts = self._looked_up(self.led, words.take(pa.array(led)).to_pylist(), " ")
        parts += self._looked_up(self.first, words.take(pa.array(first)).to_pylist(), "")
        parts.append(self.newline.tobytes())
        size = np.zeros(2 * n + 1, "i8")
        begin = np.zeros(2 * n + 1, "i8")
        at = np.concatenate((led, n + first, [2 * n]))
        size[at] = np.fromiter(map(len, parts), "i8", len(parts)) // 4
        begin[at] = np.cumsum(size[at]) - size[at]
        store = np.frombuffer(b"".join(parts), "<u4")
        each = size[entry]
        ends = np.append(0, np.cumsum(each))
        ids = store[np.repeat(begin[entry] - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[starts]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text, in order, as little-endian unsigned 32-bit integers; null as empty."""
        texts = texts.fill_null("")
        odd = self.odd(texts)
        out: list[bytes] = [b""] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            for i, ids in zip(plain.tolist(), self._regular(texts.take(pa.array(plain)))):
                out[i] = ids
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.encode_text(texts[i].as_py()), "<u4").tobytes()
        return out
