"""Byte-level BPE as a deterministic tokenization automaton.

Construction. The automaton over tokens starts with one state and a loop for each of the 256 bytes: every byte string, unmerged. Merges are
put in one after the other, each as a gadget. For a merge (a, b) -> c: where an a-arc ends in state p and p has a b-arc to r, the a-arcs are
led to a copy of p without its b-arc, and every state that had an a-arc gets a c-arc to r. All arcs of one token lead to one state
throughout, so a merge adds one state at most. After the last merge exactly the correct token sequences are accepted, and each byte string
has one accepting path.

Compiled form. A c-arc is missing wherever the a-arc of its left part had been taken away before c was made. So arcs are numbered by a
post-order walk of the tokens under their left parts, parts of one token in the order in which they were made: what one gadget takes from a
state for good is then one range of arc numbers. A state's row is the sorted list of its missing ranges, compiled once, gadget by gadget, as
the row of the state it was copied from with one more range; a transition (state, arc) is looked up by bisection of the row. State 0 has no
missing range: it has an arc for every token.

Encoding walks a word from state 0: at each byte the longest label first whose arc the state has; at a dead end the last arc is given up and
the place remembered, so that no (place, arc) is tried twice. As the accepting path is the only one, the first path that reaches the end is it.
Decoding emits the labels of the arcs.

Texts are cut into words by the file's own pattern first; a word's path does not depend on its surroundings, so paths of words seen lately
are remembered (a table of bounded size, whose older half is forgotten when it is full).

Defined results: null counts as empty, with no ids; a special token's spelling in a text is that token; equal rows give equal results, each
its own row; there are no ties, as a word has one path; a text of any length is coded whole, with memory in proportion to it; null ids are
kept; empty tables give no rows; further columns are ignored. A file of another kind (normaliser, other word pattern) is refused.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from episoda.llm import common, tokens

#: The word pattern that byte-level files of this kind are used with, and what the file has to say for it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_KIND = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_WORDS_MAX, _LONG = 400_000, 64


class Automaton:
    """Rows of states, the state that each token's arcs lead to, and the number of each token's arc."""

    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        """merges in order; ids of all byte strings that are tokens, the 256 single bytes among them."""
        steps = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        if len({c for _, _, c in steps}) < len(steps) or any(len(t) == 1 for t in (a + b for a, b in merges)):
            raise ValueError("two merges make the same token")
        self._number(steps, [ids[bytes([b])] for b in range(256)])
        rows, start = [array("i")], {ids[bytes([b])]: 0 for b in range(256)}
        self.copied_from = [-1]
        for step, (a, b, c) in enumerate(steps):
            if a not in start or b not in start or bisect_right(rows[start[a]], self.arc[b]) & 1:
                continue  # a and b never stand side by side: the gadget changes nothing, and c has no arc
            target = start[b]
            rows.append(self._without(rows[start[a]], *self._range(b, step)))
            self.copied_from.append(start[a])
            start[a], start[c] = len(rows) - 1, target
        self.rows = array("i", [x for row in rows for x in row])
        self.row_at = array("i", np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32).tolist())
        self.state_of = start
        del self.parts, self.made, self.first
        label = {i: t for t, i in ids.items()}
        self.labels = ahocorasick.Automaton()  # only its trie is used: how far a text runs along some label
        #: the arcs of state 0, by label: (token, arc number, begin and end of the row of the state it leads to, length, the next shorter label that it begins with)
        self.arcs: dict[str, tuple] = {}
        for text, t, s in sorted((label[t].decode("latin-1"), t, s) for t, s in start.items()):
            shorter = next((self.arcs[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.arcs), None)
            self.arcs[text] = (t, self.arc[t], self.row_at[s], self.row_at[s + 1], len(text), shorter)
            self.labels.add_word(text, 0)
        self.most = max(map(len, self.arcs))

    def _number(self, steps: list[tuple[int, int, int]], singles: list[int]) -> None:
        self.parts: dict[int, list[int]] = {}
        self.made: dict[int, list[int]] = {}
        for step, (a, _, c) in enumerate(steps):
            self.parts.setdefault(a, []).append(c)
            self.made.setdefault(a, []).append(step)
        self.arc: dict[int, int] = {}
        self.first: dict[int, int] = {}  # lowest number below a token
        for root in singles:
            stack = [(root, False)]
            while stack:
                token, done = stack.pop()
                if done:
                    self.arc[token] = len(self.arc)
                    continue
                self.first[token] = len(self.arc)
                stack.append((token, True))
                stack += [(c, False) for c in reversed(self.parts.get(token, []))]

    def _range(self, b: int, step: int) -> tuple[int, int]:
        """Arc numbers that a state lacks for good once its b-arc goes at `step`: b and what is built on it from then on."""
        k = bisect_left(self.made.get(b, []), step)
        later = self.parts.get(b, [])[k : k + 1]
        return (self.first[later[0]] if later else self.arc[b]), self.arc[b] + 1

    @staticmethod
    def _without(row: array, low: int, high: int) -> array:
        i, j = bisect_left(row, low), bisect_right(row, high)
        return row[:i] + array("i", [low] * (i % 2 == 0) + [high] * (j % 2 == 0)) + row[j:]

    def has_arc(self, state: int, token: int) -> bool:
        """The transition table: whether the state has an arc of the token."""
        return token in self.state_of and not (bisect_right(self.rows, self.arc[token], self.row_at[state], self.row_at[state + 1]) - self.row_at[state]) & 1

    def path(self, word: bytes) -> list[int]:
        """The arcs of the one accepting path that spells `word`."""
        text, rows, arcs, longest, most, n = word.decode("latin-1"), self.rows, self.arcs, self.labels.longest_prefix, self.most, len(word)
        way: list[tuple] = []
        dead: set[tuple[int, int]] = set()
        at = low = high = 0
        found = (arcs.get(text) or self._from(text, longest(text))) if text else None
        while at < n:
            while found is not None and ((bisect_right(rows, found[1], low, high) - low) & 1 or (dead and (at + found[4], found[0]) in dead)):
                found = found[5]
            if found is not None:
                way.append(found)
                _, _, low, high, size, _ = found
                at += size
                if at < n:
                    rest = text[at : at + most]
                    reach = longest(rest)
                    found = arcs.get(rest[:reach]) or self._from(rest, reach)
            else:
                last = way.pop()
                dead.add((at, last[0]))
                at -= last[4]
                low, high = way[-1][2:4] if way else (0, 0)
                found = last[5]
        return [x[0] for x in way]

    def _from(self, text: str, reach: int) -> tuple:
        """The longest label that begins `text`, which runs `reach` bytes along the labels' trie; a single byte at least."""
        found = self.arcs.get(text[:reach])
        while found is None:
            reach -= 1
            found = self.arcs.get(text[:reach])
        return found


#: WORDS over ASCII alone, where \\p{L} is A-Za-z and \\p{N} is 0-9; alternatives that differ in their first character are put in another order.
_ASCII = re.compile(r" ?[A-Za-z]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(1)
def _plane_words() -> re.Pattern:
    """WORDS for texts without characters beyond U+FFFF, with the classes as ranges: one table lookup a character in the re module."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))

    def ranges(one: str) -> str:
        return "".join(re.escape(m[0][0]) + ("-" + re.escape(m[0][-1]) if len(m[0]) > 1 else "") for m in regex.finditer(one + "+", every))

    letter, number, space = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    return re.compile(rf" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


def cut_words(text: str) -> list[str]:
    """The words of a text by WORDS."""
    if text.isascii():
        return _ASCII.findall(text)
    return (regex.compile(WORDS) if _ASTRAL.search(text) else _plane_words()).findall(text)


class Codec:
    """Encoding and decoding of whole texts by the automaton of a byte-level BPE file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        if spec["normalizer"] or any(cut.get(k) != v for k, v in _KIND.items()) or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path} is not a byte-level BPE file of the kind this codec compiles")
        symbol = tokens.byte_symbols()
        to_bytes = lambda t: bytes(symbol[c] for c in t)
        ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.automaton = Automaton([(to_bytes(a), to_bytes(b)) for a, b in pairs], ids)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.labels = pa.array([labels.get(i, b"") for i in range(max(labels) + 1)], pa.large_binary())
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        known = self.memo.get(word)
        if known is None:
            known = array("i", self.automaton.path(word.encode("utf-8"))).tobytes()
            if len(word) <= _LONG:
                tokens.remember(self.memo, word, known, _WORDS_MAX)
        return known

    def _plain(self, text: str) -> bytes:
        words = cut_words(text)
        found = list(map(self.memo.get, words))
        if None in found:
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                found[at] = self._word(words[at])
        return b"".join(found)

    def encode_ints(self, text: str) -> bytes:
        """The ids as native 32-bit integers."""
        if self.cut is None or not any(t in text for t in self.special):
            return self._plain(text)
        return b"".join(array("i", [self.special[part]]).tobytes() if part in self.special else self._plain(part) for part in self.cut.split(text))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_ints(text), np.int32).tolist()

    def decode_many(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """The texts of ids[edges[k]:edges[k + 1]]: their arcs' labels, emitted one after the other."""
        if not len(ids):
            return [""] * (len(edges) - 1)
        _, offsets, data = self.labels.take(pa.array(ids)).buffers()
        at = np.frombuffer(offsets, np.int64)[edges].tolist()
        raw = memoryview(data) if data is not None else memoryview(b"")
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(at, at[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(np.array(ids, np.int32), np.array([0, len(ids)]))[0]


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


SCHEMA = "doc_id long, ids array<int>, decoded string"


def _code(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    own = codec(path)
    for batch in common.slices(batches, "text", 2 << 20):
        coded = [own.encode_ints(t) for t in common.texts(batch)]
        edges = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
        flat = np.frombuffer(b"".join(coded), np.int32)
        ids = pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))
        decoded = pa.array(own.decode_many(flat, edges), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), ids, decoded], ["doc_id", "ids", "decoded"])


def encode_and_decode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids, and the text decoded from those ids, for every row of docs(doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(partial(_code, path=tokenizer or tokens.default_path("byte_bpe_50k.json")), SCHEMA)
