"""Word-level memo over the public BPE files: same ids as the tokenizers library, at the cost of a dictionary probe a word."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np

#: Below this code point every character is stable under NFC, has the same lower case in Rust and Python, and has had its Unicode class for
#: decades; three letters are left out, whose lower case is two characters or far above. Chunks with others go to the library.
_PLAIN_TOP = 0x250
_ODD = re.compile("[\x1c-\x1f\u0130\u023a\u023eɐ-\U0010ffff]")
_BLANKS = re.compile("[ \t-\r]+")
#: The normaliser and the cutting of the files that this encoder is right for.
_NORMALISER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Entries of the tables of blank-delimited chunks and of pieces; the newer half stays when one is full. Few chunks suffice: an unknown one
#: is put together from pieces.
_CHUNKS_MAX, _PIECES_MAX = 400_000, 200_000
_LONG_WORD = 48


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level files: printable Latin-1 bytes stand for themselves, the others count up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def remember(memo: dict, key, value, most: int) -> None:
    """Put an entry into a bounded table; when it is full the older half is forgotten."""
    if len(memo) >= most:
        for old in list(islice(memo, most // 2)):
            del memo[old]
    memo[key] = value


def _classes() -> tuple[str, str]:
    of = lambda kind: "".join(re.escape(chr(c)) for c in range(_PLAIN_TOP + 0x100) if unicodedata.category(chr(c))[0] == kind)
    return of("L"), of("N")


class WordEncoder:
    """Ids of a lower-casing, white-space-dropping, word-final BPE file (word_bpe_49k.json), as little-endian uint32 bytes.

    White space never reaches the merges of that file, and no character combines with it, so each chunk between blanks encodes alone and
    repeats are looked up. A chunk with unusual characters is handed to the library by itself, a text with a special token's spelling as a
    whole. Files of another kind are refused.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (spec["normalizer"] or {}).get("normalizers") != _NORMALISER or steps[0].get("pattern") != {"Regex": _PIECES} or steps[0].get("behavior") != "Removed" or steps[-1].get("type") != "ByteLevel":
            raise ValueError(f"{path} is not a lower-casing word BPE file of the kind this encoder is for")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.symbol = {b: c for c, b in byte_symbols().items()}
        self.tokenize = self.library.model.tokenize
        self.pieces: dict[str, bytes] = {}
        letters, numbers = _classes()
        self.piece = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")
        self.memo: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            word = piece if piece.isascii() and piece.isprintable() else "".join([self.symbol[b] for b in piece.encode()])
            ids = array("I", [t.id for t in self.tokenize(word)])
            if sys.byteorder == "big":
                ids.byteswap()
            known = ids.tobytes()
            if len(piece) <= _LONG_WORD:
                remember(self.pieces, piece, known, _PIECES_MAX)
        return known

    def _learn(self, chunk: str) -> bytes:
        known = self.memo.get(chunk)
        if known is None:
            if _ODD.search(chunk):
                known = self._whole(chunk)
            else:
                pieces = [chunk] if chunk.isalpha() else self.piece.findall(chunk)
                known = self._piece(pieces[0]) if len(pieces) == 1 else b"".join([self._piece(p) for p in pieces])
            if len(chunk) <= _LONG_WORD:
                remember(self.memo, chunk, known, _CHUNKS_MAX)
        return known

    def encode(self, text: str) -> bytes:
        if "<|" in text and any(s in text for s in self.special):
            return self._whole(text)
        if _ODD.search(text):
            chunks = [c if _ODD.search(c) else c.lower() for c in _BLANKS.split(text)]
        else:
            chunks = text.lower().split()
        found = list(map(self.memo.get, chunks))
        if None in found:
            found = [self._learn(c) if f is None else f for c, f in zip(chunks, found, strict=True)]
        return b"".join(found)


@lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
