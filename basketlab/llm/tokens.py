"""Exact byte-BPE ids from the ``tokenizers`` library, memoised per word.

Pre-tokens of this family of tokenizers never run over the border between a
non-space character and a following space, so a text may be cut there and the
pieces encoded alone. Pieces repeat a lot; the ids of those seen twice are kept
in a Python worker's memory of two generations: the older one goes when the
younger one is full, so the words of any part of the data are found again, and
what a text costs doesn't depend on how many came before it. Pieces not seen yet are split
by the vocabulary's own pattern and merged by the library's BPE model. Text
outside the Latin blocks, and white space in front of a space, take the
library's ordinary encode call, so the ids are the same in every case.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable

_BEFORE_SPACE = re.compile(r"\s ")
_LATIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
#: Letters, and marks behind them.
_MARKED = re.compile(r"([^\W\d_]+)([^\w\s]*)")
# array("I") holds the machine's order; ids are written little-endian.
assert sys.byteorder == "little" and array("I").itemsize == 4
#: Longer pieces are encoded but not kept.
KEEP_CHARS = 48


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[int, str]:
    """Byte -> the printable character which stands for it in byte-level BPE:
    printable bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    table.update({b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in table)})
    return table


def token_bytes(vocabulary: dict[str, int]) -> list[bytes]:
    """Each id's bytes in byte-level BPE (special tokens: their string)."""
    byte_of = {c: b for b, c in byte_symbols().items()}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        known = all(c in byte_of for c in token)
        out[i] = bytes(byte_of[c] for c in token) if known else token.encode()
    return out


def pieces(text: str) -> list[str] | None:
    """The text cut in front of its spaces, without them; none if white space
    lies in front of a space. Joined by spaces, the pieces are the text."""
    return None if _BEFORE_SPACE.search(text) else text.split(" ")


class Memory(dict):
    """Piece -> value; computes what is missing. Short pieces are kept from
    their second sight on (many are seen once only), up to ``keep`` of them in
    each of two generations."""

    SEEN = 1 << 22

    def __init__(self, compute: Callable[[str], object], keep: int):
        self.compute, self.keep, self.older, self.seen = compute, keep, {}, bytearray(self.SEEN)

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            at = hash(key) % self.SEEN
            if not self.seen[at]:
                self.seen[at] = 1
                return value
        if len(key) <= KEEP_CHARS:
            if len(self) >= self.keep:
                self.older, self.seen = dict(self), bytearray(self.SEEN)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """``encode(text)`` gives the ids as little-endian uint32 bytes."""

    def __init__(self, path: str, keep: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        # A special token's string inside a text is ordinary text.
        self.tok.encode_special_tokens = True
        self.model = self.tok.model
        self.words = regex.compile(public_tokenizers.PATTERN).findall
        self.symbols = byte_symbols()
        self.space, self.newline = self.symbols[0x20], self.plain("\n")
        self.known = Memory(self.after_space, keep)
        #: Starts of lines, and runs of marks.
        self.heads, self.marks = Memory(self._piece, keep // 4), Memory(self._piece, keep // 20)

    def plain(self, text: str) -> bytes:
        """The library's own encode call on the whole text."""
        return array("I", self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not _LATIN.fullmatch(piece):
            return self.plain(piece)
        out = array("I")
        for word in self.words(piece):
            out.extend([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.symbols))])
        return out.tobytes()

    def after_space(self, piece: str) -> bytes:
        """Ids of the piece with a space in front of it. A line break between
        others than white space is a pre-token; so are letters with the space,
        and so are the marks behind them."""
        if not _LATIN.fullmatch(piece):
            return self.plain(" " + piece)
        line, _, rest = piece.partition("\n")
        if line and rest and not line[-1].isspace() and not rest[0].isspace():
            return self.known[line] + self.newline + self.heads[rest]
        if word := _MARKED.fullmatch(piece):
            stem, marks = word.groups()
            ids = (self.known.get(stem) or self.known.older.get(stem)) if marks else None
            if ids is None:
                symbols = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.symbols)
                ids = array("I", [t.id for t in self.model.tokenize(self.space + symbols)]).tobytes()
            return ids + self.marks[marks] if marks else ids
        return self._piece(" " + piece)

    def encode(self, text: str) -> bytes:
        parts = pieces(text)
        if parts is None:
            return self.plain(text)
        # Keys are pieces without the space in front of them.
        return (self._piece(parts[0]) if parts[0] else b"") + b"".join(map(self.known.__getitem__, parts[1:]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
