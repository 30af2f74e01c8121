"""Token ids of texts, word by word.

The tokenizers this serves never join text across white space, so a text's ids are those of its
words in turn. Each distinct word is tokenized once for as long as it stays in the worker's table,
which has a bounded number of entries. Plain words (ASCII and Latin letters, digits and marks) go
to the merge table directly; any other word takes the full path of the tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

TABLE_ENTRIES = 300_000

# letters between A and ÿ but for the two signs among them
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[!-~{_LETTER}]+")
# the split pattern of the tokenizer file, for plain words (fixed value)
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")


def _byte_symbols() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokens(dict):
    """Word (bytes) -> its ids as little-endian 32-bit numbers."""

    _shared: dict[str, "WordTokens"] = {}

    def __new__(cls, path: str):
        if path not in cls._shared:
            cls._shared[path] = super().__new__(cls)
        return cls._shared[path]

    def __init__(self, path: str):
        if hasattr(self, "tokenizer"):
            return
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.symbols = _byte_symbols()
        self.pieces: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added) or b"(?!)")
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and not self.special.search(word):
            ids = b"".join(map(self._piece, _SPLIT.findall(text.lower())))
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= TABLE_ENTRIES:
                self.pieces.clear()
            shown = piece if piece.isascii() else "".join(map(self.symbols.__getitem__, piece.encode()))
            ids = b"".join([self.id_bytes[t.id] for t in self.merges.tokenize(shown)])
            self.pieces[piece] = ids
        return ids

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text; none for null."""
        look = self.__getitem__
        for text in column:
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            yield b"".join(map(look, data.split()))
