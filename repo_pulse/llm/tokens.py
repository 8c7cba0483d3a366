"""Token ids of the word-level BPE vocabulary, with bounded caches per Python worker."""

from __future__ import annotations

import os
import re
import struct

import numpy as np

END = 1  # id that closes every document
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")  # no character outside it is touched by the short cut
#: The vocabulary file's own split pattern, narrowed to lower-cased PLAIN text.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
CACHE = 300_000  # strings per generation; a worker remembers two generations, so frequent strings outlive a full cache
LONGEST = 64  # characters of a remembered string


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class Encoder:
    """ids(text) equals the library's ids for the whole text, without special tokens added.

    White space always separates tokens in this vocabulary, so a text of PLAIN
    characters is encoded chunk by chunk; the library's model encodes each
    piece once and the ids are remembered. Any other text, or one that may
    hold a special token's string, goes to the library whole.
    """

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.limit = cache
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = self.old_pieces.get(piece)
            if found is None:
                seen = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
                ids = [t.id for t in self.model.tokenize(seen)]
                found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.pieces) >= self.limit:
                self.old_pieces, self.pieces = self.pieces, {}
            if len(piece) <= LONGEST:
                self.pieces[piece] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self.old_chunks.get(chunk)
        if found is None:
            found = b"".join(map(self._piece, PIECES.findall(chunk)))
        if len(self.chunks) >= self.limit:
            self.old_chunks, self.chunks = self.chunks, {}
        if len(chunk) <= LONGEST:
            self.chunks[chunk] = found
        return found

    def ids(self, text: str) -> np.ndarray:
        """Ids (unsigned 32-bit) of a text, without the closing id."""
        if "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join([self.chunks.get(c) or self._chunk(c) for c in text.lower().split()]), "<u4")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
