"""Byte-level BPE ids of public vocabularies, fast on repeated words.

The vocabulary files are read where they lie; their path is a parameter.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np

#: a piece that the byte-level pre-tokeniser never joins with its neighbours, as long as
#: white space is single blanks and line breaks
_CHUNK = re.compile(r"[ \n]?[^ \n]+|[ \n]")
_ODD = re.compile(r"[^\S \n]|[ \n]{2}")
#: words whose ids a worker remembers, and the longest such word
CACHED, LONGEST = 100_000, 48


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the named public vocabulary lies; every worker has the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to ids; special token strings in a text are ordinary text.

    Gives what ``tokenizers`` gives for ``byte_bpe_50k.json`` without special
    tokens: the rank file holds the same vocabulary.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        return array("I", self._bpe.encode_ordinary(text)).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """The ids of one chunk as little-endian bytes, remembered."""
        found = self._known.get(chunk)
        if found is None:
            found = self._bytes(chunk)
            if len(chunk) <= LONGEST:
                if len(self._known) >= CACHED:
                    self._known.clear()
                self._known[chunk] = found
        return found

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text without remembering its words: faster where words rarely repeat."""
        return self._bpe.encode_to_numpy(text)

    def pieces(self) -> list[bytes]:
        """The bytes of each id."""
        return [self._bpe.decode_single_token_bytes(i) if i < self._bpe.n_vocab else b"" for i in range(self._bpe.n_vocab)]

    def ids(self, text: str) -> np.ndarray:
        if _ODD.search(text):
            return np.frombuffer(self._bytes(text), "<u4")
        known, chunk = self._known.get, self.chunk
        return np.frombuffer(b"".join([known(c) or chunk(c) for c in _CHUNK.findall(text)]), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)
