"""Token ids of whole texts, with a bounded cache of the pieces between spaces."""

from __future__ import annotations

from itertools import islice

import numpy as np
import public_tokenizers

from daycast.llm.common import kept
from daycast.llm.secrets import encoding

#: Cached pieces of one worker; beyond that the half met first stays.
CACHE = 500_000
#: Longer pieces are not cached.
LONG_PIECE = 48
TOKENIZER = "byte_bpe_50k.tiktoken"


class _Pieces(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of a piece with the space before it.

    The vocabulary's word pattern never joins what stands before a single space
    to the space and what follows, so pieces can be encoded alone. Pieces at
    which that does not hold (empty ones and those with white space at an edge)
    map to None.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes | None:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        ids = np.array(self.encode(" " + piece), "<u4").tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self) >= CACHE:
                # What was met first is what is met often.
                first = list(islice(self.items(), CACHE // 2))
                self.clear()
                self.update(first)
            self[piece] = ids
        return ids


class Tokens:
    """Ids of the byte-level vocabulary that ``byte_bpe_50k.json`` and its rank file share.

    Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path: str | None = None):
        self.coder = encoding(path or public_tokenizers.path(TOKENIZER))
        self.encode = self.coder.encode_ordinary
        self.pieces = _Pieces(self.encode)

    def ids(self, text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return np.array(self.encode(text), "<u4")
        pieces = self.pieces
        try:
            tail = b"".join([pieces[p] for p in rest])
        except TypeError:  # a piece that can't be encoded alone
            return np.array(self.encode(text), "<u4")
        return np.frombuffer(np.array(self.encode(first), "<u4").tobytes() + tail, "<u4")

    def strings(self) -> list[bytes]:
        """Every id's bytes."""
        return [self.coder.decode_single_token_bytes(i) for i in range(self.coder.n_vocab)]


def tokens_of(path: str | None = None) -> Tokens:
    """One coder a worker process: the pieces it has met serve the worker's later tasks of the same vocabulary."""
    return kept(("tokens", path), lambda: Tokens(path))
