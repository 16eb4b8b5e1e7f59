"""Order-preserving sequence packing by dynamic programming.

Documents follow each other in doc_id order. Cuts are chosen among document
ends, sentence ends and, inside long sentences, evenly spaced tokens, so that
padding plus truncation penalties is least. A sequence from cut j to cut i
costs ``window - (p_i - p_j)`` of padding, none where its length is a power of
two; as the padding is linear in p_j, the best j inside the window is the head
of a monotone queue.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import block_of, deal_key, ordered_blocks
from daycast.llm.tokens import tokens_of

WINDOW = 1024
#: Token that ends every document.
END_ID = 0
#: Costs of a cut, in padding tokens: at a sentence end, and inside a sentence.
SENTENCE_CUT, INNER_CUT = 2, 10
#: Sentences of more tokens get inner cuts this far apart.
INNER_STEP = 32
#: Shorter powers of two are no target of their own, to avoid a crowd of tiny sequences.
LEAST_POWER = 128
#: Tokens packed at once; the last, open sequence moves on to the next unit.
UNIT = 1 << 18
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def sentence_tables(path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """By id: does it end a sentence if white space follows; does it begin with white space."""
    strings = tokens_of(path).strings()
    ends = np.array([s[-1:] in (b".", b"!", b"?") for s in strings])
    white = np.array([s[:1].isspace() for s in strings])
    return ends, white


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, white: np.ndarray, step: int = INNER_STEP) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the possible cuts of a token stream, both ends included."""
    total = len(ids)
    small = np.minimum(ids, len(ends) - 1)
    after = np.flatnonzero(ends[small[:-1]] & white[small[1:]]) + 1 if total > 1 else np.zeros(0, np.int64)
    marks = np.union1d(np.r_[0, after], np.r_[doc_ends, total])
    gap = np.diff(marks)
    extra = np.where(gap > step, (gap - 1) // step, 0)
    inner = np.repeat(marks[:-1], extra) + step * (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
    positions = np.union1d(marks, inner)
    penalty = np.full(len(positions), INNER_CUT)
    penalty[np.searchsorted(positions, after)] = SENTENCE_CUT
    penalty[np.searchsorted(positions, np.r_[0, doc_ends, total])] = 0
    return positions, penalty


def best_cuts(positions: np.ndarray, penalty: np.ndarray, window: int = WINDOW, least_power: int = LEAST_POWER) -> list[int]:
    """Indices of the cuts of least cost, first and last included. Gaps must not exceed ``window``."""
    at, fee = positions.tolist(), penalty.tolist()
    index = np.full(at[-1] + 1, -1, np.int64)
    index[positions] = np.arange(len(positions))
    exact: dict[int, list[int]] = {}
    power = window >> 1
    while power >= least_power:
        reach = positions - power
        j = np.where(reach >= 0, index[np.maximum(reach, 0)], -1)
        for i in np.flatnonzero(j >= 0).tolist():
            exact.setdefault(i, []).append(int(j[i]))
        power >>= 1
    key, back = [0] * len(at), [0] * len(at)  # key: cost + position
    queue = deque([0])
    for i in range(1, len(at)):
        p = at[i]
        low = p - window
        while at[queue[0]] < low:
            queue.popleft()
        j = queue[0]
        cost = key[j] + window - p
        if i in exact:
            for k in exact[i]:
                if key[k] - at[k] < cost:
                    cost, j = key[k] - at[k], k
        back[i] = j
        value = key[i] = cost + fee[i] + p
        while queue and key[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class _Stream:
    """Documents whose tokens are not all in a closed sequence yet."""

    def __init__(self, window: int, tables, first_id: int):
        self.window, self.tables, self.sequence = window, tables, first_id
        self.docs: list[tuple] = []  # (doc_id, ids left, tokens packed before, tokens in all)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)

    def pack(self, last: bool) -> pa.RecordBatch | None:
        """Pieces of the closed sequences; unless ``last``, the open one is kept."""
        if not self.docs:
            return None
        ids = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])
        positions, penalty = cut_points(ids, ends, *self.tables)
        cuts = positions[best_cuts(positions, penalty, self.window)]
        if not last:
            cuts = cuts[:-1]
        if len(cuts) < 2:
            return None
        stop = cuts[-1]
        begins = np.union1d(cuts[:-1], ends[ends < stop])
        lengths = np.diff(np.r_[begins, stop])
        doc = np.searchsorted(ends, begins, side="right")
        seq = np.searchsorted(cuts, begins, side="right") - 1
        doc_begin = np.r_[0, ends[:-1]]
        before = np.array([d[2] for d in self.docs], np.int64)
        totals = np.array([d[3] for d in self.docs], np.int64)
        view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begins.tolist(), lengths.tolist())]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([d[0] for d in self.docs], pa.int64()).take(pa.array(doc)),
                pa.array(begins - doc_begin[doc] + before[doc], pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(totals[doc]),
                pa.array(self.sequence + seq, pa.int64()),
                pa.array(begins - cuts[seq], pa.int64()),
            ],
            [x.split()[0] for x in PIECES.split(", ")],
        )
        self.sequence += len(cuts) - 1
        # The documents that reach beyond the last cut.
        k = int(np.searchsorted(ends, stop, side="right"))
        rest = self.docs[k:]
        if rest:
            doc_id, left, done, total = rest[0]
            used = int(stop - doc_begin[k])
            rest[0] = (doc_id, left[used:], done + used, total)
        self.docs, self.held = rest, sum(len(d[1]) for d in rest)
        return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens; one row per piece.

    Columns: doc_id, start (tokens of the document before the piece), length,
    ids_crc32 (of the piece's ids as little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset (in the sequence, gapless from 0). A document's tokens
    are its text's ids and ``END_ID``; a null or empty text has that id alone.
    Documents are range-partitioned by id and packed in id order inside each
    partition; a task holds one unit of tokens and one batch of texts. Rows with
    equal or null ids follow each other, ordered by text, each packed as a
    document of its own. Extra columns are ignored; an empty table gives no row.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = ordered_blocks(rows, "doc_id")
    n = len(bounds) + 1
    keyed = rows.withColumn("block", block_of(F.col("doc_id"), bounds))
    dealt = keyed.repartition(n, deal_key(docs.sparkSession, F.col("block"), n)).sortWithinPartitions("block", "doc_id", "text").drop("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer)
        stream = _Stream(window, sentence_tables(tokenizer), TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                stream.add(doc_id, np.append(tokens.ids(text.as_py()), np.uint32(END_ID)))
                if stream.held >= UNIT and (out := stream.pack(last=False)) is not None:
                    yield out
        if (out := stream.pack(last=True)) is not None:
            yield out
        pa.default_memory_pool().release_unused()  # an idle worker should not hold a batch's memory

    return dealt.mapInArrow(run, PIECES)


def padding(length: int, window: int = WINDOW) -> int:
    """Padding of a sequence: up to the window, none at a power of two."""
    return 0 if length & (length - 1) == 0 else window - length
