"""Chat formatting by columnar byte assembly.

Every turn becomes ``<s>[INST role]\\n text </s>\\n``. A batch of turns is laid out
at once: numpy computes the segment lengths, their cumulative offsets and the
scatter indices, and headers and contents are copied into one preallocated
buffer that becomes the Arrow string column. Inside roles and texts the three
characters a control string can start with are escaped, so a text that holds
control strings is read back unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import pieces_of, utf8

OPEN, MID, CLOSE = "<s>[INST ", "]\n", "</s>\n"
#: Escapes: after them a text holds none of ``<``, ``[``, ``]``.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))
_BACK = {code[1]: char for char, code in ESCAPES}
_TURN = re.compile(r"<s>\[INST ([^\]]*)\]\n([^<]*)</s>\n")
BATCH_TURNS = 4096
OUT = "conv_id long, first_turn long, n_turns long, text string, roles array<string>, loss_start array<long>, loss_end array<long>"


def escape(column: pa.Array) -> pa.Array:
    for char, code in ESCAPES:
        column = pc.replace_substring(column, char, code)
    return column


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text) if "\\" in text else text


def read_turns(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, content start, content end) of each turn of a formatted text."""
    at = 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"not a formatted conversation at {at}")
        at = m.end()
        yield unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)
    if at != len(text):
        raise ValueError(f"not a formatted conversation at {at}")


def assemble(segments: list[pa.Array | str], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate segment columns row by row: (bytes, row offsets).

    A segment is a string column or one constant. All copies go to one buffer
    through scatter indices.
    """
    parts = []
    for seg in segments:
        if isinstance(seg, str):
            raw = np.frombuffer(seg.encode(), np.uint8)
            parts.append((np.tile(raw, rows), np.full(rows, len(raw), np.int64)))
        else:
            raw, at = utf8(seg)
            parts.append((raw, np.diff(at)))
    lengths = np.stack([n for _, n in parts], axis=1) if rows else np.zeros((0, len(parts)), np.int64)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(lengths.shape)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k, (raw, n) in enumerate(parts):
        source = np.cumsum(n) - n
        out[np.repeat(starts[:, k] - source, n) + np.arange(len(raw))] = raw
    return out, np.append(starts[:, 0] if rows else np.zeros(0, np.int64), len(out))


def _format(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One output row per run of turns of one conversation inside the batch."""
    rows = batch.num_rows
    ids, turns = batch.column("conv_id"), batch.column("turn")
    role, text = (batch.column(c).fill_null("") for c in ("role", "text"))
    safe_role, safe = escape(role), escape(text)
    raw, at = assemble([OPEN, safe_role, MID, safe, CLOSE], rows)
    key = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (null[1:] != null[:-1])])
    last = np.r_[first[1:], rows]
    texts = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(at[np.r_[first, rows]].copy()), pa.py_buffer(raw)])

    # Loss spans in code points from the start of the piece.
    chars = [pc.utf8_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (safe_role, safe)]
    whole = len(OPEN) + len(MID) + len(CLOSE) + chars[0] + chars[1]
    row_at = np.cumsum(whole) - whole
    row_at -= np.repeat(row_at[first], last - first)
    begin = row_at + len(OPEN) + chars[0] + len(MID)
    learn = pc.equal(role, "assistant").to_numpy(zero_copy_only=False)
    count = np.r_[0, np.cumsum(learn)]
    cut = pa.array(count[np.r_[first, rows]].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(first)),
            turns.take(pa.array(first)),
            pa.array(last - first),
            texts.cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(np.r_[first, rows].astype(np.int32)), role),
            pa.ListArray.from_arrays(cut, pa.array(begin[learn])),
            pa.ListArray.from_arrays(cut, pa.array((begin + chars[1])[learn])),
        ],
        ["conv_id", "first_turn", "n_turns", "text", "roles", "loss_start", "loss_end"],
    )


def format_chats(conversations: DataFrame, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """Format conversations (conv_id, turn, role, text).

    Returns pieces in conversation order, hash-partitioned by conv_id and
    sorted by (conv_id, turn): conv_id, first_turn, n_turns, text (the formatted
    turns), roles, loss_start / loss_end (code-point spans of the assistants'
    contents inside the piece). A conversation is the concatenation of its
    pieces; a piece holds at most ``batch_turns`` turns, so a conversation of
    any length streams through in bounded memory.

    Null roles and texts count as empty; null turns come first; a null conv_id
    is a conversation of its own. Rows with equal (conv_id, turn) are ordered by
    role and text, and repeated rows are all formatted. An empty table gives an
    empty result; extra columns are ignored.
    """
    rows = (
        conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, batch_turns):
                if piece.num_rows:
                    yield _format(piece)

    return rows.mapInArrow(run, OUT)
