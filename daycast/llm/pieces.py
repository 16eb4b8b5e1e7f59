"""SentencePiece encoding and decoding on a relational lattice.

The substrings of distinct units (words, single digits, runs of other characters),
up to the longest piece, are exploded and equi-joined to the piece table; the edges
are grouped by unit. The lattices of a batch of units are then folded together, one
array step for all of them, into their segmentations:

* ``viterbi`` keeps the best score of every prefix -- the rule of unigram models;
* ``merge`` applies the edges in order of score to the set of boundaries -- the
  rule of BPE models, whose scores are merge ranks, not log-probabilities, so
  that a best sum would split almost every word into pairs of letters.

``both`` folds one lattice by both rules. Frequent units are folded first and
broadcast in a table of bounded size; texts are encoded from it where they are read.
Occurrences of all other units are shuffled by unit, and each unit is folded once in
the task that has its occurrences. The digests of ``summary`` are made from the ids of
every occurrence by both rules, and from the text that these ids decode to.
"""

from __future__ import annotations

import heapq
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property, lru_cache, partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import drop_kept, give_back, kept, pieces_of
from daycast.session import materialize

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Units with at least 1 / HEAD of all counted units are broadcast: at most HEAD of them,
#: and as counts fall like 1 / rank, in practice a tenth of that at any corpus size.
HEAD = 4_000_000
HELD_CHUNKS = 400_000
CACHED_CHUNKS = 300_000
#: Chunks whose number is kept, which takes less room than their ids.
NUMBERED_CHUNKS = 600_000
GROUPS = 100_000
#: Units folded together.
FOLDED = 10_000
#: Ids decoded and summed together.
SUMMED = 100_000
#: Longer units are folded one by one by the task that holds them.
LONG = 61
#: No piece joins characters of two of these runs, so they can be encoded alone.
UNIT = regex.compile(rf"{SPACE}*[\p{{L}}\p{{M}}]+|{SPACE}*\p{{Nd}}|{SPACE}*[^{SPACE}\p{{L}}\p{{M}}\p{{Nd}}]+|{SPACE}+")
#: What an unknown character costs below the lowest score.
UNKNOWN_COST = 10.0


@dataclass
class Pieces:
    """The piece table: normal pieces by falling score, and the ids of the byte pieces."""

    text: list[str]
    score: np.ndarray
    id: np.ndarray
    byte_id: list[int]
    names: list[bytes]  # of every id, for decoding
    unknown: int

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.text))


@lru_cache(maxsize=2)
def load(path: str | None = None) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
    normal, bytes_, names = [], {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_[int(piece[3:5], 16)] = i
            names.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            names.append(b"")
        else:
            normal.append((-model.get_score(i), i, piece))
            names.append(piece.replace(SPACE, " ").encode())
    normal.sort()
    joined = [p for _, _, p in normal if len(UNIT.findall(p)) > 1]
    if joined:
        raise ValueError(f"pieces that span units: {joined[:5]}")
    return Pieces([p for _, _, p in normal], np.array([-s for s, _, _ in normal]), np.array([i for _, i, _ in normal]), [bytes_.get(b, model.unk_id()) for b in range(256)], names, model.unk_id())


def units_of(text: str) -> list[str]:
    """The units of a text, in order; spaces become the space mark, one is put in front."""
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def chunk_units(chunk: str) -> tuple[str, ...]:
    """Units of what stands between two spaces."""
    if chunk.isalpha():
        return (SPACE + chunk,)
    if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
        return (SPACE + chunk[:-1], chunk[-1])
    return tuple(UNIT.findall(SPACE + chunk))


class Chunks(dict):
    """(units, bytes of ids of each unit or none, all ids' bytes) of a chunk, in a cache that stops growing when full."""

    def __init__(self, table: dict[str, bytes]):
        super().__init__()
        self.table = table

    def entry(self, units: tuple[str, ...]) -> tuple:
        found = [self.table.get(u, b"") for u in units]
        return units, tuple(map(len, found)), b"".join(found)

    def __missing__(self, chunk: str) -> tuple:
        entry = self.entry(chunk_units(chunk))
        if len(chunk) <= LONG and len(self) < CACHED_CHUNKS:
            self[chunk] = entry
        return entry

    def entries(self, text: str) -> list[tuple]:
        if not text:
            return []
        parts = text.split(" ")
        return [self.entry(tuple(units_of(text)))] if "" in parts else [self[p] for p in parts]


class Numbered(dict):
    """The number of a chunk, kept in a cache that stops growing when full; others are numbered for one batch, below 0.

    A number stands for a range of ``units``: the places of frequent units in
    ``table``, and beyond them places in the list of ``rare`` units.
    """

    def __init__(self, table: dict[str, int]):
        super().__init__()
        self.table = table
        self.kept, self.passing = ([], array("q", [0]), array("q")), ([], array("q", [0]), array("q"))

    def add(self, units: Iterable[str], store: tuple) -> int:
        rare, ends, places = store
        for unit in units:
            at = self.table.get(unit)
            if at is None:
                at = -1 - len(rare)
                rare.append(unit)
            places.append(at)
        ends.append(len(places))
        return len(ends) - 2

    def __missing__(self, chunk: str) -> int:
        if len(chunk) <= LONG and len(self) < NUMBERED_CHUNKS:
            self[chunk] = number = self.add(chunk_units(chunk), self.kept)
            return number
        return -1 - self.add(chunk_units(chunk), self.passing)

    def units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(place of every unit in the table or -1 - its place in the rare units, units of each text, rare units)."""
        numbers: list[int] = []
        chunks = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            if text:
                if "  " in text or text[0] == " " or text[-1] == " ":
                    numbers.append(-1 - self.add(units_of(text), self.passing))
                else:
                    numbers += map(self.__getitem__, text.split(" "))
            chunks[i + 1] = len(numbers)
        (rare, ends, places), (more_rare, more_ends, more_places) = self.kept, self.passing
        known, late = np.array(places, np.int64), np.array(more_places, np.int64)
        late[late < 0] -= len(rare)
        bounds = np.r_[np.array(ends, np.int64), np.array(more_ends, np.int64)[1:] + len(known)]
        code = np.array(numbers, np.int64)
        code = np.where(code < 0, len(ends) - 2 - code, code)
        first, size = bounds[code], bounds[code + 1] - bounds[code]
        upto = np.r_[0, np.cumsum(size)]
        unit = np.r_[known, late][np.repeat(first - upto[:-1], size) + np.arange(upto[-1])]
        self.passing = ([], array("q", [0]), array("q"))
        return unit, np.diff(upto[chunks]), rare + more_rare


def _texts(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def unit_counts(texts: DataFrame) -> DataFrame:
    """(unit, n) over all rows of ``texts`` (text), of what repeats.

    What stands between two spaces counts where it occurs again among the texts that
    a task counts together. So n is at most the unit's number, and close to it for
    frequent units; units that never repeat are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter[str] = Counter()
        others: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                parts = text.split(" ")
                if "" in parts:
                    others.update(units_of(text))
                else:
                    chunks.update(parts)
                if len(chunks) + len(others) > HELD_CHUNKS:
                    yield hand_on(chunks, others)
                    chunks.clear()
                    others.clear()
        yield hand_on(chunks, others)

    def hand_on(chunks: Counter, others: Counter) -> pa.RecordBatch:
        units = Counter({u: n for u, n in others.items() if n > 1})
        for chunk, n in chunks.items():
            if n > 1:
                for unit in chunk_units(chunk):
                    units[unit] += n
        return pa.RecordBatch.from_arrays([pa.array(list(units), pa.string()), pa.array(list(units.values()), pa.int64())], ["unit", "n"])

    return texts.mapInArrow(count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """(piece, rank), and rank -1 for the empty string, which every unit has as an edge."""
    rows = pa.table({"piece": pa.array([*pieces.text, ""]), "rank": pa.array([*range(len(pieces.text)), -1], pa.int64())})
    return spark.createDataFrame(rows)


def spans(longest: int) -> list[int]:
    """All spans start << 6 | end of units up to ``LONG``, by end: a unit of n characters has the first of them."""
    return [s * 64 + e for e in range(1, LONG + 1) for s in range(max(0, e - longest), e)]


def _by_unit(unit: np.ndarray, units: int) -> np.ndarray:
    """Stable order; narrow integers are sorted by digits."""
    return np.argsort(unit.astype(np.uint16) if units <= 1 << 16 else unit, kind="stable")


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """unit, n, chars and ``edges``: array of rank << 12 | start << 6 | end, in any order.

    Substrings up to the longest piece's length are exploded and joined to the piece
    table, which has a fixed size and is broadcast. ``units`` is hash-partitioned by
    unit, so grouping needs no second shuffle.
    """
    every = spans(pieces.longest)
    upto = [sum(1 for x in every if x & 63 <= n) for n in range(LONG + 1)]
    chars = F.char_length("unit")
    # The empty span 0 is an edge of every unit, so that none is lost in the join.
    number = F.when(chars <= LONG, F.element_at(F.lit(upto), chars + 1)).otherwise(0) + 1
    rows = units.withColumn("span", F.explode(F.slice(F.lit([0, *every]), 1, number)))
    rows = rows.select(
        "unit",
        F.when(F.col("span") == 0, F.col("n")).alias("n"),  # once, as n may be an array
        "span",
        F.expr("substring(unit, shiftright(span, 6) + 1, (span & 63) - shiftright(span, 6))").alias("piece"),
    )
    joined = rows.join(F.broadcast(piece_table(units.sparkSession, pieces)), "piece")
    edge = F.expr("CASE WHEN rank >= 0 THEN rank * 4096 + span END")
    grouped = joined.groupBy("unit").agg(F.first("n", ignorenulls=True).alias("n"), F.collect_list(edge).alias("edges"))
    return grouped.select("unit", "n", F.char_length("unit").alias("chars"), "edges")


@dataclass
class Edges:
    """The edges of a batch of units, by unit and then by end."""

    chars: np.ndarray  # of each unit
    unit: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rank: np.ndarray

    @classmethod
    def of(cls, chars: np.ndarray, lists: pa.ListArray) -> Edges:
        flat = lists.flatten().to_numpy()
        unit = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort((flat & 63).astype(np.uint16), kind="stable")
        order = order[_by_unit(unit[order], len(lists))]
        flat = flat[order]
        return cls(chars.astype(np.int64), unit[order], (flat >> 6) & 63, flat & 63, flat >> 12)

    def inside(self) -> np.ndarray:
        """Mask of the boundaries between start and end."""
        return ((np.int64(1) << (self.end - self.start - 1)) - 1) << (self.start + 1)

    def on(self, masks: np.ndarray) -> np.ndarray:
        """Places of the edges that join neighbouring boundaries of their unit's mask."""
        mask = masks[self.unit]
        return np.flatnonzero(((mask >> self.start) & (mask >> self.end) & 1 == 1) & (mask & self.inside() == 0))


def merge_fold(edges: Edges) -> np.ndarray:
    """Each unit's boundary mask after all merges: always its first possible one, by rank and then by start."""
    masks = (np.int64(1) << (edges.chars + 1)) - 1
    longer = np.flatnonzero(edges.end - edges.start > 1)
    key = (edges.unit[longer] << 40) | (edges.rank[longer] << 12) | (edges.start[longer] << 6)
    longer = longer[np.argsort(key)]
    unit, inside = edges.unit[longer], edges.inside()[longer]
    ends = (np.int64(1) << edges.start[longer]) | (np.int64(1) << edges.end[longer])
    while len(unit):
        mask = masks[unit]
        between = mask & inside
        # Boundaries only go, so an edge without them is out for good.
        live = (between != 0) & (mask & ends == ends)
        unit, inside, ends, between = unit[live], inside[live], ends[live], between[live]
        can = np.flatnonzero(between & (between - 1) == 0)
        first = can[np.flatnonzero(np.diff(unit[can], prepend=-1))]
        masks[unit[first]] &= ~inside[first]
        goes_on = np.zeros(len(masks), bool)
        goes_on[unit[first]] = True
        live = goes_on[unit]
        unit, inside, ends = unit[live], inside[live], ends[live]
    return masks


def viterbi_fold(edges: Edges, score: np.ndarray) -> np.ndarray:
    """Each unit's boundary mask of the best path: folds the positions, keeping the best (score, mask) of every prefix.

    ``score`` is the scores by rank. Of equal scores the larger mask wins, which has
    a boundary where paths first differ from the end.
    """
    top, units = int(edges.chars.max(initial=0)), len(edges.chars)
    best, masks = np.zeros((top + 1, units)), np.ones((top + 1, units), np.int64)
    order = np.argsort(edges.end.astype(np.uint16), kind="stable")
    cuts = np.searchsorted(edges.end[order], np.arange(top + 2))
    # Below every piece's score, so it is best only for a character that is no piece.
    lowest = score.min() - UNKNOWN_COST
    for p in range(1, top + 1):
        bit = np.int64(1) << p
        best[p], masks[p] = best[p - 1] + lowest, masks[p - 1] | bit
        some = order[cuts[p] : cuts[p + 1]]
        if not len(some):
            continue
        unit, start = edges.unit[some], edges.start[some]
        value, way = best[start, unit] + score[edges.rank[some]], masks[start, unit] | bit
        first = np.flatnonzero(np.diff(unit, prepend=-1))
        most = np.maximum.reduceat(value, first)
        way[value < np.repeat(most, np.diff(np.append(first, len(unit))))] = -1
        way, at = np.maximum.reduceat(way, first), unit[first]
        better = (most > best[p, at]) | ((most == best[p, at]) & (way > masks[p, at]))
        best[p, at[better]], masks[p, at[better]] = most[better], way[better]
    return masks[edges.chars, np.arange(units)]


def encode_units(units: DataFrame, pieces: Pieces, rule: str = "merge") -> DataFrame:
    """(unit, n, ids): every unit's ids, for ``units`` (unit, n) hash-partitioned by unit; n is handed on, of any type.

    Rule ``both`` gives the ids by merging and, in ``best``, those of the best path.
    """
    rules = {"ids": "merge", "best": "viterbi"} if rule == "both" else {"ids": rule}

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        table, ids_of = {p: r for r, p in enumerate(pieces.text)}, pieces.id.tolist()
        for batch in batches:
            for part in pieces_of(batch, FOLDED):
                chars = part.column("chars").to_numpy()
                short = chars <= LONG
                edges = Edges.of(np.where(short, chars, 0), part.column("edges"))
                ids = []
                for by in rules.values():
                    used = edges.on(merge_fold(edges) if by == "merge" else viterbi_fold(edges, pieces.score))
                    ids.append(_path_ids(part.column("unit"), chars, edges, used, short, table, ids_of, pieces, by))
                yield pa.RecordBatch.from_arrays([part.column("unit"), part.column("n"), *ids], ["unit", "n", *rules])
        give_back()

    schema = f"unit string, n {units.schema['n'].dataType.simpleString()}, " + ", ".join(f"{to} array<int>" for to in rules)
    return lattice(units, pieces).mapInArrow(finish, schema)


def _path_ids(units: pa.Array, chars: np.ndarray, edges: Edges, used: np.ndarray, folded: np.ndarray, table: dict[str, int], ids_of: list[int], pieces: Pieces, rule: str) -> pa.ListArray:
    """The ids of the ``used`` edges, gaps filled with single characters or bytes; a unit that is not ``folded`` is folded here."""
    of, start, end, rank = (x[used] for x in (edges.unit, edges.start, edges.end, edges.rank))
    sizes = np.bincount(of, minlength=len(units))
    ends = np.cumsum(sizes)
    covered = np.bincount(of, end - start, len(units))
    ids = pieces.id[rank].astype(np.int32)
    out, done = [], 0
    for i in np.flatnonzero((covered != chars) | ~folded).tolist():
        unit, first = units[i].as_py(), ends[i] - sizes[i]
        if folded[i]:
            marks = list(zip(*(x[first : ends[i]].tolist() for x in (start, end, rank))))
        else:
            marks = _long(unit, table, pieces, rule)
        filled = _filled(unit, marks, table, ids_of, pieces)
        out += [ids[done:first], filled]
        done, sizes[i] = ends[i], len(filled)
    return pa.ListArray.from_arrays(_offsets(sizes), pa.array(np.concatenate([*out, ids[done:]])))


def _filled(unit: str, marks: list[tuple[int, int, int]], table: dict[str, int], ids_of: list[int], pieces: Pieces) -> np.ndarray:
    """Ids of the marked pieces (start, end, rank), and between them of single characters, or of their bytes."""
    out, at = [], 0
    for start, end, rank in [*marks, (len(unit), len(unit), -1)]:
        for char in unit[at:start]:
            single = table.get(char)
            if single is not None:
                out.append(ids_of[single])
            else:
                out += [pieces.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]
        if rank >= 0:
            out.append(ids_of[rank])
        at = end
    return np.array(out, np.int32)


def _long(unit: str, table: dict[str, int], pieces: Pieces, rule: str) -> list[tuple[int, int, int]]:
    """Segmentation (start, end, rank) of a unit the fold leaves out, in n log n steps."""
    n = len(unit)
    if rule == "merge":
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and end[b] - a <= pieces.longest and (rank := table.get(unit[a : end[b]])) is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

        for a in range(n):
            offer(a)
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if not (alive[a] and alive[b] and end[a] == b and end[b] == stop):
                continue
            end[a], alive[b] = stop, False
            if stop < n:
                before[stop] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        cuts = [(a, end[a]) for a in range(n) if alive[a]]
    else:
        lowest = pieces.score.min() - UNKNOWN_COST
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for p in range(1, n + 1):
            for a in range(max(0, p - pieces.longest), p):
                rank = table.get(unit[a:p])
                value = best[a] + (pieces.score[rank] if rank is not None else lowest if a == p - 1 else -np.inf)
                if value >= best[p]:
                    best[p], back[p] = value, a
        cuts, p = [], n
        while p:
            cuts.append((back[p], p))
            p = back[p]
        cuts.reverse()
    return [(a, b, table[unit[a:b]]) for a, b in cuts if unit[a:b] in table]


# Texts --------------------------------------------------------------------

def _chunks(sent: pa.Table) -> Chunks:
    """The frequent units' ids and the chunks made of them."""
    lists = sent.column("ids").combine_chunks()
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return Chunks({u: flat[a:b].tobytes() for u, a, b in zip(sent.column("unit").to_pylist(), at[:-1].tolist(), at[1:].tolist())})


@dataclass
class Lists:
    """The ids of numbered units by both rules, and the bytes of every id."""

    rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # (first, number, ids) of each unit, ids by merging and of the best path
    names: pa.BinaryArray

    @classmethod
    def of(cls, units: pa.RecordBatch | pa.Table, names: list[bytes]) -> Lists:
        """``units`` has ids and best; another unit follows them that has none."""
        rules = []
        for name in ("ids", "best"):
            column = units.column(name)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            sizes = np.r_[column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), 0]
            rules.append((np.cumsum(sizes) - sizes, sizes, column.flatten().to_numpy()))
        return cls(rules, pa.array(names, pa.binary()))


def _numbered(sent: pa.Table, names: list[bytes]) -> tuple[Numbered, Lists]:
    """Chunks by number and the frequent units' ids, with a unit without ids for all other units."""
    return Numbered({u: i for i, u in enumerate(sent.column("unit").to_pylist())}), Lists.of(sent, names)


@contextmanager
def _grouping_in_memory(spark: SparkSession):
    """Group by hash up to GROUPS units a task; Spark sorts what goes beyond."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(GROUPS))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "merge", summary: bool = False, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Encode all texts. Returns (texts, segments).

    texts: one row per input row -- ``id_col``, row (its key), n_units.
    segments: row, first_unit, units, ids; a text's ids are those of its
    segments in order of first_unit. Frequent units that follow each other share
    a segment, every other unit has one of its own, so no text is put together
    in one place; ``assembled`` does that where it is wanted. Null and empty texts
    have no segment. Repeated rows are encoded each on its own; extra columns are
    ignored; an empty table gives no rows.

    With ``summary`` all units are segmented by both rules. The ids of a segment are put
    together, those by merging decoded again, in the task that has the segment, which then
    has SUMS instead of ids: number and checksum of the merged ids, of the best path's
    ids, and of the decoded code points, which still have the space in front. All frequent
    units of a text are in one row.
    """
    pieces = load(path)
    by = "both" if summary else rule
    text = _texts(docs, text_col)
    counts = materialize(unit_counts(docs.select(text.alias("text"))), "piece-units", compression="zstd")
    total = counts.agg(F.sum("n")).first()[0] or 0
    head = encode_units(counts.where(F.col("n") * HEAD >= total), pieces, by).drop("n")
    with _grouping_in_memory(docs.sparkSession):
        sent = docs.sparkSession.sparkContext.broadcast(head.toArrow())
    token, names = uuid.uuid4().hex, pieces.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = kept(("pieces", token), lambda: _numbered(sent.value, names) if summary else _chunks(sent.value))
        row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in pieces_of(batch, 256 if summary else 512):
                per_text, runs, missing, place, unit = (_summed if summary else _encoded)(part.column("text").to_pylist(), chunks)
                words = pa.StructArray.from_arrays([pa.array(place), pa.array(unit, pa.string())], ["place", "unit"])
                rows = np.arange(row, row + part.num_rows)
                row += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows), pa.array(per_text), runs, pa.ListArray.from_arrays(_offsets(missing), words)], ["id", "row", "n_units", "runs", "rare"])

    sums = [f"{c}: long" for c in SUMS]
    shape = ", ".join(["first_unit: long", "units: long", *(sums if summary else ["ids: array<int>"])])
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, row long, n_units long, runs array<struct<{shape}>>, rare array<struct<place: long, unit: string>>"
    done = materialize(docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(run, schema), "piece-texts", compression="zstd")

    others = done.select(F.explode("rare").alias("r"), "row").select("r.unit", "row", "r.place").repartition("unit")
    # Not frequent, so a unit's list is bounded: it has less than 1 / HEAD of the counted units, and one more a task at most.
    places = others.groupBy("unit").agg(F.collect_list(F.struct("row", "place")).alias("n"))
    with _grouping_in_memory(docs.sparkSession):
        known = materialize(encode_units(places, pieces, by).drop("unit"), "piece-rare", compression="zstd")
    if summary:
        single = known.mapInArrow(partial(_sum_segments, names=names), "row long, first_unit long, units long, " + ", ".join(f"{c} long" for c in SUMS))
    else:
        single = known.select(F.inline("n"), "ids").select("row", F.col("place").alias("first_unit"), F.lit(1).cast("long").alias("units"), "ids")
    segments = done.select("row", F.inline("runs")).unionByName(single)
    return done.select(F.col("id").alias(id_col), "row", "n_units"), segments


def _encoded(texts: list[str], chunks: Chunks) -> tuple:
    """Units of each text, its runs of ids, its number of rare units; place and name of these."""
    entries = [chunks.entries(t) for t in texts]
    flat = [e for of in entries for e in of]
    sizes = np.fromiter(chain.from_iterable([e[1] for e in flat]), np.int64) >> 2
    ids = np.frombuffer(b"".join([e[2] for e in flat]), np.int32)
    per_text = np.array([sum(len(e[0]) for e in of) for of in entries], np.int64)
    rare = np.flatnonzero(sizes == 0)
    units = list(chain.from_iterable([e[0] for e in flat])) if len(rare) else []
    text_of = np.repeat(np.arange(len(texts)), per_text)
    place = np.arange(len(sizes)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return per_text, _runs(sizes, ids, text_of, place, len(texts)), np.bincount(text_of[rare], minlength=len(texts)), place[rare], [units[i] for i in rare.tolist()]


def _summed(texts: list[str], chunks: tuple[Numbered, Lists]) -> tuple:
    """:func:`_encoded` with the sums of each text's frequent units in place of runs."""
    numbered, lists = chunks
    unit, per_text, names = numbered.units(texts)
    place = np.arange(len(unit)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    text_of = np.repeat(np.arange(len(texts)), per_text)
    rare = np.flatnonzero(unit < 0)
    missing = np.bincount(text_of[rare], minlength=len(texts))
    # -1 is the last unit, which has no ids.
    found = digests(lists, np.maximum(unit, -1), place, text_of, len(texts))
    has = per_text > missing
    values = [np.zeros(int(has.sum()), np.int64), (per_text - missing)[has], *found[has].T]
    entries = pa.StructArray.from_arrays([pa.array(v) for v in values], ["first_unit", "units", *SUMS])
    return per_text, pa.ListArray.from_arrays(_offsets(has), entries), missing, place[rare], [names[-1 - i] for i in unit[rare].tolist()]


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))


def _runs(sizes: np.ndarray, ids: np.ndarray, text_of: np.ndarray, place: np.ndarray, texts: int) -> pa.Array:
    """Per text the runs of units that have ids: (first_unit, units, ids)."""
    has = sizes > 0
    new = has.copy()
    new[1:] &= ~has[:-1] | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(new)
    number = np.cumsum(new)[has] - 1
    units = np.bincount(number, minlength=len(first))
    length = np.bincount(number, sizes[has], len(first)).astype(np.int64)
    runs = pa.StructArray.from_arrays([pa.array(place[first]), pa.array(units), pa.ListArray.from_arrays(_offsets(length), pa.array(ids))], ["first_unit", "units", "ids"])
    return pa.ListArray.from_arrays(_offsets(np.bincount(text_of[first], minlength=texts)), runs)


SUMS = ["pieces", "checksum", "best_pieces", "best_checksum", "chars", "chars_checksum"]
#: Steps of the weights of :func:`checksum`.
UNIT_STEP, FACTOR = np.uint64(131), np.uint64(2654435761)


def checksum(place: np.ndarray, within: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of each piece: its id weighted by its unit's place in the text and its place in the unit; sums are taken modulo 2**32."""
    weight = (place.astype(np.uint64) * UNIT_STEP + within.astype(np.uint64) + np.uint64(1)) * FACTOR
    return ((ids.astype(np.uint64) + np.uint64(1)) * (weight & np.uint64(0xFFFFFFFF))) & np.uint64(0xFFFFFFFF)


def decoded(ids: np.ndarray, names: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The code points that ``ids`` decode to, and how many of them begin before the end of each id.

    The ids are those of whole characters: bytes of one character follow each other.
    """
    taken = names.take(pa.array(ids))
    _, ends, data = taken.buffers()
    ends = np.frombuffer(ends, np.int32)[taken.offset + 1 : taken.offset + 1 + len(ids)]
    raw = data.to_pybytes()[: ends[-1]] if len(ids) and ends[-1] else b""
    if raw.isascii():
        return np.frombuffer(raw, np.uint8), ends
    starts = np.r_[0, np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)]
    return np.frombuffer(raw.decode().encode("utf-32-le"), "<u4"), starts[ends]


def digests(lists: Lists, unit: np.ndarray, place: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """SUMS of every group of units, from the ids that they have there and from what these decode to.

    ``unit``: numbers in ``lists``; ``place``: theirs in their texts; ``group`` ascends. Each unit's
    ids are put down in order, decoded and weighted, about SUMMED of them at once.
    """
    totals = np.zeros((groups, 6), np.uint64)
    upto = np.cumsum(1 + sum(sizes[unit] for _, sizes, _ in lists.rules))
    cuts = np.unique(np.r_[0, np.searchsorted(upto, np.arange(SUMMED, upto[-1], SUMMED)), len(unit)]) if len(unit) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        some, of, at = unit[a:b], group[a:b], place[a:b] * int(UNIT_STEP) + 1
        first = np.flatnonzero(np.diff(of, prepend=-1))
        to = of[first]

        def add(k: int, values: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> None:
            weights = np.repeat(at - (ends - sizes), sizes) + np.arange(len(values))
            weights *= values.astype(np.int64) + 1
            sums = np.r_[0, np.cumsum(weights)]
            begin = (ends - sizes)[first]
            end = np.r_[begin[1:], len(values)]
            totals[to, k] += (end - begin).astype(np.uint64)
            totals[to, 3 + k] += (sums[end] - sums[begin]).astype(np.uint64)

        for k, (firsts, numbers, flat) in enumerate(lists.rules):
            sizes = numbers[some]
            ends = np.cumsum(sizes)
            ids = flat[np.repeat(firsts[some] - (ends - sizes), sizes) + np.arange(ends[-1])]
            add(k, ids, sizes, ends)
            if k == 0:
                points, known = decoded(ids, lists.names)
                chars = np.r_[0, known][ends].astype(np.int64)
                add(2, points, np.diff(chars, prepend=0), chars)
    return np.stack([totals[:, :3], (totals[:, 3:] * FACTOR) & np.uint64(0xFFFFFFFF)], axis=2).reshape(groups, 6).astype(np.int64)


def _sum_segments(batches: Iterator[pa.RecordBatch], names: list[bytes]) -> Iterator[pa.RecordBatch]:
    """A row for every place of a unit."""
    for batch in batches:
        at = batch.column("n")
        rows, place = at.flatten().flatten()
        of = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
        sums = digests(Lists.of(batch, names), of, place.to_numpy(), np.arange(len(of)), len(of))
        yield pa.RecordBatch.from_arrays([rows, place, pa.array(np.ones(len(of), np.int64)), *[pa.array(c) for c in sums.T]], ["row", "first_unit", "units", *SUMS])


def _literals(words: list[str]) -> Column:
    """A constant array of words without commas, made in one call and folded by the planner."""
    return F.split(F.lit(",".join(words)), ",")


def assembled(texts: DataFrame, segments: DataFrame) -> DataFrame:
    """``texts`` with ids, the whole id sequence of each text (empty for an empty text)."""
    parts = segments.groupBy(F.col("row").alias("of")).agg(F.array_sort(F.collect_list(F.struct("first_unit", "ids"))).alias("parts"))
    ids = F.coalesce(F.flatten(F.col("parts.ids")), F.array().cast("array<int>"))
    return texts.join(parts, texts["row"] == parts["of"], "left").select(*texts.columns, ids.alias("ids"))


def decode(rows: DataFrame, ids_col: str = "ids", to: str = "text", path: str | None = None, mark: bool = False) -> DataFrame:
    """``rows`` with column ``to``: the text of the ids. A null id sequence gives null, bytes that are no UTF-8 become U+FFFD.

    ``mark``: keep the space that encoding puts in front, as the ids of a part of a text need not have one.
    """
    names = _literals([n.hex() for n in load(path).names])
    joined = F.array_join(F.transform(ids_col, lambda i: F.element_at(names, i + 1)), "")
    plain = F.decode(F.unhex(joined), "UTF-8")
    return rows.withColumn(to, F.when(F.col(ids_col).isNotNull(), plain if mark else F.regexp_replace(plain, "^ ", "")))
