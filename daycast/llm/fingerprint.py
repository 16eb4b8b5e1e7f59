"""Document fingerprints by I-Match with randomised lexicon subsets.

Terms whose inverse document frequency lies in a band form the lexicon. A
document's distinct lexicon terms are sorted and hashed: once as a whole, and
once for each of several random subsets of the lexicon. The subsets come in
levels of falling size; a document is hashed at the two levels at which a
subset holds a few of its terms, so that texts of any length keep some hashes
unchanged under small edits.

The band's upper end bounds the lexicon: a term in at least 1 / ``rarest`` of
the documents takes that share of all (document, term) pairs, so there are at
most ``rarest`` times the mean number of distinct terms, at any corpus size.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.llm.common import block_of, deal_key, ordered_blocks

#: Document-frequency band as shares of all documents: 1 / RAREST up to 1 / COMMONEST.
RAREST, COMMONEST = 2000, 10
SUBSETS = 16
#: A subset of level k keeps 1 / 4**k of the lexicon.
PER_SUBSET = 4
#: With fewer lexicon terms, a document is hashed by all its terms.
FEWEST = 8
#: Distinct terms a task holds before it hands its counts on.
HELD_TERMS = 200_000
_PUNCTUATION = bytes(32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256))
_SEEDS = np.random.default_rng(20240501).integers(0, 2**64, SUBSETS, np.uint64)
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def terms_of(text: str) -> set[bytes]:
    """Distinct lower-cased terms: runs without white space and ASCII punctuation."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split())


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


def lexicon(docs: DataFrame, text_col: str = "text", rarest: int = RAREST, commonest: int = COMMONEST) -> np.ndarray:
    """Sorted 64-bit hashes of the terms in the band, from exact document frequencies over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                held.update(terms_of(text.as_py()))
                if len(held) > HELD_TERMS:
                    yield hand_on(held)
                    held.clear()
        if held:
            yield hand_on(held)

    def hand_on(held: Counter) -> pa.RecordBatch:
        keys = np.array([term_hash(t) for t in held], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.fromiter(held.values(), np.int64, len(held)))], ["term", "n"])

    total = docs.count()
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = F.col("n") * 1.0
    kept = rows.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).where((n * rarest >= total) & (n * commonest <= total) & (n >= 2))
    got = kept.select("term").toArrow().column("term").to_numpy()
    return np.sort(got.view(np.uint64))


class _Lexicon(dict):
    """Term to its hash if the lexicon has it, else 0; a bounded cache over the sorted hashes."""

    def __init__(self, hashes: np.ndarray):
        super().__init__()
        self.hashes = hashes

    def __missing__(self, term: bytes) -> int:
        value = term_hash(term)
        at = int(np.searchsorted(self.hashes, np.uint64(value)))
        if at == len(self.hashes) or int(self.hashes[at]) != value:
            value = 0
        if len(self) >= HELD_TERMS:
            self.clear()
        self[term] = value
        return value


class Print:
    """One fingerprint: the hash of all terms, a level, and the subsets' hashes at that level and the next."""

    __slots__ = ("text", "level", "hashes")

    def __init__(self, text: str, level: int, hashes: dict[tuple[int, int], int]):
        self.text, self.level, self.hashes = text, level, hashes


def fingerprint(text: str, lex: _Lexicon) -> Print:
    """Equal texts have equal fingerprints. A text without terms is hashed as it is."""
    terms = terms_of(text)
    found = {lex[t] for t in terms} - {0}
    if len(found) < FEWEST:
        found = {term_hash(t) for t in terms}
    if not found:
        whole = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return Print(f"text:{whole[:16]}", 0, {(0, 0): int(whole[:8], 16)})
    sorted_terms = np.sort(np.fromiter(found, np.uint64, len(found)))
    level = max(0, math.ceil(math.log(len(found) / PER_SUBSET, 4)))
    draw = _mix(sorted_terms[:, None] ^ _SEEDS)
    hashes = {}
    shown = []
    for k in (level, level + 1):
        inside = draw < np.uint64(1 << (64 - 2 * k)) if k else np.ones(draw.shape, bool)
        for j in range(SUBSETS):
            own = sorted_terms[inside[:, j]]
            if len(own):
                hashes[k, j] = value = xxhash.xxh3_64_intdigest(own.tobytes()) & 0xFFFFFFFF
                shown.append(f"{value:08x}")
            else:
                shown.append("-")
    return Print(f"{xxhash.xxh3_64_hexdigest(sorted_terms.tobytes())}:{level}:{'.'.join(shown)}", level, hashes)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def likeness(a: Print, b: Print) -> float:
    """Share of equal hashes among the subsets, at levels both have, in which either has a term."""
    if a.text == b.text:
        return 1.0
    levels = {a.level, a.level + 1} & {b.level, b.level + 1}
    keys = {k for k in a.hashes.keys() | b.hashes.keys() if k[0] in levels}
    same = sum(1 for k in keys if k in a.hashes and a.hashes[k] == b.hashes.get(k))
    return same / len(keys) if keys else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many first characters of ``following``, or all it has."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def neighbour_prints(docs: DataFrame, hashes: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text, its edited text, and compare with the next document's in ascending id order.

    Texts are shuffled once, compressed, into ranges of ids; the first document
    of a range is also sent to the range before it (the very first to the last
    range), so every range is worked through front to back on its own. Null
    texts count as empty, rows with equal ids follow each other by text, null
    ids come first. Extra columns are ignored; an empty table gives no row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bounds = ordered_blocks(rows, "doc_id")
    first = rows.agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("a"), F.col("doc_id").alias("b"))).alias("m")).first()["m"]
    least = first["b"] if first is not None else None
    block = block_of(F.col("doc_id"), bounds)
    at = lambda b, tail: F.struct(b.cast("int").alias("block"), F.lit(tail).alias("tail"))
    places = F.array(at(block, 0))
    if bounds:
        edge = F.col("doc_id").isin([int(b) for b in bounds]) & (block > 0)
        places = F.concat(places, F.when(edge, F.array(at(block - 1, 1))).otherwise(F.array().cast("array<struct<block:int,tail:int>>")))
    wrap = F.col("doc_id").eqNullSafe(F.lit(least).cast("long"))
    places = F.concat(places, F.when(wrap, F.array(at(F.lit(len(bounds)), 1))).otherwise(F.array().cast("array<struct<block:int,tail:int>>")))
    dealt = (
        rows.select("doc_id", "text", F.explode(places).alias("at"))
        .select("at.block", "at.tail", "doc_id", "text")
        .mapInArrow(_packed, "block int, tail int, doc_id long, text binary")
        .repartition(len(bounds) + 1, deal_key(spark, F.col("block"), len(bounds) + 1))
        .sortWithinPartitions("block", "tail", "doc_id", "text")
    )
    sent = spark.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, unpack = _Lexicon(sent.value), zstandard.ZstdDecompressor()
        names = [x.split()[0] for x in OUT.split(", ")]
        before = None
        for batch in batches:
            out = []
            for block, tail, doc_id, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if tail and (before is None or before[0] != block):
                    continue  # a further row of the next range's first id
                text = unpack.decompress(packed).decode("utf-8", "surrogatepass")
                now = (block, doc_id, text, fingerprint(text, lex))
                if before is not None and before[0] == block:
                    changed = edited(before[2], text)
                    other = fingerprint(changed, lex)
                    out.append((before[1], len(before[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), before[3].text, other.text, likeness(before[3], other), likeness(before[3], now[3])))
                before = None if tail else now
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))), _SCHEMA)

    return dealt.mapInArrow(run, OUT)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        small = [pack.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(small, pa.binary())], ["block", "tail", "doc_id", "text"])


def fingerprints(docs: DataFrame, hashes: np.ndarray, text_col: str = "text", to: str = "fingerprint") -> DataFrame:
    """``docs`` with column ``to``, the text's fingerprint (null: that of an empty text); no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(hashes)
    kept = [c for c in docs.columns if c != to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = _Lexicon(sent.value)
        for batch in batches:
            prints = [fingerprint(t.as_py() or "", lex).text for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, to])

    return docs.select(*kept).mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + [T.StructField(to, T.StringType())]))
