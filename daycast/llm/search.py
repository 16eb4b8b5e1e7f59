"""Ranked lexical search with one score per class of equal documents.

For a query set the only words of a document that matter are the queries' own.
Restricted to them, documents fall into classes: the same term frequencies and
the same length factor m give the same score for every query. A class is found by
a 64-bit hash and verified by its whole vector, scored once against all queries,
and only the members of the classes that reach a query's best are looked up,
in ascending order of the id.

Weights and scores are the integers of the stated formulas (see ``length_factor``,
``weight``, ``saturation``), so that ties are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daycast.llm.common import pieces_of, utf8
from daycast.session import materialize

#: Bytes of a term: ASCII letters and digits, A-Z lower-cased, and all of a non-ASCII code point.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: A block of queries is closed at so many queries or pairs of a query and a term.
BLOCK_ITEMS, BLOCK_POSTINGS = 256, 500_000
#: Classes scored at once.
STEP = 1024
#: Largest table of chosen classes, in bytes of their vectors, that is broadcast; beyond it the join is a plain one.
BROADCAST_BYTES = 16 << 20
BAGS = "doc_id long, n long, bag binary"
_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of term characters of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_TERM).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def length_factor(n: Column, documents: int, terms: int) -> Column:
    """m = 100 - 75 + (75 * n * documents) div terms, wide enough for any corpus."""
    wide = lambda x: x.cast("decimal(19,0)")
    return (F.lit(25) + F.floor(wide(n * 75) * wide(F.lit(documents)) / wide(F.lit(max(1, terms)))).cast("long")).cast("long")


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, times) of all queries; the rows of one id are one query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            raw, at = utf8(batch.column("text"))
            data = raw.tobytes()
            for item, a, b in zip(batch.column("item").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                out += [(item, t.decode(), c) for t, c in Counter(terms_of(data[a:b])).items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.string(), pa.int64()))], ["item", "term", "times"])

    rows = items.select(F.col(id_col).cast("long").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item long, term string, times long").groupBy("item", "term").agg(F.sum("times").alias("times"))


def query_blocks(items: DataFrame, id_col: str, text_col: str, most_items: int = BLOCK_ITEMS, most_postings: int = BLOCK_POSTINGS) -> Iterator[dict]:
    """The queries in blocks of {item: {term: times}}; the driver holds one block."""
    block: dict = {}
    held = 0
    terms = materialize(query_terms(items, id_col, text_col), "query-terms")
    for row in terms.orderBy("item", "term").toLocalIterator():
        if row["item"] not in block and block and (len(block) >= most_items or held >= most_postings):
            yield block
            block, held = {}, 0
        block.setdefault(row["item"], {})[row["term"].encode()] = row["times"]
        held += 1
    if block:
        yield block


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with at least one term: doc_id, n (terms with repeats) and bag, the vocabulary's terms in it.

    A bag is a sequence of (number of the term, frequency), unsigned 32-bit
    little-endian, in order of the number; it may be empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for whole in batches:
            for batch in pieces_of(whole, 1000):
                raw, at = utf8(batch.column("text"))
                data = raw.tobytes().translate(_TERM)
                ids, counts, vectors = [], [], []
                for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    terms = data[a:b].split()
                    if not terms:
                        continue
                    known = Counter(map(get, terms))
                    known.pop(None, None)
                    ids.append(doc_id)
                    counts.append(len(terms))
                    vectors.append(np.array(sorted(known.items()), "<u4").tobytes())
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(vectors, pa.binary())], ["doc_id", "n", "bag"])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, BAGS)


def bag_classes(rows: DataFrame) -> DataFrame:
    """Classes of ``rows`` (doc_id, h, m, bag): class, h, m, bag, size and first, the least doc_id (null if none has one).

    ``h`` is the vector's hash; a class is one h *and* one m and bag, so
    vectors that share a hash stay apart. Sizes and least ids are combined map-side.
    """
    found = rows.where(F.octet_length("bag") > 0).groupBy("h", "m", "bag").agg(F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("first"))
    return materialize(found.withColumn("class", F.monotonically_increasing_id()), "bag-classes")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of all entries of a column of bags."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(_PAIR)
    row = np.repeat(np.arange(len(column)), np.diff(offsets) // _PAIR.itemsize)
    return row, flat["term"].astype(np.int64), flat["tf"].astype(np.int64)


def document_frequencies(classes: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of the vocabulary's ``size`` terms, from the classes and their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, term, _ = _pairs(batch.column("bag"))
            np.add.at(df, term, batch.column("size").to_numpy()[row])
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in classes.select("bag", "size").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class _Best:
    """The ``k`` best (score, then least first member) classes of each query seen so far."""

    def __init__(self, queries: int, k: int):
        self.queries, self.k = queries, k
        self.item, self.score, self.first, self.cls = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.ones(queries, np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, cls: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.floor)
        if not len(row):
            return
        self.item = np.r_[self.item, item]
        self.score = np.r_[self.score, scores[row, item]]
        self.first, self.cls = np.r_[self.first, first[row]], np.r_[self.cls, cls[row]]
        order = np.lexsort((self.cls, self.first, -self.score, self.item))
        of = self.item[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        order = order[rank < self.k]
        self.item, self.score, self.first, self.cls = (x[order] for x in (self.item, self.score, self.first, self.cls))
        many = np.bincount(self.item, minlength=self.queries)
        last = np.cumsum(many) - 1
        full = many == self.k
        self.floor[full] = self.score[last[full]]


def best_classes(classes: DataFrame, postings: list[tuple[np.ndarray, np.ndarray]], queries: int, k: int) -> DataFrame:
    """(query, class, score): for every query at least its ``k`` best classes, by score and least first member.

    ``postings`` has, by term number, the queries that hold the term and its
    weight times its occurrences there. A step scores ``STEP`` classes against
    all queries of the block, term by term; a task keeps k classes a query.
    """
    none = np.iinfo(np.int64).max  # a class without an id comes last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(queries, k)
        for whole in batches:
            for batch in pieces_of(whole, STEP):
                row, term, tf = _pairs(batch.column("bag"))
                value = saturation(tf, batch.column("m").to_numpy()[row])
                order = np.argsort(term, kind="stable")
                row, term, value = row[order], term[order], value[order]
                cuts = np.flatnonzero(np.diff(term)) + 1
                scores = np.zeros((batch.num_rows, queries), np.int64)
                for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(term)].tolist()):
                    if a < b:
                        of, times = postings[term[a]]
                        scores[row[a:b, None], of] += value[a:b, None] * times
                first = batch.column("first").fill_null(none).to_numpy()
                best.add(scores, first, batch.column("class").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.item, best.cls, best.score, best.first)], ["query", "class", "score", "first"])

    found = classes.select("class", "m", "bag", "first").mapInArrow(run, "query long, class long, score long, first long")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "first", "class")
    return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("query", "class", "score")


def _members(rows: DataFrame, classes: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """(class, doc_id, place): the ``k`` least ids of each chosen class; nulls last. Rows are cut to k a class before the shuffle."""
    wanted = classes.join(chosen.select("class").distinct(), "class", "left_semi").select("class", "h", "m", "bag")
    wanted = materialize(wanted, "chosen-classes")
    size = wanted.agg(F.sum(F.octet_length("bag") + 100).alias("b")).first()["b"] or 0
    side = F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted
    found = rows.join(side, ["h", "m", "bag"]).select("class", "doc_id")
    w = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           most_items: int = BLOCK_ITEMS, most_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The ``k`` highest-scoring documents above 0 of every query: item_id, rank, doc_id, score.

    Equal scores go by ascending doc_id, rows without an id last. Every row of
    ``docs`` is a document, also where ids or texts repeat; a null text has no
    term. The rows of one item_id are one query, whose terms count with repeats;
    a null item_id is a query too; a query without a term or a match has no row.
    Queries are run in blocks, each against all documents, so that what tasks
    hold of them is bounded (one query's own terms are never divided). Extra
    columns are ignored; empty tables give no row.
    """
    spark = docs.sparkSession
    out, totals = None, None
    for block in query_blocks(items, item_col, item_text, most_items, most_postings):
        ids = list(block)
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*block.values())))}
        rows = materialize(bags(docs, vocabulary, id_col, text_col), "bags")
        if totals is None:
            totals = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        documents, terms = totals
        keyed = rows.withColumn("m", length_factor(F.col("n"), documents, terms)).withColumn("h", F.xxhash64("m", "bag"))
        classes = bag_classes(keyed)
        df = document_frequencies(classes, len(vocabulary))
        held: list[tuple[list, list]] = [([], []) for _ in vocabulary]
        for q, item in enumerate(ids):
            for term, times in block[item].items():
                number = vocabulary[term]
                held[number][0].append(q)
                held[number][1].append(times * weight(documents, int(df[number])))
        postings = [(np.array(a, np.int64), np.array(b, np.int64)) for a, b in held]
        chosen = materialize(best_classes(classes, postings, len(ids), k), "best-classes")
        members = _members(keyed, classes, chosen, k)
        w = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = chosen.join(members, "class").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, item) for q, item in enumerate(ids)], "query long, item_id long")
        found = materialize(ranked.join(names, "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
