"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

One permutation scatters a document's shingles over a fixed universe, a second
one -- shifted by k places for coordinate k -- ranks them; a coordinate is the
least rank. Documents that agree in a band are candidates. Instead of all pairs
of a bucket, every document is verified against one central document of the
bucket, on the full sets. Documents of a bucket that this leaves in different
components are then compared with each other, in blocks, through their set
differences from the centre; that is exact too, and the triangle inequality of
Jaccard distance skips pairs that cannot be close.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import drop_kept, give_back, pieces_of
from daycast.llm.components import components
from daycast.session import materialize

SHINGLE = 5
THRESHOLD = 80  # per cent
BANDS, ROWS = 40, 5
UNIVERSE_BITS = 20
#: Rows of one side of a block of late comparisons.
BLOCK = 1000
WORD_CACHE = 200_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, in a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, size: int, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of a text in UTF-8.

    A-Z are lower-cased; words are separated by ASCII white space. Fewer words
    make one shingle of the whole sequence, no word the empty set.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter((words[w] for w in found), np.uint64, len(found))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


@lru_cache(maxsize=2)
def permutations(coordinates: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and for every place the ranks of all shifts as one row (a view)."""
    size = 1 << UNIVERSE_BITS
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(size).astype(np.int32)
    ranks = rng.permutation(size).astype(np.int32)
    shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:coordinates]]), coordinates)
    return scatter, shifted


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    scatter, shifted = permutations(coordinates)
    places = scatter[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    out = None
    for at in range(0, len(places), 1024):
        least = shifted[places[at : at + 1024]].min(axis=0)
        out = least if out is None else np.minimum(out, least)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key per band."""
    parts = sig.reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(id, key, n, set, bands) of every row; ``set`` is a digest of the shingle set (null: empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        words = _Words()
        for batch in batches:
            for part in pieces_of(batch, 2048):
                counts, digests, keys = [], [], []
                for text in part.column("text"):
                    s = shingle_set(text.as_py(), size, words)
                    counts.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    keys.append(band_keys(signature(s, bands * rows), bands, rows) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "key", "n", "set", "bands"],
                )
        give_back()

    return docs.mapInArrow(run, "id long, key string, n long, set binary, bands array<long>")


def _key(text: Column) -> Column:
    """What tells rows of one id apart: a digest of the text; null is empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), _key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def set_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS, join_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``rows`` has id, key, n and set of every row; ``classes`` one row per distinct non-empty set:
    set, node (its number), rep (the least id with it) and label (the same for all linked classes).

    ``join_ids`` also links the classes of one id. Rows without an id are in no class.
    """
    texts = _texts(docs, id_col, text_col)
    marked = materialize(signatures(texts, shingle, bands, rows), "minhash")
    held = marked.where("id IS NOT NULL AND set IS NOT NULL")
    # Equal sets form one class, which the least (id, text) stands for.
    classes = held.groupBy("set").agg(F.min(F.struct("id", "key", "bands")).alias("one"))
    classes = materialize(classes.select("set", F.monotonically_increasing_id().alias("node"), F.col("one.id").alias("rep"), F.col("one.key").alias("key"), F.col("one.bands").alias("bands")), "minhash-classes")
    tried = verified(candidates(classes.select(F.col("node").alias("id"), "bands")), classes, texts, shingle)
    near = F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * threshold
    direct = tried.where(near).select("a", "b")
    links = direct.union(late_links(tried, components(direct), threshold))
    if join_ids:
        links = links.union(_links_of_ids(held, classes))
    label = components(links)
    labelled = classes.join(label.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("set", "node", "rep", F.coalesce("component", "node").alias("label"))
    return marked, materialize(labelled, "minhash-labels")


def _links_of_ids(held: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): every class of an id with several and the least of them."""
    several = held.groupBy("id").agg(F.min("set").alias("one"), F.max("set").alias("other")).where("one <> other").select(F.col("id").alias("of"), F.col("one").alias("first"))
    pairs = held.join(several, F.col("id") == F.col("of")).where(F.col("set") != F.col("first")).select("set", "first").distinct()
    number = classes.select(F.col("set").alias("of_set"), "node")
    left = pairs.join(number.withColumnRenamed("node", "a"), F.col("set") == F.col("of_set")).drop("of_set")
    return left.join(number.withColumnRenamed("node", "b"), F.col("first") == F.col("of_set")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``threshold`` per cent or more.

    Returns one row per input row: ``id_col``, n_shingles, component_id (the
    least id reachable over links, itself included), kept (id = component_id).
    Null or empty texts, and texts of white space, have an empty set and are
    linked with nothing. Rows that share an id are one document: it is linked by
    each of its texts, and all its rows have one component. Rows with a null id
    get component_id null and are kept. Extra columns are ignored; an empty table
    gives no row. A pair at the threshold is missed with probability
    (1 - s**rows)**bands, 1.3e-7 at 80 per cent by default.
    """
    marked, classes = set_classes(docs, id_col, text_col, shingle, threshold, bands, rows)
    least = classes.groupBy("label").agg(F.min("rep").alias("component")).withColumnRenamed("label", "of_label")
    by_class = classes.join(least, F.col("label") == F.col("of_label")).select(F.col("set").alias("of"), "component")
    out = marked.join(by_class, marked["set"] == by_class["of"], "left")
    # A row of white space has no class; its id may have other texts.
    several = marked.where("id IS NOT NULL").groupBy("id").agg(F.count_if(F.col("set").isNull()).alias("empty"), F.count("set").alias("full")).where("empty > 0 AND full > 0")
    partly = out.where("set IS NOT NULL").join(several, "id", "left_semi").groupBy("id").agg(F.min("component").alias("own")).withColumnRenamed("id", "of_id")
    out = out.join(partly, F.col("id") == F.col("of_id"), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "own", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def candidates(centres: DataFrame) -> DataFrame:
    """Distinct (a, b): document a shares a band with b, the most connected document of that bucket."""
    rows = centres.select("id", F.explode("bands").alias("bucket"))
    many = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(rows.join(many, "bucket"), "minhash-buckets")
    score = shared.groupBy("id").agg(F.sum("size").alias("score"))
    chosen = shared.join(score, "id").groupBy("bucket").agg(F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("best"))
    pairs = shared.join(chosen, "bucket").select(F.col("id").alias("a"), (-F.col("best.minus")).alias("b"))
    return materialize(pairs.where("a <> b").distinct(), "minhash-pairs")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Pairs of class numbers with both (size of the intersection), n_a, n_b, plus (a's set less b's) and minus (b's less a's).

    Only the texts that stand for a class of a pair are read again, found by a join on their id and digest.
    """
    nodes = pairs.select(F.col("a").alias("of")).union(pairs.select("b")).distinct()
    wanted = classes.join(nodes, classes["node"] == nodes["of"], "left_semi").select(F.col("rep").alias("of_id"), F.col("key").alias("of_key"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        words = _Words()
        for batch in batches:
            for part in pieces_of(batch, 1024):
                sets = [shingle_set(t.as_py(), size, words).view(np.int64) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])
        give_back()

    found = texts.join(wanted, (F.col("id") == F.col("of_id")) & (F.col("key") == F.col("of_key"))).select("node", "text")
    # Rows may repeat the one that stands for a class.
    sets = materialize(found.mapInArrow(run, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles")), "minhash-sets")
    left, right = (sets.select(F.col("node").alias(f"{x}_node"), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    both = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node")).select("a", "b", "a_set", "b_set")
    return materialize(both.mapInArrow(_compare, "a long, b long, both long, n_a long, n_b long, plus array<long>, minus array<long>"), "minhash-verified")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    for batch in batches:
        for part in pieces_of(batch, 2048):
            rows = []
            for x, y in zip(part.column("a_set"), part.column("b_set")):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                common = np.intersect1d(x, y, assume_unique=True)
                plus, minus = (np.setdiff1d(v, common, assume_unique=True).view(np.int64) for v in (x, y))
                rows.append((len(common), len(x), len(y), plus, minus))
            both, n_a, n_b, plus, minus = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(both, pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(list(plus), longs), pa.array(list(minus), longs)],
                ["a", "b", "both", "n_a", "n_b", "plus", "minus"],
            )
    give_back()


def late_links(tried: DataFrame, label: DataFrame, threshold: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between documents of one centre that are in different components so far.

    An outsider -- not in its centre's component -- meets all others of the
    centre's group. Groups are cut into blocks of outsiders and blocks of all,
    so a task holds about ``block`` rows of either side whatever a group's size.
    """
    to_a, to_b = (label.select(F.col("node").alias(f"{x}_node"), F.col("component").alias(f"{x}_comp")) for x in "ab")
    group = (
        tried.join(to_a, F.col("a") == F.col("a_node"), "left")
        .join(to_b, F.col("b") == F.col("b_node"), "left")
        .select("a", "b", "both", "n_a", "n_b", "plus", "minus", F.coalesce("a_comp", "a").alias("comp"), (F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b")).alias("out"))
    )
    group = materialize(group, "minhash-groups")
    blocks = lambda n: F.ceil(n / block).cast("int")
    sizes = group.groupBy("b").agg(blocks(F.count_if("out")).alias("outs"), blocks(F.count(F.lit(1))).alias("alls")).where("outs > 0").withColumnRenamed("b", "of")
    open_groups = group.join(sizes, group["b"] == sizes["of"]).drop("of")
    deal = lambda n: F.pmod(F.xxhash64("a"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    # Aliased, as both sides of the cogroup come from one table.
    columns = ["b", "i", "j", "a", "n_a", "n_b", "both", "comp", "plus", "minus"]
    outs = open_groups.where("out").withColumn("i", deal(F.col("outs"))).withColumn("j", every(F.col("alls"))).select(*columns)
    alls = open_groups.withColumn("j", deal(F.col("alls"))).withColumn("i", every(F.col("outs"))).select(*(F.col(c).alias(c) for c in columns))

    def compare(x: pa.Table, y: pa.Table) -> pa.Table:
        return _late(x, y, threshold)

    key = ("b", "i", "j")
    return outs.groupBy(*key).cogroup(alls.groupBy(*key)).applyInArrow(compare, "a long, b long")


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, row of each value) of a list column."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    values = lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    return values, np.repeat(np.arange(len(lists)), sizes)


def _late(x: pa.Table, y: pa.Table, threshold: int) -> pa.Table:
    """Close pairs (outsider of x, document of y) in different components.

    With a centre R: |A n B| = |R| - |minus_A u minus_B| + |plus_A n plus_B|.
    """
    found_a, found_b = [], []
    if x.num_rows and y.num_rows:
        number = lambda t, c: t.column(c).to_numpy()
        far = {id(t): 1 - number(t, "both") / (number(t, "n_a") + number(t, "n_b") - number(t, "both")) for t in (x, y)}
        plus, plus_row = _flat(y.column("plus"))
        minus, minus_row = _flat(y.column("minus"))
        minus_size = np.bincount(minus_row, minlength=y.num_rows)
        y_n, y_comp, y_id = number(y, "n_a"), number(y, "comp"), number(y, "a")
        x_comp, x_id = number(x, "comp"), number(x, "a")
        slack = 1 - threshold / 100 + 1e-9
        for k in range(x.num_rows):
            if not ((np.abs(far[id(y)] - far[id(x)][k]) <= slack) & (y_comp != x_comp[k])).any():
                continue
            own_plus, own_minus = (x.column(c)[k].values.to_numpy() for c in ("plus", "minus"))
            shared_plus = np.bincount(plus_row[np.isin(plus, own_plus)], minlength=y.num_rows)
            shared_minus = np.bincount(minus_row[np.isin(minus, own_minus)], minlength=y.num_rows)
            common = x.column("n_b")[k].as_py() - (minus_size + len(own_minus) - shared_minus) + shared_plus
            union = y_n + x.column("n_a")[k].as_py() - common
            hit = np.flatnonzero((common * 100 >= union * threshold) & (y_comp != x_comp[k]))
            # One link into each component is enough.
            _, one = np.unique(y_comp[hit], return_index=True)
            found_a += [x_id[k]] * len(one)
            found_b += y_id[hit[one]].tolist()
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of linked texts the rows with the least id (of several such texts the one of least digest); all columns.

    Here texts are linked, not ids: a row goes only if its own text is linked
    with the one that stays, so an id's other texts are kept. Rows without an id and empty texts stay.
    """
    marked, classes = set_classes(docs, id_col, text_col, join_ids=False, **options)
    best = classes.groupBy("label").agg(F.min(F.struct("rep", "set")).alias("best"))
    stays = classes.join(best.withColumnRenamed("label", "of"), F.col("label") == F.col("of")).select(F.col("set").alias("of_set"), F.col("best.rep").alias("keep_id"), F.col("best.set").alias("keep_set"))
    placed = marked.where("id IS NOT NULL AND set IS NOT NULL").join(stays, F.col("set") == F.col("of_set"))
    lost = placed.where((F.col("id") != F.col("keep_id")) | (F.col("set") != F.col("keep_set"))).select(F.col("id").alias("__lost"), F.col("key").alias("__key")).distinct()
    return docs.join(lost, (docs[id_col] == lost["__lost"]) & (_key(docs[text_col]) == lost["__key"]), "left_anti")
