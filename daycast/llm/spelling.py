"""Spelling variants: exact neighbours at one edit by a trie-node pair dictionary.

Every word is a path in a forward trie and, read backwards, in a reversed trie.
With the tries' nodes numbered, a word of length l with position i skipped is the
integer pair (node of its first i letters, reversed node of its last l-1-i
letters), and the word itself is the pair (first i, last l-i) at every i. Two
words differ by one replaced letter if they share a skipping pair; one is the
other with a letter deleted if its whole pair equals the other's skipping pair.
No letters are compared, no word is paired with another one that isn't near it.

The tries are numbered over words in sorted order, where equal prefixes lie next
to each other: a range-partitioned sort, one pass in each task, and a carry of
the nodes that a range shares with the range before it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.llm.common import UPPER
from daycast.session import materialize

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
RATIO = 10
LETTERS = "A-Za-zÀ-ÿ"
#: Distinct words counted in a task before they are handed on.
HELD_WORDS = 200_000
#: Bits of a node's number that count inside one range.
_LOCAL = 40
_LOWER = str.maketrans(UPPER, UPPER.lower())


def planted_edit(doc_id: int | None, run: str, every: int = 31) -> str:
    """``run`` without one letter, where the crc32 of ``<doc_id>:<run>`` is a multiple of ``every``; a null id is empty text."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, edit: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """(word, n) of the words of whole texts: maximal runs of letters, A-Z lower-cased, of at least ``least_letters`` that occur ``least_count`` times.

    ``edit`` may change a run by its document's id. A null text has no word. Counts are added up in the
    tasks before they are shuffled.
    """
    pattern = re.compile(f"[{LETTERS}]{{{int(least_letters)},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                runs = pattern.findall(text.as_py().translate(_LOWER))
                if edit is None:
                    held.update(runs)
                else:
                    for word, n in Counter(runs).items():
                        word = edit(doc_id, word)
                        if len(word) >= least_letters:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed()
        if held:
            yield handed()
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def number_trie(words: DataFrame, word_col: str, to: str) -> DataFrame:
    """``words`` with the trie nodes of ``word_col``: ``to`` is an array of one number per prefix, the empty one (0) first.

    Words that share a prefix share its number, and no others do. Words must be
    distinct. Also adds ``place``, a number in the words' code-point order.
    """
    spark = words.sparkSession
    fields = [T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()), T.StructField(to, T.ArrayType(T.LongType()))]
    schema = T.StructType([*words.schema.fields, *fields])
    names = words.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base = part << _LOCAL
        last, nodes, used, seen = "", [0], 0, 0
        for batch in batches:
            flat, ends = [], [0]
            for word in batch.column(word_col).to_pylist():
                shared = _common(last, word)
                grown = len(word) - shared
                nodes = nodes[: shared + 1]
                nodes.extend(range(base + used + 1, base + used + 1 + grown))
                used += grown
                last = word
                flat += nodes
                ends.append(len(flat))
            n = batch.num_rows
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            place = pa.array(range(base + seen, base + seen + n), pa.int64())
            seen += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int32()), place, lists], [*names, "part", "place", to])

    dealt = words.repartitionByRange(word_col).sortWithinPartitions(word_col)
    local = materialize(dealt.mapInArrow(run, schema), "trie")
    edges = local.groupBy("part").agg(
        F.min(word_col).alias("first"), F.max(word_col).alias("last"), F.max_by(to, word_col).alias("nodes")).orderBy("part").collect()
    carries = spark.createDataFrame(list(_carries(edges)), "of int, carry array<long>")
    start = F.shiftleft(F.col("part").cast("long"), _LOCAL)
    # A range's first word has the local numbers 1, 2, ...: node i of its path is number i.
    shared = F.transform(to, lambda x, i: F.when((i >= 1) & (i <= F.size("carry")) & (x == start + i), F.element_at("carry", F.greatest(i, F.lit(1)))).otherwise(x))
    return local.join(carries, F.col("part") == F.col("of"), "left").withColumn(to, F.when(F.col("carry").isNull(), F.col(to)).otherwise(shared)).select(*names, "place", to)


def _carries(edges) -> Iterator[tuple[int, list[int]]]:
    """For every range, the numbers of the nodes its first word shares with the last word of the range before.

    ``edges`` has one row a range, in order: its first and last word and the last word's nodes.
    """
    before, path = "", [0]
    for row in edges:
        shared = _common(before, row["first"])
        carry = path[1 : shared + 1]
        if carry:
            yield row["part"], carry
        # The last word's own path, where it still runs along the shared nodes.
        base = row["part"] << _LOCAL
        path = [carry[x - base - 1] if 1 <= x - base <= len(carry) and x - base == i else x for i, x in enumerate(row["nodes"])]
        before = row["last"]


def node_pairs(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with ``id``, in code-point order, and the nodes of both tries: ``ahead`` and ``back``."""
    reversed_ = words.select("word", "n", F.reverse("word").alias("mirror"))
    back = number_trie(reversed_, "mirror", "back").select("word", "n", "back")
    return materialize(number_trie(back, "word", "ahead").withColumnRenamed("place", "id"), "trie-nodes")


def near_pairs(nodes: DataFrame) -> DataFrame:
    """(id, n, near, near_n): every ordered pair of words that differ by one inserted, deleted or replaced letter, once.

    A pair of nodes is shared by at most one word a letter of the alphabet, so no
    group is large. Of equal letters in a row only the last is skipped for a
    deletion, so that a pair of words meets at one position.
    """
    letters, ahead, back = F.length("word"), F.col("ahead"), F.col("back")
    at = lambda i: (F.element_at(ahead, i + 1), F.element_at(back, F.length("word") - i))
    skips = F.transform(F.sequence(F.lit(0), letters - 1), lambda i: F.struct(
        at(i)[0].alias("p"), at(i)[1].alias("s"), (F.substring("word", i + 1, F.lit(1)) != F.substring("word", i + 2, F.lit(1))).alias("drops")))
    whole = F.transform(F.sequence(F.lit(0), letters), lambda i: F.struct(F.element_at(ahead, i + 1).alias("p"), F.element_at(back, F.length("word") - i + 1).alias("s")))
    skipping = nodes.select("id", "n", F.inline(skips))
    a, b = skipping.alias("a"), skipping.alias("b")
    same = (F.col("a.p") == F.col("b.p")) & (F.col("a.s") == F.col("b.s"))
    replaced = a.join(b, same & (F.col("a.id") < F.col("b.id")))
    w = nodes.select("id", "n", F.inline(whole)).alias("b")
    dropped = skipping.where("drops").alias("a").join(w, same)
    both = lambda df: df.select(F.inline(F.array(
        F.struct(F.col("a.id").alias("id"), F.col("a.n").alias("n"), F.col("b.id").alias("near"), F.col("b.n").alias("near_n")),
        F.struct(F.col("b.id").alias("id"), F.col("b.n").alias("n"), F.col("a.id").alias("near"), F.col("a.n").alias("near_n")))))
    return both(replaced).unionAll(both(dropped))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for ``forms`` (id, form): forms followed to the last, by doubling.

    A form is more frequent than its word, so there is no cycle; a chain of d
    steps takes about log2(d) rounds.
    """
    now = materialize(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("id").alias("of"), F.col("root").alias("further"))
        step = materialize(now.join(onward, now["root"] == onward["of"], "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = step.select("id", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``counts`` (word, n): word, form, root, n, n_near, form_n.

    ``n_near`` is the number of near words, ``form`` the near word of largest n
    (ties: the smallest in code-point order) if that n is at least ``ratio`` times
    the word's, else null, ``form_n`` its n, and ``root`` the last word reached by
    following forms (the word itself without one). Words are distinct, not null
    and of at least one letter; extra columns are ignored; an empty table gives no row.
    """
    nodes = node_pairs(counts.select("word", "n"))
    best = near_pairs(nodes).groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.struct(F.col("near_n").alias("n"), (-F.col("near")).alias("least"))).alias("best"))
    near = materialize(best.select("id", "n_near", F.col("best.n").alias("near_n"), (-F.col("best.least")).alias("near")), "near")
    words = nodes.select("id", "word", "n")
    found = words.join(near, "id", "left")
    has = F.col("near_n") >= F.col("n") * ratio
    placed = materialize(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near")).alias("form_id"), F.when(has, F.col("near_n")).alias("form_n")), "spelling")
    linked = placed.where(F.col("form_id").isNotNull())
    ends = roots(linked.select("id", F.col("form_id").alias("form")))
    named = (
        linked.select("id", "form_id").join(ends, "id")
        .join(words.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
        .join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
        .select("id", "form", "root_word")
    )
    return placed.join(named, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
