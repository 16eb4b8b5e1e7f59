import hashlib
from collections import defaultdict

from daycast.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, heavy_hitters
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def test_groups_equal_a_dictionary(frame):
    rows = [(i, ["Hot text", "hot TEXT", "É", "é", "", None, f"own {i}"][i % 7]) for i in range(400)]
    got = {r["doc_id"]: r for r in exact_duplicates(frame(rows), hot_keys=4).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    assert len(got) == len(rows)
    for i, t in rows:
        group = groups[digest(t)]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(group), len(group), i == max(group), digest(t))
    assert digest("É") != digest("é")


def test_repeated_rows_null_ids_and_clashing_columns(frame):
    rows = [(5, "a", 1, "x"), (5, "A", 2, "y"), (None, "a", 3, "z"), (None, "only", 4, "z"), (None, "only", 5, "z")]
    docs = frame(rows, "doc_id long, text string, row long, digest string")
    got = exact_duplicates(docs).collect()
    assert len(got) == 5
    assert sum(r["kept"] for r in got) == 2
    assert {r["keep_id"] for r in got if r["text_sha256"] == digest("a")} == {5}
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"].lower()) for r in left.collect()) == [(-1, "only"), (5, "a")]


def test_empty_table(frame):
    assert exact_duplicates(frame([])).count() == 0
    assert drop_exact_duplicates(frame([])).count() == 0


def test_heavy_hitters_are_exact_and_bounded(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = heavy_hitters(rows, "k", F.max("id").alias("keep"), 8, 256).collect()
    assert [(r["k"], r["n"], r["keep"]) for r in got] == [("hot", 1000, 2997)]


def test_main_path_has_no_python(frame):
    plan = exact_duplicates(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
