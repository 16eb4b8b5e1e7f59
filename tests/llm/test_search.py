import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from daycast.llm import queries, search
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    documents, total = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        for i, bag, n in bags:
            m = 100 - 75 + (75 * n * documents) // total
            s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in words if bag[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


@pytest.fixture
def corpus(make_text):
    docs = [(i, make_text(i % 37, 3 + i * 13 % 60)) for i in range(300)]
    docs += [(1000 + i, "alpha BETA, gamma") for i in range(40)]          # a large class of copies
    docs += [(2000 + i, f"gamma beta\nalpha x{i}") for i in range(40)]    # another text, the same vector
    docs += [(3000, None), (3001, ""), (3002, "... !"), (None, "alpha beta gamma"), (5, "alpha"), (5, "alpha"), (3003, "Élan élan ÉLAN 漢字 a1B2"), (3004, "beta " * 5000)]
    return docs


ITEMS = [(1, "Alpha beta"), (2, "alpha alpha gamma delta5"), (3, None), (4, "!!"), (5, "élan 漢字 nothing A1b2"), (5, "beta"), (None, "omega7 omega8"), (6, "unknownword"), (7, "alpha12 beta7 xi3")]


def test_ranks_equal_brute_force(frame, corpus):
    want = brute(corpus, ITEMS)
    docs = frame(corpus).repartition(5).selectExpr("text", "doc_id", "1 AS h", "'c' AS class", "2 AS m", "3 AS n")
    items = frame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS query", "2 AS term", "0 AS doc_id")
    assert rows(search.search(docs, items)) == want
    assert rows(search.search(docs, items, k=3)) == brute(corpus, ITEMS, 3)


def test_blocks_give_the_same(frame, corpus):
    docs, items = frame(corpus), frame(ITEMS, "item_id long, text string")
    assert [len(b) for b in search.query_blocks(items, "item_id", "text", 2)] == [2, 2, 2]
    assert [len(b) for b in search.query_blocks(items, "item_id", "text", 100, 3)][0] < 6
    assert rows(search.search(docs, items, most_items=2)) == brute(corpus, ITEMS)


def test_plain_join_beyond_the_broadcast_bound(frame, corpus, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(search, "STEP", 7)
    assert rows(search.search(frame(corpus), frame(ITEMS, "item_id long, text string"))) == brute(corpus, ITEMS)


def test_equal_vectors_are_one_class_and_hashes_are_verified(frame):
    bag = lambda *x: np.array(x, "<u4").tobytes()
    made = [(1, 7, 30, bag(0, 1)), (2, 7, 30, bag(0, 1)), (3, 7, 30, bag(0, 2)), (4, 7, 31, bag(0, 1)), (5, 8, 30, bag()), (None, 9, 30, bag(1, 1))]
    got = search.bag_classes(frame(made, "doc_id long, h long, m long, bag binary")).collect()
    assert sorted((r["size"], r["first"] or 0) for r in got) == [(1, 0), (1, 3), (1, 4), (2, 1)]
    assert len({r["class"] for r in got}) == 4


def test_members_are_limited_before_the_shuffle(frame, corpus):
    plan = search._members(frame([(1, 2, 3, b"x")], "doc_id long, h long, m long, bag binary"), frame([(0, 2, 3, b"x")], "class long, h long, m long, bag binary"), frame([(0,)], "class long"), 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_factors(spark):
    got = spark.range(1).select(search.length_factor(F.lit(10**7), 10**12, 10**15).alias("m")).first()["m"]
    assert got == 25 + 75 * 10**7 * 10**12 // 10**15
    tf = np.array([1, 3, 10**6])
    assert search.saturation(tf, np.array([30, 30, 30])).tolist() == [10**9 * t // (1000 * t + 240) for t in tf.tolist()]


def test_empty_tables(frame, corpus):
    none = frame([], "item_id long, text string")
    assert search.search(frame(corpus), none).count() == 0
    assert search.search(frame([]), frame(ITEMS, "item_id long, text string")).count() == 0
    assert search.search(frame([(1, None), (2, " ")]), frame(ITEMS, "item_id long, text string")).count() == 0


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(queries.OP13_SQL).fetchall()
    assert rows(queries.op13_search(spark, sf)) == sorted(want, key=str) and want
