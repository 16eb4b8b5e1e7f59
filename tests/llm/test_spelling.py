import random
import re
import zlib
from collections import Counter

import pytest
from daycast.llm import queries, spelling
from hypothesis import given, settings
from hypothesis import strategies as st

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(docs, least=7):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=10):
    form, many = {}, {}
    for w, n in counts.items():
        around = [(-counts[v], v) for v in counts if near(w, v)]
        many[w] = len(around)
        best = min(around, default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, many[w], counts[form[w]] if form[w] else None)
    return out


def found(df):
    got = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


def variants(seed, n):
    """Counted words in families of near ones, chains of forms among them."""
    r, counts = random.Random(seed), {}
    for _ in range(n):
        w = "".join(r.choice("abé") for _ in range(r.randrange(5, 12)))
        c = 2 * 10 ** r.randrange(5)
        for _ in range(r.randrange(8)):
            counts.setdefault(w, c + r.randrange(3))
            at, kind = r.randrange(len(w)), r.randrange(3)
            w = w[:at] + (r.choice("abé") if kind else "") + w[at + (kind != 1) :]
            c = max(2, c // 10 - 1) if r.random() < 0.7 else c
            if len(w) < 5:
                break
    return counts


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(frame, seed):
    counts = variants(seed, 60)
    rows = [(w, n, 0, [1]) for w, n in counts.items()]
    got = found(spelling.spelling_groups(frame(rows, "word string, n long, id int, back array<int>").repartition(3)))
    want = brute_groups(counts)
    assert got == want
    assert any(v[0] and want[v[0]][0] for v in want.values())  # a chain


def test_pairs_come_once(frame):
    words = ["aaaaaaa", "aaaaaaaa", "aaaabaaa", "abababab", "ababababa", "babababa", "xaaaaaaa", "ÿÿÿÿÿÿÿ", "÷×÷×÷×÷", "÷×÷××÷×÷"]
    nodes = spelling.node_pairs(frame([(w, 2) for w in words], "word string, n long"))
    named = {r["id"]: r["word"] for r in nodes.collect()}
    assert [named[i] for i in sorted(named)] == sorted(words)
    pairs = [(named[r["id"]], named[r["near"]]) for r in spelling.near_pairs(nodes).collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if near(a, b))


def test_nodes_are_prefixes(spark, frame):
    r = random.Random(3)
    words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(1, 11))) for _ in range(600)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = spelling.number_trie(frame([(w,) for w in words], "word string"), "word", "nodes").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    seen = {}
    for row in got:
        assert len(row["nodes"]) == len(row["word"]) + 1
        for i, node in enumerate(row["nodes"]):
            assert seen.setdefault(row["word"][:i], node) == node
    assert len(set(seen.values())) == len(seen)
    assert [row["word"] for row in sorted(got, key=lambda x: x["place"])] == words
    assert len({row["place"] >> spelling._LOCAL for row in got}) > 1


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="ab", min_size=1, max_size=6), min_size=1, max_size=40), st.lists(st.integers(0, 39), max_size=6))
def test_carries_join_the_ranges(words, cuts):
    words = sorted(words)
    bounds = sorted({0, *[c for c in cuts if c < len(words)], len(words)})
    edges, local = [], {}
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        base, used, last, nodes = part << spelling._LOCAL, 0, "", [0]
        for w in words[a:b]:
            k = spelling._common(last, w)
            nodes = nodes[: k + 1] + list(range(base + used + 1, base + used + 1 + len(w) - k))
            used, last = used + len(w) - k, w
            local[w] = (part, nodes)
        edges.append({"part": part, "first": words[a], "last": words[b - 1], "nodes": nodes})
    carries = dict(spelling._carries(edges))
    seen = {}
    for w, (part, nodes) in local.items():
        carry, base = carries.get(part, []), part << spelling._LOCAL
        for i, x in enumerate(nodes):
            x = carry[i - 1] if 1 <= i <= len(carry) and x == base + i else x
            assert seen.setdefault(w[:i], x) == x
    assert len(set(seen.values())) == len(seen)


def test_counts_equal_brute_force(frame, make_text):
    texts = ["Größen größen GRÖSSEN naïveté naïveté", "Straßen ÀÉÎÕÜ×÷ àéîõü×÷ İstanbul İstanbul", None, "", "short", "abcdefg" * 3000 + " " + "abcdefg" * 3000, "x" * 6 + "1" + "y" * 7 + " yyyyyyy"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "nothing nothing"), (3, "repeated repeated"), (3, "repeated repeated")]
    r = random.Random(5)
    stock = ["".join(r.choice("abcdefghijÉé") for _ in range(r.randrange(6, 11))) for _ in range(40)]
    docs += [(100 + i, " ".join(r.choice(stock) for _ in range(60))) for i in range(200)]
    got = spelling.word_counts(frame(docs).selectExpr("1 AS n", "'w' AS word", "text", "doc_id"), edit=spelling.planted_edit).collect()
    assert {x["word"]: x["n"] for x in got} == brute_counts(docs)
    whole = spelling.word_counts(frame(docs)).collect()
    assert sum(x["n"] for x in whole) > 0 and len({x["word"] for x in whole}) == len(whole)


def test_counts_are_handed_on_in_parts(frame, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 1)
    got = spelling.word_counts(frame([(i, "seventh eighthh") for i in range(5)])).collect()
    assert {x["word"]: x["n"] for x in got} == {"seventh": 5, "eighthh": 5}


def test_empty_table(frame):
    counts = spelling.word_counts(frame([]), edit=spelling.planted_edit)
    assert spelling.spelling_groups(counts).count() == 0
    assert spelling.spelling_groups(frame([("alonely", 2)], "word string, n long")).collect()[0]["root"] == "alonely"


def test_query_on_a_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    counts = brute_counts(docs)
    got = found(queries.op11_spelling(spark, sf))
    assert {w: v[2] for w, v in got.items()} == counts
    by = {}
    for w in counts:  # near words by deletion keys
        for i in range(len(w)):
            by.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    keys = {}
    for (i, k), ws in by.items():
        keys.setdefault(k, set()).update(ws)
    for w in list(counts):
        around = {v for i in range(len(w)) for v in by[(i, w[:i] + w[i + 1 :])] | ({w[:i] + w[i + 1 :]} & counts.keys())} | keys.get(w, set())
        around.discard(w)
        assert got[w][3] == len(around), w
        best = min(((-counts[v], v) for v in around), default=None)
        assert got[w][0] == (best[1] if best and -best[0] >= 10 * counts[w] else None)
