import random
from itertools import combinations

import numpy as np
import pytest
from daycast.llm import minhash
from daycast.llm.components import components


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w)} - {()} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, threshold=80):
    sets = [(i, shingles(t, size)) for i, t in rows]
    head = {i: i for i, _ in rows}

    def find(a):
        while head[a] != a:
            a = head[a]
        return a

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= threshold * len(a | b):
            x, y = find(i), find(j)
            head[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def edit(text, r, n):
    w = text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture
def corpus(make_text):
    r = random.Random(5)
    rows = [make_text(i, 60) for i in range(40)]
    base = make_text(1000, 60)
    rows += [edit(base, r, r.randrange(0, 9)) for _ in range(60)]  # many below the threshold of each other
    drift = make_text(2000, 80)
    for _ in range(25):  # a chain: neighbours are close, its ends are not
        drift = edit(drift, r, 3)
        rows.append(drift)
    rows += [make_text(3000, 60).upper(), make_text(3000, 60), "one", "ONE", "one two", "", None, " \n", "a b"]
    r.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(frame, corpus, size):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(corpus), shingle=size).collect()}
    want = brute(corpus, size)
    assert len(got) == len(corpus)
    for i, (n, component) in want.items():
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, component, i == component)


def test_repeated_rows_null_ids_and_empty_table(frame):
    rows = [(4, "a b c d e f", "x"), (4, "a b c d e f", "x"), (2, "A B C D E F", "y"), (None, "a b c d e f", "z"), (9, None, "z")]
    docs = frame(rows, "doc_id long, text string, bands string")
    got = sorted(((r["doc_id"] or -1), r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [(-1, None, True), (2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted((r["doc_id"] or -1) for r in left.collect()) == [-1, 2, 9]
    assert minhash.near_duplicates(frame([])).count() == 0


def test_coordinates_are_shifts_of_one_permutation():
    scatter, shifted = minhash.permutations(16)
    assert sorted(scatter.tolist()) == list(range(1 << minhash.UNIVERSE_BITS))
    s = minhash.shingle_set(b"some words of a text", 2, minhash._Words())
    place = scatter[(s >> np.uint64(64 - minhash.UNIVERSE_BITS)).astype(np.int64)]
    first = shifted[:, 0]
    want = [min(int(first[(p + k) % len(first)]) for p in place) for k in range(16)]
    assert minhash.signature(s, 16).tolist() == want


def test_estimate_follows_jaccard(make_text):
    words, r = minhash._Words(), random.Random(1)
    text = make_text(1, 400)
    a = minhash.shingle_set(text.encode(), 2, words)
    b = minhash.shingle_set(edit(text, r, 40).encode(), 2, words)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    estimate = (minhash.signature(a, 200) == minhash.signature(b, 200)).mean()
    assert abs(true - estimate) < 0.15


def test_late_comparison_by_differences():
    import pyarrow as pa

    r = np.random.default_rng(2)
    centre = np.arange(0, 100)
    sets = [np.unique(np.r_[r.choice(centre, 85, replace=False), r.integers(200, 260, 6)]) for _ in range(40)]

    def table(rows):
        return pa.table({"b": [0] * len(rows), "i": [0] * len(rows), "j": [0] * len(rows), "a": pa.array(rows, pa.int64()), "n_a": [len(sets[k]) for k in rows], "n_b": [100] * len(rows), "both": [len(np.intersect1d(sets[k], centre)) for k in rows], "comp": pa.array(rows, pa.int64()), "plus": pa.array([np.setdiff1d(sets[k], centre) for k in rows], pa.list_(pa.int64())), "minus": pa.array([np.setdiff1d(centre, sets[k]) for k in rows], pa.list_(pa.int64()))})

    got = minhash._late(table(list(range(20))), table(list(range(40))), 65)
    want = {(a, b) for a in range(20) for b in range(40) if a != b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 65 * len(np.union1d(sets[a], sets[b]))}
    assert want and set(zip(got["a"].to_pylist(), got["b"].to_pylist())) == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(300, 340)] + [(7, 7), (340, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(300, 341)} == {5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_id_link_it(frame, make_text):
    a, b, c, d = (make_text(i, 40) for i in range(4))
    rows = [(1, a), (2, b), (3, a), (3, b), (3, c), (4, d), (5, ""), (5, d + " more"), (6, None), (6, None), (7, c), (7, " ")]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame(rows)).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 1, False), (3, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (5, 4, False),
                   (6, 6, True), (6, 6, True), (7, 1, False), (7, 1, False)]


def test_an_ids_other_texts_stay(frame, make_text):
    a, c, d = (make_text(i, 40) for i in range(3))
    rows = [(1, a), (3, a.upper()), (3, c), (3, c + " tail"), (8, c), (2, d + " x"), (2, d), (None, a), (3, "")]
    left = minhash.drop_near_duplicates(frame(rows)).collect()
    kept = sorted((r["doc_id"] or -1, r["text"]) for r in left)
    assert (-1, a) in kept and (1, a) in kept and (3, "") in kept and (3, a.upper()) not in kept
    assert sum(r[1].startswith(c) for r in kept) == 1 and sum(r[1].startswith(d) for r in kept) == 1
    assert len(kept) == 5 and all(i == 3 for i, t in kept if t.startswith(c))


def test_repeated_representatives_are_one_set(frame, make_text):
    base = make_text(9, 60)
    rows = [(1, base)] * 30 + [(2, base + " tail")] * 20 + [(3, base + " other end")]
    got = minhash.near_duplicates(frame(rows).repartition(3)).collect()
    assert len(got) == 51 and {r["component_id"] for r in got} == {1}
    marked, classes = minhash.set_classes(frame(rows))
    assert classes.count() == 3
