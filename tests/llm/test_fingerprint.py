import hashlib
from collections import Counter

import numpy as np
from daycast.llm import fingerprint as fp


def test_lexicon_is_the_band(frame, make_text):
    docs = [(i, make_text(i, 40)) for i in range(300)] + [(999, None), (1000, "")]
    n = Counter(t for _, text in docs for t in fp.terms_of(text or ""))
    want = sorted(fp.term_hash(t) for t, k in n.items() if k >= 2 and k * 100 >= len(docs) and k * 20 <= len(docs))
    got = fp.lexicon(frame(docs), rarest=100, commonest=20)
    assert got.tolist() == want


def test_equal_near_and_other_texts(make_text):
    texts = [make_text(i, 200) for i in range(40)]
    lex = fp._Lexicon(np.sort(np.array([fp.term_hash(t) for x in texts for t in fp.terms_of(x)], np.uint64)))
    prints = [fp.fingerprint(t, lex) for t in texts]
    assert all(fp.likeness(p, fp.fingerprint(t, lex)) == 1.0 for p, t in zip(prints, texts))
    near = [fp.likeness(p, fp.fingerprint(fp.edited(t, texts[i - 1]), lex)) for i, (p, t) in enumerate(zip(prints, texts))]
    other = [fp.likeness(p, prints[i - 1]) for i, p in enumerate(prints)]
    assert np.mean(near) > 0.25 and np.mean(other) < 0.05
    assert all(0 <= x <= 1 for x in near + other)


def test_texts_without_terms():
    lex = fp._Lexicon(np.zeros(0, np.uint64))
    a, b, c = (fp.fingerprint(t, lex) for t in ("", "!!", "!!"))
    assert a.text != b.text == c.text and fp.likeness(a, b) == 0.0 and fp.likeness(b, c) == 1.0


def expected(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0]))
    out = {}
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        k = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[: len(t) - k] + following[:k]).encode()).hexdigest())
    return out


def test_every_document_meets_the_next(frame):
    docs = [((i * 7919) % 13001 - 100, f"dokument nummer {i} über das {i % 7}") for i in range(9000)] + [(20000, None), (20001, "é" * 70000)]
    got = fp.neighbour_prints(frame(docs).repartition(3), np.zeros(0, np.uint64)).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == expected(docs) and len(got) == len(docs)


def test_small_tables(spark, frame):
    lex = np.zeros(0, np.uint64)
    assert fp.neighbour_prints(frame([]), lex).count() == 0 and len(fp.lexicon(frame([]))) == 0
    one = fp.neighbour_prints(frame([(5, "abcdefgh")]), lex).collect()
    assert [(r["doc_id"], r["edited_sha256"], r["near_next"]) for r in one] == [(5, hashlib.sha256(b"abcdefab").hexdigest(), 1.0)]
    rows = frame([(1, "a b c d", "x"), (1, "a b c d", "x"), (None, "z", "y")], "doc_id long, text string, block string")
    got = fp.neighbour_prints(rows, lex).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 1, 1]


def test_column_is_added_without_a_shuffle(frame):
    docs = frame([(1, "a b c", "old"), (2, None, "old")], "doc_id long, text string, fingerprint string")
    got = fp.fingerprints(docs, np.zeros(0, np.uint64))
    rows = got.collect()
    assert got.columns == docs.columns and rows[0]["fingerprint"] != rows[1]["fingerprint"] != "old"
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
