import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from daycast.llm import langid, minhash, secrets

ROOT = Path(__file__).resolve().parents[2]


def test_stages_take_effect_and_keep_clean_documents(spark, make_text):
    clean = [(i, make_text(i, 60), "en", "s", 1) for i in range(30)]
    rows = clean + [
        (100, clean[0][1].upper(), "en", "s", 1),  # exact copy of 0
        (101, clean[1][1] + " tail", "en", "s", 1),  # near copy of 1
        (102, clean[2][1] + " password=abcdefghijkl99", "en", "s", 1),  # near copy of 2
        (103, "password=zyxwvutsrqpo11 " + make_text(500, 50), "en", "s", 1),
        (104, "12345 !!", "en", "s", 1),
        (105, None, "en", "s", 1),
        (5, clean[5][1], "en", "s", 1),  # a repeated row
        (101, make_text(700, 50), "en", "s", 1),  # another text of an id whose first text goes
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, now, ""), name)
        kept[name] = now
        if name != "packing":
            assert now.columns == docs.columns
    ids = {k: sorted(r["doc_id"] for r in v.select("doc_id").collect()) for k, v in kept.items()}
    assert ids["language_id"] == sorted([r[0] for r in rows if r[0] not in (104, 105)])
    assert ids["exact_dedup"] == sorted([*range(1, 30), 100, 101, 101, 102, 103])
    assert ids["minhash_near_dedup"] == sorted([*range(1, 30), 100, 101, 103])
    assert ids["secret_scan"] == ids["minhash_near_dedup"]
    texts = {r["doc_id"]: r["text"] for r in kept["secret_scan"].collect()}
    assert texts[101] == make_text(700, 50)
    assert texts[103].startswith("[SECRET] ") and all(texts[i] == clean[i][1] for i in range(1, 30))
    assert sorted(set(ids["packing"])) == ids["secret_scan"]


def test_pipeline_equals_the_operators_on_a_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = langid.learn(docs)
    lang = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    left = {i: t for i, t in rows.items() if lang[i]["lang_pred"] != "und" and lang[i]["lang_score"] >= 0.3}
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {}
    for i in sorted(left):
        last[left[i].translate(fold)] = i
    left = {i: left[i] for i in last.values()}
    from test_minhash import brute

    found = brute(sorted(left.items()), minhash.SHINGLE)
    left = {i: t for i, t in left.items() if found[i][1] == i}
    got = corpus_pipeline.run(spark, d).groupBy("doc_id").sum("length").collect()
    assert sorted(r["doc_id"] for r in got) == sorted(left)
    from daycast.llm.tokens import Tokens

    tokens = Tokens()
    for r in got:
        text = left[r["doc_id"]]
        spans = secrets.to_mask(text, secrets.scan_text(text, tokens.encode))
        assert r["sum(length)"] == len(tokens.ids(secrets.masked(text, spans, "[SECRET]"))) + 1


def test_entry_point_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith('daycast.llm') or name == 'corpus_pipeline':
            raise ImportError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 40 and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_all_queries_are_registered():
    import __spark_entry__ as e

    names = [k for k in e.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in e.queries()
