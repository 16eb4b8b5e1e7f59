import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from daycast.llm import langid

DATA = "/root/testdata/sf0.001"
EN = ["the cat sat on the mat with another thing", "this is what they thought of that weather", "where there is a will there is a way home"]
RU = ["кот сидел на окне и смотрел на дождь", "это было хорошее время для прогулки", "где мы будем жить в следующем году"]
DE = ["der hund lief schnell über die straße", "ich habe gestern ein gutes buch gelesen", "wir möchten heute nicht ins kino gehen"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for lang, texts in (("en", EN), ("ru", RU), ("de", DE)) for t in texts] + [(None, "en"), ("no label", None)]
    return langid.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(3)
    lengths = np.array([0, 1, 5, 0, 3, 6])
    scores = r.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    labels = langid.viterbi(scores, lengths, 2.0)
    at = 0
    for n in lengths:
        own = scores[at : at + n]
        cost = lambda path: sum(own[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        if n:
            best = max(cost(p) for p in itertools.product(range(3), repeat=int(n)))
            assert cost(labels[at : at + n].tolist()) == pytest.approx(best, abs=1e-4)
        at += n


def test_spans_of_mixed_text(model):
    text = "the weather is what they thought. Где мы будем жить? ich habe ein gutes buch"
    lang, score, spans = langid.label_texts(pa.array([text]), model, switch=4.0)
    got = [(s["lang"], text[s["start"] : s["end"]]) for s in spans[0].as_py()]
    assert [k for k, _ in got] == ["en", "ru", "de"]
    assert got[1][1] == "Где мы будем жить"
    assert 0 < score[0].as_py() < 1


def test_script_rules_languages_out(model):
    lang, score, _ = langid.label_texts(pa.array(["ещё раз", "漢字だ"]), model)
    assert lang[0].as_py() == "ru" and score[0].as_py() == 1.0
    assert lang[1].as_py() in model.langs


def test_texts_without_letters(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (3, "12 + 34 = 46 !!", "c"), (4, "ª", "d"), (5, "x" * 300000, "e"), (5, "x" * 300000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_score string")
    got = langid.identify(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "lang_score", "lang_spans"]
    found = [(r["doc_id"], r["lang_pred"], r["lang_score"]) for r in got.collect()]
    assert [f for f in found if f[0] <= 3] == [(i, "und", 0.0) for i in (1, 2, 3)]
    assert found[3][1] in model.langs and len(found) == 6
    assert [r["doc_id"] for r in langid.keep_identified(docs, model).collect()] == [5, 5]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_nothing_learned(spark):
    empty = langid.learn(spark.createDataFrame([], "text string, lang string"))
    got = langid.identify(spark.createDataFrame([("abc",)], "text string"), empty).first()
    assert (got["lang_pred"], got["lang_score"]) == ("und", 0.0)


def test_batch_neighbours_do_not_touch(model):
    texts = [random.Random(i).choice(EN + RU + DE) for i in range(30)] + [""] * 3
    together = langid.label_texts(pa.array(texts), model)
    for i, t in enumerate(texts):
        alone = langid.label_texts(pa.array([t]), model)
        assert [x[i].as_py() for x in together] == [x[0].as_py() for x in alone]


def test_held_out_accuracy(spark):
    from daycast.llm import queries

    got = queries.op4_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)


def test_unlearned_languages_and_gibberish_are_dropped(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("text", "lang")
    learned = langid.learn(docs)
    r = random.Random(5)
    odd = [
        "все люди рождаются свободными и равными в своем достоинстве",
        "人人生而自由在尊严和权利上一律平等",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "".join(r.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400)),
    ]
    rows = spark.createDataFrame([(t, "") for t in odd], docs.schema)
    assert [r["lang_score"] for r in langid.identify(rows, learned).collect()] == [0.0] * len(odd)
    kept = langid.keep_identified(docs.unionByName(rows), learned)
    assert kept.count() == docs.count() and not {r["text"] for r in kept.collect()} & set(odd)


def test_words_of_an_unused_script_count_for_no_language(model):
    lang, score, spans = langid.label_texts(pa.array(["the cat 漢字漢字漢字漢字"]), model)
    assert lang[0].as_py() == "en" and score[0].as_py() == pytest.approx(6 / 30)
    assert [s["lang"] for s in spans[0].as_py()] == ["en", "und"]


def test_more_labels_than_a_byte_holds():
    scores = np.full((4, 300), -50.0, np.float32)
    scores[0, 299] = scores[1, 200] = scores[2, 130] = scores[3, 256] = 0
    assert langid.viterbi(scores, np.array([2, 2]), 1.0).tolist() == [299, 200, 130, 256]
