import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from daycast.llm import common, langid, minhash, packing, secrets
from daycast.llm import tokens as tokens_module
from daycast.llm.tokens import Tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ODD = ["", " ", "  two  spaces ", "a\n b \n\nc", " x y　z", "it's  we'll", "<|endoftext|> x", "漢字 𝄞 é", "a" * 5000, "end. \tnext\r\n", " lead", "trail ", "x \x1c y", "1 22 333"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(library):
    tokens = Tokens()
    for text in ODD:
        assert tokens.ids(text).tolist() == library(text), text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 1.\n\t' é漢s,")), max_size=40))
def test_ids_of_any_text(text):
    tokens = Tokens()
    assert tokens.ids(text).tolist() == tokens.encode(text)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0, 2, 10])), min_size=1, max_size=25))
def test_cuts_cost_least(steps):
    at = np.r_[0, np.cumsum([s for s, _ in steps])]
    fee = np.r_[0, [f for _, f in steps]]
    fee[-1] = 0

    def pad(n):
        return 0 if n in (16, 8, 4) else 16 - n

    best = [0.0] + [np.inf] * (len(at) - 1)
    for i in range(1, len(at)):
        best[i] = min(best[j] + pad(at[i] - at[j]) for j in range(i) if at[i] - at[j] <= 16) + fee[i]
    cuts = packing.best_cuts(at, fee, 16, 4)
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1
    assert sum(pad(at[b] - at[a]) + fee[b] for a, b in zip(cuts, cuts[1:])) == best[-1]


def check(rows, docs, library, window=1024):
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(library(t or "") + [0])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == [0, *np.cumsum([r["length"] for r in parts])[:-1]]
        assert sum(r["length"] for r in parts) <= window
        known = [r["doc_id"] for r in parts if r["doc_id"] is not None]
        assert known == sorted(known)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, own in texts.items():
        want = sorted((n, zlib.crc32(np.array(ids, "<u4").tobytes())) for ids in own for n in [len(ids)])
        if len(own) == 1:
            ids, at = own[0], 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in pieces[i]) == sum(n for n, _ in want)


def test_every_id_in_one_piece(frame, library, make_text):
    docs = [(i, make_text(i, 5 + i * 7 % 400) + ". Next one. " + ODD[i % len(ODD)]) for i in range(60)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(200, None), (None, "null id"), (7, "again"), (7, "again")]
    got = packing.pack(frame(docs).withColumnsRenamed({}).selectExpr("doc_id", "text", "1 AS block", "'x' AS start"))
    rows = got.collect()
    check(rows, docs, library)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["sequence_id"]] += r["length"]
    tail = max(sizes)
    padded = sum(packing.padding(n) for s, n in sizes.items() if s != tail)
    assert padded <= 0.02 * sum(sizes.values())


def test_many_ranges(frame, library):
    docs = [((i * 7919) % 9000, f"text {i}") for i in range(9000)]
    rows = packing.pack(frame(docs).repartition(3)).collect()
    check(rows, docs, library)


def test_units_carry_the_open_sequence(frame, library, make_text, monkeypatch):
    monkeypatch.setattr(packing, "UNIT", 3000)
    tokens, tables = Tokens(), packing.sentence_tables()
    stream, rows = packing._Stream(256, tables, 0), []
    docs = [(i, make_text(i, 300)) for i in range(12)]
    for i, t in docs:
        stream.add(i, np.append(tokens.ids(t), np.uint32(0)))
        if stream.held >= packing.UNIT and (out := stream.pack(False)) is not None:
            rows += out.to_pylist()
    rows += stream.pack(True).to_pylist()
    check(rows, docs, library, 256)


def test_empty_table(frame):
    assert packing.pack(frame([])).count() == 0


def test_pieces_are_kept_from_task_to_task(frame, monkeypatch):
    monkeypatch.setattr(tokens_module, "CACHE", 4)
    tokens = Tokens()
    plain = tokens.encode
    assert tokens.ids("x " + " ".join("abcdef")).tolist() == plain("x " + " ".join("abcdef"))
    assert list(tokens.pieces)[:2] == ["a", "b"] and len(tokens.pieces) <= 4  # the first half stays
    assert packing.tokens_of() is packing.tokens_of()
    calls = []
    monkeypatch.setattr(packing, "tokens_of", lambda path: calls.append(path) or tokens_module.tokens_of(path))
    packing.sentence_tables.__wrapped__()
    assert calls == [None]


def test_other_operators_drop_the_known_pieces(frame, monkeypatch):
    docs = frame([(i, "plain words here") for i in range(8)])
    model = langid.learn(docs.withColumn("lang", F.lit("en")))
    tasks = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: tasks.append(run) or self)
    langid.identify(docs, model)
    secrets.find_secrets(docs)
    minhash.signatures(docs, 2, 40, 5)
    assert len(tasks) == 3
    for run in tasks:
        packing.tokens_of().ids("some words")
        assert common._KEPT
        assert list(run(iter([]))) == [] and not common._KEPT
