import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from daycast.llm import tokenfiles
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

ODD = ["", " ", "  two  spaces ", "a\n b \n\nc", " x y　z", "it's  we'll", "<|endoftext|> x", "漢字 𝄞 é", "a" * 5000, "end. \tnext\r\n", " lead", "trail ",
       "x \x1c y", "1 22 333", "cr\rin piece \r and alone", "x\x85  y z"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def ids_of(raw, encoder):
    return np.frombuffer(raw, encoder.dtype).tolist()


def test_ids_equal_the_library(library, monkeypatch):
    encoder = tokenfiles.Encoder()
    want = [library(t) for t in ODD]
    assert [ids_of(x, encoder) for x in encoder.encode(ODD)] == want
    assert [ids_of(x, encoder) for x in encoder.encode(ODD)] == want  # from the cache
    monkeypatch.setattr(tokenfiles, "CACHE", 5)
    assert [ids_of(x, encoder) for x in encoder.encode(ODD)] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 1.\n\r\t' é漢s,")), max_size=40), max_size=5))
def test_ids_of_any_text(library, texts):
    encoder = tokenfiles.Encoder()
    assert [ids_of(x, encoder) for x in encoder.encode(texts)] == [library(t) for t in texts]


LINES = [f"{a}{tail}{ends}{b}{last}" for a in ("word", "été") for tail in ("", ".", "?!", "***", "-", "(#", "<|", "." * 60) for ends in ("", "\n", "\n\n", "\n\n\n")
         for b, last in ((("next", ""), ("Été", ",")) if ends else (("", ""),))]


def test_pieces_across_lines(library, monkeypatch):
    texts = ["first " + " ".join(LINES), "x " + " ".join(reversed(LINES)), *(f"a {p} b" for p in LINES), "w it's.\nnext d'été\nand we.'s\nend ẞa.\nb a\n1 a1\nb a\n\tb"]
    want = [library(t) for t in texts]
    for _ in range(2):
        encoder = tokenfiles.Encoder()
        assert [ids_of(x, encoder) for x in encoder.encode(texts)] == want
        assert [ids_of(x, encoder) for x in encoder.encode(texts)] == want  # from the cache
        monkeypatch.setattr(tokenfiles, "TAILS", 3)


def test_known_words_of_a_line_end_are_not_encoded_again(library):
    words = [a + b for a in "abcdefgh" for b in "ijklmnopqrst"]
    text = "x " + " ".join(f"{a}.\n{b}" for a, b in zip(words, reversed(words)))
    encoder, sent = tokenfiles.Encoder(), []
    encoder._ids = lambda t, ids=encoder._ids: sent.append(len(t)) or ids(t)
    assert ids_of(encoder.encode([text])[0], encoder) == library(text)
    assert sum(sent) < len(text) / 10


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_round_trip_of_odd_documents(frame, library, make_text, tmp_path):
    docs = [(i * 3 - 40, make_text(i, 5 + i * 37 % 900) + ODD[i % len(ODD)]) for i in range(70)]
    docs += [(1000, None), (None, "no id"), (None, "no id"), (7000, "same id"), (7000, "another text"), (7000, "same id"), (9000, "漢" * 30_000)]
    rows = frame(docs).selectExpr("text", "'x' AS block", "doc_id", "1 AS start", "'y' AS path")
    manifest = tokenfiles.write_tokens(rows, str(tmp_path), length=64, file_tokens=3000)
    got = tokenfiles.read_documents(manifest).collect()
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(library(t or "") + [0])
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append(r)
    assert {i: sorted((len(x), crc(x)) for x in v) for i, v in want.items()} == {i: sorted((r["n_tokens"], r["ids_crc32"]) for r in v) for i, v in found.items()}
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1].tolist()]
    ids = [r["doc_id"] for r in ordered]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    files = manifest.orderBy("number").collect()
    assert len(files) > 3 and [f["base"] for f in files] == [0, *np.cumsum([f["tokens"] for f in files])[:-1].tolist()]


def test_sequences_are_views_of_the_file(frame, library, tmp_path):
    docs = [(i, f"document {i} " + "word " * (i % 50)) for i in range(400)]
    files = tokenfiles.write_tokens(frame(docs), str(tmp_path), length=16).collect()
    want = [x for _, t in docs for x in library(t) + [0]]
    assert len(files) == 1 and files[0]["sequences"] == -(-len(want) // 16) > tokenfiles.BATCH_SEQUENCES
    with tokenfiles.TokenFile(files[0]["path"]) as file:
        assert len(file) == files[0]["sequences"]
        before = pa.total_allocated_bytes()
        for k in (0, 1, 255, 256, len(file) - 2):
            ids, mask = file.sequence(k)
            assert ids.tolist() == want[16 * k : 16 * k + 16] and mask.true_count == 16
            assert not ids.flags.owndata and not ids.flags.writeable
        assert pa.total_allocated_bytes() - before < 10_000
        ids, mask = file.sequence(len(file) - 1)
        left = len(want) % 16 or 16
        assert mask.to_pylist() == [True] * left + [False] * (16 - left)
        assert ids.tolist() == want[-left:] + [0] * (16 - left)
        with pytest.raises(IndexError):
            file.sequence(len(file))


def test_a_frequent_id_is_several_tasks(frame, library, tmp_path):
    docs = [(5, f"hot {i}") for i in range(6000)] + [(None, f"none {i}") for i in range(5000)] + [(i, f"own {i}") for i in range(9000)]
    manifest = tokenfiles.write_tokens(frame(docs).repartition(3), str(tmp_path))
    got = tokenfiles.read_documents(manifest).collect()
    assert sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in got) == sorted((i or -1, crc(library(t) + [0])) for i, t in docs)
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids[:5000] == [None] * 5000 and ids[5000:] == sorted(ids[5000:])
    assert max(f["documents"] for f in manifest.collect()) < 6500  # 9,000 if the hot id were not divided


def test_damaged_files_are_errors(frame, tmp_path):
    path = tokenfiles.write_tokens(frame([(1, "a b c"), (2, "d")]), str(tmp_path)).first()["path"]
    docs = path.removesuffix(".arrow") + ".docs.arrow"
    rows = pa.ipc.open_file(docs).read_all().slice(0, 1)
    with pa.ipc.new_file(docs, rows.schema) as out:
        out.write_table(rows)
    with pytest.raises(ValueError):
        list(tokenfiles.document_crcs(path))


def test_empty_table(frame, tmp_path):
    manifest = tokenfiles.write_tokens(frame([]), str(tmp_path))
    assert manifest.count() == 0 and tokenfiles.read_documents(manifest).count() == 0
