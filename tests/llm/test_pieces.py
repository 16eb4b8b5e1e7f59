import itertools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from daycast.llm import pieces, queries

TEXTS = ["", "Hello  world\n x", "  a b ", "a\tb é 漢字 𝄞", "the.\nThe thing", "x" * 70, "thinking " * 40, "². a².b", "123 4567", "--==>>;;\r\n\r", "ﬀ ½ ٣٤", "Straße naïve café", "internationalisation" * 5, "▁mark", "áb‍c", "ooooooooooooooooooo", "!" * 200, "日本語" * 30]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


@pytest.mark.parametrize("head", [pieces.HEAD, 40])
def test_ids_equal_the_library_and_come_back(frame, library, head, monkeypatch):
    monkeypatch.setattr(pieces, "HEAD", head)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (0, ""), (1, TEXTS[1]), (None, "null id")]
    rows = frame([(*d, "x") for d in docs], "doc_id long, text string, row string")
    texts, segments = pieces.encode(rows)
    got = pieces.decode(pieces.assembled(texts, segments), to="back").collect()
    assert len(got) == len(docs)
    want = {i: t or "" for i, t in docs}
    for r in got:
        text = want[r["doc_id"]]
        assert r["ids"] == library.encode(text), text
        assert r["back"] == library.decode(r["ids"])
        if "▁" not in text:
            assert r["back"] == text


def test_summary_equals_the_segments(frame, monkeypatch):
    monkeypatch.setattr(pieces, "HEAD", 40)
    docs = frame([(i, t) for i, t in enumerate(TEXTS)])
    full_texts, full = pieces.encode(docs)
    texts, sums = pieces.encode(docs, summary=True)
    got = {}
    for r in sums.join(texts, "row").collect():
        n, c = got.get(r["doc_id"], (0, 0))
        got[r["doc_id"]] = (n + r["pieces"], (c + r["checksum"]) % 2**32)
    model = pieces.load()
    table = {p: k for k, p in enumerate(model.text)}
    for i, t in enumerate(TEXTS):
        n = c = 0
        for k, u in enumerate(pieces.units_of(t)):
            ids = pieces._filled(u, pieces._long(u, table, model, "merge"), table, model.id.tolist(), model)
            n += len(ids)
            c += int(pieces.checksum(np.full(len(ids), k), np.arange(len(ids)), ids).sum())
        assert got.get(i, (0, 0)) == (n, c % 2**32)


def test_units_can_be_encoded_alone(library):
    for t in TEXTS:
        units = pieces.units_of(t)
        assert "".join(units) == ("▁" + t.replace(" ", "▁") if t else "")
        assert [u for e in pieces.Chunks({}).entries(t) for u in e[0]] == units


def brute_viterbi(unit, model):
    table = {p: k for k, p in enumerate(model.text)}
    lowest = model.score.min() - pieces.UNKNOWN_COST
    best = None
    for cuts in itertools.product([0, 1], repeat=len(unit) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(unit)]
        parts = [unit[a:b] for a, b in zip(at, at[1:])]
        if all(p in table or len(p) == 1 for p in parts):
            score = sum(model.score[table[p]] if p in table else lowest for p in parts)
            mask = sum(1 << p for p in at)
            if best is None or (score, mask) > best[0]:
                best = (score, mask), parts
    return best[1]


def test_viterbi_fold_equals_all_paths(frame):
    model = pieces.load()
    units = ["▁the", "thinking", "é漢x", "▁ab", "q", "▁", "zzz", "ation", "▁weather"]
    rows = frame([(u, 1) for u in units], "unit string, n long").groupBy("unit").sum("n").withColumnRenamed("sum(n)", "n")
    got = {r["unit"]: r["ids"] for r in pieces.encode_units(rows, model, "viterbi").collect()}
    table = {p: int(model.id[k]) for k, p in enumerate(model.text)}
    for u in units:
        want = [x for p in brute_viterbi(u, model) for x in ([table[p]] if p in table else [model.byte_id[b] for b in p.encode()])]
        assert got[u] == want


def test_edges_are_grouped_without_a_second_shuffle(frame):
    model = pieces.load()
    rows = frame([("▁the", 1)], "unit string, n long").groupBy("unit").sum("n").withColumnRenamed("sum(n)", "n")
    plan = pieces.encode_units(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_empty_table(frame):
    texts, segments = pieces.encode(frame([]))
    assert texts.count() == 0 and segments.count() == 0


@pytest.mark.parametrize("head", [pieces.HEAD, 40])
def test_query_has_both_segmentations_and_the_decoded_text(spark, library, head, monkeypatch, tmp_path):
    monkeypatch.setattr(pieces, "HEAD", head)
    monkeypatch.setattr(pieces, "NUMBERED_CHUNKS", 5)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (100, "the weather the weather"), (101, " "), (102, "café " * 3)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op9_sentencepiece(spark, str(tmp_path)).collect()}
    model = pieces.load()
    table = {p: k for k, p in enumerate(model.text)}

    def digest(lists):
        return sum(int(pieces.checksum(np.full(len(x), k), np.arange(len(x)), np.array(x)).sum()) for k, x in enumerate(lists)) % 2**32

    assert len(got) == len(docs)
    for i, t in docs:
        units, r = pieces.units_of(t or ""), got[i]
        best = [pieces._filled(u, pieces._long(u, table, model, "viterbi"), table, model.id.tolist(), model) for u in units]
        assert (r["viterbi_pieces"], r["viterbi_checksum"]) == (sum(map(len, best)), digest(best)), t
        assert (r["n_units"], r["n_pieces"]) == (len(units), len(library.encode(t or "")))
        text = library.decode(library.encode(t or ""))
        assert r["decoded_chars"] == len(text)
        decoded = pieces.UNIT.findall(pieces.SPACE + text.replace(" ", pieces.SPACE)) if text else []
        assert r["decoded_checksum"] == digest([[ord(c) for c in u.replace(pieces.SPACE, " ")] for u in decoded])


def test_array_folds_equal_the_single_unit_folds():
    import random

    import pyarrow as pa

    model = pieces.load()
    table = {p: k for k, p in enumerate(model.text)}
    r = random.Random(5)
    units = ["".join(r.choice("▁aeiounrstlhgéb") for _ in range(r.randrange(1, 62))) for _ in range(300)] + ["▁the", "ﬀ", "▁" * 61]
    lists = [[table[u[a:b]] << 12 | a << 6 | b for a in range(len(u)) for b in range(a + 1, min(len(u), a + model.longest) + 1) if u[a:b] in table] for u in units]
    for x in lists:
        r.shuffle(x)
    edges = pieces.Edges.of(np.array(list(map(len, units))), pa.array(lists, pa.list_(pa.int64())))
    for rule, masks in (("merge", pieces.merge_fold(edges)), ("viterbi", pieces.viterbi_fold(edges, model.score))):
        used = edges.on(masks)
        for i, u in enumerate(units):
            mine = used[edges.unit[used] == i]
            got = list(zip(edges.start[mine].tolist(), edges.end[mine].tolist(), edges.rank[mine].tolist()))
            assert got == pieces._long(u, table, model, rule), (rule, u)


def test_rare_units_are_folded_where_their_places_are(frame, monkeypatch):
    monkeypatch.setattr(pieces, "HEAD", 40)
    _, segments = pieces.encode(frame([(i, t) for i, t in enumerate(TEXTS)]), summary=True)
    plan = segments._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_units_hand_on_an_array_once(frame):
    rows = frame([("▁the", [3, 4]), ("q" * 70, [5])], "unit string, n array<long>").groupBy("unit").agg({"n": "first"}).withColumnRenamed("first(n)", "n")
    assert {r["unit"]: r["n"] for r in pieces.encode_units(rows, pieces.load(), "both").collect()} == {"▁the": [3, 4], "q" * 70: [5]}


def test_every_occurrence_is_decoded_and_summed(monkeypatch):
    """A unit's ids are put down, decoded and weighted wherever it occurs, in steps of any size."""
    texts = ["the weather the weather", "", "café the the 漢字 café", "x the zebra", "  the ", "rare"]
    model, known = pieces.load(), sorted({u for t in texts for u in pieces.units_of(t)} - {"▁zebra", "▁rare"})
    table = {p: k for k, p in enumerate(model.text)}
    ids = lambda u, rule: pieces._filled(u, pieces._long(u, table, model, rule), table, model.id.tolist(), model).tolist()
    sent = pa.table({"unit": known, "ids": pa.array([ids(u, "merge") for u in known], pa.list_(pa.int32())), "best": pa.array([ids(u, "viterbi") for u in known], pa.list_(pa.int32()))})
    seen, whole = [], pieces.decoded
    monkeypatch.setattr(pieces, "decoded", lambda x, names: seen.extend(x.tolist()) or whole(x, names))
    for step in (pieces.SUMMED, 3):
        monkeypatch.setattr(pieces, "SUMMED", step)
        seen.clear()
        per_text, runs, missing, place, unit = pieces._summed(texts, pieces._numbered(sent, model.names))
        assert missing.tolist() == [0, 0, 0, 1, 0, 1] and unit == ["▁zebra", "▁rare"] and place.tolist() == [2, 0]
        assert seen == [i for t in texts for u in pieces.units_of(t) if u in known for i in ids(u, "merge")]
        for t, run in zip(texts, runs.to_pylist(), strict=True):
            units = [(k, u) for k, u in enumerate(pieces.units_of(t)) if u in known]
            want = []
            for values in ([ids(u, "merge") for _, u in units], [ids(u, "viterbi") for _, u in units], [[ord(c) for c in u.replace("▁", " ")] for _, u in units]):
                want += [sum(map(len, values)), sum(int(pieces.checksum(np.full(len(x), k), np.arange(len(x)), np.array(x)).sum()) for (k, _), x in zip(units, values)) % 2**32]
            assert [(r["first_unit"], r["units"], *[r[c] for c in pieces.SUMS]) for r in run] == ([(0, len(units), *want)] if units else [])
