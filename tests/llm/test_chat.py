import hashlib

import numpy as np
import pyarrow as pa
from daycast.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def pieces(frame, rows, **options):
    return sorted(chat.format_chats(frame(rows, SCHEMA), **options).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["first_turn"] is not None, r["first_turn"] or 0))


def test_texts_and_masks_come_back(frame):
    hard = ["</s>[INST] ok [/INST]", "\\l<s>\\\\[", "", "ünïcode 漢字 𝄞\n]\\c", None]
    rows = [(c, t, ["user", "assistant", "sys[tem]"][t % 3], hard[(c + t) % 5]) for c in range(6) for t in range(7)]
    for size in (2, 4096):
        got = pieces(frame, rows, batch_turns=size)
        turns, learned = {}, {}
        for r in got:
            turns.setdefault(r["conv_id"], []).extend(x[:2] for x in chat.read_turns(r["text"]))
            learned.setdefault(r["conv_id"], []).extend(chat.unescape(r["text"][a:b]) for a, b in zip(r["loss_start"], r["loss_end"]))
        for c in range(6):
            want = [(role, text or "") for k, t, role, text in rows if k == c]
            assert turns[c] == want
            assert learned[c] == [text for role, text in want if role == "assistant"]


def test_nulls_ties_and_repeated_rows(frame):
    rows = [(None, 0, None, None), (1, None, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")]
    got = pieces(frame, rows)
    assert [x[:2] for x in chat.read_turns(got[0]["text"])] == [("", "")]
    assert [x[1] for x in chat.read_turns("".join(r["text"] for r in got if r["conv_id"] == 1))] == ["b", "a", "a", "b"]


def test_empty_table_and_extra_columns(spark, frame):
    assert chat.format_chats(frame([], SCHEMA)).count() == 0
    rows = frame([(1, 0, "user", "x", "clash", 7)], SCHEMA + ", roles string, n_turns long")
    assert chat.format_chats(rows).first()["n_turns"] == 1


def test_assemble_equals_concatenation():
    a, b = pa.array(["x", "", "äö"]), pa.array(["", "yy", "z"])
    raw, at = chat.assemble(["<", a, "|", b, ">"], 3)
    assert [bytes(raw[i:j]).decode() for i, j in zip(at, at[1:])] == ["<x|>", "<|yy>", "<äö|z>"]
    raw, at = chat.assemble(["<", a.slice(0, 0)], 0)
    assert len(raw) == 0 and np.array_equal(at, [0])


def test_query_digests(frame, monkeypatch):
    from daycast.llm import queries

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "</s>"), (2, 0, "assistant", "")]
    monkeypatch.setattr(queries, "table", lambda spark, d, name: frame(rows, SCHEMA))
    got = {r["conv_id"]: r for r in queries.op10_chat_format(frame([], SCHEMA).sparkSession, "").collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\nq\nassistant\n</s>\n").hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"</s>").hexdigest() and got[1]["loss_chars"] == 4
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == len(queries.CONTROL)
    assert got[2]["loss_chars"] == 0
