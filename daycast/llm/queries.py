"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm import chat, exact_dedup, fingerprint, langid, lm, minhash, packing, pieces, search, secrets, spelling, tokenfiles, warc
from daycast.llm.common import crc_mod, table


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: units; number and checksum of its ids, of the best path's (Viterbi) ids, and of the characters the ids decode to.

    A checksum depends on the order. It is the sum over pieces of (id + 1) * w modulo 2**32 with
    w = (131 * unit + place in the unit + 1) * 2654435761 modulo 2**32; for decoded text, code points
    take the ids' part, with the space that encoding puts in front, which ``decoded_chars`` leaves out.
    """
    texts, segments = pieces.encode(table(spark, sf_dir, "documents"), summary=True)
    sums = segments.groupBy(F.col("row").alias("of")).agg(*[F.sum(c).alias(c) for c in pieces.SUMS])

    def digest(name: str):
        return F.coalesce(F.col(name) % (1 << 32), F.lit(0))

    return texts.join(sums, texts["row"] == sums["of"], "left").select(
        "doc_id",
        "n_units",
        F.coalesce("pieces", F.lit(0)).alias("n_pieces"),
        digest("checksum").alias("ids_checksum"),
        F.coalesce("best_pieces", F.lit(0)).alias("viterbi_pieces"),
        digest("best_checksum").alias("viterbi_checksum"),
        F.coalesce(F.col("chars") - 1, F.lit(0)).alias("decoded_chars"),
        digest("chars_checksum").alias("decoded_checksum"),
    )


#: A conversation whose texts hold control strings.
CONTROL = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation and reads the result back from the formatted text."""
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.format_chats(rows).mapInPandas(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation; its pieces follow each other, so only running digests are held."""
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    now = None

    def row():
        return (now["id"], now["turns"], now["all"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["long"])

    for batch in batches:
        done = []
        for conv, text, starts, ends in zip(batch["conv_id"], batch["text"], batch["loss_start"], batch["loss_end"]):
            conv = None if pd.isna(conv) else int(conv)
            if now is None or now["id"] != conv:
                if now is not None:
                    done.append(row())
                now = {"id": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "long": 0}
            for role, content, _, _ in chat.read_turns(text):
                now["turns"] += 1
                now["all"].update(f"{role}\n{content}\n".encode())
            for a, b in zip(starts, ends):
                content = chat.unescape(text[a:b])
                now["chars"] += len(content)
                now["loss"].update(content.encode())
            now["long"] += len(text)
        if done:
            yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
    if now is not None:
        yield pd.DataFrame([row()], columns=columns).astype({"conv_id": "Int64"})


OP10_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(replace(text, '\\', ''), '<', ''), '[', ''), ']', '')) AS n_text,
    length(role) + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '<', ''), '[', ''), ']', '')) AS n_role
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n_text + n_role + 16) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprint.neighbour_prints(docs, fingerprint.lexicon(docs))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = langid.learn(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.identify(rows, model, score_to="score", spans_to=None).drop("text")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive_round_trip(table(spark, sf_dir, "pages"), payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response IS NULL OR page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans are those of the three fixed kinds; ``spans`` has all."""
    rows = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), to="found").drop("text")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    listed = lambda x: F.concat_ws(",", F.transform(x, text))
    base = F.filter("found", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id",
        *(count(k) for k in ("assign", "access", "hex")),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        count("random"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all texts, some of them with one letter lost by rule, and their forms."""
    return spelling.spelling_groups(spelling.word_counts(table(spark, sf_dir, "documents"), edit=spelling.planted_edit))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document read back from the token files."""
    return tokenfiles.token_round_trip(table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), d AS (
  SELECT doc_id, row, CAST(len(terms) AS BIGINT) AS n, terms FROM words WHERE len(terms) > 0
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d
), q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term
), tf AS (
  SELECT doc_id, row, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, row, n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, row, n, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, row, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), totals GROUP BY item_id, doc_id, row
), ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_fingerprint": op2_fingerprint,
    "op3_minhash": op3_minhash,
    "op4_language_id": op4_language_id,
    "op5_warc": op5_warc,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_secrets": op8_secrets,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_chat_format": op10_chat_format,
    "op11_spelling": op11_spelling,
    "op12_token_files": op12_token_files,
    "op13_search": op13_search,
}
ORACLE = {"op5_warc": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op10_chat_format": OP10_SQL, "op13_search": OP13_SQL}
