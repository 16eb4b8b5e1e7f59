"""Secret scans: fixed patterns plus a token-efficiency test.

A tokenizer needs few tokens for words and many for random strings. Runs of key
characters that mix character classes and come out below ``max_ratio``
characters per token are reported as kind ``random``. Runs shaped like words (one
case, or groups of it between separators) need fewer than ``WORD_RATIO`` letters
per token, which long words and identifiers seldom have. Left out are a known
digest (hex of a digest's length), an identifier (UUID, number) and what lies wholly
in a span the patterns already found.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.llm.common import drop_kept, give_back

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Hex runs of the least length: the same as all runs less the short ones.
HEX_LONG = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hex.
DIGESTS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile("(?:(?:md5|sha-?[0-9]{1,3})[-_=])?(?:" + "|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGESTS) + ")")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Characters that make a hex span part of something longer; a slash separates the parts of a path.
_JOINED = re.compile(r"[A-Za-z0-9+_=-]+")
#: Below so many characters a token a run counts as random.
MAX_RATIO = 2.1
#: The ratio for runs shaped like words, and the letters such a run must have. At 1.8, 2 of the 1,242 different long words of
#: the sf0.1 documents come out as random, and 88 % (lower) and 97 % (upper) of random strings of 16 letters.
WORD_RATIO, WORD_LETTERS = 1.8, 12
TOKENIZER = "byte_bpe_50k.tiktoken"
#: Texts without a match of these have no span; they skip the Python patterns.
_MAY = (r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]", r"[A-Za-z0-9+/_=-]{16}")
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind, in code points."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return found


def digest(run: str) -> bool:
    """A digest, alone or after its algorithm's name, or a UUID."""
    return bool(DIGEST.fullmatch(run) or UUID.fullmatch(run))


def known(run: str) -> bool:
    """Numbers, digests, and runs shaped like words joined by separators."""
    return run.isdigit() or all(digest(part) or words(part) for part in run.split("/"))


def words(run: str) -> bool:
    return all(re.fullmatch(r"[A-Z]?[a-z]*|[A-Z]+|[0-9]{1,4}", part) for part in re.split(r"[-+/_=]+", run))


def public_hex(text: str) -> set[tuple[int, int]]:
    """The hex spans of ``text`` that are a digest, with nothing joined to it."""
    wholes = (m for m in _JOINED.finditer(text) if len(m[0]) >= LEAST["hex"])
    return {(m.start() + h.start(), m.start() + h.end()) for m in wholes if digest(m[0].strip("-+_=")) for h in HEX_LONG.finditer(m[0])}


def mixed(run: str) -> bool:
    """Letters with digits, or letters that change case again and again."""
    letters, digits = re.search(r"[A-Za-z]", run), re.search(r"[0-9]", run)
    return bool(letters and digits) or len(re.findall(r"[a-z][A-Z]", run)) >= 3


def random_spans(text: str, taken: list[tuple[str, int, int]], encode, max_ratio: float) -> list[tuple[str, int, int]]:
    found = []
    for m in RUN.finditer(text):
        run = m[0]
        if run.isdigit() or any(a <= m.start() and m.end() <= b for _, a, b in taken):
            continue
        if mixed(run) and not known(run):
            random = len(run) < max_ratio * len(encode(run))
        else:
            random = unlike_words(run, encode, min(max_ratio, WORD_RATIO))
        if random:
            found.append(("random", *m.span()))
    return found


def unlike_words(run: str, encode, ratio: float) -> bool:
    """Do the letter groups of three and more of ``run`` need more tokens than words do, alone or after a space?"""
    parts = [p for whole in run.split("/") if not digest(whole) for p in re.split(r"[-+_=]+", whole) if len(p) >= 3 and not p.isdigit()]
    letters = sum(map(len, parts))
    return letters >= WORD_LETTERS and letters < ratio * sum(min(len(encode(p)), len(encode(" " + p))) for p in parts)


def _in_order(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_text(text: str, encode, max_ratio: float = MAX_RATIO) -> list[tuple[str, int, int]]:
    base = base_spans(text)
    return _in_order(base + random_spans(text, base, encode, max_ratio))


def may_hold(texts: pa.Array) -> pa.Array:
    """Rows that can hold a span, by two linear-time patterns over the whole column."""
    first, second = (pc.match_substring_regex(texts, p) for p in _MAY)
    return pc.or_(first, second)


def find_secrets(docs: DataFrame, text_col: str = "text", to: str = "secret_spans", max_ratio: float = MAX_RATIO, tokenizer: str | None = None) -> DataFrame:
    """``docs`` with column ``to``: array of (kind, start, end), in code points, by start, then kind.

    Kinds: assign (group 2 of 12 or more characters), access (18 or more),
    hex (16 or more), random (the token-efficiency test). The span is the whole
    match. Null texts count as empty and have no spans. A column named ``to`` is
    replaced; all other columns and repeated rows stay as they are.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    kept = [c for c in docs.columns if c != to]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(to, SPANS)])
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        encode = encoding(path).encode_ordinary
        for batch in batches:
            texts = batch.column(text_col).fill_null("")
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i in pc.indices_nonzero(may_hold(texts)).to_pylist():
                found[i] = [{"kind": k, "start": a, "end": b} for k, a, b in scan_text(texts[i].as_py(), encode, max_ratio)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, spans)], [*batch.schema.names, to])
        give_back()

    return docs.select(*kept).mapInArrow(run, schema)


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` with every span of ``kinds`` replaced by ``mask``; no row goes. Overlapping spans become one mask.

    Hex spans that are a digest or UUID, with nothing joined to it, stay.
    ``n_chars``, where present, follows the new text.
    """
    spans = "__secret_spans"
    found = find_secrets(docs, text_col, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col)
            marked = batch.column(spans)
            hit = pc.indices_nonzero(pc.greater(pc.list_value_length(marked), 0)).to_pylist()
            if hit:
                new = texts.to_pylist()
                for i in hit:
                    new[i] = masked(new[i], to_mask(new[i], [(s["kind"], s["start"], s["end"]) for s in marked[i].as_py()], kinds), mask)
                texts = pa.array(new, texts.type)
            columns = [texts if n == text_col else c for n, c in zip(batch.schema.names, batch.columns) if n != spans]
            yield pa.RecordBatch.from_arrays(columns, [n for n in batch.schema.names if n != spans])
        give_back()

    out = found.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.char_length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out


def to_mask(text: str, spans: list[tuple[str, int, int]], kinds: tuple[str, ...] = KINDS) -> list[tuple[int, int]]:
    """Places of the ``spans`` of ``kinds``, less the hex spans that are public."""
    public = public_hex(text) if any(k == "hex" for k, _, _ in spans) else set()
    return [(a, b) for k, a, b in spans if k in kinds and not (k == "hex" and (a, b) in public)]


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    parts, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join([*parts, text[at:]])
