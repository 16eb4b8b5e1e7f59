"""Language identification of mixed-language text.

A word's script narrows the candidate languages; each candidate scores the
word with byte-trigram log-probabilities learned from labelled documents; a
Viterbi pass over the words with a switching penalty labels spans, and the
language with most letters names the document. Counting and scoring work on
whole Arrow batches of UTF-8 bytes with numpy; the Viterbi steps run over all
documents of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.llm.common import drop_kept, utf8

#: Trigram codes are hashed to so many cells, which bounds the model.
CELLS = 1 << 17
#: Log-probability lost at a change of language between words.
SWITCH = 12.0
SMOOTH = 0.5
#: A text fits its languages if a letter's log-probability is on average at most so far below that of their own
#: texts, besides ``NOISE`` standard errors of the text's length.
MARGIN, NOISE = 2.5, 3.0
#: A language uses a script if at least this share of its words does.
SCRIPT_SHARE = 0.01
#: Bytes of text whose words are scored at once, and whose paths are found at once.
SCORE_BYTES, STEP_BYTES = 1 << 20, 4 << 20
UNKNOWN = "und"

#: Scripts by the range of a character's first UTF-8 byte.
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "southeast", "kana", "han", "hangul", "other")
_RANGES = {"latin": (0xC3, 0xCB), "greek": (0xCD, 0xCF), "cyrillic": (0xD0, 0xD5), "hebrew": (0xD6, 0xD7), "arabic": (0xD8, 0xDF), "indic": (0xE0, 0xE0), "southeast": (0xE1, 0xE2), "kana": (0xE3, 0xE3), "han": (0xE4, 0xE9), "hangul": (0xEA, 0xED), "other": (0xEE, 0xF7)}
_SCRIPT = np.zeros(256, np.uint8)
_SCRIPT[ord("a") : ord("z") + 1] = 1
for _name, (_low, _high) in _RANGES.items():
    _SCRIPT[_low : _high + 1] = SCRIPTS.index(_name)
#: Letters get codes from 1; every other byte is the word boundary 0.
_CODE = np.zeros(256, np.int32)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0x80:] = np.arange(27, 27 + 128)
SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


@dataclass
class Words:
    """Words of a batch of texts: maximal runs of letter bytes of the lower-cased text."""

    raw: np.ndarray  # bytes
    text_at: np.ndarray  # byte offset of each text, and the end
    cell: np.ndarray  # trigram cell of each letter byte
    letter: np.ndarray  # byte position of each letter byte
    first: np.ndarray  # index into letter of each word's first byte
    text: np.ndarray  # text of each word
    script: np.ndarray  # script of each word

    @property
    def size(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.letter)))


def words_of(texts: pa.Array) -> Words:
    raw, at = utf8(pc.utf8_lower(texts.fill_null("")))
    code = _CODE[raw]
    # Punctuation outside ASCII: U+0080-00BF, U+2000-206F, U+3000-303F.
    for lead, second in ((0xC2, None), (0xE2, (0x80, 0x81)), (0xE3, (0x80, 0x80))):
        p = np.flatnonzero(raw == lead)
        p = p[p + 1 < len(raw)]
        if second is not None and len(p):
            p = p[(raw[p + 1] >= second[0]) & (raw[p + 1] <= second[1])]
        for k in range(2 if lead == 0xC2 else 3):
            code[p[p + k < len(raw)] + k] = 0
    letter = np.flatnonzero(code)
    # A text boundary separates words even where two texts touch.
    new_text = np.zeros(len(raw) + 1, bool)
    new_text[at] = True
    before = np.zeros(len(letter), np.int32)
    after = np.zeros(len(letter), np.int32)
    inner = (letter > 0) & ~new_text[letter]
    before[inner] = code[letter[inner] - 1]
    inner = (letter + 1 < len(raw)) & ~new_text[letter + 1]
    after[inner] = code[letter[inner] + 1]
    cell = ((before * 160 + code[letter]) * 160 + after).astype(np.uint32) * np.uint32(2654435761) >> np.uint32(15)
    first = np.flatnonzero(before == 0)
    script = np.maximum.reduceat(_SCRIPT[raw[letter]], first) if len(first) else np.zeros(0, np.uint8)
    return Words(raw, at, cell, letter, first, np.searchsorted(at, letter[first], side="right") - 1, script)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # (languages, CELLS) float32
    uses: np.ndarray  # (scripts, languages) bool
    prior: int  # the language with most training words
    typical: np.ndarray  # mean log-probability of a letter of each language's own text
    spread: np.ndarray  # and its variance


def pieces(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count trigrams and scripts per language over all rows with text and a label.

    Each task sums its counts, Spark adds them up; the driver gets at most
    (labels x (CELLS + scripts)) sums. Rows with a null text or label are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text", SCORE_BYTES):
                words = words_of(part.column("text"))
                labels = part.column("lang").dictionary_encode()
                of = labels.indices.to_numpy(zero_copy_only=False)
                word_lang = of[words.text]
                byte_lang = np.repeat(word_lang, words.size)
                for k, lang in enumerate(labels.dictionary.to_pylist()):
                    total = sums.setdefault(lang, np.zeros(CELLS + len(SCRIPTS), np.int64))
                    total[:CELLS] += np.bincount(words.cell[byte_lang == k], minlength=CELLS)
                    total[CELLS:] += np.bincount(words.script[word_lang == k], minlength=len(SCRIPTS))
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "cell": at, "n": total[at]})

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(sums.column("lang").to_pylist()))
    table = np.zeros((len(langs), CELLS + len(SCRIPTS)))
    if langs:
        row = pc.index_in(sums.column("lang").combine_chunks(), pa.array(langs)).to_numpy()
        table[row, sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    cells, scripts = table[:, :CELLS] + SMOOTH, table[:, CELLS:]
    logp = np.log(cells / cells.sum(axis=1, keepdims=True)).astype(np.float32)
    uses = (scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    weights = table[:, :CELLS] / np.maximum(table[:, :CELLS].sum(axis=1, keepdims=True), 1)
    typical = (weights * logp).sum(axis=1)
    spread = (weights * (logp - typical[:, None]) ** 2).sum(axis=1)
    return Model(langs, logp, uses, int(scripts.sum(axis=1).argmax()) if langs else -1, typical, spread)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """(words, languages): log-probabilities; languages that don't use a word's script are ruled out, 0 where nobody does."""
    out = np.empty((len(words.first), len(model.langs)), np.float32)
    for k in range(len(model.langs)):
        out[:, k] = np.add.reduceat(model.logp[k][words.cell], words.first) if len(words.first) else 0
    uses = model.uses[words.script]
    nobody = ~uses.any(axis=1)
    out[~uses] = -1e4
    out[nobody] = 0
    return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word. ``scores`` holds the texts' words one after the other.

    Step t handles word t of all texts that have one; texts are ordered by
    length, so those are a prefix.
    """
    labels = np.zeros(len(scores), np.int64)
    order = np.argsort(-lengths, kind="stable")
    start = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max()) if len(lengths) else 0
    if not longest:
        return labels
    #: So many texts have a word t.
    active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
    came_from = np.zeros(len(scores), np.min_scalar_type(max(scores.shape[1] - 1, 0)))
    switched = np.zeros(scores.shape, bool)
    state = scores[start[: active[0]]]
    rows = np.arange(active[0])
    for t in range(1, longest):
        n = active[t]
        at = start[:n] + t
        now = state[:n]
        top = now.argmax(axis=1)
        jump = now[rows[:n], top][:, None] - switch
        came_from[at] = top
        switched[at] = jump > now
        state[:n] = np.maximum(now, jump) + scores[at]
    label = state.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        now = label[:n]
        labels[at] = now
        if t:
            label[:n] = np.where(switched[at, now], came_from[at], now)
    return labels


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_to: str = "lang_pred", score_to: str = "lang_score", spans_to: str | None = "lang_spans", switch: float = SWITCH) -> DataFrame:
    """``docs`` with the predicted language, its share of the letters, and the spans.

    ``lang_to`` is a learned label, or ``und`` with score 0 where the text is
    null or empty, has no letter, or nothing was learned. A text whose only
    letters are outside the word ranges, or in scripts that no language uses,
    gets the commonest label with score 0; beside other words, words of such
    scripts count as letters of no language. A text whose letters are less
    likely than ``MARGIN`` allows (gibberish, most languages that were not
    learned) keeps its label with score 0.
    ``spans_to`` (None: left out) is an array of (lang, start, end) in code
    points of the lower-cased text, one entry per run of words of one language;
    words of a script that no language uses are ``und``.
    Columns of these names are replaced; other columns and repeated rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    new = [lang_to, score_to] + ([spans_to] if spans_to else [])
    kept = [c for c in docs.columns if c not in new]
    added = [T.StructField(lang_to, T.StringType()), T.StructField(score_to, T.DoubleType())] + ([T.StructField(spans_to, SPANS)] if spans_to else [])
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            for part in pieces(batch, text_col):
                lang, score, spans = label_texts(part.column(text_col), sent.value, switch, bool(spans_to))
                columns = [*part.columns, lang, score] + ([spans] if spans_to else [])
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *new])
        pa.default_memory_pool().release_unused()  # an idle worker should not hold a batch's memory

    return docs.select(*kept).mapInArrow(run, schema)


def label_texts(texts: pa.Array, model: Model, switch: float = SWITCH, with_spans: bool = True) -> tuple[pa.Array, pa.Array, pa.Array | None]:
    n, many = len(texts), len(model.langs)
    found = _scored(texts, model, with_spans)
    size, text = found["size"], found["text"]
    lengths = np.bincount(text, minlength=n)
    share = np.zeros((n, max(many, 1)))
    if many and len(text):
        labels = viterbi(found["scores"], lengths, switch)
        own = found["used"]
        share = np.bincount((text * many + labels)[own], weights=size[own], minlength=n * many).reshape(n, many)
        fits = _fits(found, labels, share, model)
        share = share / np.maximum(np.bincount(text, weights=size, minlength=n), 1)[:, None]
        labels[~own] = many
    else:
        labels, fits = np.zeros(len(text), np.int64), np.zeros(n, bool)
    best = np.where(share.any(axis=1), share.argmax(axis=1), model.prior)
    has_letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    known = has_letter & bool(many)
    names = np.array([*model.langs, UNKNOWN], object)
    lang = pa.array(names[np.where(known, best, many)], pa.string())
    score = pa.array(np.where(known & fits, share[np.arange(n), np.minimum(best, max(many, 1) - 1)], 0.0))
    return lang, score, _spans(text, labels, found["begin"], found["end"], names.tolist(), n) if with_spans else None


def _fits(found: dict[str, np.ndarray], labels: np.ndarray, letters: np.ndarray, model: Model) -> np.ndarray:
    """Texts whose labelled words are about as likely as the languages' own texts; ``letters`` by text and language."""
    own = np.flatnonzero(found["used"])
    score = np.bincount(found["text"][own], weights=found["scores"][own, labels[own]], minlength=len(letters))
    total = letters.sum(axis=1)
    least = letters @ model.typical - MARGIN * total - NOISE * np.sqrt(letters @ model.spread)
    return (total > 0) & (score >= least)


def _scored(texts: pa.Array, model: Model, places: bool) -> dict[str, np.ndarray]:
    """Of every word: text, letters, scores and, with ``places``, its code-point span; a small slice of texts at a time."""
    parts, base = [], 0
    for part in pieces(pa.RecordBatch.from_arrays([texts], ["t"]), "t", SCORE_BYTES):
        words = words_of(part.column("t"))
        one = {"text": words.text + base, "size": words.size.astype(np.int32), "scores": word_scores(words, model), "used": model.uses.any(axis=1)[words.script]}
        if places:
            chars = np.r_[0, np.cumsum((words.raw & 0xC0) != 0x80)]
            last = np.append(words.first[1:], len(words.letter)) - 1
            origin = chars[words.text_at[words.text]]
            one["begin"] = chars[words.letter[words.first]] - origin
            one["end"] = chars[words.letter[last] + 1] - origin if len(words.first) else origin
        parts.append(one)
        base += part.num_rows
    if not parts:
        return {"text": np.zeros(0, np.int64), "size": np.zeros(0, np.int32), "scores": np.zeros((0, len(model.langs)), np.float32), "used": np.zeros(0, bool), "begin": np.zeros(0, np.int64), "end": np.zeros(0, np.int64)}
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _spans(text: np.ndarray, labels: np.ndarray, begin: np.ndarray, end: np.ndarray, langs: list[str], n: int) -> pa.Array:
    """Runs of words of one label in one text, as code-point spans."""
    if not len(text):
        return pa.array([[]] * n, pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (labels[1:] != labels[:-1])])
    close = np.append(new[1:], len(text)) - 1
    struct = pa.StructArray.from_arrays(
        [pa.array(np.array(langs, object)[labels[new]], pa.string()), pa.array(begin[new], pa.int64()), pa.array(end[close], pa.int64())],
        ["lang", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(text[new], minlength=n))].astype(np.int32)), struct)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that fit their languages and in which one has at least ``least`` of the letters; columns as they were."""
    lang, score = "__lang_pred", "__lang_score"
    found = identify(docs, model, lang_to=lang, score_to=score, spans_to=None)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).drop(lang, score)
