"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The model predicts an output -- one of the commonest words, the end of the text,
or a class of all other words -- from the two outputs before it. Each context
position has a matrix; their products with the context's vectors add up to a
predicted vector, whose products with the output vectors and the biases give the
scores. Inside a class, its more frequent words have vectors and biases of their
own, scored by the same predicted vector and normalised over the class; their
number follows the corpus, ``OWN`` times the root of its tokens. All rarer words of
a class follow their smoothed counts, with one place for a word that was never
seen. So every token has a normalised probability over all known words and the
unknown one, the product of its class's and its own inside the class.

Word counts are exact and cover all training rows. Words with at least 1 /
``HEAD`` of the tokens -- at most ``HEAD`` words, whatever the corpus -- are
broadcast and scored where the text is read; the counts of all rarer words are
joined by an ordinary shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import give_back, pieces_of
from daycast.session import materialize

HEAD = 1_000_000
#: Outputs: WORDS words, the end, CLASSES classes.
WORDS, CLASSES = 767, 256
WIDTH = 16
NOISE = 16
MINIBATCH = 4096
RATE = 0.1
#: Words with vectors of their own inside the classes: this times the root of the training tokens.
OWN = 2.0
INNER_NOISE = 2
#: Values of the parameters in one row when tasks' models are averaged.
BLOCK = 1 << 14
#: Tokens of one class scored at once.
INNER_STEP = 1024
#: Passes over disjoint parts of the training rows, with the tasks' models averaged after each.
ROUNDS = 2
HELD_WORDS = 200_000
LN10 = float(np.log(10))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: A-Z lower-cased, split at ASCII white space."""
    return text.lower().split()


def class_of(word: bytes) -> int:
    """Class of a word outside the commonest: by its last two bytes."""
    return zlib.crc32(word[-2:]) % CLASSES


def _class_column(word: Column) -> Column:
    return F.crc32(F.expr("substring(word, greatest(octet_length(word) - 1, 1), 2)")) % CLASSES


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``texts`` (text binary)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.update(words_of(text))
                if len(held) > HELD_WORDS:
                    yield hand_on(held)
                    held.clear()
        if held:
            yield hand_on(held)

    def hand_on(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(np.fromiter(held.values(), np.int64, len(held)))], ["word", "n"])

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Exact counts of the training rows; the words of ``head`` in order of falling count."""

    tokens: int
    types: int
    ends: int
    head: list[bytes]
    head_count: np.ndarray
    class_tokens: np.ndarray  # of the words outside the commonest
    class_types: np.ndarray

    @property
    def common(self) -> int:
        return min(WORDS, len(self.head))

    @property
    def own(self) -> int:
        return min(len(self.head) - self.common, int(np.ceil(OWN * self.tokens**0.5)))

    def output_counts(self) -> np.ndarray:
        """Expected tokens of each output, smoothed like the words inside a class."""
        words = np.zeros(WORDS)
        words[: self.common] = self.head_count[: self.common] + 0.5
        return np.concatenate([words + 1e-3, [self.ends + 0.5], self.class_mass()])

    def class_mass(self) -> np.ndarray:
        return self.class_tokens + 0.5 * (self.class_types + 1)

    def base_log10(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    total = counts.agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens")).first()
    tokens, types = (total["tokens"] or 0) + ends, total["types"] + (ends > 0)
    head = counts.where(F.col("n") * HEAD >= tokens).orderBy(F.desc("n"), "word").toArrow()
    words, n = head.column("word").to_pylist(), head.column("n").to_numpy()
    spark = counts.sparkSession
    common = spark.createDataFrame([(bytearray(w),) for w in words[:WORDS]], "word binary")
    rare = counts.join(F.broadcast(common), "word", "left_anti").groupBy(_class_column(F.col("word")).alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types"))
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, n_k, types_k in rare.collect():
        class_tokens[k], class_types[k] = n_k, types_k
    return Vocabulary(tokens, types, ends, words, n.astype(np.float64), class_tokens, class_types)


class _Ends(dict):
    """Code of a word's class by the word's last two bytes, of which there are at most 2^16 and some."""

    def __missing__(self, last: bytes) -> int:
        self[last] = code = -1 - class_of(last)
        return code


class _Codes(dict):
    """Word to its place in the head, or -1 - class."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.head, range(len(vocabulary.head))))
        self.ends = _Ends()

    def __missing__(self, word: bytes) -> int:
        return self.ends[word[-2:]]


END = WORDS


def outputs_of(codes: np.ndarray, head_class: np.ndarray) -> np.ndarray:
    """Output of each code; ``head_class`` has the output of each head word."""
    return np.where(codes >= 0, head_class[np.maximum(codes, 0)], END - codes)


def head_outputs(vocabulary: Vocabulary) -> np.ndarray:
    n = len(vocabulary.head)
    out = np.arange(max(n, 1))
    out[vocabulary.common : n] = [END + 1 + class_of(w) for w in vocabulary.head[vocabulary.common :]]
    return out


def contexts(outputs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs one and two places before; texts begin at ``first`` and follow an end."""
    one, two = np.empty_like(outputs), np.empty_like(outputs)
    one[1:], two[2:] = outputs[:-1], outputs[:-2]
    one[first] = two[first] = END
    second = first + 1
    two[second[second < len(outputs)]] = END
    return one, two


def read(texts: list[bytes], codes: _Codes, head_class: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """(codes, outputs, first token of each text, words) of texts; every text ends with the end, code of a large number."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), np.int64)
    for at, found in zip(first.tolist(), words):
        flat[at : at + len(found)] = list(map(codes.__getitem__, found))
        flat[at + len(found)] = 0
    outputs = outputs_of(flat, head_class)
    outputs[first + sizes - 1] = END
    return flat, outputs, first, words


class OwnWords:
    """The words with vectors inside the classes, class by class, and their shares of the class's such words."""

    def __init__(self, vocabulary: Vocabulary):
        first, n = vocabulary.common, vocabulary.own
        classes = np.array([class_of(w) for w in vocabulary.head[first : first + n]], np.int64)
        order = np.argsort(classes, kind="stable")
        self.size, self.classes = n, classes[order]
        self.starts = np.searchsorted(self.classes, np.arange(CLASSES + 1))
        weight = vocabulary.head_count[first + order] + 0.5
        self.cumulated = np.cumsum(weight)
        before = np.r_[0.0, self.cumulated]
        self.low, self.end = before[self.starts[self.classes]], self.starts[self.classes + 1]
        self.mass = before[self.end] - self.low
        self.log_share = np.log(weight / self.mass).astype(np.float32)
        self.place = np.full(len(vocabulary.head) + 1, -1)
        self.place[first + order] = np.arange(n)

    def places(self, codes: np.ndarray, outputs: np.ndarray) -> np.ndarray:
        """Each token's place among these words, -1 for any other."""
        return np.where((codes >= 0) & (outputs > END), self.place[np.maximum(codes, 0)], -1)

    def start(self) -> dict[str, np.ndarray]:
        return {"own": np.zeros((self.size, WIDTH), np.float32), "own_bias": self.log_share.copy()}

    def noise(self, rng: np.random.Generator, place: np.ndarray, n: int) -> np.ndarray:
        """For every token ``n`` words of its class by their counts."""
        at = self.low[place][:, None] + rng.random((len(place), n)) * self.mass[place][:, None]
        return np.minimum(np.searchsorted(self.cumulated, at, side="right"), self.end[place][:, None] - 1)

    def log_gain(self, values: dict[str, np.ndarray], predicted: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log probability of every token's word inside its class, less that of its share; one matrix product a class."""
        out = np.empty(len(place))
        of = self.classes[place].astype(np.int16)
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(CLASSES + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = self.starts[k], self.starts[k + 1]
            own, bias = values["own"][a:b].T, values["own_bias"][a:b]
            for at in range(cuts[k], cuts[k + 1], INNER_STEP):
                some = order[at : min(at + INNER_STEP, cuts[k + 1])]
                scores = predicted.take(some, axis=0) @ own
                scores += bias
                chosen, top = scores[np.arange(len(some)), place[some] - a], scores.max(axis=1)
                scores -= top[:, None]
                np.exp(scores, out=scores)
                out[some] = chosen - np.log(scores.sum(axis=1)) - top - self.log_share[place[some]]
        return out


# The model ----------------------------------------------------------------


def start_values(vocabulary: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    """Small random vectors, near-identity context matrices, and biases of the unigram model."""
    rng = np.random.default_rng(seed)
    n = WORDS + 1 + CLASSES
    counts = vocabulary.output_counts()
    return {
        "context": rng.normal(0, 0.3, (n, WIDTH)).astype(np.float32),
        "output": rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32),
        "place1": np.eye(WIDTH, dtype=np.float32),
        "place2": 0.5 * np.eye(WIDTH, dtype=np.float32),
        "bias": np.log(counts / counts.sum()).astype(np.float32),
    }


def _order(values: np.ndarray, end: int) -> np.ndarray:
    """Stable order of integers from 0 below ``end``; small ones are narrowed, which numpy sorts by digits."""
    return np.argsort(values.astype(np.uint16) if end <= 1 << 16 else values, kind="stable")


def _add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = _order(rows, len(total))
    sorted_rows = rows[order]
    first = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    total[sorted_rows[first]] += np.add.reduceat(values.take(order, axis=0), first)


def _share(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place of ``x``."""
    np.minimum(np.maximum(x, -30, out=x), 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


class Trainer:
    """Noise-contrastive estimation with Adagrad; the noise words of a minibatch are shared."""

    def __init__(self, values: dict[str, np.ndarray], noise: np.ndarray, seed: int, own: OwnWords | None = None, inner: dict[str, np.ndarray] | None = None):
        self.own = own if own is not None and own.size else None
        self.inner = {k: v.copy() for k, v in (inner or {}).items()}
        self.inner_squares = {k: np.full(v.shape, 0.1, np.float32) for k, v in self.inner.items()}
        self.values = {k: v.copy() for k, v in values.items()}
        self.squares = {k: np.full(v.shape, 0.1, np.float32) for k, v in values.items()}
        self.rng = np.random.default_rng(seed)
        self.cumulated = np.cumsum(noise)
        self.log_expected = np.log(NOISE * noise).astype(np.float32)

    def step(self, word: np.ndarray, one: np.ndarray, two: np.ndarray, place: np.ndarray | None = None) -> None:
        v = self.values
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), len(self.cumulated) - 1)
        c1, c2 = v["context"].take(one, axis=0), v["context"].take(two, axis=0)
        predicted = c1 @ v["place1"] + c2 @ v["place2"]
        hit = np.flatnonzero(place >= 0) if place is not None and self.own is not None else np.zeros(0, np.int64)
        q, q_noise = v["output"].take(word, axis=0), v["output"][noise]
        true = np.einsum("ij,ij->i", predicted, q) + v["bias"][word] - self.log_expected[word]
        false = predicted @ q_noise.T
        false += v["bias"][noise] - self.log_expected[noise]
        up = _share(true)
        down = _share(np.negative(false, out=false))
        np.negative(down, out=down)
        toward = up[:, None] * q
        toward += down @ q_noise
        if len(hit):
            toward[hit] += self.inside(predicted.take(hit, axis=0), place[hit])
        grad = {k: np.zeros_like(x) for k, x in v.items()}
        _add_rows(grad["output"], word, up[:, None] * predicted)
        np.add.at(grad["output"], noise, down.T @ predicted)
        grad["bias"] += np.bincount(word, up, len(grad["bias"])).astype(np.float32)
        np.add.at(grad["bias"], noise, down.sum(axis=0))
        grad["place1"] = c1.T @ toward
        grad["place2"] = c2.T @ toward
        _add_rows(grad["context"], one, toward @ v["place1"].T)
        _add_rows(grad["context"], two, toward @ v["place2"].T)
        for k, g in grad.items():
            g /= len(word) ** 0.5
            self.squares[k] += g * g
            v[k] += RATE * g / np.sqrt(self.squares[k])

    def inside(self, p: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The same estimation among the words of a class, for tokens with predicted vectors ``p`` and places ``w``.

        Only rows met are touched. Returns the gradient of the predicted vectors.
        """
        rows = np.column_stack([w, self.own.noise(self.rng, w, INNER_NOISE)])
        q = self.inner["own"].take(rows, axis=0)
        score = np.einsum("md,mkd->mk", p, q) + self.inner["own_bias"][rows] - self.own.log_share[rows] - np.float32(np.log(INNER_NOISE))
        toward = _share(np.negative(score, out=score))
        np.negative(toward, out=toward)
        toward[:, 0] += 1
        back = np.einsum("mk,mkd->md", toward, q)
        flat = rows.ravel()
        order = _order(flat, self.own.size)
        first = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
        met = flat[order][first]
        grad = {"own": (toward[:, :, None] * p[:, None, :]).reshape(-1, p.shape[1]), "own_bias": toward.ravel()}
        for k, g in grad.items():
            g = np.add.reduceat(g.take(order, axis=0), first)
            self.inner_squares[k][met] += g * g
            self.inner[k][met] += RATE * g / np.sqrt(self.inner_squares[k][met])
        return back


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Train on all rows of ``texts`` (part, text), each row in one round.

    In a round every task runs over its own rows from the same start; Spark
    averages the parameters, in blocks and weighted by tokens, and their mean
    starts the next round. The driver holds one set of parameters: those of the
    outputs, of fixed size, and those of at most ``HEAD`` words of their own.
    """
    values = start_values(vocabulary) | OwnWords(vocabulary).start()
    noise = vocabulary.output_counts()
    noise = noise / noise.sum()
    names = list(values)
    sizes = [values[k].size for k in names]
    sc = texts.sparkSession.sparkContext
    for turn in range(rounds):
        sent = sc.broadcast((vocabulary, values, noise))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, values, noise = sent.value
            codes, head_class, own = _Codes(vocabulary), head_outputs(vocabulary), OwnWords(vocabulary)
            inner = {k: values[k] for k in ("own", "own_bias")}
            trainer, seen = Trainer({k: v for k, v in values.items() if k not in inner}, noise, turn, own, inner), 0
            for batch in batches:
                for part in pieces_of(batch, 512):
                    flat, outputs, first, _ = read(part.column("text").to_pylist(), codes, head_class)
                    one, two = contexts(outputs, first)
                    place = own.places(flat, outputs)
                    order = trainer.rng.permutation(len(outputs))
                    for at in range(0, len(order), MINIBATCH):
                        pick = order[at : at + MINIBATCH]
                        trainer.step(outputs[pick], one[pick], two[pick], place[pick])
                    seen += len(outputs)
            if seen:
                learned = trainer.values | trainer.inner
                flat = np.concatenate([learned[k].ravel() for k in names])
                ends = np.r_[np.arange(0, len(flat), BLOCK), len(flat)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(ends) - 1)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), pa.array(np.full(len(ends) - 1, float(seen)))],
                    ["block", "data", "weight"])
            give_back()

        rows = texts.where(F.col("part") == turn).select("text").mapInArrow(run, "block long, data array<float>, weight double")
        mean = Summarizer.mean(array_to_vector(F.col("data").cast("array<double>")), F.col("weight"))
        blocks = rows.groupBy("block").agg(vector_to_array(mean, "float32").alias("mean")).orderBy("block").toArrow().column("mean").combine_chunks()
        if len(blocks):
            flat = (blocks if isinstance(blocks, pa.Array) else pa.concat_arrays(blocks.chunks)).flatten().to_numpy()
            values = {k: x.reshape(values[k].shape) for k, x in zip(names, np.split(flat, np.cumsum(sizes)[:-1]))}
        sent.unpersist()
    return values


@dataclass
class Scorer:
    """Score tables: log probability of an output = one[c1, w] + two[c2, w] + bias[w] - norm[c1, c2].

    ``lead1`` and ``lead2`` are the contexts' parts of the predicted vector, which
    scores the words with vectors of their own (``inner``).
    """

    one: np.ndarray
    two: np.ndarray
    bias: np.ndarray
    norm: np.ndarray
    lead1: np.ndarray
    lead2: np.ndarray
    inner: dict[str, np.ndarray] | None = None

    def log10_inside(self, own: OwnWords, place: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """What a token's own vector adds to the log10 of its share of its class; 0 for a token without a ``place``."""
        out = np.zeros(len(place))
        hit = np.flatnonzero(place >= 0)
        if len(hit) and self.inner is not None:
            out[hit] = own.log_gain(self.inner, self.lead1.take(c1[hit], axis=0) + self.lead2.take(c2[hit], axis=0), place[hit]) / LN10
        return out

    def log10(self, word: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        return (self.one[c1, word] + self.two[c2, word] + self.bias[word] - self.norm[c1, c2]).astype(np.float64) / LN10


def normalisers(one: np.ndarray, two: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log partition functions of the contexts (rows, all): exp-sums over the outputs as one matrix product.

    exp(a + b) factors into exp(a) exp(b); each factor is scaled by its largest
    exponent, so a sum is at most the number of outputs.
    """
    left, right = one[rows].astype(np.float64) + bias, two.astype(np.float64)
    top_left, top_right = left.max(axis=1), right.max(axis=1)
    sums = np.exp(left - top_left[:, None]) @ np.exp(right - top_right[:, None]).T
    return np.log(np.maximum(sums, 1e-300)) + top_left[:, None] + top_right


def scorer(values: dict[str, np.ndarray]) -> Scorer:
    """Tables of fixed size, by matrix products over all pairs of context outputs, and the words' own vectors."""
    lead1, lead2 = values["context"] @ values["place1"], values["context"] @ values["place2"]
    one, two = lead1 @ values["output"].T, lead2 @ values["output"].T
    norm = np.concatenate([normalisers(one, two, values["bias"], rows) for rows in np.array_split(np.arange(len(one)), 8)])
    inner = {k: values[k] for k in ("own", "own_bias")} if "own" in values else None
    return Scorer(one, two, values["bias"], norm.astype(np.float32), lead1, lead2, inner)


def rare_words(rare: np.ndarray, first: np.ndarray, words: list[list[bytes]]) -> pa.ListArray:
    """Of each text the distinct words at ``rare`` tokens, with their numbers."""
    at = np.flatnonzero(rare)
    cuts = np.searchsorted(at, np.append(first, len(rare))).tolist()
    within = (at - np.repeat(first, np.diff(cuts))).tolist()
    names, numbers, ends = [], [], [0]
    for a, b, found in zip(cuts[:-1], cuts[1:], words):
        counts = Counter([found[i] for i in within[a:b]])
        names += counts
        numbers += counts.values()
        ends.append(len(names))
    entries = pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


PARTIAL = "row long, n_tokens long, known long, base double, score double, rare array<struct<word: binary, n: long>>"


def score_texts(docs: DataFrame, counts: DataFrame, vocabulary: Vocabulary, tables: Scorer, text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, and n_tokens, n_known, base_score, score of each row."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, tables))
    kept = [c for c in docs.columns if c != text_col]
    keys = {c: f"k{i}" for i, c in enumerate(kept)}
    renamed = docs.select(*(F.col(c).alias(k) for c, k in keys.items()), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = ", ".join([*(f"{k} {renamed.schema[k].dataType.simpleString()}" for k in keys.values()), PARTIAL])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, tables = sent.value
        codes, head_class, own = _Codes(vocabulary), head_outputs(vocabulary), OwnWords(vocabulary)
        base = np.append(vocabulary.base_log10(vocabulary.head_count), 0.0)
        absent = float(vocabulary.base_log10(np.float64(0))) - np.log10(0.5)  # less the log of c + 0.5
        base_end = float(vocabulary.base_log10(np.float64(vocabulary.ends)))
        mass = np.log10(vocabulary.class_mass())
        within = np.append(np.log10(vocabulary.head_count + 0.5), 0.0)
        in_class = head_class > END
        within[: len(in_class)][in_class] -= mass[head_class[in_class] - END - 1]
        within[: vocabulary.common] = 0
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in pieces_of(batch, 512):
                flat, outputs, first, words = read(part.column("text").to_pylist(), codes, head_class)
                one, two = contexts(outputs, first)
                end = outputs == END
                rare = flat < 0
                place = np.maximum(flat, 0)
                token = tables.log10(outputs, one, two) + np.where(rare, -mass[np.where(rare, -1 - flat, 0)], np.where(end, 0, within[place]))
                token += tables.log10_inside(own, own.places(flat, outputs), one, two)
                plain = np.where(rare, absent, np.where(end, base_end, base[place]))
                known = np.where(end, vocabulary.ends > 0, ~rare)
                sums = [np.add.reduceat(x, first) for x in (token, plain, known.astype(np.int64))]
                sizes = np.diff(np.append(first, len(flat)))
                lists = rare_words(rare, first, words)
                rows = np.arange(row, row + part.num_rows)
                row += part.num_rows
                new = [pa.array(rows), pa.array(sizes), pa.array(sums[2]), pa.array(sums[1]), pa.array(sums[0]), lists]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys.values()), *new], [*keys.values(), "row", "n_tokens", "known", "base", "score", "rare"])
        give_back()

    done = materialize(renamed.mapInArrow(run, schema), "lm-partial")
    rare = done.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.n")
    seen = counts.select(F.col("word").alias("of"), F.col("n").alias("c")).where(F.col("c") * HEAD < vocabulary.tokens)
    joined = rare.join(seen, rare["word"] == seen["of"], "left")
    c = F.coalesce("c", F.lit(0))
    rest = joined.groupBy(F.col("row").alias("at")).agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("logs"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"))
    out = done.drop("rare").join(rest, F.col("row") == F.col("at"), "left")
    logs = F.coalesce("logs", F.lit(0.0))
    base = F.col("base") + logs
    return out.select(
        *(F.col(k).alias(c) for c, k in keys.items()),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("score") + logs if vocabulary.tokens else base).alias("score"),
    )


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Score every row, learning from the rows that are not ``held_out``.

    Returns one row per input row: ``id_col``, held_out, n_tokens (words and
    the end), n_known (tokens seen in training), train_tokens, base_score (the
    smoothed unigram model) and score (this model), both log10 of the text's
    probability. Null texts count as empty and have the end alone. Repeated rows
    are scored, and learned from, each on its own. Without training rows the
    score is the base score. Extra columns are ignored; an empty table gives no
    row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    part = F.pmod(F.xxhash64(text), F.lit(rounds))
    learning = docs.where(~held_out).select(text.alias("text"), part.alias("part"))
    counts = materialize(word_counts(learning), "lm-counts")
    known = vocabulary(counts, learning.count())
    tables = scorer(train(learning, known, rounds) if known.tokens else start_values(known))
    rows = docs.select(F.col(id_col).alias(id_col), held_out.alias("held_out"), F.col(text_col).alias("__lm_text"))
    return score_texts(rows, counts, known, tables, "__lm_text")
