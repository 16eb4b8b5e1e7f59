"""Token ids in Arrow files of equal-length sequences with masks.

Documents are encoded in ascending id order, each followed by an end id, and the
token stream is cut into sequences of one length. A file is an uncompressed
Arrow IPC file of two fixed-size-list columns, ``ids`` (the narrowest unsigned
type that holds the vocabulary) and ``mask`` (true for a token, false for the
padding of a file's last sequence), so that sequence k of a memory-mapped file is
a view of the file's bytes. Beside ``x.arrow`` lies ``x.docs.arrow``: doc_id,
start (tokens of the file before it) and n_tokens of every document in it.

Spark deals out the documents by ranges of the id and each task streams its own
range into files. Files carry names of their own for each task attempt; only
files that a finished task reported are in the manifest.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daycast.llm.common import in_order
from daycast.session import materialize, scratch_path

TOKENIZER = "byte_bpe_50k.json"
#: Token that ends every document.
END_ID = 0
LENGTH = 1024
#: Sequences of one record batch.
BATCH_SEQUENCES = 256
#: A file is closed at the first document's end after so many tokens.
FILE_TOKENS = 64 << 20
#: Texts encoded together.
STEP = 256
#: Cached pieces of one worker, as many as a dictionary of 2^21 places takes; beyond that the half met first stays.
CACHE = 1_390_000
#: Longer pieces are not cached.
LONG_PIECE = 48
#: In place of the ids of a piece that can't be encoded alone.
WHOLE = "whole"
#: Cached punctuations and line ends.
TAILS = 10_000
#: Pieces encoded in one call of the library.
JOINED = 200
#: A word of letters (of the Latin blocks, the same in all versions of Unicode) and punctuation after it, then perhaps
#: line ends and the next line's first word with its punctuation.
WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)(?:(\n+)([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*))?")
FILES = "block int, file int, path string, tokens long, documents long, sequences long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class Encoder:
    """Ids of whole texts by the tokenizers library, with a bounded cache of the pieces between spaces.

    The byte-level pattern never joins what stands before a single space to the
    space and what follows, so a piece can be encoded with the space before it
    alone; a text for which that does not hold (empty pieces, pieces with white
    space at an edge) is encoded whole. A word with punctuation after it is one
    call of the library's model for the word, shared by all its punctuations; so are
    two words with a line's end between them. Where the library's pattern cuts
    before, between and after line ends is asked of it once for each punctuation.
    Other unknown pieces are encoded many at a time, a carriage return between
    them, which is a token of its own there. Special tokens' strings in a text
    are ordinary text.
    """

    def __init__(self, path: str | None = None):
        self.coder = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.coder.encode_special_tokens = True
        self.model = self.coder.model
        size = self.coder.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.between = self._ids("\r")
        self.cache: dict[str, bytes | str] = {}
        self.tails: dict[tuple[str, str], bytes | None] = {("", ""): b""}
        # The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(shown)))}

    def _ids(self, text: str) -> list[int]:
        return self.coder.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def whole(self, text: str) -> bytes:
        return array(self.kind, self._ids(text)).tobytes()

    def _word(self, word: str, before: str = "\u0120") -> bytes:
        """Ids of a word of letters with the space before it, or with nothing before it."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return array(self.kind, [x.id for x in self.model.tokenize(before + word)]).tobytes()

    def _between(self, tail: str, ends: str) -> bytes | None:
        """Ids of punctuation and line ends that follow a word, the line ends before another word; None if a word's ids depend on them."""
        key = tail, ends
        if key in self.tails:
            return self.tails[key]
        if not ends:
            ids = self.whole(tail)
        else:
            text = f" a{tail}{ends}a"
            first, last, made, size = self.whole(" a"), self.whole("a"), self.whole(text), self.dtype.itemsize
            apart = [at for _, at in self.coder.pre_tokenizer.pre_tokenize_str(text)]
            alone = len(first) == len(last) == size and apart[0] == (0, 2) and apart[-1] == (len(text) - 1, len(text))
            ids = made[size:-size] if alone else None
        if len(self.tails) < TAILS and len(tail) + len(ends) <= LONG_PIECE:
            self.tails[key] = ids
        return ids

    def _known(self, word: str, before: str) -> bytes:
        """A word's ids, kept in the cache; without the space before it under a name that no piece has."""
        name = word if before else " " + word
        ids = self.cache.get(name)
        if ids is None:
            ids = self._word(word, before)
            if len(word) <= LONG_PIECE:
                self.cache[name] = ids
        return ids

    def _learn(self, pieces: list[str]) -> None:
        cache, alone = self.cache, []
        for p in pieces:
            m = WORD.fullmatch(p)
            if m and (m[3] is None or self._between(m[2], m[3]) is not None):
                word, tail, ends, following, last = m.groups()
                ids = self._known(word, "\u0120")
                if ends:
                    ids += self._between(tail, ends) + self._known(following, "") + self._between(last, "")
                elif tail:
                    ids += self._between(tail, "")
                cache[p] = ids
            elif not p or p[0].isspace() or p[-1].isspace():
                cache[p] = WHOLE
            elif "\r" in p or len(self.between) != 1:
                cache[p] = self.whole(" " + p)
            else:
                alone.append(p)
        width = self.dtype.itemsize
        for at in range(0, len(alone), JOINED):
            some = alone[at : at + JOINED]
            ids = np.array(self._ids("\r".join([" " + p for p in some])), self.dtype)
            cuts = np.flatnonzero(ids == self.between[0])
            if len(cuts) != len(some) - 1:
                raise ValueError("the vocabulary joins a carriage return to its neighbours")
            begins, ends = (width * np.r_[0, cuts + 1]).tolist(), (width * np.r_[cuts, len(ids)]).tolist()
            raw = ids.tobytes()
            cache.update(zip(some, [raw[a:b] for a, b in zip(begins, ends)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes of ``dtype``."""
        if len(self.cache) >= CACHE:
            # What was met first is what is met often.
            self.cache = dict(islice(self.cache.items(), CACHE // 2))
        # Nearly all pieces are known: they are looked up once, and only the gaps are learned and filled.
        get, found, gaps = self.cache.get, [], []
        for text in texts:
            parts = text.split(" ")
            ids = list(map(get, parts))
            ids[0] = b""
            found.append((parts[0], ids))
            gaps.append([(i, parts[i]) for i, x in enumerate(ids) if x is None])
        new = {p for of in gaps for _, p in of}
        self._learn(list(new))
        out, known = [], self.cache
        for text, (first, ids), of in zip(texts, found, gaps):
            if len(ids) == 1 or not first or first[-1].isspace():
                out.append(self.whole(text) if text else b"")
                continue
            for i, p in of:
                ids[i] = known[p]
            try:
                tail = b"".join(ids)
            except TypeError:  # a piece that can't be encoded alone
                out.append(self.whole(text))
                continue
            out.append(self.whole(first) + tail)
        for p in new:
            if len(p) > LONG_PIECE:
                self.cache.pop(p, None)
        return out


@lru_cache(maxsize=2)
def encoder_of(path: str | None) -> Encoder:
    """One encoder a worker process and vocabulary: what it has learned serves the worker's later tasks."""
    return Encoder(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Writer:
    """One file of sequences and its document table, written batch by batch."""

    def __init__(self, folder: str, dtype: np.dtype, length: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.arrow"
        self.store, at = _store(self.path)
        self.store.create_dir(at.rpartition("/")[0])
        self.length, self.dtype = length, dtype
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.docs_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = self.store.open_output_stream(at, compression=None)
        self.docs_out = self.store.open_output_stream(at.removesuffix(".arrow") + ".docs.arrow", compression=None)
        self.file, self.docs_file = pa.ipc.new_file(self.out, self.schema), pa.ipc.new_file(self.docs_out, self.docs_schema)
        self.held, self.held_tokens, self.rows = [], 0, []
        self.tokens = self.documents = self.sequences = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.rows.append((doc_id, self.tokens, n))
        self.held.append(ids)
        self.tokens, self.held_tokens, self.documents = self.tokens + n, self.held_tokens + n, self.documents + 1
        if self.held_tokens >= self.length * BATCH_SEQUENCES:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        full = len(flat) // self.length * self.length
        for at in range(0, full, self.length * BATCH_SEQUENCES):
            self._batch(flat[at : min(full, at + self.length * BATCH_SEQUENCES)], None)
        rest = flat[full:]
        if last and len(rest):
            self._batch(np.r_[rest, np.zeros(self.length - len(rest), self.dtype)], len(rest))
            rest = rest[:0]
        self.held, self.held_tokens = [rest.tobytes()], len(rest)
        if self.rows:
            self.docs_file.write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*self.rows)], schema=self.docs_schema))
            self.rows = []

    def _batch(self, flat: np.ndarray, tokens: int | None) -> None:
        real = np.arange(len(flat)) < (len(flat) if tokens is None else tokens)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (flat, real)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.sequences += len(flat) // self.length

    def close(self) -> tuple[str, int, int, int]:
        self._flush(last=True)
        for x in (self.file, self.docs_file, self.out, self.docs_out):
            x.close()
        return self.path, self.tokens, self.documents, self.sequences


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write all documents' ids to token files; returns the manifest.

    Manifest: number (files in document order), path, base (tokens of all files
    before it), tokens, documents, sequences. A null or empty text has the end id
    alone. Rows without an id come first; rows that share an id follow each
    other, ordered by a hash of the text and the text, and a frequent id's rows
    go to several tasks. Extra columns are ignored. An empty table writes no
    file and has an empty manifest. A task holds one batch of texts and of ids.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        out, block, number = None, None, 0

        def closed():
            return pa.RecordBatch.from_pylist([dict(zip(("block", "file", "path", "tokens", "documents", "sequences"), (block, number, *out.close())))], schema)

        schema = pa.schema([("block", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("tokens", pa.int64()), ("documents", pa.int64()), ("sequences", pa.int64())])
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                some = batch.slice(at, STEP)
                texts = encoder.encode(some.column("text").to_pylist())
                for doc_id, of, ids in zip(some.column("doc_id").to_pylist(), some.column("block").to_pylist(), texts):
                    if out is not None and (of != block or out.tokens >= file_tokens):
                        yield closed()
                        out, number = None, number + 1 if of == block else 0
                    if out is None:
                        out, block = _Writer(folder, encoder.dtype, length), of
                    out.add(doc_id, ids + end)
        if out is not None:
            yield closed()
        pa.default_memory_pool().release_unused()

    files = materialize(in_order(rows, "doc_id", "text").mapInArrow(run, FILES), "token-files")
    order = Window.orderBy("block", "file")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return materialize(files.select((F.row_number().over(order) - 1).alias("number"), "path", before.alias("base"), "tokens", "documents", "sequences"), "token-manifest")


class TokenFile:
    """Random access to one token file; a local file is memory-mapped and sequences are views of it."""

    def __init__(self, path: str):
        store, at = _store(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(at) if local else store.open_input_file(at)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        docs = at.removesuffix(".arrow") + ".docs.arrow"
        self.docs_source = pa.memory_map(docs) if local else store.open_input_file(docs)
        self.docs = pa.ipc.open_file(self.docs_source)
        # Every batch but the last few has the same number of sequences; bounds serve them all.
        self.ends = np.cumsum([self.file.get_batch(i).num_rows for i in range(self.file.num_record_batches)])

    def __enter__(self) -> "TokenFile":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.source.close()
        self.docs_source.close()

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence ``k`` without copying."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        b = int(np.searchsorted(self.ends, k, side="right"))
        batch = self.file.get_batch(b)
        row = k - (int(self.ends[b - 1]) if b else 0)
        ids, mask = (batch.column(i).flatten().slice(row * self.length, self.length) for i in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def stream(self) -> Iterator[np.ndarray]:
        """The file's tokens in order, a batch at a time, padding left out."""
        for i in range(self.file.num_record_batches):
            batch = self.file.get_batch(i)
            ids, mask = batch.column(0).flatten(), batch.column(1).flatten()
            n = mask.true_count
            yield ids.to_numpy(zero_copy_only=True) if n == len(ids) else ids.to_numpy(zero_copy_only=True)[mask.to_numpy(zero_copy_only=False)]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, start, n_tokens) in file order."""
        for i in range(self.docs.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.docs.get_batch(i).columns))


def document_crcs(path: str) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc_id, start, n_tokens, crc32 of the ids as little-endian unsigned 32-bit) of a file's documents.

    The token stream is read once, front to back; a document may span batches.
    """
    with TokenFile(path) as file:
        batches, now, used = file.stream(), np.zeros(0, "<u4"), 0
        for doc_id, start, n in file.documents():
            crc, left = 0, n
            while left:
                if used == len(now):
                    more = next(batches, None)
                    if more is None:
                        raise ValueError(f"{path} ends inside a document")
                    now, used = more.astype("<u4"), 0
                take = min(left, len(now) - used)
                crc = zlib.crc32(now[used : used + take], crc)
                used, left = used + take, left - take
            yield doc_id, start, n, crc
        if used != len(now) or next(batches, None) is not None:
            raise ValueError(f"{path} has tokens of no document")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x.split()[0], pa.int64()) for x in READ.split(", ")])
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                rows = []
                for doc_id, start, n, crc in document_crcs(path):
                    rows.append((doc_id, base + start, n, crc))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)
        pa.default_memory_pool().release_unused()

    return manifest.select("path", "base").repartition(max(1, manifest.count())).mapInArrow(run, READ)


def token_round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read every document back."""
    folder = scratch_path(docs.sparkSession, f"tokens-{uuid.uuid4().hex}")
    return read_documents(write_tokens(docs, folder, **options))
