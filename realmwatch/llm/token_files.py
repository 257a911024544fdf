"""Token ids of documents as binary files: each document compressed by itself with one shared dictionary.

Documents are dealt by ranges of their id, so files hold them in ascending order.  A task encodes its
documents, compresses the id array of each by itself with a zstandard dictionary that all files share,
and writes them one after the other, so a short document costs few bytes and is read without
its neighbours.  The dictionary is trained on id arrays of a sample: about `sample_rows` different texts
of at most `sample_chars` characters, drawn from all rows by their hash.  It decides the size of the files only.

A file is named at random and counts once the table of files (`files`, written by Spark when
all tasks are done) lists it; what a lost or repeated task left is never read.  Layout of a file, all
numbers little-endian:

    header   magic `RWTOKEN1`, bytes of an id (2 or 4), 32 bytes of the dictionary's SHA-256
    frames   one zstandard frame for every document
    index    for every document: its id, 1 if it has one, place of its frame, size of it, number of ids
    footer   place of the index, number of documents, number of ids, magic

`dictionary-<sha256>.zdict` lies beside the files; without anything to train on it is empty and frames
are compressed without one.  A reader checks the hash before it reads a frame.

Files are written and read through the file systems that pyarrow knows (local and shared mounts, HDFS, S3,
GCS, Azure), below `folder`, by default one in `spark.checkpoint.dir`.

Null and empty texts are documents of the end id alone.  Rows without id come first.  Rows of one id stand
by the hash of their text, equal rows in any order, since they cannot be told apart; ranges are cut inside
such a group too, so an id of many rows spans several files.  A very long text is one frame.  An
empty table gives no file and no row.  Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.texts import shared_folder, ship

# Fixed values of the format.
MAGIC = b"RWTOKEN1"
_HEADER, _ENTRY, _FOOTER = struct.Struct("<8sB32s"), struct.Struct("<qBQIQ"), struct.Struct("<QQQ8s")

_WRITTEN = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("number", T.IntegerType()), T.StructField("file", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("documents", "tokens", "size", "first_id", "last_id")]
)
_FILES = T.StructType([*_WRITTEN.fields, T.StructField("start", T.LongType())])


class Settings(NamedTuple):
    """What writing tasks need; the vocabulary and the dictionary have a fixed size."""

    folder: str
    vocabulary: str
    dictionary: bytes
    end_id: int
    level: int
    file_bytes: int


def _open(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        arrow_fs.LocalFileSystem(), folder
    )


# The pattern by which a byte-level tokenizer cuts a text before it merges bytes, and the
# same for ASCII.
_PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASCII_PIECE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"""
# Characters that have been letters, digits or neither in all editions of Unicode that a regular-expression
# library may know; white space on whose extent libraries differ is left out.
_SETTLED = re.compile("[\\x00-\\x1b\\x20-\\x84\\x86-\\u052f\\u2010-\\u2027\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5]*")
_KNOWN_PIECES = 1 << 19
_PIECES_AT_ONCE = 1 << 18


def _byte_letters() -> dict[int, str]:
    """The character by which a byte-level vocabulary names each byte: printable ones name themselves, the
    others are numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Pieces(dict):
    """Ids, as bytes, of the pieces met lately; the library encodes those that are missing."""

    def __init__(self, model, width: np.dtype) -> None:
        super().__init__()
        self._model, self._width, self._letters = model, width, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        named = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._letters)
        made = np.array([t.id for t in self._model.tokenize(named)], self._width).tobytes()
        if len(self) >= _KNOWN_PIECES:
            self.clear()
        self[piece] = made
        return made


class Encoder:
    """A tokenizer of the library, asked once for each different piece.

    A byte-level tokenizer merges bytes within pieces of a text only, and words come again and again; so
    a text is cut here by the same pattern and the library's model encodes the pieces not met lately.  Texts
    that hold a special token, or characters that libraries may class differently, and all texts of a
    tokenizer of another kind are encoded by the library as a whole.
    """

    def __init__(self, vocabulary: str, end_id: int) -> None:
        self.tokenizer = load_tokenizer(vocabulary)
        self.width = id_width(self.tokenizer, end_id)
        self._end = np.array([end_id], self.width).tobytes()
        declared = json.loads(vocabulary)
        self.specials = [t["content"] for t in declared.get("added_tokens") or []]
        before = declared.get("pre_tokenizer") or {}
        self.by_pieces = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and declared.get("normalizer") is None
            and declared["model"].get("type") == "BPE"
            and not declared["model"].get("dropout")
        )
        self._ascii, self._any = re.compile(_ASCII_PIECE), regex.compile(_PIECE)
        self._known = _Pieces(self.tokenizer.model, self.width)

    def _cut(self, text: str, pattern) -> Iterator[list[str]]:
        if len(text) <= _PIECES_AT_ONCE:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while part := [m[0] for m in itertools.islice(found, _PIECES_AT_ONCE)]:
            yield part

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the text and the end id."""
        text = text or ""
        if self.by_pieces and _SETTLED.fullmatch(text) and not any(s in text for s in self.specials):
            cut = self._cut(text, self._ascii if text.isascii() else self._any)
            data = b"".join(itertools.chain.from_iterable(map(self._known.__getitem__, part) for part in cut))
        else:
            data = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        return np.frombuffer(data + self._end, self.width)


def load_tokenizer(vocabulary: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary)


def id_width(tokenizer, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of at most `size` bytes; empty if the samples are too few to train one."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) > 7 else b""
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    return zstandard.ZstdCompressor(level=level, write_content_size=True, **options)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


class TokenFileWriter:
    """One file: frames as they come, then the index and the footer."""

    def __init__(self, filesystem: arrow_fs.FileSystem, path: str, dictionary: bytes, width: np.dtype, level: int) -> None:
        self._compressor = _compressor(dictionary, level)
        self._out = filesystem.open_output_stream(path)
        self._index: list[bytes] = []
        self.tokens = 0
        self.first_id: int | None = None
        self.last_id: int | None = None
        self.size = self._put(_HEADER.pack(MAGIC, width.itemsize, hashlib.sha256(dictionary).digest()))

    def _put(self, data: bytes) -> int:
        self._out.write(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frame = self._compressor.compress(ids.tobytes())
        self._index.append(_ENTRY.pack(doc_id or 0, doc_id is not None, self.size, len(frame), len(ids)))
        self.size += self._put(frame)
        self.tokens += len(ids)
        self.first_id = doc_id if self.first_id is None else self.first_id
        self.last_id = doc_id if doc_id is not None else self.last_id

    @property
    def documents(self) -> int:
        return len(self._index)

    def close(self) -> None:
        self._put(b"".join(self._index))
        footer = _FOOTER.pack(self.size, self.documents, self.tokens, MAGIC)
        self.size += self.documents * _ENTRY.size + self._put(footer)
        self._out.close()


class Entry(NamedTuple):
    doc_id: int | None
    place: int
    size: int
    n_tokens: int


class TokenFile:
    """A written file: its index, and the ids of any document by one read."""

    def __init__(self, filesystem: arrow_fs.FileSystem, path: str, dictionary: bytes) -> None:
        self._in = filesystem.open_input_file(path)
        self._size = self._in.size()
        magic, width, digest = _HEADER.unpack(self._at(0, _HEADER.size))
        self._index, self.documents, self.tokens, tail = _FOOTER.unpack(self._at(self._size - _FOOTER.size, _FOOTER.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"{path} is no whole token file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self._width = np.dtype(f"<u{width}")
        self._decompressor = _decompressor(dictionary)

    def _at(self, place: int, size: int) -> bytes:
        self._in.seek(place)
        return self._in.read(size)

    def entries(self, step: int = 4096) -> Iterator[Entry]:
        for first in range(0, self.documents, step):
            count = min(step, self.documents - first)
            data = self._at(self._index + first * _ENTRY.size, count * _ENTRY.size)
            for doc_id, known, place, size, n_tokens in _ENTRY.iter_unpack(data):
                yield Entry(doc_id if known else None, place, size, n_tokens)

    def entry(self, number: int) -> Entry:
        """The index entry of the file's `number`-th document."""
        if not 0 <= number < self.documents:
            raise IndexError(number)
        doc_id, known, place, size, n_tokens = _ENTRY.unpack(self._at(self._index + number * _ENTRY.size, _ENTRY.size))
        return Entry(doc_id if known else None, place, size, n_tokens)

    def find(self, doc_id: int) -> list[int]:
        """Numbers of the documents with this id, by bisection: ids ascend, those without one come first."""

        def first_from(key: tuple[bool, int]) -> int:
            low, high = 0, self.documents
            while low < high:
                middle = (low + high) // 2
                own = self.entry(middle).doc_id
                if (own is not None, own or 0) < key:
                    low = middle + 1
                else:
                    high = middle
            return low

        return list(range(first_from((True, doc_id)), first_from((True, doc_id + 1))))

    def ids(self, entry: Entry) -> np.ndarray:
        return np.frombuffer(self._decompressor.decompress(self._at(entry.place, entry.size)), self._width)

    def close(self) -> None:
        self._in.close()


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(vocabulary: str, end_id: int) -> Encoder:
    """The task's encoder, kept by its process."""
    name = hashlib.sha256(vocabulary.encode()).hexdigest(), end_id
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary, end_id)
    return _ENCODERS[name]


def _write_part(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """The files of one range of ids, and a row for each; a file is closed once it has `file_bytes`."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_WRITTEN)
    settings: Settings = sent.value
    part, number, writer, name = TaskContext.get().partitionId(), 0, None, ""
    filesystem, root = _open(settings.folder)
    encoder = _encoder(settings.vocabulary, settings.end_id)

    def done() -> pa.RecordBatch:
        writer.close()
        row = (part, number, name, writer.documents, writer.tokens, writer.size, writer.first_id, writer.last_id)
        return _batch([row], arrow)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encoder.encode(text.as_py())
            if writer is None:
                name = f"tokens-{part:06d}-{number:04d}-{uuid.uuid4().hex}.bin"
                writer = TokenFileWriter(filesystem, f"{root}/{name}", settings.dictionary, encoder.width, settings.level)
            writer.add(doc_id, ids)
            if writer.size >= settings.file_bytes:
                yield done()
                writer, number = None, number + 1
    if writer is not None:
        yield done()


class TokenFiles:
    """A written folder: the dictionary and the table of files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def files(self) -> DataFrame:
        """The files in the order of their documents, with the number of ids before each."""
        return self.spark.read.schema(_FILES).parquet(f"{self.folder}/files")

    def dictionary(self) -> bytes:
        filesystem, root = _open(self.folder)
        (found,) = [
            f for f in filesystem.get_file_info(arrow_fs.FileSelector(root)) if f.path.endswith(".zdict")
        ]
        with filesystem.open_input_file(found.path) as source:
            data = source.read()
        if hashlib.sha256(data).hexdigest() not in found.path:
            raise ValueError(f"{found.path} does not hold what its name says")
        return data

    def _read(self, rows, schema: T.StructType, files: DataFrame) -> DataFrame:
        """`rows(file, start)` of every listed file, each file read by one task of its own."""
        ship(self.spark)
        sent = self.spark.sparkContext.broadcast((self.folder, self.dictionary()))
        count = max(1, files.count())
        dealt = files.select("file", "start", "number", "part").repartitionByRange(min(count, 10_000), "part", "number")
        return dealt.mapInArrow(partial(_read_part, sent=sent, rows=rows, schema=schema), schema)

    def documents(self) -> DataFrame:
        """A row for every document: doc_id, `start` (ids of all documents before it), n_tokens, and the
        CRC-32 of its ids as unsigned 32-bit numbers."""
        return self._read(_digests, _DIGESTS, self.files())

    def token_ids(self, doc_ids: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
        """doc_id, start and ids of every document."""
        found = self._read(_id_rows, _IDS, self.files())
        if doc_ids is None:
            return found
        wanted = doc_ids.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
        return found.join(wanted, "doc_id", "left_semi")

    def document(self, doc_id: int) -> list[np.ndarray]:
        """Ids of the documents with this id, without reading any other: files are found by the ids they
        begin with, documents by bisection in the index."""
        filesystem, root = _open(self.folder)
        dictionary, found = self.dictionary(), []
        near = self.files().where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        for row in near.orderBy("part", "number").toLocalIterator():
            opened = TokenFile(filesystem, f"{root}/{row.file}", dictionary)
            found += [opened.ids(opened.entry(k)) for k in opened.find(doc_id)]
            opened.close()
        return found


def _read_part(batches: Iterator[pa.RecordBatch], sent, rows, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    folder, dictionary = sent.value
    filesystem, root = _open(folder)
    arrow = to_arrow_schema(schema)
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            opened = TokenFile(filesystem, f"{root}/{name}", dictionary)
            made: list[tuple] = []
            held = 0
            for entry in opened.entries():
                made.append(rows(entry, start, opened.ids(entry)))
                held += entry.n_tokens
                start += entry.n_tokens
                if held >= 1 << 20:
                    yield _batch(made, arrow)
                    made, held = [], 0
            opened.close()
            if made:
                yield _batch(made, arrow)


def _batch(made: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _digests(entry: Entry, start: int, ids: np.ndarray) -> tuple:
    return entry.doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def _id_rows(entry: Entry, start: int, ids: np.ndarray) -> tuple:
    return entry.doc_id, start, ids.astype(np.int64).tolist()


_DIGESTS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
_IDS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))]
)


def write_token_files(
    docs: DataFrame,
    vocabulary_path: str,
    folder: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
    file_bytes: int = 64 << 20,
    level: int = 3,
    dictionary_bytes: int = 64 << 10,
    sample_rows: int = 2_000,
    sample_chars: int = 8_192,
) -> TokenFiles:
    """Write the documents' ids below `folder`, in `partitions` ranges of their ids (by default as many as
    shuffles have)."""
    spark = docs.sparkSession
    ship(spark)
    folder = (folder or shared_folder(spark, "token-files")).rstrip("/")
    with open(vocabulary_path, encoding="utf-8") as source:
        vocabulary = source.read()
    encoder = Encoder(vocabulary, end_id)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    # different texts whose hash is small enough for about `sample_rows` of all rows
    share = F.lit(min(1.0, sample_rows / max(docs.count(), 1)))
    drawn = rows.where(F.pmod("h", F.lit(1 << 32)) < share * (1 << 32)).where(F.length("text").between(1, sample_chars))
    sample = [r.text for r in drawn.select("h", "text").distinct().orderBy("h", "text").limit(sample_rows).collect()]
    dictionary = train_dictionary([encoder.encode(t).tobytes() for t in sample], dictionary_bytes)
    filesystem, root = _open(folder)
    filesystem.create_dir(root, recursive=True)
    with filesystem.open_output_stream(f"{root}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    sent = spark.sparkContext.broadcast(Settings(folder, vocabulary, dictionary, end_id, level, file_bytes))
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key only cuts groups of equal rows into ranges
    keys: list[Column] = [F.col("id"), F.col("h"), F.col("salt")]
    ordered = rows.withColumn("salt", F.rand(0)).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    written = ordered.select("id", "text").mapInArrow(partial(_write_part, sent=sent), _WRITTEN)
    listed = f"{folder}/listed"
    written.write.parquet(listed)
    # a row for each file, of 64 MB or one task's documents
    files = spark.read.schema(_WRITTEN).parquet(listed)
    before = F.sum("tokens").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    files.withColumn("start", F.coalesce(before, F.lit(0)).cast("bigint")).write.parquet(f"{folder}/files")
    return TokenFiles(spark, folder)


def token_report(docs: DataFrame, vocabulary_path: str, **options) -> DataFrame:
    """The documents' rows, as read back from files written for them."""
    return write_token_files(docs, vocabulary_path, **options).documents()
