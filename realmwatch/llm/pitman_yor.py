"""Language-model scores from a hierarchical Pitman-Yor model sampled over the whole corpus.

Tokens are the words `[^\\x20\\x09-\\x0D]+` of a text with A-Z lower-cased, and one end.  Every token
has a restaurant of its own, for the tokens that follow it; a text's first token follows the end.  So
there are as many restaurants as different training tokens, and a restaurant has as many customers as
its token has occurrences.  All of them share one parent restaurant, whose base is uniform over the training
vocabulary and one unknown token.  A dish is a token.  Discounts follow from the counts of
pairs seen once and twice.

Texts are read once.  Their tokens are dealt by hash into buckets, all of a token in one; what a
batch has of a bucket is packed into one row.  Rows are written under the name of their batch before
anything is shuffled, so a retry meets the same names.  The training counts of (token, token before)
are summed before they meet in the task of their bucket, so a hot token costs it one number for each
different token before it in every few million tokens read.  Gibbs sweeps reseat the customers of every
(restaurant, token) pair one after another given all other seats, and keep the tables from sweep to
sweep.  A bucket holds all tables of its dishes, which are the parent's customers; the tables of a
restaurant lie in many buckets.  So between sweeps each bucket sends what it has of each restaurant's
tables to the bucket of the restaurant's token, which sends the sums back; no totals of restaurants
pass the driver.  After a few sweeps each bucket averages seats over several samples, and the averaged
tables are summed up once more, so the chances in each restaurant sum to one.  The predictive
probabilities of the averaged seats score every token of every text, and the buckets' sums are added per text.
A bucket with more than its share of the tokens is scored in several groups; each gets a copy of the
bucket's averaged seats, and its rows stream past them one at a time.

All Python runs in RDDs, one worker a task: counts and news of a bucket are dealt alike, so their union needs no worker
of its own.  Workers give freed memory back between buckets.

Packed rows name frequent words by their place in a list of at most 1,048,576, drawn from about 128 MB of
text, and others by hash.  The list only shortens rows; no result depends on it.

Null texts are empty and have one token, the end.  Rows without id count as the id "".  Repeated rows
are texts of their own.  Without training rows every token is unknown.
"""

from __future__ import annotations

import ctypes
import struct
import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import RDD
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.texts import blank_words, ship, shared_folder, stored

_STRENGTH = 10.0  # of the contexts' and the parent's restaurants
_NONE = np.zeros(0, np.uint64)


def contexts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each token; `first` marks the first ones of texts, which follow an end.

    Every text's last token is its end, so before a text's first token stands the last text's end."""
    before = np.roll(tokens, 1)
    return np.where(first, tokens[-1], before)


def _release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and those of several stages stand
    side by side in an executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def _frame(spark: SparkSession, rows: RDD, schema: T.StructType) -> DataFrame:
    """Rows that Python made, as a table.  All of this module's Python runs in RDDs: workers of DataFrames would stand
    beside those of RDDs, and their batches take several times 64 MB outside the heap."""
    return spark.createDataFrame(rows, schema, verifySchema=False)


def _planes(a: np.ndarray, kind: str) -> bytes:
    a = np.ascontiguousarray(a, dtype=kind)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _join(arrays: list[np.ndarray], kinds: tuple[str, ...]) -> bytes:
    head = struct.pack(f"<{len(kinds)}Q", *map(len, arrays))
    size = len(head) + sum(len(a) * np.dtype(k).itemsize for a, k in zip(arrays, kinds, strict=True))
    out = zstandard.ZstdCompressor(level=3).compressobj(size=size)
    made = [out.compress(head), *(out.compress(_planes(a, k)) for a, k in zip(arrays, kinds, strict=True))]
    return b"".join([*made, out.flush()])


def _split(blob: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    found, at = [], 8 * len(kinds)
    for kind, size in zip(kinds, struct.unpack_from(f"<{len(kinds)}Q", data), strict=True):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, size * wide, at).reshape(wide, size)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * wide
    return found


_SET = ("<u4", "<u8")  # a sorted set of hashes: steps between places in the list of frequent words, and between others


def _packed_set(hashes: np.ndarray, common: np.ndarray) -> list[np.ndarray]:
    common = getattr(common, "value", common)  # a broadcast one
    at = np.searchsorted(common, hashes)
    known = np.zeros(len(hashes), bool)
    if len(common):
        known = common[np.minimum(at, len(common) - 1)] == hashes
    return [np.diff(at[known], prepend=0), np.diff(hashes[~known], prepend=np.uint64(0))]


def _read_set(places: np.ndarray, steps: np.ndarray, common: np.ndarray) -> np.ndarray:
    common = getattr(common, "value", common)
    return np.sort(np.concatenate([common[np.cumsum(places, dtype=np.int64)], np.cumsum(steps, dtype=np.uint64)]))


_TOKEN_ROW = (*_SET, "<u4", *_SET, "<u4", "<u2", "u1")  # tokens and counts; tokens before, and which; steps between owners; training


def _pack(
    hashes: np.ndarray, counts: np.ndarray, before: np.ndarray, context: np.ndarray, owner: np.ndarray,
    train: np.ndarray, common: np.ndarray,
) -> bytes:
    steps = np.diff(owner.astype(np.uint16), prepend=np.uint16(0))  # the few that fall wrap around
    return _join(
        [*_packed_set(hashes, common), counts, *_packed_set(before, common), context, steps, train], _TOKEN_ROW
    )


def _unpack(blob: bytes, common: np.ndarray = _NONE) -> list[np.ndarray]:
    """Different tokens, their counts; of each occurrence the place of the token before and the text; training texts;
    the different tokens before."""
    *words, counts, places, steps, context, owner, train = _split(blob, _TOKEN_ROW)
    owner = np.cumsum(owner, dtype=np.uint16)
    return [_read_set(*words, common), counts, context, owner, train, _read_set(places, steps, common)]


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of tokens; they ascend as the hashes do."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _salt(sub: bytes, tokens: int, total: int, buckets: int) -> int:
    """The group that scores a batch's `tokens` of a bucket, of `total` in all.

    Every group gets less than two even shares of the batches' tokens, in the mean."""
    return zlib.crc32(sub) % max(1, tokens * buckets // total)


def _token_rows(
    texts: list[str], train: np.ndarray, buckets: int, common: np.ndarray = _NONE
) -> tuple[list[int], list[tuple[int, bytes, int]]]:
    """Tokens of each text, and (bucket, packed tokens, their number) of each bucket that has any."""
    place: dict[bytes, int] = {}  # numbers words as they come, so no list of all words is held
    numbers, sizes = [], []
    for text in texts:
        found = blank_words(text)
        found.append(b"")
        numbers.append(np.fromiter([place.setdefault(w, len(place)) for w in found], np.int32, len(found)))
        sizes.append(len(found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
    del place
    distinct, rank = np.unique(hashes, return_inverse=True)
    token = rank.astype(np.int32)[np.concatenate(numbers)]
    del numbers
    first = np.zeros(len(token), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    order = np.argsort(token, kind="stable")
    context = contexts(token, first)[order]
    owner = np.repeat(np.arange(len(texts), dtype=np.uint16), sizes)[order]
    del order, first
    counts = np.bincount(token)
    edge = np.concatenate([[0], np.cumsum(counts)])
    cut = np.searchsorted(_bucket_of(distinct, buckets), np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        i, j = cut[b], cut[b + 1]
        if i < j:
            at = slice(edge[i], edge[j])
            before, place = np.unique(context[at], return_inverse=True)
            blob = _pack(distinct[i:j], counts[i:j], distinct[before], place, owner[at], train, common)
            rows.append((b, blob, int(edge[j] - edge[i])))
    return sizes, rows


@dataclass
class _Bucket:
    """Training counts of one bucket: tokens, tokens before, and of each pair, in order of token and token before,
    the places of both and its customers."""

    words: np.ndarray
    contexts: np.ndarray
    word: np.ndarray
    context: np.ndarray
    customers: np.ndarray

    @property
    def pairs(self) -> np.ndarray:
        return self.word.astype(np.int64) * len(self.contexts) + self.context

    @property
    def count(self) -> np.ndarray:
        return np.bincount(self.word, self.customers, len(self.words)).astype(np.int64)


def _bucket(words: np.ndarray, contexts: np.ndarray, pairs: np.ndarray, customers: np.ndarray | None) -> _Bucket:
    """The sum of `customers` (None: one each) by ascending `pairs` (token * tokens before + token before)."""
    edge = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]]))
    if customers is None:
        customers = np.diff(edge, append=len(pairs))
    else:
        customers = np.add.reduceat(customers, edge, dtype=np.int64) if len(edge) else np.zeros(0, np.int64)
    pairs = pairs[edge]
    del edge
    word = (pairs // max(1, len(contexts))).astype(np.int32)
    pairs %= max(1, len(contexts))
    return _Bucket(words, contexts, word, pairs.astype(np.int32), customers)


def _gather(parts: list[list[np.ndarray]]) -> _Bucket:
    words = np.unique(np.concatenate([p[0] for p in parts]))
    known = np.unique(np.concatenate([p[5] for p in parts]))
    pairs, size = np.empty(sum(len(p[2]) for p in parts), np.int64), 0
    for hashes, counts, context, owner, train, before in parts:
        word = np.repeat(np.searchsorted(words, hashes), counts)
        found = (word * len(known) + np.searchsorted(known, before)[context])[train[owner].astype(bool)]
        pairs[size : size + len(found)] = found
        size += len(found)
    pairs = pairs[:size]
    pairs.sort()
    return _bucket(words, known, pairs, None)


_COUNTS = (*_SET, *_SET, "<u8", "<u4")  # tokens, tokens before, steps between pairs, and their customers
_TOKENS = 3_000_000  # counted at once in a task


def _counted(batches: Iterable[pa.RecordBatch], buckets: int, common: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Training counts of packed tokens: (bucket, counts) for every few million tokens."""
    return _counts((blob.as_py() for batch in batches for blob in batch["blob"]), buckets, common)


def _counts(blobs: Iterable[bytes], buckets: int, common: np.ndarray) -> Iterator[tuple[int, bytes]]:
    parts, size = [], 0

    def made() -> Iterator[tuple[int, bytes]]:
        found = _gather(parts)
        parts.clear()
        word, context = found.word, found.context
        cut = np.searchsorted(_bucket_of(found.words, buckets), np.arange(buckets + 1))
        edge = np.searchsorted(word, cut)
        for b in np.flatnonzero(np.diff(edge)):
            at = slice(edge[b], edge[b + 1])
            learnt, token = np.unique(word[at], return_inverse=True)
            before, place = np.unique(context[at], return_inverse=True)
            pairs = token * len(before) + place
            yield int(b), _join([
                *_packed_set(found.words[learnt], common), *_packed_set(found.contexts[before], common),
                np.diff(pairs, prepend=0), found.customers[at],
            ], _COUNTS)

    for blob in blobs:
        parts.append(_unpack(blob, common))
        size += len(parts[-1][2])
        if size >= _TOKENS:
            yield from made()
            _release()
            size = 0
    if parts:
        yield from made()
    _release()


def _merge(blobs: list[bytes], common: np.ndarray) -> _Bucket:
    parts = []
    for blob in blobs:
        a, b, c, d, steps, customers = _split(blob, _COUNTS)
        parts.append((_read_set(a, b, common), _read_set(c, d, common), steps, customers))
    words = np.unique(np.concatenate([_NONE, *(p[0] for p in parts)]))
    known = np.unique(np.concatenate([_NONE, *(p[1] for p in parts)]))
    size = sum(len(p[2]) for p in parts)
    pairs, customers = np.zeros(size, np.int64), np.zeros(size, np.uint32)
    while parts:
        w, c, steps, found = parts.pop()
        at = slice(size - len(steps), size)
        size -= len(steps)
        word, context = np.divmod(np.cumsum(steps, dtype=np.int64), max(1, len(c)))
        pairs[at] = np.searchsorted(words, w)[word] * len(known) + np.searchsorted(known, c)[context]
        customers[at] = found
    order = np.argsort(pairs, kind="stable")
    pairs, customers = pairs[order], customers[order]
    del order
    return _bucket(words, known, pairs, customers)


def _by_bucket(rows: Iterable[tuple]) -> Iterator[tuple[int, list[bytes], list[tuple[int, bytes]]]]:
    """Of every bucket in a partition its counts and its news; news are pairs."""
    found: defaultdict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    for number, row in rows:
        found[number][isinstance(row, tuple)].append(row)
    while found:
        number, (counts, news) = found.popitem()
        yield number, counts, news
        del counts, news
        _release()


@dataclass(frozen=True)
class Corpus:
    """What all buckets share: totals and discounts; and the tables of a bucket's contexts."""

    tokens: int
    vocabulary: int
    customers: tuple[int, ...] | np.ndarray
    tables: tuple[float, ...] | np.ndarray
    parents: float  # tables of the parent
    discount: float
    parent_discount: float
    sent: float | None = None  # customers of the parent, where `tables` are not those of all contexts

    @property
    def total(self) -> float:
        return float(np.sum(self.tables)) if self.sent is None else self.sent

    @property
    def base(self) -> float:
        """What the parent's base adds to the customers of a token."""
        return (_STRENGTH + self.parent_discount * self.parents) / (self.vocabulary + 1)

    @property
    def unknown(self) -> float:
        """The parent's chance of a token it has not seen."""
        return self.base / (_STRENGTH + self.total)


def _seat(customers: np.ndarray, fresh: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables after seating all customers of each dish in turn; `fresh` weighs a new table, a taken
    one its customers less the discount.  Beyond 32 customers they sit down in doubling groups."""
    tables = np.minimum(customers, 1).astype(np.float64)
    seated = 1
    order = np.argsort(-customers, kind="stable")
    ranked = customers[order]
    tables, fresh = tables[order], fresh[order]
    while True:
        active = int(np.searchsorted(-ranked, -seated, "left"))  # dishes with more customers than seated
        if not active:
            break
        step = 1 if seated < 32 else seated
        more = np.minimum(ranked[:active] - seated, step)
        open_new = fresh[:active] / (seated + (more - 1) / 2 - discount * tables[:active] + fresh[:active])
        tables[:active] += random.binomial(more, np.clip(open_new, 0, 1))
        seated += step
    result = np.empty_like(tables)
    result[order] = tables
    return result


def _sweep(
    bucket: _Bucket, tables: np.ndarray, corpus: Corpus, random: np.random.Generator
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Reseat the parent, then every context: new tables, the parent's tables and chances by word."""
    sent = np.bincount(bucket.word, tables, len(bucket.words))
    top = _seat(sent.astype(np.int64), np.full(len(sent), corpus.base), corpus.parent_discount, random)
    chance = (sent - corpus.parent_discount * top + corpus.base) / (_STRENGTH + corpus.total)
    made = np.ones(len(bucket.customers))
    more = np.flatnonzero(bucket.customers > 1)  # one customer has one table
    fresh = (_STRENGTH + corpus.discount * np.asarray(corpus.tables, np.float64))[bucket.context[more]]
    made[more] = _seat(bucket.customers[more], fresh * chance[bucket.word[more]], corpus.discount, random)
    return made, top, chance


def _totals(counts: RDD, common: np.ndarray) -> Corpus:
    """Totals and discounts of all buckets, as they are with one table for each pair."""

    def run(rows: Iterable[tuple[int, bytes]]) -> Iterator[tuple[int, ...]]:
        for _, blobs, _ in _by_bucket(rows):
            bucket = _merge(blobs, common)
            seen = bucket.customers
            yield int(seen.sum()), len(bucket.words), len(seen), int((seen == 1).sum()), int((seen == 2).sum())

    sums = counts.mapPartitions(run).fold((0,) * 5, lambda a, b: tuple(map(int.__add__, a, b)))
    tokens, vocabulary, pairs, ones, twos = sums
    discount = min(max(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.05), 0.95)
    return Corpus(tokens, vocabulary, _NONE, _NONE, float(vocabulary), discount, discount, float(pairs))


# Between sweeps bucket `origin` tells others (bucket, (origin, blob)).  _KEPT: what a bucket keeps for itself; _HOME:
# the tables of the contexts whose token is the bucket's.
_News = Iterator[tuple[int, tuple[int, bytes]]]
_KEPT, _HOME = -1, -2
_TABLES = (*_SET, "<f8", "<f8")  # contexts, their tables; customers and tables of the parent
_KEEPS = ("<u4", "<f8")  # tables of every pair; what the parent's customers of every token weigh


def _told(
    number: int, bucket: _Bucket, tables: np.ndarray, share: float, parent: np.ndarray, sums: tuple[float, float],
    buckets: int, common: np.ndarray,
) -> _News:
    """A bucket's news: to every bucket its tables of that bucket's contexts, `tables` * `share`, and `sums`."""
    own = np.bincount(bucket.context, tables, len(bucket.contexts)) * share
    cut = np.searchsorted(_bucket_of(bucket.contexts, buckets), np.arange(buckets + 1))
    yield number, (_KEPT, _join([tables, parent], _KEEPS))
    for b in range(buckets):
        at = slice(cut[b], cut[b + 1])
        blob = _join([*_packed_set(bucket.contexts[at], common), own[at], np.array(sums)], _TABLES)
        yield b, (number, blob)


def _answers(home: int, rows: Iterable[tuple[int, bytes]], common: np.ndarray) -> _News:
    """To every bucket the tables of its contexts over all buckets, by where they were summed."""
    asked = []
    for origin, blob in rows:
        if origin == _KEPT:
            yield home, (_KEPT, blob)
        else:
            asked.append((origin, _split(blob, _TABLES)))
    asked.sort(key=lambda x: x[0])
    sets = [_read_set(places, steps, common) for _, (places, steps, _, _) in asked]
    known, at = np.unique(np.concatenate(sets), return_inverse=True)
    tables = np.bincount(at, np.concatenate([x[2] for _, x in asked]), len(known))
    sums = np.sum([x[3] for _, x in asked], axis=0)
    edge = np.cumsum([0, *map(len, sets)])
    for (origin, _), i, j in zip(asked, edge[:-1], edge[1:], strict=True):
        yield origin, (home, _join([_NONE, _NONE, tables[at[i:j]], sums], _TABLES))
    yield home, (_HOME, _join([_NONE, _NONE, tables, sums], _TABLES))


def _heard(counts: list[bytes], news: list[tuple[int, bytes]], corpus: Corpus, common: np.ndarray) -> tuple:
    """A bucket, the corpus with the tables of its contexts, what it kept, and its own words' tables."""
    bucket = _merge(counts, common)
    kept, home, tables = [np.zeros(0), np.zeros(0)], np.zeros(0), []
    for origin, blob in sorted(news):
        if origin == _KEPT:
            kept = _split(blob, _KEEPS)
            continue
        *_, found, sums = _split(blob, _TABLES)
        if origin == _HOME:
            home = found  # in order of its words, each of which stands before some token
        else:
            tables.append(found)
        corpus = replace(corpus, sent=float(sums[0]), parents=float(sums[1]))
    return bucket, replace(corpus, tables=np.concatenate([np.zeros(0), *tables])), kept, home


def _averaged(
    counts: RDD, corpus: Corpus, sweeps: int, burn: int, samples: int, seed: int, buckets: int, common: np.ndarray
) -> RDD:
    """(bucket, seats): counts, parent's chances and seats of its words, averaged over samples."""

    def begin(number: int, found: list[bytes]) -> _News:
        """The first sweep, from one table for each pair; a context has in other buckets what it has here."""
        bucket = _merge(found, common)
        guess = np.bincount(bucket.context, minlength=len(bucket.contexts)) * (corpus.vocabulary / len(bucket.words))
        random = np.random.default_rng([seed, 1, number])
        tables, top, _ = _sweep(bucket, np.ones(len(bucket.customers)), replace(corpus, tables=guess), random)
        return _told(number, bucket, tables, 1.0, np.zeros(0), (tables.sum(), top.sum()), buckets, common)

    def sweep(number: int, found: list[bytes], news: list[tuple[int, bytes]], turn: int) -> _News:
        if not found:
            return iter(())
        bucket, state, (tables, _), _ = _heard(found, news, corpus, common)
        random = np.random.default_rng([seed, turn, number])
        if turn <= sweeps:
            tables, top, _ = _sweep(bucket, tables, state, random)
            sums = (tables.sum(), top.sum())
            return _told(number, bucket, tables, 1.0, np.zeros(0), sums, buckets, common)
        seated, parent, sums = np.zeros(len(bucket.customers)), np.zeros(len(bucket.words)), np.zeros(2)
        for sample in range(burn + samples):
            sent = np.bincount(bucket.word, tables, len(bucket.words))
            tables, top, _ = _sweep(bucket, tables, state, random)
            if sample >= burn:
                seated += tables
                parent += (sent - corpus.parent_discount * top) / samples
                sums += np.array([sent.sum(), top.sum()]) / samples
        return _told(number, bucket, seated, 1 / samples, parent, tuple(sums), buckets, common)

    def close(number: int, found: list[bytes], news: list[tuple[int, bytes]]) -> tuple[int, bytes]:
        bucket, state, (seated, parent), home = _heard(found, news, corpus, common)
        share = (_STRENGTH + corpus.discount * home) / (_STRENGTH + bucket.count)
        parent = (parent + state.base) / (_STRENGTH + state.total)
        return number, _join([
            *_packed_set(bucket.words, common), bucket.count, parent, np.log10(share),
            *_packed_set(bucket.contexts, common), state.tables,
            np.diff(bucket.pairs, prepend=0), bucket.customers, seated, [state.unknown, samples],
        ], _SEATS)

    def started(rows: Iterable[tuple]) -> _News:
        for number, found, _ in _by_bucket(rows):
            yield from begin(number, found)

    def answered(rows: Iterable[tuple]) -> _News:
        for number, _, told in _by_bucket(rows):
            yield from _answers(number, told, common)

    def swept(rows: Iterable[tuple], turn: int) -> _News:
        for number, found, told in _by_bucket(rows):
            yield from sweep(number, found, told, turn)

    # Counts and news are dealt alike, so only news move; a partition of their union goes straight to one Python worker.
    parts = counts.getNumPartitions()
    news = counts.mapPartitions(started)
    for turn in range(2, sweeps + 2):
        told = news.partitionBy(parts).mapPartitions(answered).partitionBy(parts)
        news = counts.union(told).mapPartitions(lambda rows, turn=turn: swept(rows, turn))
    told = news.partitionBy(parts).mapPartitions(answered).partitionBy(parts)
    return counts.union(told).mapPartitions(lambda rows: (close(*row) for row in _by_bucket(rows)))


# Words, their counts, the parent's chances of them and log10 of what their restaurants leave to it; tokens before and
# their tables; steps between pairs, their customers and the tables of all samples; the chance of an unknown token and
# the number of samples.
_SEATS = (*_SET, "<u4", "<f8", "<f8", *_SET, "<f8", "<u8", "<u4", "<u4", "<f8")


def _seats(blob: bytes, discount: float, common: np.ndarray) -> list[np.ndarray]:
    """What `_sums` needs of a bucket; seats are over the weight that their restaurant gives the parent."""
    a, b, count, parent, share, c, d, tables, steps, customers, seated, rest = _split(blob, _SEATS)
    contexts, pairs = _read_set(c, d, common), np.cumsum(steps, dtype=np.int64)
    seats = np.maximum(customers - discount * seated / rest[1], 0)
    seats /= (_STRENGTH + discount * tables)[pairs % max(1, len(contexts))]
    return [_read_set(a, b, common), count, parent, share, contexts, pairs, seats, rest[:1]]


_PART = T.StructType([
    T.StructField("sub", T.BinaryType()),
    T.StructField("sums", T.BinaryType()),
])


def _score(dealt: DataFrame, averaged: DataFrame, corpus: Corpus, buckets: int, common: np.ndarray) -> DataFrame:
    """For each batch and bucket, sums per text: base score, score, known tokens."""
    groups = averaged.join(F.broadcast(dealt.select("bucket", "salt").distinct()), "bucket")  # a few for each bucket
    rows = groups.select("bucket", "salt", F.lit(None).cast("binary").alias("sub"), F.col("seats").alias("blob"))
    rows = rows.unionAll(dealt.select("bucket", "salt", "sub", "blob"))

    def run(batch: Iterable[Row]) -> Iterator[tuple[bytes, bytes]]:
        now, known = None, None
        for bucket, salt, sub, blob in batch:
            if (bucket, salt) != now:  # its seats come first; without training tokens there are none
                now, known = (bucket, salt), [_NONE] * 7 + [np.array([corpus.unknown])]
            if sub is None:
                known = None
                known = _seats(blob, corpus.discount, common)
                _release()
                continue
            yield sub, _sums(_unpack(blob, common), known, corpus)
        known = None
        _release()

    rows = rows.repartition(int(buckets), "bucket", "salt").sortWithinPartitions("bucket", "salt", F.asc_nulls_first("sub"))
    return _frame(dealt.sparkSession, rows.select("bucket", "salt", "sub", "blob").rdd.mapPartitions(run), _PART)


def _sums(packed: list[np.ndarray], known: list[np.ndarray], corpus: Corpus) -> bytes:
    hashes, counts, place, owner, train, before = packed
    words, customers, chances, shares, contexts, pairs, seats, unknown = known
    count, parent = np.zeros(len(hashes), np.int64), np.full(len(hashes), unknown[0])
    share, seat = np.zeros(len(hashes)), np.zeros(len(place))
    if len(words):
        word = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        same = words[word] == hashes
        count[same], parent[same], share[same] = customers[word[same]], chances[word[same]], shares[word[same]]
        context = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
        pair = np.repeat(word, counts) * len(contexts) + context[place]
        at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        seen = np.repeat(same, counts) & (contexts[context] == before)[place] & (pairs[at] == pair)
        seat[seen] = seats[at[seen]]
    base = np.log10((count + 1) / (corpus.tokens + corpus.vocabulary + 1))
    # A token's restaurant leaves that share to the parent once for each token that follows it in the text; the
    # end's does for the text's first token.
    chance = np.log10(seat + np.repeat(parent, counts)) + np.repeat(share, counts)
    n = len(train)
    has = np.flatnonzero(np.bincount(owner, minlength=n))
    sums = [np.bincount(owner, x, n)[has] for x in (np.repeat(base, counts), chance, np.repeat(count > 0, counts))]
    return _join([has, *sums], _TEXT_SUMS)


_TEXT_SUMS = ("<u2", "<f8", "<f8", "<u4")  # texts; their base scores, scores and known tokens


def _frequent(source: DataFrame, text_bytes: int, sample: int = 128_000_000, most: int = 1_048_576) -> np.ndarray:
    """Hashes of frequent words of about `sample` bytes of text, ascending; they only shorten packed rows."""
    made = T.StructType([T.StructField("word", T.LongType()), T.StructField("n", T.LongType())])
    some = source.where(F.pmod(F.xxhash64("doc_id", "t"), F.lit(max(1, text_bytes // sample))) == 0).select("t")

    def count(rows: Iterable[Row]) -> Iterator[tuple[int, int]]:
        found: Counter[bytes] = Counter()
        for (text,) in rows:
            found.update(blank_words(text))
        for word, n in found.items():
            if n > 1:
                yield int(np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64)), n
        del found
        _release()

    words = _frame(source.sparkSession, some.rdd.mapPartitions(count), made)
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return np.sort(np.array([r.word for r in top.select("word").collect()], np.int64).view(np.uint64))


def _dealt(source: DataFrame, buckets: int, batch_bytes: int, common: np.ndarray = _NONE) -> DataFrame:
    """Packed tokens (bucket, salt, sub, blob) of every batch, and its texts in a row of bucket -1."""
    read = T.StructType([
        T.StructField("bucket", T.IntegerType()),
        T.StructField("salt", T.IntegerType()),
        T.StructField("sub", T.BinaryType()),
        T.StructField("blob", T.BinaryType()),
        T.StructField("ids", T.ArrayType(source.schema["doc_id"].dataType)),
        T.StructField("held", T.ArrayType(T.BooleanType())),
        T.StructField("sizes", T.ArrayType(T.LongType())),
    ])

    def flush(ids: list, held: list, texts: list) -> Iterator[tuple]:
        sub = uuid.uuid4().bytes  # the written rows keep it
        sizes, rows = _token_rows(texts, ~np.array(held, bool), buckets, common)
        yield -1, 0, sub, None, ids, held, sizes
        for bucket, blob, n in rows:
            yield bucket, _salt(sub, n, sum(sizes), buckets), sub, blob, None, None, None

    def tokens(rows: Iterable[Row]) -> Iterator[tuple]:
        ids, held, texts, size = [], [], [], 0
        for i, h, text in rows:
            ids.append(i)
            held.append(bool(h))
            texts.append(text or "")
            size += len(texts[-1])
            if size >= batch_bytes or len(texts) >= 60_000:
                yield from flush(ids, held, texts)
                ids, held, texts, size = [], [], [], 0
                _release()
        if texts:
            yield from flush(ids, held, texts)
        texts = None
        _release()

    return stored(_frame(source.sparkSession, source.rdd.mapPartitions(tokens), read), "tokens")


def score_language(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    sweeps: int = 2,
    burn: int = 2,
    samples: int = 4,
    seed: int = 7,
    batch_bytes: int = 8_000_000,
    bucket_bytes: int = 32_000_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from rows that are not `held_out`.  `bucket_bytes` of text make a bucket, so tasks keep
    their size as the corpus grows.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(
        F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("t")
    )
    total = source.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))
    common = spark.sparkContext.broadcast(_frequent(source, total))
    made = _dealt(source, int(buckets), batch_bytes, common)
    dealt = made.where("bucket >= 0").select("bucket", "salt", "sub", "blob")
    counts = dealt.select("blob").rdd.mapPartitions(lambda rows: _counts((r.blob for r in rows), int(buckets), common))
    counts = counts.partitionBy(int(buckets))  # a partition holds whole buckets
    corpus = _totals(counts, common)
    averaged = _frame(
        spark,
        _averaged(counts, corpus, sweeps, burn, samples, seed, int(buckets), common),
        T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("seats", T.BinaryType())]),
    )
    parts = _score(dealt, averaged, corpus, int(buckets), common)
    listed = made.where("bucket < 0").select("sub", "ids", "held", "sizes")
    together = parts.select(
        "sub", "sums", *[F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in ("ids", "held", "sizes")]
    ).unionAll(listed.select("sub", F.lit(None).cast("binary").alias("sums"), "ids", "held", "sizes"))
    result = T.StructType([
        source.schema["doc_id"],
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ])
    n_train = corpus.tokens

    def add(rows: Iterable[Row]) -> Iterator[tuple]:
        now, sums, texts = None, [], None

        def close() -> Iterator[tuple]:
            ids, held, sizes = texts
            total = np.zeros((3, len(ids)))
            for blob in sums:
                has, *found = _split(blob, _TEXT_SUMS)
                total[:, has] += found
            base, score, known = total.tolist()
            for i, h, size, k, b, x in zip(ids, held, sizes, known, base, score, strict=True):
                yield i, h, size, int(k), n_train, b, x

        for sub, blob, *listing in rows:
            if sub != now:
                if now is not None:
                    yield from close()
                now, sums, texts = sub, [], None
            if blob is None:
                texts = listing
            else:
                sums.append(blob)
        if now is not None:
            yield from close()

    return _frame(spark, together.repartition("sub").sortWithinPartitions("sub").rdd.mapPartitions(add), result)
