"""Exact removal of repeated byte strings by sorting suffixes, deep-shallow style.

Every byte covered by a string of `length` bytes that also starts elsewhere goes.  Only suffixes
that can matter are sorted: each such string names as its anchor the place in it whose `gram`-byte
hash is smallest, so equal strings have their anchor at the same offset, and an anchor whose hash
occurs once belongs to no repeat.  About one place in seventy is an anchor.

1. Texts are scanned once.  An anchor's block is the text that its strings cover.  Blocks that are
   equal within a batch are found at once and leave the batch as one row each.
2. Anchors meet by hash.  Equal blocks are repeats as a whole; where a hash has different
   blocks, one of each goes on with its bytes.  Where it has more than `most`, as many near copies do, blocks
   are cut by the offset of their strings: those of up to 16 neighbouring offsets share all but 15 bytes at
   each side, their core, and the hash of the core is the new one.  Copies that differ in the core part
   there, those that are equal around it meet as equal blocks, and a hot hash is dealt over many tasks.
3. The blocks of a hash are sorted twice: as suffixes from the anchor on, and, reversed, from the
   anchor back.  Multikey quicksort orders them to a shallow depth, then blind tries order the
   groups that agree on it, and give the common prefix of neighbours.  A string at offset o is
   repeated if two blocks agree on o bytes before the anchor and the rest of the string after it.
4. Where even more than `most` different blocks have one core, their strings, 16 of a block at most, become
   128-bit hashes that are counted across the cluster.

Rows stream through each step in constant memory, copies of a text are combined before they are
shuffled, and only the spans of one text are ever gathered in one place.

Null texts are empty.  Texts shorter than `length` lose nothing.  Equal rows are documents of
their own: their texts, if long enough, are repeats of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.minhash_dedup import text_key
from realmwatch.llm.texts import ship, stored, to_bytes

LENGTH = 200
_BASE = 0x9E3779B97F4A7C15
_POS = np.uint64(2**28 - 1)  # places within a stretch; longer texts are scanned in stretches


# ---- sorting ---------------------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:  # a[:low] == b[:low], a[:n] != b[:n]
        middle = (low + n) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            n = middle
    return low


class _Node:
    __slots__ = ("depth", "children", "leaf")

    def __init__(self, depth: int, leaf: int) -> None:
        self.depth, self.leaf, self.children = depth, leaf, {}


class BlindTrie:
    """Orders strings that share a long prefix: only branching bytes are kept, and one string is
    compared once with one leaf to find where it belongs.  A string's end is the byte -1."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        self.root: _Node | None = None

    def _byte(self, text: bytes, at: int) -> int:
        return text[at] if at < len(text) else -1

    def insert(self, which: int) -> None:
        text = self.texts[which]
        leaf = _Node(len(text) + 1, which)
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while node.children:  # blind descent: skipped bytes are not looked at
            node = node.children.get(self._byte(text, node.depth)) or next(iter(node.children.values()))
        other = self.texts[node.leaf]
        same = common_prefix(text, other)
        parent, node, key = None, self.root, None
        while node.children and node.depth <= same:
            parent, key = node, self._byte(text, node.depth)
            if key not in node.children:
                node.children[key] = leaf
                return
            node = node.children[key]
        if not node.children and text == self.texts[node.leaf]:
            raise ValueError("strings must differ")
        branch = _Node(same, -1)
        branch.children = {self._byte(other, same): node, self._byte(text, same): leaf}
        if parent is None:
            self.root = branch
        else:
            parent.children[key] = branch

    def ordered(self) -> Iterator[tuple[int, int]]:
        """Strings in order, each with its common prefix with the one before."""
        if self.root is None:
            return
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if not node.children:
                yield node.leaf, shared
                continue
            for i, key in enumerate(sorted(node.children, reverse=True), 1):
                stack.append((node.children[key], shared if i == len(node.children) else node.depth))


def deep_shallow(texts: list[bytes], shallow: int = 24, start: int = 0) -> tuple[list[int], list[int]]:
    """Order of the texts, which share `start` bytes, and the common prefix of each with the one before.

    Equal texts share a place in the trie and follow each other.
    """
    order: list[int] = []
    shared: list[int] = []
    deep = start + shallow
    stack: list[tuple[list[int], int, int]] = [(list(range(len(texts))), start, 0)]
    while stack:
        group, depth, before = stack.pop()
        if len(group) == 1:
            order.append(group[0])
            shared.append(before)
        elif depth >= deep:
            equal: dict[bytes, list[int]] = {}
            for i in group:
                equal.setdefault(texts[i], []).append(i)
            distinct = list(equal)
            trie = BlindTrie(distinct)
            for i in range(len(distinct)):
                trie.insert(i)
            for n, (i, same) in enumerate(trie.ordered()):
                for m, which in enumerate(equal[distinct[i]]):
                    order.append(which)
                    shared.append(len(texts[which]) if m else same if n else before)
        else:  # multikey quicksort: split three ways by the byte at this depth
            keys = [texts[i][depth] if depth < len(texts[i]) else -1 for i in group]
            pivot = keys[len(keys) // 2]
            less = [i for i, k in zip(group, keys, strict=True) if k < pivot]
            same = [i for i, k in zip(group, keys, strict=True) if k == pivot]
            more = [i for i, k in zip(group, keys, strict=True) if k > pivot]
            if more:
                stack.append((more, depth, depth))
            if pivot < 0:  # these end here, and so are equal
                parts = [([i], depth, before if not less and n == 0 else depth) for n, i in enumerate(same)]
                stack += reversed(parts)
            else:
                stack.append((same, depth + 1, depth if less else before))
            if less:
                stack.append((less, depth, before))
    return order, shared


def repeated_offsets(
    blocks: list[tuple[bytes, int, int, int]], length: int, gram: int
) -> list[list[tuple[int, int]]]:
    """For blocks (bytes, anchor's place in them, least and greatest offset) with one anchor: the
    ranges of offsets at which a block's string of `length` bytes stands in another block too."""
    right = [b[at:] for b, at, _, _ in blocks]
    left = [b[:at][::-1] for b, at, _, _ in blocks]
    sides = [deep_shallow(texts, start=start) for texts, start in ((left, 0), (right, gram))]
    bits = _by_pairs(sides, length) if len(blocks) <= 32 else _by_classes(sides, blocks, length)
    found = []
    for covered, (_, _, least, most) in zip(bits, blocks, strict=True):
        covered = covered >> least & (1 << (most - least + 1)) - 1
        ranges, at = [], least
        while covered:
            gap = (covered & -covered).bit_length() - 1
            covered >>= gap
            run = (~covered & covered + 1).bit_length() - 1
            ranges.append((at + gap, at + gap + run - 1))
            covered >>= run
            at += gap + run
        found.append(ranges)
    return found


def _by_pairs(sides: list[tuple[list[int], list[int]]], length: int) -> list[int]:
    """Repeated offsets as bits, from the common prefixes of all pairs of a few blocks."""
    n = len(sides[0][0])
    common = []
    for order, shared in sides:
        table = [[0] * n for _ in range(n)]
        for i in range(n):
            least = length
            for j in range(i + 1, n):  # the least of the neighbours' common prefixes between two texts
                least = min(least, shared[j])
                table[order[i]][order[j]] = table[order[j]][order[i]] = least
        common.append(table)
    bits = [0] * n
    for i in range(n):
        for j in range(i):
            low, high = length - common[1][i][j], common[0][i][j]
            if low <= high:
                span = (1 << (high + 1)) - (1 << low)
                bits[i] |= span
                bits[j] |= span
    return bits


def _by_classes(
    sides: list[tuple[list[int], list[int]]], blocks: list[tuple[bytes, int, int, int]], length: int
) -> list[int]:
    """The same for many blocks: at each offset, those that agree on both sides are one class."""
    n = len(blocks)
    bits = [0] * n
    low, high = np.array([b[2] for b in blocks]), np.array([b[3] for b in blocks])
    for o in range(low.min(), high.max() + 1):
        pair = np.zeros(n, np.int64)
        for (order, shared), depth in zip(sides, (o, length - o), strict=True):
            made = np.empty(n, np.int64)
            made[np.array(order)] = np.cumsum(np.array(shared) < depth)
            pair = pair * (n + 2) + made
        pair[(o < low) | (o > high)] = -1
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        for i in np.flatnonzero((count[inverse] > 1) & (pair >= 0)).tolist():
            bits[i] |= 1 << int(o)
    return bits


# ---- anchors ---------------------------------------------------------------------------------

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = (np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, pow(_BASE, -1, 2**64)))
        _POWERS[size] = up, down
    return _POWERS[size]


def anchors(data: bytes, length: int = LENGTH, gram: int = 64, stretch: int = 1 << 22) -> tuple[np.ndarray, ...]:
    """Hash, place, and first and last string start of every anchor, in order.  A start is in one anchor."""
    starts = len(data) - length + 1
    parts = []
    window = length - gram + 1
    for at in range(0, max(starts, 0), stretch):
        piece = np.frombuffer(data, np.uint8, min(stretch + length - 1, len(data) - at), at).astype(np.uint64)
        up, down = _powers(len(piece))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((piece + np.uint64(1)) * up[: len(piece)])])
        hashes = (sums[gram:] - sums[:-gram]) * down[: len(piece) - gram + 1]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        n = len(hashes)
        keys = np.full(-(-n // window) * window, 2**64 - 1, np.uint64)
        keys[:n] = (hashes & ~_POS) | np.arange(n, dtype=np.uint64)
        keys = keys.reshape(-1, window)
        ahead = np.minimum.accumulate(keys, 1).ravel()
        behind = np.minimum.accumulate(keys[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[: n - window + 1], ahead[window - 1 : n])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        place = (least[first] & _POS).astype(np.int64)
        last = np.append(first[1:], len(least)) - 1
        parts.append((hashes[place].view(np.int64), place + at, first + at, last + at))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, end) joined where they overlap or touch."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


# ---- Spark jobs ------------------------------------------------------------------------------

_ANCHOR = T.StructType([
    T.StructField("k", T.BinaryType()),
    T.StructField("h", T.LongType()),  # null: `first` to `last` is a span found already
    T.StructField("f", T.LongType()),
    T.StructField("place", T.LongType()),
    T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()),
    T.StructField("known", T.BooleanType()),
])


def _pack_rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, kinds, strict=True)], schema=kinds)


def _scan(source: DataFrame, length: int, gram: int) -> DataFrame:
    """Step 1: the anchors of each batch; blocks that are equal in it become spans and one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["k"].to_pylist()
            met: dict[bytes, list] = {}
            for key, text in zip(keys, batch["t"], strict=True):
                data = to_bytes(text.as_py())
                view = memoryview(data)
                for h, place, first, last in zip(*(x.tolist() for x in anchors(data, length, gram)), strict=True):
                    name = xxhash.xxh3_128_digest(view[first : last + length]) + (place - first).to_bytes(4, "big")
                    held = met.get(name)
                    if held is None:
                        met[name] = [key, h, place, first, last, None]
                    elif held[5] is None:
                        held[5] = [(held[0], held[3], held[4]), (key, first, last)]
                    else:
                        held[5].append((key, first, last))
            rows, spans = [], {}
            for name, (key, h, place, first, last, copies) in met.items():
                f = int.from_bytes(name[:8], "big", signed=True) ^ int.from_bytes(name[-4:], "big")
                rows.append((key, h, f, place, first, last, copies is not None))
                for k, a, b in copies or ():
                    spans.setdefault(k, []).append((a, b + 1))
            for k, found in spans.items():
                rows += [(k, None, None, None, a, b - 1, True) for a, b in merge_spans(found)]
            for at in range(0, len(rows), 50_000):
                yield _pack_rows(rows[at : at + 50_000], _ANCHOR)

    return source.mapInArrow(run, _ANCHOR)


_SPAN, _COMPARE, _SPLIT = range(3)
_MET = T.StructType([*_ANCHOR.fields[:2], *_ANCHOR.fields[3:6], T.StructField("kind", T.IntegerType())])


def _meet(rows: DataFrame, most: int) -> DataFrame:
    """Step 2, on rows in order of h and f: starts that are repeats, and one row of every block of a hash with
    several, to be compared or, if they are more than `most`, to be split.  Up to `most` rows wait for that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_now = block_now = None
        waiting: list[tuple] = []  # the hash's blocks, until it is known what becomes of them
        full = False
        alone: tuple | None = None  # the block's only row so far

        def decided() -> list[tuple]:
            return [(*r, _COMPARE) for r in waiting] if len(waiting) > 1 else []

        for batch in batches:
            made: list[tuple] = []
            for k, h, f, place, first, last, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (k, h, place, first, last)
                if h is None:
                    made.append((*row, _SPAN))
                    continue
                if h != hash_now:
                    made += decided()
                    hash_now, block_now, waiting, full = h, None, [], False
                if f != block_now:
                    block_now, alone = f, None if known else row
                    if full:
                        made.append((*row, _SPLIT))
                        continue
                    waiting.append(row)
                    if len(waiting) > most:
                        made += [(*r, _SPLIT) for r in waiting]
                        waiting, full = [], True
                else:
                    if alone:
                        made.append((*alone, _SPAN))
                        alone = None
                    if not known:
                        made.append((*row, _SPAN))
            if made:
                yield _pack_rows(made, _MET)
        if rest := decided():
            yield _pack_rows(rest, _MET)

    return rows.mapInArrow(run, _MET)


# Offsets of a split block's strings that stay together.
_RUN = 16
_BLOCK = T.StructType([*_ANCHOR.fields[:6], T.StructField("block", T.BinaryType())])


def split_block(data: bytes, place: int, first: int, last: int, length: int) -> Iterator[tuple]:
    """The block's strings by runs of offsets before the anchor: hash of what all strings of the run share,
    where that begins, first and last start."""
    low, high, size = place - last, place - first, max(1, min(_RUN, length // 8))
    for run in range(low // size, high // size + 1):
        begin = place - run * size
        core = data[begin : begin - (size - 1) + length]
        least, most = max(low, run * size), min(high, run * size + size - 1)
        yield xxhash.xxh3_64_intdigest(core, run + 1) - 2**63, begin, place - most, place - least


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the blocks to compare and of those to split; of rows with one text, which stand together, once.

    Parts of split blocks that are equal in a batch leave it as one row, and as spans, which have no hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows: list[tuple] = []
            met: dict[tuple, list] = {}
            spans: dict[bytes, list] = {}

            def add(k: bytes, h: int, place: int, first: int, last: int, data: bytes, split: bool) -> None:
                block = data[first : last + length]
                f = xxhash.xxh3_64_intdigest(block, place - first) - 2**63
                row = (k, h, f, place, first, last, block)
                if split:
                    held = met.setdefault((h, f), [row, 0])
                    held[1] += 1
                    if held[1] > 1:
                        for other in (row, held[0]) if held[1] == 2 else (row,):
                            spans.setdefault(other[0], []).append((other[4], other[5] + 1))
                        return
                rows.append(row)

            for k, text, wanted in zip(batch["k"].to_pylist(), batch["t"], batch["wanted"], strict=True):
                if k == before:
                    continue
                before = k
                data = to_bytes(text.as_py())
                for w in wanted.as_py():
                    if w["kind"] == _COMPARE:
                        add(k, w["h"], w["place"], w["first"], w["last"], data, False)
                        continue
                    for h, place, first, last in split_block(data, w["place"], w["first"], w["last"], length):
                        add(k, h, place, first, last, data, True)
                if len(rows) > 20_000:
                    yield _pack_rows(rows, _BLOCK)
                    rows = []
            for k, found in spans.items():
                rows += [(k, None, None, None, a, b - 1, None) for a, b in merge_spans(found)]
            if rows:
                yield _pack_rows(rows, _BLOCK)

    return texts.mapInArrow(run, _BLOCK)


_FOUND = T.StructType([
    T.StructField("k", T.BinaryType()),
    T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()),
    T.StructField("name", T.BinaryType()),  # set: one string of a core with too many blocks
])


def _sort(blocks: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """Step 3, on blocks in order of h and f: ranges of repeated starts, or strings to be counted."""

    def solve(group: list[tuple]) -> list[tuple]:
        cut = [(block, place - first, place - last, place - first) for _, _, _, place, first, last, block in group]
        return [
            (row[0], row[3] - b, row[3] - a, None)
            for row, ranges in zip(group, repeated_offsets(cut, length, gram), strict=True)
            for a, b in ranges
        ]

    def strings(row: tuple) -> list[tuple]:
        k, _, _, _, first, last, block = row
        view = memoryview(block)
        return [
            (k, s, s, xxhash.xxh3_128_digest(view[s - first : s - first + length])) for s in range(first, last + 1)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block_now, group, many = None, None, [], False
        for batch in batches:
            made: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k, h, f, _, first, last, _ = row
                if h is None:
                    made.append((k, first, last, None))
                    continue
                if h != now:
                    if not many and len(group) > 1:
                        made += solve(group)
                    now, block_now, group, many = h, None, [], False
                if f == block_now:  # an equal block: all its strings are repeats
                    made.append((k, first, last, None))
                    if alone:
                        made.append((alone[0], alone[4], alone[5], None))
                        alone = None
                    continue
                block_now, alone = f, row
                if many:
                    made += strings(row)
                else:
                    group.append(row)
                    if len(group) > most:
                        made += [s for r in group for s in strings(r)]
                        group, many = [], True
                if len(made) > 20_000:
                    yield _pack_rows(made, _FOUND)
                    made = []
            if made:
                yield _pack_rows(made, _FOUND)
        if not many and len(group) > 1:
            yield _pack_rows(solve(group), _FOUND)

    return blocks.mapInArrow(run, _FOUND)


def repeated_spans(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = 64, most: int = 2000
) -> DataFrame:
    """`k`, the text's key, and `spans`, its repeated bytes as an array of (first, end), for texts with any."""
    ship(docs.sparkSession)
    source = docs.select(F.col(text_col).cast("string").alias("t")).where(F.octet_length("t") >= length)
    source = source.select(text_key("t").alias("k"), "t")
    scanned = _scan(source, length, gram)
    # Spans known already have no hash; they are dealt by their text so that they do not meet.
    met_by = scanned.repartition(F.coalesce("h", F.xxhash64("k", "first"))).sortWithinPartitions("h", "f")
    found = stored(_meet(met_by, most), "met")
    wanted = found.where(F.col("kind") != _SPAN).groupBy("k").agg(
        F.collect_list(F.struct("h", "place", "first", "last", "kind")).alias("wanted")
    )
    blocks = _cut(source.hint("merge").join(wanted, "k").select("k", "t", "wanted"), length)
    sorted_blocks = blocks.repartition(F.coalesce("h", F.xxhash64("k", "first"))).sortWithinPartitions("h", "f")
    more = stored(_sort(sorted_blocks, length, gram, most), "sorted")
    strings = more.where("name IS NOT NULL")
    twice = strings.groupBy("name").agg(F.count("*").alias("c")).where("c > 1").select("name")
    spans = (
        found.where(F.col("kind") == _SPAN).select("k", "first", "last")
        .unionAll(more.where("name IS NULL").select("k", "first", "last"))
        .unionAll(strings.join(twice, "name").select("k", "first", "last"))
    )
    span = F.struct(F.col("first"), (F.col("last") + length).alias("end"))
    return spans.groupBy("k").agg(F.collect_set(span).alias("spans"))


def _spans_of(cell: pa.Scalar) -> list[tuple[int, int]]:
    value = cell.as_py()
    return merge_spans([(s["first"], s["end"]) for s in value]) if value else []


def kept_bytes(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for first, end in spans:
        kept.append(data[at:first])
        at = end
    return b"".join([*kept, data[at:]])


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spans = repeated_spans(docs, text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_key(text_col).alias("k"), F.col(text_col).cast("string").alias("t")
    )
    joined = rows.hint("merge").join(spans, "k", "left").select("doc_id", "t", "spans")
    schema = T.StructType([
        joined.schema["doc_id"],
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, cell in zip(batch["t"], batch["spans"], strict=True):
                data, removed = to_bytes(text.as_py()), _spans_of(cell)
                digest = hashlib.sha256(kept_bytes(data, removed)).hexdigest()
                made.append((len(data), sum(b - a for a, b in removed), len(removed), digest))
            columns = list(zip(*made, strict=True)) if made else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=schema.names
            )

    return joined.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, the text without its repeated strings.

    A character of which a byte goes, goes as a whole.  Null texts stay null.
    """
    spans = repeated_spans(docs, text_col)
    names = docs.columns
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], text_key(text_col).alias("__k"))
    joined = keyed.hint("merge").join(spans.withColumnRenamed("k", "__k").withColumnRenamed("spans", "__s"), "__k", "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in names], "__s")
    schema = T.StructType(joined.schema.fields[:-1])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cell in zip(batch.column(at), batch.column(len(names)), strict=True):
                value, removed = text.as_py(), _spans_of(cell)
                if removed:
                    data, end, kept = to_bytes(value), 0, []
                    for a, b in [*removed, (len(data), len(data))]:
                        kept.append(data[end:a].decode("utf-8", "ignore"))
                        end = b
                    value = "".join(kept)
                texts.append(value)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(run, schema)
