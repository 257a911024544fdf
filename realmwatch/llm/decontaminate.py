"""Benchmark decontamination: longest matches of test items found by a generalised suffix automaton.

The items' words build the automaton; a document's words are streamed through it, and the length
of the longest run of item words ending at each place is tracked.  A run of `window` words is an
occurrence of a window; an item of fewer words is one window as a whole.  All words of occurring
windows are hit.  Neighbouring hit words form spans.

The benchmark is cut into blocks of at most `block_words` words, so an automaton has a bounded
size however large the benchmark is; each block is streamed against all documents, and the blocks'
hits are united per document.  One block, the usual case, needs no shuffle.

Null texts have no words.  Items without words match nothing; a null item_id counts hits, but is
no item in the lists; equal ids count once.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.automaton import SuffixAutomaton, known_runs
from realmwatch.llm.texts import map_texts, words

WINDOW = 13


class ItemMatcher:
    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        coded = []
        for item, text in items:
            if found := words(text):
                coded.append((item, [self.number.setdefault(w, len(self.number)) for w in found]))
        self.shortest = min([window, *(len(t) for _, t in coded)])
        self.automaton = SuffixAutomaton(t for _, t in coded)
        link, longest = self.automaton.link, self.automaton.longest
        # The state at which the last `window` words of a longer run are recognised.
        self.window_state = [0] * len(link)
        for state in sorted(range(len(link)), key=longest.__getitem__):
            if longest[state] >= window:
                self.window_state[state] = state if longest[link[state]] < window else self.window_state[link[state]]
        self.items: dict[int, set] = {}
        whole: dict[int, tuple[int, set]] = {}
        for item, text in coded:
            if len(text) < window:
                whole.setdefault(self.automaton.state_of(text), (len(text), set()))[1].add(item)
                continue
            for state, length in self.automaton.stream(text):
                if length >= window:
                    self.items.setdefault(self.window_state[state], set()).add(item)
        # Items of fewer words: those of each state and of its suffixes.
        self.whole: list[list[tuple[int, set]]] = [[] for _ in link]
        if whole:
            for state in sorted(range(1, len(link)), key=longest.__getitem__):
                own = [whole[state]] if state in whole else []
                self.whole[state] = own + self.whole[link[state]]

    def match(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """Words of the text, its hit spans and the items of which a window occurs."""
        file = words(text)
        get = self.number.get
        numbers = [get(w, -1) for w in file]
        spans: list[tuple[int, int]] = []
        hit: set = set()
        for start, stop in known_runs(numbers, self.shortest):
            for end, (state, length) in enumerate(self.automaton.stream(numbers[start:stop]), start + 1):
                covered = 0
                if length >= self.window:
                    covered = length
                    hit |= self.items[self.window_state[state]]
                for size, found in self.whole[state]:
                    if size <= length:
                        covered = max(covered, size)
                        hit |= found
                if covered:
                    first = end - covered
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, end))
        return len(file), spans, hit


_MATCHERS: dict[str, ItemMatcher] = {}

_SPAN = T.StructType([T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
_FIELDS = [
    T.StructField("__words", T.LongType()),
    T.StructField("__spans", T.ArrayType(_SPAN)),
    T.StructField("__items", T.ArrayType(T.StringType())),
]


def _match_block(docs: DataFrame, text: str, keep: list, block: list[tuple], window: int) -> DataFrame:
    """The documents streamed through the automaton of one block; the block has a bounded size."""
    sent = docs.sparkSession.sparkContext.broadcast((block, window))
    # A name of the matcher's own: addresses of dropped broadcasts are used again.
    name = uuid.uuid4().hex

    def rows(texts: list[str | None]) -> list[list]:
        if name not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[name] = ItemMatcher(*sent.value)
        found = [_MATCHERS[name].match(t) for t in texts]
        return [
            [n for n, _, _ in found],
            [[{"first_word": a, "end_word": b} for a, b in spans] for _, spans, _ in found],
            [sorted(i for i in items if i is not None) for _, _, items in found],
        ]

    return map_texts(docs, text, keep, rows, _FIELDS)


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_words: int) -> list[list[tuple]]:
    """Items in blocks of about `block_words` words; each block is fetched by itself."""
    rows = items.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    size = F.coalesce(F.length("t"), F.lit(0)) + 1
    total = rows.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // (6 * block_words)))
    if blocks == 1:
        return [[tuple(r) for r in rows.collect()]]
    dealt = rows.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    return [[(r.i, r.t) for r in dealt.where(F.col("b") == b).collect()] for b in range(blocks)]


def match_benchmark(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str | Column],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = 2_000_000,
) -> DataFrame:
    """`keep` columns of every document, n_words, n_hit, item_ids and `spans` (hit spans in words)."""
    blocks = item_blocks(items, item_col, item_text_col, block_words)
    if len(blocks) == 1:
        found = _match_block(docs, text_col, keep, blocks[0], window)
    else:
        # Equal rows get equal results, so the row itself, as a hash of id and text, is the key.
        names = [c if isinstance(c, str) else docs.select(c).columns[0] for c in keep]
        keyed = docs.select(F.col(text_col).alias("__t"), *keep)
        keyed = keyed.withColumn("__key", F.sha2(F.coalesce(F.col("__t").cast("string"), F.lit("")), 256))
        parts = [_match_block(keyed, "__t", ["__key"], block, window) for block in blocks]
        union = parts[0]
        for part in parts[1:]:
            union = union.unionAll(part)
        hits = (
            union.where(F.size("__spans") > 0)
            .groupBy("__key")
            .agg(
                F.flatten(F.collect_set("__spans")).alias("__spans"),
                F.array_distinct(F.flatten(F.collect_set("__items"))).alias("__items"),
            )
        )
        counted = map_texts(
            keyed, "__t", ["__key", *names], lambda texts: [[len(words(t)) for t in texts]], [_FIELDS[0]]
        )
        empty = F.array().cast(_FIELDS[1].dataType), F.array().cast(_FIELDS[2].dataType)
        found = counted.join(hits, "__key", "left").select(
            *names,
            "__words",
            _united(F.coalesce("__spans", empty[0])).alias("__spans"),
            F.coalesce("__items", empty[1]).alias("__items"),
        )
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    kept = [c for c in found.columns if c not in ("__words", "__spans", "__items")]
    return found.select(
        *kept,
        F.col("__words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.sort_array("__items").alias("item_ids"),
        F.col("__spans").alias("spans"),
    )


def _united(spans: Column) -> Column:
    """Overlapping or touching spans joined."""
    start = F.slice(F.sort_array(spans), 1, 0)

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(
            last["first_word"].alias("first_word"), F.greatest(last["end_word"], span["end_word"]).alias("end_word")
        )
        before = F.slice(done, 1, F.size(done) - 1)
        overlap = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end_word"] >= span["first_word"])
        return F.when(overlap, F.concat(before, F.array(joined))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.sort_array(spans), start, add)


def contamination(matched: DataFrame, least_share: int = 20) -> DataFrame:
    """Digests of the items and the decision: at least one word in `least_share` is hit."""
    return matched.select(
        *[c for c in matched.columns if c not in ("item_ids", "spans")],
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def digest(items: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
