"""Periodic runs: stretches of words that repeat with a period, found by their Lyndon roots.

A run is a longest stretch of words whose smallest period q fits into it at least `least_exponent`
times, and which has at least `least_words` words.  Every run holds, in one of the two orders of
its words, a root that is the longest Lyndon word starting at its place; so there are two candidates
for each place, the stretches up to the next smaller suffix.  A candidate is extended in both
directions by longest common extensions, read from the suffix trees of the words and of their
reversal (`suffix_tree`), and what is long enough is a run.

Trees are built only where a run can be.  A run of at least `least_words` words, three periods long,
repeats each of its strings of a few words (`_GRAM`) inside itself, so it lies in a stretch in which
the string at every place occurs elsewhere in the text as well; such stretches are found by hashing
all strings, and a collision only makes one longer.  Texts without repeats need no tree at all.

Words are `[^\\x20\\x09-\\x0D]+`, as they are.  Null, empty and blank texts have no words and no run.
Very long texts are read whole; memory is some hundred bytes for every word of a repeating
stretch.  Of runs with the same exponent the first start counts, then the smallest period.  Repeated
rows get results of their own, an empty table an empty result; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.suffix_tree import SuffixTree
from realmwatch.llm.texts import map_texts, to_bytes

LEAST_WORDS, LEAST_EXPONENT = 24, 3
# Strings that every run repeats inside itself: 24 words and three periods hold a string of eight
# and its copy a period on, to one side or the other (2q + 7 is at most 24 and 3q for q up to 8, and
# at most 3q beyond).
_GRAM = 8
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Run(NamedTuple):
    start: int
    length: int
    period: int


def file_words(text: str | None) -> list[bytes]:
    return to_bytes(text).split()


def numbered(file: Sequence[bytes]) -> np.ndarray:
    """Words as numbers from 1, in order of first use."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in file), np.int64, len(file))


def _gram_of(least_words: int, least_exponent: int) -> int:
    """The longest string, of 1, 2, 4 or 8 words, that such runs repeat inside themselves.

    A string and its copy a period q away, to either side, need 2q + gram - 1 words at most.
    """
    if least_exponent < 2 or least_words < 2:
        raise ValueError("a run has at least two words and two periods")
    gram = _GRAM
    while gram > 1 and any(
        2 * q + gram - 1 > max(least_words, least_exponent * q) for q in range(1, least_words + gram)
    ):
        gram //= 2
    return gram


def repeating_stretches(numbers: np.ndarray, gram: int, least_words: int) -> list[tuple[int, int]]:
    """Stretches in which the string of `gram` words at every place occurs more than once in the text."""
    if len(numbers) < least_words:
        return []
    hashed, size, turn = numbers.astype(np.uint64), 1, 0
    with np.errstate(over="ignore"):
        while size < gram:
            hashed = hashed[:-size] * np.uint64(_MIX[turn]) + (hashed[size:] ^ (hashed[size:] >> np.uint64(29)))
            size, turn = 2 * size, turn + 1
    order = np.argsort(hashed, kind="stable")
    same = hashed[order[1:]] == hashed[order[:-1]]
    if not same.any():
        return []
    repeated = np.zeros(len(hashed) + 2, np.int8)
    repeated[order[1:][same] + 1] = 1
    repeated[order[:-1][same] + 1] = 1
    edge = np.diff(repeated)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(a, b + gram - 1) for a, b in zip(starts.tolist(), stops.tolist(), strict=True) if b - a + gram > least_words]


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix the place of the next one that is smaller; the end, where there is none."""
    ranks = rank.tolist()
    found = [len(ranks)] * len(ranks)
    stack: list[int] = []
    for place in range(len(ranks) - 1, -1, -1):
        own = ranks[place]
        while stack and ranks[stack[-1]] > own:
            stack.pop()
        if stack:
            found[place] = stack[-1]
        stack.append(place)
    return np.array(found, np.int64)


def stretch_runs(numbers: np.ndarray, least_words: int, least_exponent: int) -> np.ndarray:
    """Runs of one stretch: rows of start, length, period."""
    total = len(numbers)
    values, dense = np.unique(numbers, return_inverse=True)
    dense = dense + 1
    tree = SuffixTree(dense.tolist(), len(values))
    back = SuffixTree(dense[::-1].tolist(), len(values))
    starts = np.arange(total)
    parts = []
    for rank in (tree.rank, tree.reverse_rank()):
        # the end mark is the smallest suffix: the last Lyndon words end at it
        root_end = np.minimum(_next_smaller(rank)[:total], total)
        period = root_end - starts
        forth = np.zeros(total, np.int64)
        inside = root_end < total
        forth[inside] = tree.common(starts[inside], root_end[inside])
        # prefixes that end before the root and at its last word, as suffixes of the reversal
        behind = np.zeros(total, np.int64)
        behind[1:] = back.common(total - starts[1:], total - root_end[1:])
        parts.append(np.stack([starts - behind, behind + period + forth, period], axis=1))
    found = np.concatenate(parts)
    long = (found[:, 1] >= least_words) & (found[:, 1] >= least_exponent * found[:, 2])
    return np.unique(found[long], axis=0)


def find_runs(
    file: Sequence[bytes], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT
) -> list[Run]:
    """All runs of a text's words, by start, then period."""
    if len(file) < least_words:
        return []
    numbers = numbered(file)
    found = []
    for first, last in repeating_stretches(numbers, _gram_of(least_words, least_exponent), least_words):
        for start, length, period in stretch_runs(numbers[first:last], least_words, least_exponent).tolist():
            found.append(Run(start + first, length, period))
    return sorted(found, key=lambda r: (r.start, r.period))


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run of the greatest exponent; of equal ones the first, then the one of smallest period."""
    best = None
    for run in runs:
        if best is None:
            best = run
            continue
        more = run.length * best.period - best.length * run.period
        if more > 0 or (more == 0 and (run.start, run.period) < (best.start, best.period)):
            best = run
    return best


def collapsed(file: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that a run holds beyond its first period."""
    if not runs:
        return list(file)
    depth = np.zeros(len(file) + 1, np.int64)
    for run in runs:
        depth[run.start + run.period] += 1
        depth[run.start + run.length] -= 1
    return [file[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in Run._fields])


def detect_runs(
    docs: DataFrame,
    keep: list[str | Column],
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """`keep` columns of every row, `n_words`, its `runs` by start and period, and `collapsed`, the text's
    kept words joined by one space."""
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("collapsed", T.StringType()),
    ]

    def rows(texts: list[str | None]) -> list[list]:
        made: list[list] = [[], [], []]
        for text in texts:
            file = file_words(text)
            runs = find_runs(file, least_words, least_exponent)
            made[0].append(len(file))
            made[1].append([r._asdict() for r in runs])
            made[2].append(b" ".join(collapsed(file, runs)).decode("utf-8", "surrogatepass"))
        return made

    return map_texts(docs, text_col, keep, rows, fields)


def run_digest(runs: Sequence[Run]) -> str:
    return hashlib.sha256("".join(f"{r.start},{r.length},{r.period}\n" for r in runs).encode()).hexdigest()


def run_report(detected: DataFrame) -> DataFrame:
    """The strongest run of every row, and digests of its runs and of its collapsed text."""
    runs = F.col("runs")

    def exceeds(run: Column, best: Column) -> Column:
        # exact: lengths and periods are below 2^31
        return run["length"] * best["period"] > best["length"] * run["period"]

    # runs come by start and period, so among equal ones the first stays
    best = F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(exceeds(run, best), run).otherwise(best),
    )
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    kept = [c for c in detected.columns if c not in ("runs", "collapsed", "n_words")]
    return detected.select(
        *kept,
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(F.lit(1000) * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with a tenth of the texts made periodic from some word on, picked and shaped by the id's crc32.

    The row whose crc32 is h is one of them when 10 divides h; with g = h / 10 its words from a = g % n on
    repeat the first 1 + (n - a) / (3 + g % 8) of them.  Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    file = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # exploded, so that the words are split off once and not once for each use
    with_words = base.select(
        "id", "text", (F.col("h") / 10).cast("long").alias("g"),
        F.explode(F.array(F.when(chosen, file))).alias("w"),
    )
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    period = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, period), times)), F.lit(1), n - a)
    made = F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")
    return with_words.select(
        F.col("id").alias(id_col),
        F.when(F.col("w").isNull(), F.col("text")).otherwise(made).alias(text_col),
    )
