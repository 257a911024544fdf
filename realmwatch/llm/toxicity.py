"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A window is one word, set between marks and fixed text that both dictionaries hold, so that its
compressed length is the cost of the word alone.  The distance of a window is its length
under the ordinary dictionary less that under the toxic one.  The toxic dictionary holds the
segments, from the start of a word, that toxic training texts use far more often than ordinary
ones (lower bound of the log ratio of document frequencies); the ordinary dictionary holds as
many bytes of the commonest ordinary words.  A text is described by how many of its windows pass
each distance threshold; a logistic fit on training rows that no dictionary saw calibrates them.

Training reads a bounded sample: at most `sample_rows` labelled rows of each label, taken by a hash
of the id, of at most `sample_chars` characters each.  Scoring reads every text whole.  A score is
made from the text alone.  Null texts are empty; rows without an id count as the id "".  If
a label has no training row, nothing can be learned and all scores are 0.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from realmwatch.llm.texts import map_texts, words

_START, _STOP = b"\x01\x01", b"\x02"
_BEFORE, _AFTER = bytes(range(128, 160)), bytes(range(160, 184))  # not UTF-8: no text holds them
_THRESHOLDS = np.array([1, 2, 3, 4, 5, 6, 8])
_CACHE = 300_000


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


class WindowDistance:
    """Compressed length of a word under the ordinary dictionary less that under the toxic one."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.compressors = []
        parameters = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, window_log=13, hash_log=13, chain_log=13, search_log=6,
            min_match=6, target_length=64, strategy=zstandard.STRATEGY_LAZY2,
            write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        for content in (ordinary, toxic):
            made = zstandard.ZstdCompressionDict(content + _BEFORE + _AFTER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(compression_params=parameters)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=made, compression_params=parameters))
        self.known: dict[bytes, int] = {}

    def _measure(self, word: bytes) -> int:
        window = _BEFORE + _START + word + _STOP + _AFTER
        ordinary, toxic = (len(c.compress(window)) for c in self.compressors)
        return ordinary - toxic

    def features(self, text: list[bytes]) -> np.ndarray:
        if len(self.known) > _CACHE:
            self.known.clear()
        known = self.known
        found = []
        for word in text:
            distance = known.get(word)
            if distance is None:
                distance = known[word] = self._measure(word)
            if distance > 0:
                found.append(distance)
        passed = (np.array(found, np.int64)[:, None] >= _THRESHOLDS).sum(0)
        size = len(text) + 1
        return np.array([1, *np.log1p(passed), math.log1p(size), *np.log1p(1000 * passed[[2, 4]] / size)])


def _prefixes(text: list[bytes], most: int = 12) -> set[bytes]:
    return {x[:k] for x in (w + _STOP for w in set(text)) for k in range(4, min(len(x), most) + 1)}


def _segments(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """Word beginnings that tell toxic from ordinary texts, the most frequent last."""
    seen, usual = Counter(), Counter()
    for counts, texts in ((seen, toxic), (usual, ordinary)):
        for text in texts:
            counts.update(_prefixes(text))

    def bound(g: bytes) -> float:
        ratio = math.log(seen[g] / len(toxic)) - math.log((usual[g] + 0.5) / len(ordinary))
        return ratio - 2 * math.sqrt(1 / seen[g] + 1 / (usual[g] + 0.5))

    telling = {g: b for g, n in seen.items() if n >= 5 and (b := bound(g)) > math.log(3)}
    chosen: set[bytes] = set()
    for g in sorted(telling, key=lambda g: (len(g), g)):
        if any(telling.get(g[:k], -math.inf) >= telling[g] - 0.5 for k in range(4, len(g))):
            continue  # its beginning tells as much
        longer: bytes | None = g
        while longer:  # nearly all its uses go on in the same way
            g = longer
            longer = next((h for c in range(256) if seen[h := g + bytes([c])] >= 0.85 * seen[g]), None)
        chosen.add(g)
    return sorted(chosen, key=lambda g: (seen[g], g))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.001) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = ridge * len(y) * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-9 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
    return w


def train(toxic: list[str], ordinary: list[str], dictionary_bytes: int = 4000) -> ToxicityModel | None:
    """A model from labelled texts; equal texts count once.  None if a label has too few of them."""
    sides = [[words(t) for t in sorted(set(texts))] for texts in (toxic, ordinary)]
    if min(map(len, sides)) < 3:
        return None
    learn = [[t for i, t in enumerate(texts) if i % 3] for texts in sides]
    check = [[t for i, t in enumerate(texts) if not i % 3] for texts in sides]
    segments = _segments(*learn)
    content = b"".join(_START + g for g in segments)[-dictionary_bytes:]
    common = Counter(w for text in learn[1] for w in text)
    ranked = sorted(common, key=lambda w: (common[w], w))[-3000:]
    filling = b"".join(_START + w + _STOP for w in ranked)[-max(len(content), 2000) :]
    distance = WindowDistance(content, filling)
    x = np.array([distance.features(t) for texts in check for t in texts])
    y = np.array([1.0] * len(check[0]) + [0.0] * len(check[1]))
    return ToxicityModel(content, filling, tuple(_logistic(x, y)))


def held_out(id_col: str, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 2000,
    sample_chars: int = 20_000,
) -> ToxicityModel | None:
    """Learn from labelled rows that are not held out; see the module's text for the bounds."""
    known = (
        labels.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max(label_col).alias("__label"))
    )
    order = [F.xxhash64("__id"), F.col("__id")]
    chosen = [known.where(F.col("__label") == v).orderBy(*order).limit(sample_rows) for v in (1, 0)]
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).where(
        F.length("__text") <= sample_chars
    )
    # At most 2 * sample_rows ids are sent to the tasks, and as many texts come back.
    sample = texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "__id").select("__label", "__text").collect()
    return train(*([r["__text"] for r in sample if r["__label"] == v] for v in (1, 0)))


_LOADED: dict[ToxicityModel, WindowDistance] = {}


def score_texts(texts: list[str | None], model: ToxicityModel | None) -> list[float]:
    if model is None:
        return [0.0] * len(texts)
    if model not in _LOADED:
        _LOADED.clear()
        _LOADED[model] = WindowDistance(model.toxic, model.ordinary)
    distance, weights = _LOADED[model], np.array(model.weights)
    return [float(1 / (1 + np.exp(-np.clip(distance.features(words(t)) @ weights, -30, 30)))) for t in texts]


def score_toxicity(
    docs: DataFrame, model: ToxicityModel | None, keep: list[str | Column], text_col: str = "text", name: str = "score"
) -> DataFrame:
    """`keep` columns and the score of every row; the model has a fixed size of a few kilobytes."""
    return map_texts(
        docs, text_col, keep, lambda texts: [score_texts(texts, model)], [T.StructField(name, T.DoubleType())]
    )
