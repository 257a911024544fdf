"""Exact token counts of a byte-level BPE vocabulary by finite-state transducers.

Two deterministic transducers are compiled.  The first reads character classes and marks where
the pattern of the pre-tokenizer starts a new piece.  A batch's texts are laid end to end and cut
into chunks; for every chunk the map from each entry state to its exit state is computed for
all chunks at once, the maps are composed by a parallel prefix scan, and a second pass marks the
pieces from the entry states so found.  The second reads the bytes of a piece and annotates each
transition with the change of the token count.  Its states hold, for every position at which a
later token may still begin, the last token and the count there; they are made when first met.

Semantics: null is empty; a special string inside a text is one token and splits the text; there
are no begin or end tokens, no truncation and no padding.  Repeated rows each give their row.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from realmwatch.llm.texts import map_texts

# Character classes.
LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, ONE, TWO_E, ELL, E, END = range(11)
# States: what the current piece is; a *_1 state is a single blank, *_N a longer run of them.
FRESH, LETTERS, NUMBERS, OTHERS, SPACE_1, BLANK_1, SPACE_N, BLANK_N, QUOTED, QUOTED_RV, QUOTED_L = range(11)
# Emissions: a piece starts at this character, at the one before it.
HERE, BEFORE = 1, 2
_CHUNK, _PART = 64, 4_000_000
_NO = -1


def _piece_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state * 11 + class, for the pattern
    `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`."""
    letters = {LETTER, ONE, TWO_E, ELL, E}
    opens = dict.fromkeys(letters, LETTERS) | {
        NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: QUOTED, SPACE: SPACE_1, BLANK: BLANK_1, END: FRESH
    }
    joins = {c: OTHERS if c == QUOTE else s for c, s in opens.items() if c not in (SPACE, BLANK, END)}
    blanks = {SPACE: SPACE_N, BLANK: BLANK_N}
    goes = {
        FRESH: {},
        LETTERS: {c: (LETTERS, 0) for c in letters},
        NUMBERS: {NUMBER: (NUMBERS, 0)},
        OTHERS: {c: (OTHERS, 0) for c in (OTHER, QUOTE)},
        SPACE_1: {c: (s, 0) for c, s in (joins | blanks).items()},
        BLANK_1: {c: (s, 0) for c, s in blanks.items()},
        SPACE_N: {c: (s, BEFORE) for c, s in joins.items()} | {c: (s, 0) for c, s in blanks.items()},
        BLANK_N: {c: (opens[c], BEFORE | HERE) for c in joins} | {c: (s, 0) for c, s in blanks.items()},
        QUOTED: {ONE: (FRESH, 0), TWO_E: (QUOTED_RV, 0), ELL: (QUOTED_L, 0), OTHER: (OTHERS, 0), QUOTE: (OTHERS, 0)},
    }
    for state, second in ((QUOTED_RV, E), (QUOTED_L, ELL)):
        goes[state] = {c: (s, BEFORE | HERE) for c, s in opens.items()} | {c: (LETTERS, BEFORE) for c in letters}
        goes[state][second] = (FRESH, 0)
    to, out = np.zeros(121, np.uint8), np.zeros(121, np.uint8)
    for state, known in goes.items():
        for c, opened in opens.items():
            to[state * 11 + c], out[state * 11 + c] = known.get(c, (opened, HERE))
    return to, out


def _class_table() -> np.ndarray:
    """Class of every code point; the last entry stands for the end of a text."""
    kinds = np.full(0x110001, OTHER, np.uint8)
    unassigned = []
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        if category == "Cn":
            unassigned.append(code)
        if category[0] == "L":
            kinds[code] = LETTER
        elif category[0] == "N":
            kinds[code] = NUMBER
        elif category[0] == "Z" or 9 <= code <= 13 or code == 0x85:
            kinds[code] = BLANK
    pieces = ByteLevel(add_prefix_space=False, use_regex=True)

    def assign(codes: list[int]) -> None:
        """Code points that the library's Unicode tables may know and Python's do not."""
        run = "".join(map(chr, codes))
        if len(pieces.pre_tokenize_str("!" + run)) == 1:
            return
        for kind, before in ((LETTER, "a"), (NUMBER, "1")):
            if len(pieces.pre_tokenize_str(before + run)) == 1:
                kinds[codes] = kind
                return
        if len(codes) > 1:
            assign(codes[: len(codes) // 2])
            assign(codes[len(codes) // 2 :])

    for at in range(0, len(unassigned), 512):
        assign(unassigned[at : at + 512])
    for kind, chars in ((SPACE, " "), (QUOTE, "'"), (ONE, "stmd"), (TWO_E, "rv"), (ELL, "l"), (E, "e")):
        for c in chars:
            kinds[ord(c)] = kind
    kinds[0x110000] = END
    return kinds


def piece_starts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Marks of the code points at which a piece starts; `codes` ends with an end mark."""
    to, out = _PIECES
    n = len(codes)
    rows = -(-n // _CHUNK)
    classes = np.full(rows * _CHUNK, END, np.uint8)
    np.take(kinds, codes, out=classes[:n])
    columns = np.ascontiguousarray(classes.reshape(rows, _CHUNK).T)
    maps = np.tile(np.arange(11, dtype=np.uint8)[:, None], (1, rows))
    for column in columns:
        maps = np.take(to, maps * np.uint8(11) + column)
    step = 1
    while step < rows:  # maps[:, i] becomes the map of all chunks up to i
        maps = np.concatenate([maps[:, :step], np.take_along_axis(maps[:, step:], maps[:, :-step], 0)], axis=1)
        step *= 2
    state = np.concatenate([np.array([FRESH], np.uint8), maps[FRESH, :-1]])
    marks = np.empty_like(columns)
    for column, mark in zip(columns, marks, strict=True):
        at = state * np.uint8(11) + column
        np.take(out, at, out=mark)
        state = np.take(to, at)
    flat = np.ascontiguousarray(marks.T).ravel()
    starts = (flat & HERE).astype(bool)
    starts[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return starts[:n]


_PIECES = _piece_table()


class PieceTransducer:
    """Counts the BPE tokens of pieces; transitions are compiled when first needed.

    By the theory of BPE on prefixes, the last token of a prefix is the longest token ending
    there that stays next to the last token of what comes before it when both are encoded together.
    """

    def __init__(self, tokens: dict[bytes, int], merges: dict[tuple[int, int], tuple[int, int]], most: int = 200_000):
        self.merges, self.most = merges, most
        self.bytes_of = {i: b for b, i in tokens.items()}
        self.single = [tokens[bytes([b])] for b in range(256)]
        self.near: dict[tuple[int, int], bool] = {}
        children: list[dict[int, int]] = [{}]
        self.token, self.depth = [_NO], [0]
        for text, number in tokens.items():
            node = 0
            for b in text:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    self.token.append(_NO)
                    self.depth.append(self.depth[node] + 1)
                node = children[node][b]
            if self.encode(text) == [number]:
                self.token[node] = number
        self.children = children
        self.suffix = [0] * len(children)
        queue = list(children[0].values())
        for node in queue:
            for b, child in children[node].items():
                self.suffix[child] = self._goto(self.suffix[node], b)
                queue.append(child)
        # How far back a token that is not complete yet may have begun, by node.
        self.open: list[tuple[int, ...]] = [()] * len(children)
        for node in queue:
            own = (self.depth[node],) if children[node] else ()
            self.open[node] = own + self.open[self.suffix[node]]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.column = np.full(256, _NO, np.int64)  # only bytes that were met have a column
        self.width = 0
        self.to = np.full((0, 128), _NO, np.int32)
        self.change = np.zeros((0, 128), np.int8)
        self._state(0, [(0, _NO, 0)])

    def _goto(self, node: int, b: int) -> int:
        while b not in self.children[node]:
            if not node:
                return 0
            node = self.suffix[node]
        return self.children[node][b]

    def encode(self, text: bytes) -> list[int]:
        """Plain BPE: merge the pair of lowest rank, leftmost first, until none is left."""
        parts = [self.single[b] for b in text]
        while len(parts) > 1:
            found = [(m[0], i, m[1]) for i in range(len(parts) - 1) if (m := self.merges.get((parts[i], parts[i + 1])))]
            if not found:
                break
            _, i, merged = min(found)
            parts[i : i + 2] = [merged]
        return parts

    def _stay(self, left: int, right: int) -> bool:
        key = (left, right)
        if (known := self.near.get(key)) is None:
            known = self.near[key] = self.encode(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def _state(self, node: int, past: list[tuple[int, int, int]]) -> int:
        """`past`: how far back, the last token there, and the tokens since then."""
        key = array("i", [node, *(x for entry in past for x in entry)]).tobytes()
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            if len(self.states) > len(self.to):
                more = (16_384, self.to.shape[1])
                self.to = np.concatenate([self.to, np.full(more, _NO, np.int32)])
                self.change = np.concatenate([self.change, np.zeros(more, np.int8)])
        return self.number[key]

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """The table's column of each byte."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.column[b] == _NO:
                self.column[b] = self.width
                self.width += 1
        if self.width > self.to.shape[1]:
            more = ((0, 0), (0, 256 - self.to.shape[1]))
            self.to = np.pad(self.to, more, constant_values=_NO)
            self.change = np.pad(self.change, more)
        return self.column[data]

    def _compile(self, state: int, b: int) -> None:
        node, *flat = array("i", self.states[state])
        past = {flat[i]: (flat[i + 1], flat[i + 2]) for i in range(0, len(flat), 3)}
        node = self._goto(node, b)
        at = node
        while True:  # the longest token that ends here and leaves what precedes it as it was
            token = self.token[at]
            if token != _NO:
                before, since = past[self.depth[at] - 1]
                if before == _NO or self._stay(before, token):
                    break
            at = self.suffix[at]
        change = 1 - since
        held = [(k, past[k - 1][0], past[k - 1][1] + change) for k in self.open[node]]
        to = self._state(node, [(0, token, 0), *held])
        column = self.column[b]
        self.to[state, column], self.change[state, column] = to, change

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece `data[start:start + length]`; lengths are positive."""
        if len(self.states) > self.most:  # bounded memory: compile afresh
            self._forget()
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        columns = self._columns(data)
        active = len(starts) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), "right")
        state = np.zeros(len(starts), np.int64)
        count = np.zeros(len(starts), np.int64)
        for at, m in enumerate(active.tolist()):
            where = state[:m] * self.to.shape[1] + columns[starts[:m] + at]
            nxt = self.to.ravel()[where]
            if (nxt < 0).any():
                byte_of = np.argsort(self.column)[-self.width :]
                for key in np.unique(where[nxt < 0]).tolist():
                    held, column = divmod(key, self.to.shape[1])
                    self._compile(held, int(byte_of[column]))
                nxt = self.to.ravel()[where]
            count[:m] += self.change.ravel()[where]
            state[:m] = nxt
        result = np.empty_like(count)
        result[order] = count
        return result


class TextCounter:
    """Token counts of whole texts under a tokenizer file of byte-level BPE."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        self.special = [t["content"] for t in spec["added_tokens"]]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.pieces = PieceTransducer({bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()}, merges)
        self.kinds = _class_table()

    def _split(self, text: str) -> list[str]:
        parts = [text]
        for special in self.special:
            parts = [p for part in parts for p in part.split(special)]
        return parts

    def count(self, texts: Iterable[str | None]) -> list[tuple[int, int]]:
        """Bytes and tokens of each text."""
        texts = list(texts)
        n_bytes, n_tokens = [0] * len(texts), np.zeros(len(texts), np.int64)
        part, owner, held = [], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            pieces = self._split(text) if any(s in text for s in self.special) else [text]
            n_tokens[i] += len(pieces) - 1
            n_bytes[i] = len(text.encode())
            part += pieces
            owner += [i] * len(pieces)
            held += len(text)
            if held >= _PART:
                self._count(part, owner, n_tokens)
                part, owner, held = [], [], 0
        self._count(part, owner, n_tokens)
        return list(zip(n_bytes, n_tokens.tolist(), strict=True))

    def _count(self, part: list[str], owner: list[int], n_tokens: np.ndarray) -> None:
        if not part:
            return
        end = np.array([0x110000], np.uint32)
        codes = np.concatenate([x for t in part for x in (np.frombuffer(t.encode("utf-32-le"), np.uint32), end)])
        data = np.frombuffer("\n".join(part).encode() + b"\n", np.uint8)  # the end mark takes a byte as well
        size = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + ((codes > 0xFFFF) & (codes < 0x110000))
        size[codes == 0x110000] = 1
        marks = np.flatnonzero(piece_starts(codes, self.kinds))
        offset = np.cumsum(size) - size
        text_of = np.cumsum(codes == 0x110000)
        real = codes[marks] != 0x110000
        bounds = np.append(offset[marks], len(data))
        starts, lengths = bounds[:-1][real], np.diff(bounds)[real]
        counts = self.pieces.counts(data, starts, lengths)
        np.add.at(n_tokens, np.asarray(owner)[text_of[marks[real]]], counts)


_COUNTERS: dict[str, TextCounter] = {}


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """`id_col`, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row.

    `tokenizer` is the path of a byte-level BPE tokenizer file on the driver; its text, of a fixed
    size that no table changes, is sent to the executors.
    """
    with open(tokenizer, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def rows(texts: list[str | None]) -> list[list]:
        if source.value not in _COUNTERS:
            _COUNTERS[source.value] = TextCounter(source.value)
        counted = _COUNTERS[source.value].count(texts)
        return [[b for b, _ in counted], [n for _, n in counted], [n > limit for _, n in counted]]

    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
    return map_texts(docs, text_col, [id_col], rows, fields)
