"""Generalised suffix automaton over sequences of numbered tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence


class SuffixAutomaton:
    """Recognises every run of tokens that stands in one of the added sequences.

    State 0 is the empty run.  `steps[v]` maps a token to the next state, `longest[v]` is the
    length of the longest run of state v, `link[v]` the state of its longest suffix elsewhere.
    """

    def __init__(self, sequences: Iterable[Sequence[int]]) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.longest = [0]
        self.link = [-1]
        for sequence in sequences:
            last = 0
            for token in sequence:
                last = self._extend(last, token)

    def _new(self, steps: dict[int, int], longest: int, link: int) -> int:
        self.steps.append(steps)
        self.longest.append(longest)
        self.link.append(link)
        return len(self.steps) - 1

    def _split(self, parent: int, token: int) -> int:
        """The state of the longest run of `parent` with `token` after it, made its own if need be."""
        old = self.steps[parent][token]
        if self.longest[old] == self.longest[parent] + 1:
            return old
        new = self._new(dict(self.steps[old]), self.longest[parent] + 1, self.link[old])
        self.link[old] = new
        while parent >= 0 and self.steps[parent].get(token) == old:
            self.steps[parent][token] = new
            parent = self.link[parent]
        return new

    def _extend(self, last: int, token: int) -> int:
        if token in self.steps[last]:
            return self._split(last, token)
        state = self._new({}, self.longest[last] + 1, 0)
        at = last
        while at >= 0 and token not in self.steps[at]:
            self.steps[at][token] = state
            at = self.link[at]
        self.link[state] = 0 if at < 0 else self._split(at, token)
        return state

    def stream(self, tokens: Iterable[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: for each token, the state and length of the longest run that ends there."""
        steps, longest, link = self.steps, self.longest, self.link
        state = length = 0
        for token in tokens:
            to = steps[state].get(token)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = steps[state].get(token)
            if to is not None:
                state = to
                length += 1
            yield state, length

    def state_of(self, sequence: Sequence[int]) -> int:
        state = 0
        for token in sequence:
            state = self.steps[state][token]
        return state


def known_runs(numbers: list[int], least: int) -> Iterator[tuple[int, int]]:
    """Ranges of at least `least` numbers in a row that are not negative."""
    start = -1
    for at, number in enumerate(numbers):
        if number < 0:
            if start >= 0 and at - start >= least:
                yield start, at
            start = -1
        elif start < 0:
            start = at
    if start >= 0 and len(numbers) - start >= least:
        yield start, len(numbers)
