"""Overlaps of spans without comparing each with each."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable
from itertools import accumulate


def touching(spans: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span (start, end) shares a place with any of these, which may overlap each other."""
    found = sorted(spans)
    starts, reach = [s for s, _ in found], list(accumulate((e for _, e in found), max))

    def touches(start: int, end: int) -> bool:
        at = bisect_left(starts, end)
        return at > 0 and reach[at - 1] > start

    return touches


def first_apart(spans: Iterable[tuple]) -> list[tuple]:
    """Of spans (start, end, ...) those that touch none kept before, in the order given; none is empty."""
    starts: list[int] = []
    kept: list[tuple] = []
    ends: dict[int, int] = {}
    for span in spans:
        start, end = span[:2]
        at = bisect_left(starts, end)
        if at == 0 or ends[starts[at - 1]] <= start:
            starts.insert(at, start)
            ends[start] = end
            kept.append(span)
    return kept
