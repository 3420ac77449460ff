"""Spans (kind, start, end) found in texts, and their digests."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence

from rollcall.llm.support import by_value

by_value(__name__)

Span = tuple[str, int, int]


def ordered(spans: Sequence[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then by the kind's place in ``kinds``."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: Sequence[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def covered(base: list[Span]) -> list[tuple[int, int]]:
    """The ranges that spans, in order of their starts, cover together."""
    out: list[tuple[int, int]] = []
    for _, a, b in base:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def free(start: int, end: int, taken: Sequence[tuple[int, int]]) -> bool:
    """Whether no range of ``taken``, which ``covered`` has made, overlaps [start, end)."""
    i = bisect_left(taken, (end,))
    return not i or taken[i - 1][1] <= start


def replaced(text: str, spans: Sequence[Span], mark: str = "<{}>") -> str:
    """The text with each span, or run of overlapping ones, as a mark of its first kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < b:
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], mark.format(kind.upper())]
        at = b
    return "".join([*out, text[at:]])
