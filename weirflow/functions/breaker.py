"""Circuit-breaker steps on plain values: the small helpers that run inside Spark tasks.

A breaker is CLOSED with a count of failures in a row, OPEN since its last failure, or HALF_OPEN with
a count of trial successes.  A state is the pair (kind, value): the count, or the time of the failure.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

CLOSED, HALF_OPEN, OPEN = 0, 1, 2
NAMES = {CLOSED: "CLOSED", HALF_OPEN: "HALF_OPEN", OPEN: "OPEN"}
START = (CLOSED, 0)


@dataclass(frozen=True)
class BreakerSettings:
    failure_threshold: int = 5
    open_ms: int = 60_000
    success_threshold: int = 3


SERVICE_BREAKER = BreakerSettings()
TOPIC_BREAKER = BreakerSettings(open_ms=30_000)


def step(state: tuple[int, int], at: int, failed: bool, trips: bool, s: BreakerSettings) -> tuple[tuple[int, int], bool]:
    """The state after one call and whether the call was let through.

    ``trips`` says whether a failure is of a kind that may open a closed breaker.
    """
    kind, value = state
    if kind == OPEN:
        if at - value <= s.open_ms:
            return state, False
        kind, value = HALF_OPEN, 0
    if kind == HALF_OPEN:
        if failed:
            return (OPEN, at), True
        return ((CLOSED, 0) if value + 1 >= s.success_threshold else (HALF_OPEN, value + 1)), True
    if not failed:
        return (CLOSED, 0), True
    count = min(value + 1, s.failure_threshold)
    return ((OPEN, at) if trips and count >= s.failure_threshold else (CLOSED, count)), True


def counted_states(s: BreakerSettings) -> list[tuple[int, int]]:
    """All states except OPEN; there are few, which is what makes summaries of a stretch small."""
    return [(CLOSED, n) for n in range(s.failure_threshold + 1)] + [(HALF_OPEN, n) for n in range(s.success_threshold)]


def summarise(at: list[int], failed: list[bool], trips: list[bool], s: BreakerSettings):
    """What a stretch of calls in time order does to *any* state before it.

    Returns the end state for every counted state, and for OPEN a list of (limit, end state): the
    first limit above the time of the failure applies; above all limits the breaker stays open.
    """
    n = len(at)
    states = counted_states(s)
    index = {state: i for i, state in enumerate(states)}
    half = index[(HALF_OPEN, 0)]
    ends = list(states)  # end states when starting before call i; here i = n
    from_half: list[tuple[int, int]] = [None] * n  # end state when half-open before call i
    for i in range(n - 1, -1, -1):
        # A breaker that opens at call i wakes at the first call after its waiting time.
        wake = bisect_right(at, at[i] + s.open_ms, i + 1)
        opened = from_half[wake] if wake < n else (OPEN, at[i])
        now = []
        for state in states:
            after, _ = step(state, at[i], failed[i], trips[i], s)
            now.append(opened if after[0] == OPEN else ends[index[after]])
        ends = now
        from_half[i] = ends[half]
    waking: list[tuple[int, tuple[int, int]]] = []
    last = min(bisect_right(at, at[0] + s.open_ms), n - 1) if n else -1
    for i in range(last + 1):
        limit = at[i] - s.open_ms
        if waking and (waking[-1][1] == from_half[i] or waking[-1][0] == limit):
            if waking[-1][0] != limit:
                waking[-1] = (limit, from_half[i])
        else:
            waking.append((limit, from_half[i]))
    return ends, waking


def apply_summary(state: tuple[int, int], ends, waking, s: BreakerSettings) -> tuple[int, int]:
    """The state after a summarised stretch."""
    if state[0] != OPEN:
        return ends[counted_states(s).index(state)]
    for limit, end in waking:
        if state[1] < limit:
            return end
    return state
