"""States that pass through chunks of a key, as step functions of one number.

What a chunk does to the state it starts from is kept as a function: sorted cuts, and per piece between cuts the state
it ends in, or that it hands the state on. Functions of consecutive chunks are composed in groups of ``WIDTH`` up to
one per key, then start states are handed down the same way, so the start of every chunk is known after
``log(chunks)`` steps over tables of functions and no step over rows.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column

WIDTH = 8
MOST_PIECES = 4_000_000  # beyond it a function counts as unknown: its followers start from the initial state


@dataclass(frozen=True)
class Steps:
    """Piece i holds for states from ``cuts[i - 1]`` to below ``cuts[i]``: the end state ``outs[i]``, none of it
    where ``null[i]``, or the state itself where ``keep[i]``. ``none`` is what follows if there is no state."""

    cuts: np.ndarray
    outs: np.ndarray
    keep: np.ndarray
    null: np.ndarray
    none: float | int | None

    def __call__(self, state):
        if state is None:
            return self.none
        i = int(np.searchsorted(self.cuts, state, "right"))
        if self.keep[i]:
            return state
        return None if self.null[i] else self.outs[i].item()

    def then(self, after: Steps) -> Steps:
        """The function of this chunk and the one after it."""
        at = np.searchsorted(self.cuts, after.cuts, "right")
        cuts = np.union1d(self.cuts, after.cuts[self.keep[at]])
        # each piece is looked up at its left end; the first piece has none and is the first of both
        mine = np.concatenate(([0], np.searchsorted(self.cuts, cuts, "right")))
        keep, null, outs = self.keep[mine], self.null[mine], self.outs[mine]
        theirs = np.where(keep, np.concatenate(([0], np.searchsorted(after.cuts, cuts, "right"))),
                          np.searchsorted(after.cuts, outs, "right"))
        stays = after.keep[theirs] & ~null
        new_null = np.where(null, after.none is None, after.null[theirs] & ~stays)
        fixed = np.where(stays, outs, after.outs[theirs])
        if after.none is not None:
            fixed = np.where(null, np.asarray(after.none, outs.dtype), fixed)
        return Steps(cuts, fixed, keep & stays, new_null, after(self.none)).merged()

    def merged(self) -> Steps:
        """Neighbouring pieces that do the same become one."""
        outs = np.where(self.keep | self.null, np.zeros(1, self.outs.dtype), self.outs)
        new = (outs[1:] != outs[:-1]) | (self.keep[1:] != self.keep[:-1]) | (self.null[1:] != self.null[:-1])
        first = np.concatenate(([True], new))
        return Steps(self.cuts[new], outs[first], self.keep[first], self.null[first], self.none)

    def dump(self) -> bytes:
        out = io.BytesIO()
        none = np.array([] if self.none is None else [self.none], self.outs.dtype)
        np.savez(out, cuts=self.cuts, outs=self.outs, keep=self.keep, null=self.null, none=none)
        return out.getvalue()

    @staticmethod
    def load(body: bytes) -> Steps:
        with np.load(io.BytesIO(body)) as a:
            none = a["none"]
            return Steps(a["cuts"], a["outs"], a["keep"], a["null"], none[0].item() if len(none) else None)


@dataclass(frozen=True)
class Moves:
    """How a machine's chunks act on its state field ``state``: ``function(columns, before)`` for a chunk's rows.

    ``context`` are aggregates of a chunk whose values are handed to the next chunk as ``before`` (empty for the
    first one); ``given`` names state fields that equal one of them, whatever the rest of the past.
    """

    state: str
    function: Callable[[dict[str, np.ndarray], dict], Steps]
    context: dict[str, Column] = field(default_factory=dict)
    given: dict[str, str] = field(default_factory=dict)


def ends_of(successor: np.ndarray) -> np.ndarray:
    """The last place on the way from each place along ``successor`` (itself where the way ends), by doubling."""
    reach = successor
    while True:
        further = reach[reach]
        if (further == reach).all():
            return reach
        reach = further


def first_outside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each row the first later row whose value is above ``high`` or below ``low`` of that row, else ``len(x)``.

    Blocks of 2, 4, 8 … rows know their extremes; all rows climb and then descend together.
    """
    n = len(x)
    if n == 0:
        return np.zeros(0, np.int64)
    levels = [(x, x)]
    while len(levels[-1][0]) > 1:
        least, most = levels[-1]
        if len(least) % 2:
            least, most = np.append(least, least[-1]), np.append(most, most[-1])
        levels.append((np.minimum(least[::2], least[1::2]), np.maximum(most[::2], most[1::2])))
    out = np.full(n, n, np.int64)
    todo = np.arange(n)
    at = todo + 1  # block number on the level
    inside = at < n
    todo, at = todo[inside], at[inside]
    found_row, found_at, found_level = [], [], []
    for level, (least, most) in enumerate(levels):
        # a block that starts an even pair is left to the level above, unless this level is the last
        alone = (at % 2 == 1) | (level == len(levels) - 1)
        hit = np.zeros(len(at), bool)
        hit[alone] = (most[at[alone]] > high[todo[alone]]) | (least[at[alone]] < low[todo[alone]])
        found_row.append(todo[hit])
        found_at.append(at[hit])
        found_level.append(np.full(int(hit.sum()), level))
        at = np.where(alone, at + 1, at)[~hit]
        todo = todo[~hit]
        at = at // 2
        if level + 1 < len(levels):
            inside = at < len(levels[level + 1][0])
            todo, at = todo[inside], at[inside]
    row, at, level = (np.concatenate(v) for v in (found_row, found_at, found_level))
    for k in range(len(levels) - 1, 0, -1):
        here = np.flatnonzero(level == k)
        least, most = levels[k - 1]
        left = at[here] * 2
        hit = (most[left] > high[row[here]]) | (least[left] < low[row[here]])
        at[here] = np.where(hit, left, np.minimum(left + 1, len(least) - 1))
        level[here] = k - 1
    out[row] = at
    return out


def composed(keys: list[str], index: str = "_index", body: str = "_steps"):
    """Arrow function over up to ``WIDTH`` functions of a key: one function for all of them."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(index)
        total = None
        for steps in group.column(body):
            if not steps.is_valid:
                total = None
                break
            one = Steps.load(steps.as_py())
            total = one if total is None else total.then(one)
            if len(total.cuts) > MOST_PIECES:
                total = None
                break
        columns = {k: group.column(k).slice(0, 1) for k in keys}
        return pa.table(columns | {
            index: pa.array([group.column(index)[0].as_py() // WIDTH], pa.int64()),
            body: pa.array([None if total is None else total.dump()], pa.binary()),
        })

    return run


def handed_down(keys: list[str], kind: pa.DataType, initial, index: str = "_index", body: str = "_steps"):
    """Arrow function over the same functions with the state ``_state`` the first starts from: the start of each."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(index)
        state, starts = group.column("_state")[0].as_py(), []
        for steps in group.column(body):
            starts.append(state)
            state = Steps.load(steps.as_py())(state) if steps.is_valid else initial
        columns = {k: group.column(k) for k in keys}
        return pa.table(columns | {index: group.column(index), "_state": pa.array(starts, kind)})

    return run
