"""Periodic runs of words, found by multi-scale minimizers, and texts with their runs collapsed to one period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length of at least
``max(least, periods * q)`` that no neighbouring word extends. All texts of an Arrow batch are searched together:

- Periods up to ``SHORT`` are found by comparing the words with themselves at each lag.
- Longer periods are dealt to scales of periods from ``low`` to ``high = low * 3 // 2``. A scale hashes all stretches of
  ``high`` words and selects, in each window of ``2 * low - high + 1`` of them, the leftmost least hash. Inside a run the
  windows repeat at the distance of the period, so the selected places do; and as ``high`` words of a run cannot come
  again within less than a period, neighbours among the places of one hash lie exactly a period apart. Such pairs
  are the seeds; overlapping seeds of one distance form a chain, which ends within a window of the run's own ends.
- Chains are extended word by word, and what is found is compared with the words themselves, so no hash decides.

A hash that is shared by two different stretches of one text (64 bits) is noticed when it makes a wrong run; then the
batch is searched again under other hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import Words, batch_function, small_batches

#: Periods up to here are found by direct lag scans.
SHORT = 8

FIELDS = (
    "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,"
    "strongest:struct<start:bigint,length:bigint,period:bigint>,collapsed:string>"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass(frozen=True)
class RunRules:
    """A run has at least ``least`` words and ``periods`` periods; the search needs both, and 3 periods or more."""

    least: int = 24
    periods: int = 3

    def __post_init__(self):
        if self.periods < 3 or self.least < 1:
            raise ValueError("runs of fewer than 3 periods are not found by this search")

    def shortest(self, period):
        return np.maximum(self.least, self.periods * period)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (multiply, shift and xor, in place)."""
    values ^= values >> np.uint64(31)
    values *= np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0xA0761D6478BD642F) + (right ^ (right >> np.uint64(23))))


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost least value of each window of ``width`` values, each place once."""
    best, place, covered = values, np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        lower = best[step:] < best[:-step]
        place = np.where(lower, place[step:], place[:-step])
        best = np.where(lower, best[step:], best[:-step])
        covered += step
    kept = np.ones(len(place), dtype=bool)
    kept[1:] = place[1:] != place[:-1]  # places never go back from window to window
    return place[kept]


def _lag_runs(words: np.ndarray, lag: int, rules: RunRules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start and stop of the stretches of words that equal the word ``lag`` later, where a run comes of them."""
    if len(words) <= lag:
        return
    same = np.zeros(len(words) - lag + 2, dtype=np.int8)
    same[1:-1] = words[:-lag] == words[lag:]
    turns = np.diff(same)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = end - begin + lag >= rules.shortest(lag)
    yield begin[long], end[long]


def _scale_chains(words: np.ndarray, hashes: np.ndarray, low: int, high: int, rules: RunRules):
    """Start, stop and distance of the seeds' chains of one scale, extended to both sides; a stop is that of the earlier copy."""
    window = 2 * low - high + 1
    if len(hashes) < window:
        return
    places = _least_places(hashes, window)
    order = np.argsort(hashes[places], kind="stable")
    at, key = places[order], hashes[places][order]
    lag = at[1:] - at[:-1]
    seed = (key[1:] == key[:-1]) & (lag >= low) & (lag <= high)
    begin, lag = at[:-1][seed], lag[seed]
    order = np.lexsort((begin, lag))
    begin, lag = begin[order], lag[order]
    if not len(begin):
        return
    first = np.ones(len(begin), dtype=bool)
    first[1:] = (lag[1:] != lag[:-1]) | (begin[1:] > begin[:-1] + high)
    heads = np.flatnonzero(first)
    lasts = np.append(heads[1:], len(begin)) - 1
    end, begin, lag = begin[lasts] + high, begin[heads], lag[heads]
    # The ends of a run lie within a window of its chain: what cannot become long enough is no run.
    near = end - begin + lag + 2 * window >= rules.shortest(lag)
    begin, end, lag = begin[near], end[near], lag[near]
    growing = np.arange(len(begin))
    for _ in range(window):
        growing = growing[words[begin[growing] - 1] == words[begin[growing] - 1 + lag[growing]]]
        if not len(growing):
            break
        begin[growing] -= 1
    growing = np.arange(len(begin))
    for _ in range(window):
        growing = growing[words[end[growing]] == words[end[growing] + lag[growing]]]
        if not len(growing):
            break
        end[growing] += 1
    long = end - begin + lag >= rules.shortest(lag)
    yield from zip(begin[long].tolist(), end[long].tolist(), lag[long].tolist(), strict=True)


def _search(words: np.ndarray, sizes: np.ndarray, rules: RunRules, salt: int) -> list[tuple[int, int, int, int]] | None:
    """Text, start, length and period of all runs; None if a hash has misled. ``words`` holds texts of ``sizes`` words."""
    found: dict[tuple[int, int], int] = {}  # (start, stop of the later copy) -> period, in numbers of the whole batch

    def add(begin: int, end: int, lag: int, places: np.ndarray) -> None:
        place = int(places[begin]), int(places[end + lag - 1]) + 1
        found[place] = min(lag, found.get(place, lag))  # a stretch has one smallest period

    fences = np.zeros(len(words) + len(sizes) + 1, dtype=bool)
    fences[np.concatenate(([0], np.cumsum(sizes + 1)))] = True
    fenced = np.empty(len(fences), dtype=np.int64)
    fenced[~fences] = words
    fenced[fences] = -1 - np.arange(fences.sum())  # equal to nothing
    places = np.cumsum(~fences) - 1  # number of the word at a place
    room = np.append(sizes, 0)  # words of the text behind each fence

    def at_least(count: int):
        """Only the texts of ``count`` words or more, and the last fence."""
        kept = np.repeat(np.append(room[:-1] >= count, True), room + 1)
        return kept if not kept.all() else None

    kept = at_least(rules.least)
    if kept is not None:
        heads = kept[np.flatnonzero(fences)]
        fenced, places, fences, room = fenced[kept], places[kept], fences[kept], room[heads]
    for lag in range(1, SHORT + 1):
        for begin, end in _lag_runs(fenced, lag, rules):
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                add(a, b, lag, places)

    level, span = _mixed(fenced.astype(np.uint64) + np.uint64(salt * 2 + 1) * np.uint64(0x2545F4914F6CDD1D)), 1
    low = SHORT + 1
    while len(room) > 1 and rules.periods * low <= room.max():
        high = low * 3 // 2
        kept = at_least(int(rules.shortest(low)))
        if kept is not None:
            heads = kept[np.flatnonzero(fences)]
            fenced, places, fences, room, level = fenced[kept], places[kept], fences[kept], room[heads], level[kept]
        while span * 2 <= high:
            # Stretches that reach beyond the end would hold the last fence; they keep their shorter hash, which only
            # stretches with that fence have.
            level[: len(level) - span] = _paired(level[:-span], level[span:])
            span *= 2
        last = len(level) - high + 1
        if last > 0:
            shift = high - span
            hashes = _paired(level[:last], level[shift : shift + last]) if shift else level[:last]
            for begin, end, lag in _scale_chains(fenced, hashes, low, high, rules):
                if not np.array_equal(fenced[begin:end], fenced[begin + lag : end + lag]):
                    return None
                add(begin, end, lag, places)
        low = high + 1
    first = np.concatenate(([0], np.cumsum(sizes)))
    runs = []
    for (start, stop), period in sorted(found.items(), key=lambda f: (f[0][0], f[1])):
        text = int(np.searchsorted(first, start, side="right")) - 1
        runs.append((text, start - int(first[text]), stop - start, period))
    return runs


def find_runs(words: np.ndarray, sizes: np.ndarray, rules: RunRules = RunRules()) -> list[tuple[int, int, int, int]]:
    """``(text, start, length, period)`` of all runs, by text, start and period; ``words`` are integers, text by text."""
    salt = 0
    while (runs := _search(words, sizes, rules, salt)) is None:
        salt += 1
    return runs


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, by whole numbers; of equals the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _collapsed(words: Words, drop: np.ndarray) -> pa.Array:
    """Each text as its words that are not dropped, joined by one space."""
    sizes = np.diff(words.first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    kept = np.flatnonzero(~drop)
    ends = np.append(owner[kept][1:] != owner[kept][:-1], True)[: len(kept)]  # the last kept word of its text
    lengths = words.stops[kept] - words.starts[kept]
    width = lengths + ~ends
    stop = np.cumsum(width)
    out = np.full(int(stop[-1]) if len(stop) else 0, 0x20, dtype=np.uint8)
    source = np.repeat(words.starts[kept] - (stop - width), lengths)
    target = np.arange(int(lengths.sum())) + np.repeat((stop - width) - (np.cumsum(lengths) - lengths), lengths)
    out[target] = words.data[target + source]
    bound = np.concatenate(([0], stop))[np.searchsorted(owner[kept], np.arange(len(sizes) + 1))]
    buffers = [None, pa.py_buffer(bound.astype(np.int64)), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers).cast(pa.string())


def _rows(column: pa.Array, rules: RunRules) -> pa.Array:
    words = Words(column)
    sizes = np.diff(words.first)
    by_text: list[list[tuple[int, int, int]]] = [[] for _ in range(len(sizes))]
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for text, start, length, period in find_runs(words.ids(), sizes, rules):
        by_text[text].append((start, length, period))
        change[words.first[text] + start + period] += 1
        change[words.first[text] + start + length] -= 1
    drop = np.cumsum(change[:-1]) > 0
    names = ("start", "length", "period")
    return pa.StructArray.from_arrays(
        [
            pa.array([[dict(zip(names, r, strict=True)) for r in runs] for runs in by_text], type=pa.list_(_RUN)),
            pa.array([(b := _strongest(runs)) and dict(zip(names, b, strict=True)) for runs in by_text], type=_RUN),
            _collapsed(words, drop),
        ],
        names=["runs", "strongest", "collapsed"],
    )


def with_runs(df: DataFrame, text: str = "text", into: str = "periodic", rules: RunRules = RunRules()) -> DataFrame:
    """Add the struct ``into`` to every row; no row moves, none is dropped.

    ``runs``: start (word number), length and period of each run, by start, then period. ``strongest``: the run with the
    greatest length / period, of equals the first; null without runs. ``collapsed``: the words joined by one space without
    those that a run contains after its first period. A null, empty or blank text has no words: no runs, an empty
    ``collapsed``. Repeated rows get the same result each; an empty table gives an empty one. An existing column
    ``into`` is replaced, other columns stay. A text is searched whole in one task: about 150 bytes for each of its words,
    and a pass for each of the scales (a factor of 1.5) up to a third of its length.
    """
    small_batches(df)
    return df.withColumn(into, batch_function(lambda column: _rows(column, rules), FIELDS)(F.col(text).cast("string")))


def listed(runs: Column) -> Column:
    """``start,length,period`` of each run, a line each."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_run(words: Column, key: Column) -> Column:
    """The words, where ``key`` (unsigned) is divisible by ten with their tail replaced by repetitions of its beginning.

    With g = key / 10 and n words, words from ``g % n`` on repeat with period ``1 + (n - g % n) / (3 + g % 8)``.
    """
    n, g = F.size(words).cast("long"), F.floor(key / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), (n - a).cast("int")))
    return F.when((key % 10 == 0) & (n > 0), planted).otherwise(words)
