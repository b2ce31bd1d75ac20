"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of words in which words one period apart are equal, at least four periods and
six words long, that cannot be made longer. Texts of one Arrow slice are laid end to end with a
word of its own behind each, so no run crosses from one to the next and each step is one numpy
operation for all of them.

- Periods up to ``SHORT``: the words are compared with themselves at every such lag.
- Longer periods: scale k = 16, 32, 64, ... covers periods above k/2 and up to k. Every block of k
  words has a hash (two halves of the scale before make one), and of each k/2 neighbouring blocks
  the smallest hash is a minimizer. In a run of period q of this scale blocks are equal exactly
  when they are multiples of q apart, and k/2 < q blocks have no two equal ones. So the minimizers
  repeat at distance q, and the nearest equal minimizers are a seed of the run. The run has at
  least 4q - k + 1 > 2q block starts, room for a window and the same one a period on, so no run is
  without a seed.

Seeds are extended word by word to both sides. A stretch stays if it is long enough and no divisor of
its lag is a period of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import ids_and_bytes, text_slices

#: Fewest words and fewest periods of a run.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Longest period that is looked for at every lag.
SHORT = 8

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

#: Makes the words that are searched out of a doc_id (or None) and the words of its text.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(32))) * _ODD[0] + right
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[1]
    return mixed ^ (mixed >> np.uint64(32))


def _smallest(values: np.ndarray, width: int, least: bool = True) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` neighbours; ``width`` is a power of two."""
    pick, step = (np.minimum if least else np.maximum), 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _minimizers(blocks: np.ndarray, width: int) -> np.ndarray:
    """Places that are the smallest of some window of ``width`` blocks."""
    if len(blocks) < width:
        return np.zeros(0, np.int64)
    lowest = _smallest(blocks, width)
    # A place is a minimizer if the largest minimum of the windows around it is its own hash.
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_smallest(np.concatenate([edge, lowest, edge]), width, least=False) == blocks)


def _seeds(blocks: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of nearest equal minimizers, sorted by lag and place."""
    places = _minimizers(blocks, scale // 2)
    order = places[np.argsort(blocks[places], kind="stable")]
    lag = np.diff(order)
    good = (blocks[order[1:]] == blocks[order[:-1]]) & (lag > scale // 2) & (lag <= scale)
    place, lag = order[:-1][good], lag[good]
    order = np.lexsort((place, lag))
    return place[order], lag[order]


def _grown(words: np.ndarray, first: int, last: int, lag: int) -> tuple[int, int]:
    """The widest ``first, last`` (exclusive) with ``words[i] == words[i + lag]`` for all in between."""
    step = 64
    while first:
        low = max(0, first - step)
        wrong = np.flatnonzero(words[low:first] != words[low + lag:first + lag])
        if len(wrong):
            first = low + int(wrong[-1]) + 1
            break
        first, step = low, step * 2
    step, end = 64, len(words) - lag
    while last < end:
        high = min(end, last + step)
        wrong = np.flatnonzero(words[last:high] != words[last + lag:high + lag])
        if len(wrong):
            last += int(wrong[0])
            break
        last, step = high, step * 2
    return first, last


def _is_least(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of ``period`` is a period of the stretch at ``start``."""
    root, rest, factor = words[start:start + period], period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = period // factor
            if np.array_equal(root[part:], root[:-part]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs of an integer array as ``(start, length, period)``, by start, then period.

    ``longest`` bounds the length of a run, where the array is known to hold no longer one.
    """
    n, found = len(words), []
    for lag in range(1, min(SHORT, n // MIN_PERIODS) + 1):
        equal = np.concatenate([[False], words[lag:] == words[:-lag], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        starts, length = edges[::2], edges[1::2] - edges[::2] + lag
        good = length >= max(MIN_WORDS, MIN_PERIODS * lag)
        found += [(s, size, lag) for s, size in zip(starts[good].tolist(), length[good].tolist())
                  if _is_least(words, s, lag)]
    scale, blocks = 1, words.astype(np.uint64)
    blocks = _joined(blocks, blocks)
    while MIN_PERIODS * (scale + 1) <= (n if longest is None else longest):
        blocks, scale = _joined(blocks[:-scale], blocks[scale:]), scale * 2
        if scale <= SHORT:
            continue
        place, lag = _seeds(blocks, scale)
        if not len(place):
            continue
        # Seeds of one lag whose blocks overlap or touch are one stretch.
        new = np.concatenate([[True], (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + scale)])
        at = np.flatnonzero(new)
        last = place[np.concatenate([at[1:] - 1, [len(place) - 1]])] + scale
        done = (0, 0)  # lag, and the end of the stretch that was seen last with it
        for p, e, q in zip(place[at].tolist(), last.tolist(), lag[at].tolist()):
            if done[0] == q and p < done[1]:
                continue
            first, end = _grown(words, p, e, q)
            done = (q, end)
            if end - first + q >= max(MIN_WORDS, MIN_PERIODS * q) and _is_least(words, first, q):
                found.append((first, end - first + q, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, a number of its own behind each list; where each list starts."""
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    starts = np.zeros(len(lists) + 1, np.int64)
    for i, words in enumerate(lists):
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
        flat.append(-1 - i)
        starts[i + 1] = len(flat)
    return np.array(flat, np.int64), starts


def runs_of(lists: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    numbers, starts = _numbered(lists)
    found: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    for start, length, period in find_runs(numbers, max(map(len, lists), default=0)):
        doc = int(np.searchsorted(starts, start, "right")) - 1
        found[doc].append((start - int(starts[doc]), length, period))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one space between them, without what repeats the first period of a run."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs(doc_id, text)``.

    Words are what stands between ASCII white space. ``runs`` lists start (in words, from 0), length
    and smallest period, by start, then period; ``collapsed`` keeps the first period of each run.
    A null or blank text has no words, no runs and an empty collapsed text. Repeated rows stay, a
    null doc_id stays null, extra columns are left behind, an empty table gives an empty one. A
    text is searched whole by one task; nothing is shuffled. A text needs some 100 bytes a word.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            lists = [t.split() for t in texts]
            if prepare:
                lists = [prepare(i, w) for i, w in zip(part.column("doc_id").to_pylist(), lists)]
            found = runs_of(lists)
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            ends = np.cumsum([0, *map(len, found)])
            runs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN))
            texts = [collapsed(w, r) for w, r in zip(lists, found)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_words": pa.array(list(map(len, lists)), pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                "collapsed": pa.array(texts, pa.binary()).cast(pa.string())})

    return ids_and_bytes(docs).mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: F.Column) -> F.Column:
    """The run of the greatest exact length / period; ties: smallest start, then period."""

    def better(best: F.Column, run: F.Column) -> F.Column:
        return F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best)

    # The runs come by start and period, so the first of equal ones is kept.
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, none, better)


def runs_text(runs: F.Column) -> F.Column:
    """``start,length,period`` and a line feed for each run."""
    line = F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    return F.array_join(line, "")
