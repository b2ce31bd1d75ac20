"""Repetition rules from suffix arrays.

The words of a slice of documents are sorted as suffixes, by prefix doubling over all documents of
the slice at once; a word is told apart by its document, so that no repeat reaches into another
one. The common prefix with the neighbours in this order is, for every position, the longest
repeat that starts there: the intervals of equal common prefix are the maximal repeated substrings,
and all their occurrences start at such positions. Their spans are united.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from courtlake.llm.common import arrow_batch, ids_and_bytes, text_slices

_WHITE = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")
#: Words of the windows that the base rule counts.
WINDOW = 3
#: Texts of a slice are sorted together up to about this many words.
SLICE_WORDS = 400_000


@dataclass(frozen=True)
class Rules:
    """Base: at least ``min_words``, at most ``max_repeat_percent`` of words in repeated windows.
    Method: repeats of ``repeat_words`` or more cover at most ``max_covered`` of the words, and the
    longest has at most ``max_longest`` words."""

    min_words: int = 50
    max_repeat_percent: int = 50
    repeat_words: int = 10
    max_covered: float = 0.5
    max_longest: int = 100


def longest_repeats(keys: np.ndarray) -> np.ndarray:
    """For each position how long the longest repeat is that starts there (0: none).

    ``keys``: integers; a value that occurs once ends every repeat.
    """
    n = len(keys)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    order = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = start
    levels = [rank.copy()]
    step = 1
    while True:
        # Places in the order whose suffix isn't alone in its group yet.
        alone = new & np.concatenate([new[1:], [True]])
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        rows = order[places]
        first, second = rank[rows], rank[np.minimum(rows + step, n)]
        by = np.lexsort((second, first))
        rows, first, second = rows[by], first[by], second[by]
        order[places] = rows
        differs = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        new[places] = differs
        rank[rows] = np.maximum.accumulate(np.where(differs, places, 0))
        levels.append(rank.copy())
        step *= 2
    # Common prefix of neighbours: longest steps first; neighbours of different keys have none.
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[pairs], b[pairs]
    at, to = a.copy(), b.copy()
    for level in range(len(levels) - 1, -1, -1):
        equal = levels[level][at] == levels[level][to]
        at[equal] += 1 << level
        to[equal] += 1 << level
    common = at - a
    np.maximum.at(found, a, common)
    np.maximum.at(found, b, common)
    return found


def _covered(starts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a span."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + sizes, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _repeats(documents: list[list[bytes]], repeat_words: int) -> list[tuple[int, int, int]]:
    """For each document: words in repeated windows, words covered by repeats, longest repeat."""
    numbers: dict[bytes, int] = {}
    for words in documents:
        for w in set(words).difference(numbers):
            numbers[w] = len(numbers)
    sizes = np.array([len(w) for w in documents], np.int64)
    ends = np.cumsum(sizes + 1)  # one key of its own behind each document
    starts = ends - sizes - 1
    keys = np.zeros(int(ends[-1]), np.int64)
    for nth, (words, a) in enumerate(zip(documents, starts.tolist())):
        keys[a:a + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        keys[a:a + len(words)] += nth * (len(numbers) + 1)
        keys[a + len(words)] = nth * (len(numbers) + 1) + len(numbers)
    longest = longest_repeats(keys)
    windows, spans = np.flatnonzero(longest >= WINDOW), np.flatnonzero(longest >= repeat_words)
    in_window = _covered(windows, np.full(len(windows), WINDOW), len(keys))
    in_span = _covered(spans, longest[spans], len(keys))
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (in_window, in_span)]
    tops = np.maximum.reduceat(longest, starts)
    return [(int(sums[0][b] - sums[0][a]), int(sums[1][b] - sums[1][a]), int(top))
            for a, b, top in zip(starts.tolist(), ends.tolist(), tops.tolist())]


def _slices(documents: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    part, words = [], 0
    for d in documents:
        part.append(d)
        words += len(d)
        if words >= SLICE_WORDS:
            yield part
            part, words = [], 0
    if part:
        yield part


def repetition(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict of every row of ``docs(doc_id, text)``.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
    longest_repeat, base_failed, kept``. A null text has no words, so it fails; repeated rows and
    rows without doc_id are judged like others; extra columns are left behind; an empty table
    gives an empty one.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "covered_words", "longest_repeat"]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in counts),
                        ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            words = [t.split() for t in texts]
            repeats = [r for s in _slices(words) for r in _repeats(s, rules.repeat_words)]
            rows = []
            for text, own, (in_windows, covered, longest) in zip(texts, words, repeats):
                lines = [x for x in text.split(b"\n") if x.strip()]
                n = len(own)
                failed = n < rules.min_words or 100 * in_windows > rules.max_repeat_percent * n
                kept = not failed and covered <= rules.max_covered * n and longest <= rules.max_longest
                rows.append((n, len(text.decode()) - sum(map(text.count, _WHITE)),
                             sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
                             in_windows, covered, longest, failed, kept))
            yield arrow_batch(schema, doc_id=part.column("doc_id"),
                              **dict(zip(schema.names[1:], map(list, zip(*rows)))))

    return ids_and_bytes(docs).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean")
