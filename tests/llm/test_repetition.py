"""Suffix-array repetition against brute force."""

from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from courtlake.llm.queries import QUERIES
from courtlake.llm.repetition import Rules, longest_repeats, repetition


def brute_longest(keys):
    n, found = len(keys), [0] * len(keys)
    for i in range(n):
        for j in range(n):
            if i != j:
                size = 0
                while max(i, j) + size < n and keys[i + size] == keys[j + size]:
                    size += 1
                found[i] = max(found[i], size)
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_longest_repeats(keys):
    assert longest_repeats(np.array(keys, np.int64)).tolist() == brute_longest(keys)


def judged(text, rules=Rules()):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, places, spans = len(words), {}, {}
    for i in range(n - 2):
        places.setdefault(tuple(words[i:i + 3]), []).append(i)
    windows = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    # Repeats of at least so many words: all windows of this size found twice, joined.
    size = rules.repeat_words
    for i in range(n - size + 1):
        spans.setdefault(tuple(words[i:i + size]), []).append(i)
    covered = {i + k for p in spans.values() if len(p) > 1 for i in p for k in range(size)}
    longest, low, high = 0, 0, n
    while low < high:  # repeats of one size hold repeats of every smaller one
        middle = (low + high + 1) // 2
        runs = [tuple(words[i:i + middle]) for i in range(n - middle + 1)]
        low, high = (middle, high) if len(set(runs)) < len(runs) else (low, middle - 1)
    longest = low
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = n < 50 or 100 * len(windows) > 50 * n
    kept = not failed and len(covered) <= rules.max_covered * n and longest <= rules.max_longest
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(windows), len(covered), longest, failed, kept)


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op10_suffix_repetition"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        assert tuple(row)[1:] == judged(texts[row.doc_id]), row.doc_id


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(120))
    filler = " ".join(f"f{i}" for i in range(900))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 100), (4, "a " * 100), (None, filler),
            (5, f"{passage} {filler} {passage}"), (6, "é| ß#\né| ß#\n \né| ß#"), (7, "word " * 40_000),
            (8, filler + " x"), (9, " ".join([passage] * 4))]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    found = sorted((tuple(r) for r in repetition(docs).collect()), key=lambda r: (r[0] or 0, r))
    small = [r for r in rows if r[0] != 7]
    expected = sorted(((i, *judged(t)) for i, t in small), key=lambda r: (r[0] or 0, r))
    assert [r for r in found if r[0] != 7] == expected
    (long,) = [r for r in found if r[0] == 7]
    assert long[1:] == (40_000, 160_000, 0, 0, 40_000, 40_000, 39_999, True, False)
    assert [r[-1] for r in found if r[0] in (5, None)] == [True, False]
    assert repetition(docs.limit(0)).count() == 0
