"""Benchmark decontamination: every passage of the corpus is a query to an index of the test items.

The index holds the items' pairs of neighbouring words with BM25 weights, each item's weights
scaled to sum to 1; a passage's score for an item is then the weighted share of the item that it
holds. Postings are in item order, in blocks with their largest weight (block-max WAND). A passage
is skipped at once when the largest weights of its pairs don't reach the threshold; the others
retrieve all items above it. An item counts as leaked when the passage also holds enough of its
question and of its answer.

The benchmark is read in shards of ``SHARD_ITEMS`` items; each task holds the index of one shard.
Document frequencies and lengths are those of the whole benchmark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import ids_and_bytes, saved, text_slices, unused

SHARD_ITEMS = 20_000
BLOCK = 16
K1, B = 1.2, 0.75
#: Least share of an item's weight, of its question and of its answer that a passage must hold.
MIN_SCORE, MIN_OVERLAP = 0.5, 0.7
#: Words a task remembers with their numbers; then it starts anew.
REMEMBERED = 400_000

_LETTERS = re.compile(r"\w+")
#: Letters of scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han): words of their own.
_SPACELESS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
                        "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")


def plain_word(word: str) -> str:
    """Lower case, letters and digits only."""
    return "".join(_LETTERS.findall(word.lower()))


def raw_words(text: str) -> list[str]:
    """What any white space of Unicode parts, as it is written."""
    return (text if text.isascii() else _SPACELESS.sub(r" \1 ", text)).split()


def words_of(text: str) -> list[str]:
    return [w for w in map(plain_word, raw_words(text)) if w]


def pairs_of(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of a single sentence the last quarter of its words."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+", text.strip()) if words_of(p)]
    if len(parts) > 1:
        return words_of(" ".join(parts[:-1])), words_of(parts[-1])
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


@dataclass(frozen=True)
class Statistics:
    """Of the whole benchmark: items with a pair, mean pairs of an item, items for each pair."""

    items: int
    mean: float
    frequency: dict[tuple[str, str], int]


class Index:
    """One shard: ``items`` are (item_id, text), in order of item_id."""

    def __init__(self, items: list[tuple[int, str]], known: Statistics):
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        postings: dict[tuple[str, str], list[tuple[int, float]]] = {}
        self.longest = 2
        for nth, (_, text) in enumerate(items):
            words = words_of(text)
            self.longest = max(self.longest, len(words))
            counts = Counter(pairs_of(words))
            size = K1 * (1 - B + B * sum(counts.values()) / known.mean)
            weights = {p: math.log(1 + (known.items - known.frequency[p] + 0.5) / (known.frequency[p] + 0.5))
                       * n * (K1 + 1) / (n + size) for p, n in counts.items()}
            total = sum(weights.values())
            for p, w in weights.items():
                postings.setdefault(p, []).append((nth, w / total))
        self.numbers = {w: i for i, w in enumerate(sorted({w for p in postings for w in p}))}
        codes = sorted((self.numbers[a] * len(self.numbers) + self.numbers[b], (a, b)) for a, b in postings)
        self.codes = np.array([c for c, _ in codes], np.int64)
        self.postings = [[n for n, _ in postings[p]] for _, p in codes]
        self.weights = [[w for _, w in postings[p]] for _, p in codes]
        self.tops = np.array([max(w) for w in self.weights])
        self.blocks = [[(max(w[i:i + BLOCK]), n[min(i + BLOCK, len(n)) - 1]) for i in range(0, len(n), BLOCK)]
                       for n, w in zip(self.postings, self.weights)]

    def terms(self, numbers: np.ndarray) -> np.ndarray:
        """Term of each pair of neighbouring words, -1 for a pair that no item holds."""
        a, b = numbers[:-1], numbers[1:]
        if not len(a) or not len(self.codes):
            return np.full(len(a), -1)
        code = a * len(self.numbers) + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.codes[at] == code), at, -1)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All items whose score over these different terms is at least ``least``."""
        found = []
        cursors = [[self.postings[t][0], 0, t] for t in terms]  # item, place, term
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for n, c in enumerate(cursors):
                bound += self.tops[c[2]]
                if bound >= least:
                    pivot = n
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, jump = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf
            for c in cursors[:pivot + 1]:
                top, end = self._block(c, item)
                bound += top
                jump = min(jump, end + 1)
            if bound >= least:
                if cursors[0][0] == item:
                    score = sum(self.weights[c[2]][c[1]] for c in cursors[:pivot + 1])
                    if score >= least:
                        found.append((item, score))
                    target = item + 1
                else:
                    target = item
            else:
                target = max(jump, item + 1)
            cursors = [c for c in cursors if self._forward(c, target)]
        return found

    def _block(self, cursor: list, item: int) -> tuple[float, float]:
        """Largest weight, and last item, of the block that may hold the item."""
        blocks = self.blocks[cursor[2]]
        n = cursor[1] // BLOCK
        while n < len(blocks) and blocks[n][1] < item:
            n += 1
        return blocks[n] if n < len(blocks) else (0.0, math.inf)

    def _forward(self, cursor: list, item: float) -> bool:
        postings = self.postings[cursor[2]]
        while cursor[0] < item:
            cursor[1] += 1
            if cursor[1] == len(postings):
                return False
            cursor[0] = postings[cursor[1]]
        return True

    def overlaps(self, item: int, words: list[str]) -> tuple[float, float]:
        """Shares of the question's and the answer's pairs (words, if it is one) in a passage."""
        held, single = set(pairs_of(words)), set(words)
        shares = []
        for part in self.parts[item]:
            pairs = pairs_of(part)
            wanted, have = (pairs, held) if pairs else (part, single)
            shares.append(sum(p in have for p in wanted) / len(wanted) if wanted else 1.0)
        return shares[0], shares[1]


def _statistics(items: DataFrame) -> tuple[DataFrame, int, float]:
    """Items for each pair (as ``a, b, n``), the number of items with a pair, their mean pairs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b, n) for text in batch.column("text").to_pylist()
                    for (a, b), n in Counter(pairs_of(words_of(text))).items()]
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([r[0] for r in rows], pa.string()), "b": pa.array([r[1] for r in rows], pa.string()),
                "n": pa.array([r[2] for r in rows], pa.int64())})

    pairs = items.mapInArrow(run, "a string, b string, n long")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    return pairs.groupBy("a", "b").agg(F.count("*").alias("items")), items.count(), total


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE,
          min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``doc_id, item_id, start, score, question_overlap, answer_overlap``: one row for each leak.

    ``start`` is the first word of the passage with the highest score. Whole texts of
    ``docs(doc_id, text)`` are searched for every item of ``benchmark(item_id, text)`` that has two
    words or more (a letter of a script without spaces is a word); items that are null or shorter are
    left out. Repeated item_ids are items of
    their own, and repeated documents give repeated rows. Empty tables give no rows.
    """
    items = saved(
        spark,
        benchmark.where("text is not null and item_id is not null").select(
            F.col("item_id").cast("long").alias("item_id"), "text"),
        "benchmark-items",
    )
    frequency, count, total = _statistics(items)
    frequency = saved(spark, frequency, "benchmark-pairs")
    shards = max(1, -(-count // SHARD_ITEMS))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    found = []
    for shard in range(shards):
        part = dealt.where(F.col("shard") == shard)
        rows = sorted((r.item_id, r.text) for r in part.collect())
        own = spark.createDataFrame(
            sorted({p for _, t in rows for p in pairs_of(words_of(t))}), "a string, b string")
        known = Statistics(count, total / max(count, 1), {
            (r.a, r.b): r["items"] for r in frequency.join(own, ["a", "b"], "left_semi").collect()})
        rows = [r for r in rows if len(words_of(r[1])) > 1]
        found.append(_shard_leaks(docs, Index(rows, known), min_score, min_overlap))
    return reduce(DataFrame.union, found)


def _shard_leaks(docs: DataFrame, index: Index, min_score: float, min_overlap: float) -> DataFrame:
    # Half passages as long as the longest item: any place of it lies within one passage.
    half = index.longest
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
                        ("score", pa.float64()), ("question_overlap", pa.float64()),
                        ("answer_overlap", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        for part, texts in text_slices(batches):
            if len(numbers) > REMEMBERED:
                numbers = {}
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                rows += [(doc_id, *r) for r in searched(text, numbers)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def searched(text: bytes, numbers: dict[str, int]) -> list[tuple]:
        raw = raw_words(text.decode())
        for w in set(raw).difference(numbers):
            plain = plain_word(w)
            numbers[w] = index.numbers.get(plain, -1) if plain else -2
        known = np.fromiter(map(numbers.__getitem__, raw), np.int64, len(raw))
        places = np.flatnonzero(known != -2)  # what holds no letter isn't a word
        terms = index.terms(known[places])
        at = np.flatnonzero(terms >= 0)
        if not len(at):
            return []
        # Different terms of each half passage; two halves bound a passage from above.
        code = np.unique(at // half * len(index.codes) + terms[at])
        sums = np.bincount(code // len(index.codes), weights=index.tops[code % len(index.codes)])
        sums = np.append(sums, 0.0)
        best: dict[int, tuple] = {}
        for n in np.flatnonzero(sums[:-1] + sums[1:] >= min_score).tolist():
            start = n * half
            own = np.unique(terms[start:start + 2 * half])
            for item, score in index.search(own[own >= 0].tolist(), min_score):
                if item in best and best[item][2] >= score:
                    continue
                words = [plain_word(raw[p]) for p in places[start:start + 2 * half + 1]]
                shares = index.overlaps(item, words)
                if min(shares) >= min_overlap:
                    best[item] = (index.ids[item], int(places[start]), score, *shares)
        return list(best.values())

    return ids_and_bytes(docs).mapInArrow(
        run, "doc_id long, item_id long, start long, score double, question_overlap double, "
             "answer_overlap double")


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` that hold no leaked item, all columns kept; a row is named by its id and text."""
    row, leaked = unused(docs, "_row", "_leaked")
    marked = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    gone = leaks(spark, keyed, benchmark).select(F.col("doc_id").alias(leaked)).distinct()
    return marked.join(gone, F.col(row) == F.col(leaked), "left_anti").drop(row)
