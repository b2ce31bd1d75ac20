"""Masked pseudo-likelihood from a bidirectional window network.

Each word is predicted from the two words before and the two behind it; a document's score is the
sum of the logarithms of these probabilities. The network knows the most frequent words of the whole
corpus, by an exact count; rarer ones share buckets by checksum. It adds an embedding for each
place of the window, goes through tanh, and predicts a class of words and the word within it. A rare
word's probability is its bucket's times the word's share of the bucket's occurrences, so that every word
of the corpus has its own. These shares come from the table of all counts, by joins: tasks write the
rare words of some ``SHARE_BYTES`` of text with the rows that hold them, not a row for each mention.

Training is numpy inside Spark tasks, over every document: a first eighth of the documents brings
all tasks onto one model (the mean of theirs, weighted by words), the others refine it in the same
way. Means are formed in groups of ``GROUP`` models, so that no task and not the driver holds more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import OUT_ROWS, ids_and_bytes, saved, text_slices

#: Frequent words with a number of their own, and buckets for all others; CLASSES of equal size.
WORDS, BUCKETS, CLASSES = 960, 64, 32
SIZE = WORDS + BUCKETS
PER_CLASS = SIZE // CLASSES
PAD = SIZE
HIDDEN = 16
WINDOW = (-2, -1, 1, 2)
#: Words of one step of training, and words scored at once.
BATCH, SCORED = 8192, 16384
RATE = 0.1
#: Every so many documents, by a hash of the text, one is in the first round of training.
FIRST_ROUND = 8
#: Models that are averaged in one task.
GROUP = 64
#: Different words a task counts before it starts anew.
REMEMBERED = 400_000
#: Bytes of text whose rare words a task writes together.
SHARE_BYTES = 16 << 20


@dataclass(frozen=True)
class Vocabulary:
    words: tuple[bytes, ...]
    counts: tuple[int, ...]  # of each number, buckets included
    counted: DataFrame  # word, n: all words of the corpus


def word_number(word: bytes, known: dict[bytes, int]) -> int:
    number = known.get(word)
    return WORDS + zlib.crc32(word) % BUCKETS if number is None else number


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words (lower case, split at ASCII white space), and for each word of the texts,
    in order, its place among them and its document."""
    column = pa.array(texts, pa.large_binary()).view(pa.large_string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(column))
    coded = split.flatten().dictionary_encode()
    words, codes = coded.dictionary.view(pa.large_binary()), coded.indices.to_numpy()
    document = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    # White space at either end of a text leaves an empty word there.
    blank = words.index(pa.scalar(b"", pa.large_binary())).as_py()
    full = codes != blank
    return words, codes[full], document[full]


def _table(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The numbers of these words, as ``word_number`` gives them."""
    found = pc.index_in(words, value_set=known)
    table = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int16)
    rare = np.flatnonzero(table < 0)
    sums = np.fromiter(map(zlib.crc32, words.take(pa.array(rare)).to_pylist()), np.int64, len(rare))
    table[rare] = WORDS + sums % BUCKETS
    return table


def vocabulary(spark: SparkSession, docs: DataFrame) -> Vocabulary:
    """Counts of all words (lower case, split at ASCII white space) of all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})

        for _, texts in text_slices(batches):
            found, codes, _ = _words(texts)
            for word, n in zip(found.to_pylist(), np.bincount(codes, minlength=len(found)).tolist()):
                if n:
                    counts[word] = counts.get(word, 0) + n
            if len(counts) > REMEMBERED:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    counted = saved(spark, ids_and_bytes(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "lm-words")
    top = counted.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    known = {bytes(r.word): i for i, r in enumerate(top)}
    rare = F.pmod(F.crc32("word"), F.lit(BUCKETS)).alias("bucket")
    counts = [r.n for r in top] + [0] * (SIZE - len(top))
    # The frequent words are taken out of their buckets' sums again.
    for r in counted.groupBy(rare).agg(F.sum("n").alias("n")).collect():
        counts[WORDS + r.bucket] = r.n
    for word, i in known.items():
        counts[WORDS + zlib.crc32(word) % BUCKETS] -= counts[i]
    return Vocabulary(tuple(known), tuple(counts), counted)


class Network:
    """Parameters as one flat array of float32, with views on its parts."""

    SHAPES = {
        "embed": (len(WINDOW), SIZE + 1, HIDDEN), "hidden": (HIDDEN,), "classes": (HIDDEN, CLASSES),
        "class_bias": (CLASSES,), "words": (CLASSES, HIDDEN, PER_CLASS), "word_bias": (CLASSES, PER_CLASS)}

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape))
            at += size

    @classmethod
    def empty(cls) -> Network:
        return cls(np.zeros(sum(int(np.prod(s)) for s in cls.SHAPES.values()), np.float32))

    @classmethod
    def start(cls, counts: Iterable[int]) -> Network:
        """Small random weights; the biases are those of the words' frequencies."""
        model, rng = cls.empty(), np.random.default_rng(1)
        for name in ("embed", "classes", "words"):
            part = getattr(model, name)
            part[...] = rng.normal(0, 0.1, part.shape)
        n = np.log(np.array(list(counts), np.float64).reshape(CLASSES, PER_CLASS) + 1)
        total = np.logaddexp.reduce(n, axis=1)
        model.word_bias[...] = n - total[:, None]
        model.class_bias[...] = total - np.logaddexp.reduce(total)
        return model

    def log_probabilities(self, window: np.ndarray, target: np.ndarray) -> np.ndarray:
        return self._forward(window, target)[0]

    def _forward(self, window: np.ndarray, target: np.ndarray, gradient: Network | None = None):
        """``window``: numbers of the neighbours, a row each; targets are put in order of class."""
        group = (target // PER_CLASS).astype(np.int16)
        order = np.argsort(group, kind="stable")
        window, group, own = window[:, order], group[order], (target % PER_CLASS)[order]
        h = self.embed[0].take(window[0], axis=0)
        for place in range(1, len(WINDOW)):
            h += self.embed[place].take(window[place], axis=0)
        h += self.hidden
        h = np.tanh(np.ascontiguousarray(h.T))  # from here on a column each
        p, logs = _softmax(self.classes.T @ h + self.class_bias[:, None], group, gradient is not None)
        back = None
        if gradient is not None:
            gradient.classes[...] = h @ p.T
            gradient.class_bias[...] = p.sum(1)
            back = self.classes @ p
        ends = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
        for c, (a, b) in enumerate(zip(ends, ends[1:])):
            if a < b:
                part = h[:, a:b]
                p, within = _softmax(
                    self.words[c].T @ part + self.word_bias[c][:, None], own[a:b], gradient is not None)
                logs[a:b] += within
                if gradient is not None:
                    gradient.words[c] = part @ p.T
                    gradient.word_bias[c] = p.sum(1)
                    back[:, a:b] += self.words[c] @ p
        if gradient is not None:
            back *= 1 - h * h
            gradient.hidden[...] = back.sum(1)
            back = np.ascontiguousarray(back.T)
            for place in range(len(WINDOW)):
                by_number = np.argsort(window[place].astype(np.int16), kind="stable")
                numbers = window[place][by_number]
                starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
                gradient.embed[place][numbers[starts]] = np.add.reduceat(back.take(by_number, axis=0), starts, axis=0)
        result = np.empty_like(logs)
        result[order] = logs
        return result, gradient


def _softmax(logits: np.ndarray, own: np.ndarray, loss: bool) -> tuple[np.ndarray, np.ndarray]:
    """The log-probability of each column's own row; with ``loss`` also its gradient, the probabilities
    less 1 at that row."""
    columns = np.arange(len(own))
    logits -= logits.max(0)
    logs = logits[own, columns]
    np.exp(logits, out=logits)
    total = logits.sum(0)
    if loss:
        logits /= total
        logits[own, columns] -= 1
    return logits, (logs - np.log(total)).astype(np.float64)


class Trainer:
    """Adagrad on one task's words."""

    def __init__(self, flat: np.ndarray):
        self.model, self.gradient = Network(flat.copy()), Network.empty()
        self.seen, self.squares = 0, np.full_like(flat, 1e-6)

    def step(self, window: np.ndarray, target: np.ndarray) -> None:
        self.gradient.flat[...] = 0
        self.model._forward(window, target, self.gradient)
        g = self.gradient.flat
        g /= len(target)
        self.squares += g * g
        self.model.flat -= RATE * g / np.sqrt(self.squares)
        self.seen += len(target)


def _numbered(texts: list[bytes], known: pa.Array):
    """Numbers of all words with padding around each document; places of the words; their documents."""
    words, codes, document = _words(texts)
    numbers = np.full(len(codes) + 2 * len(texts) + 2, PAD, np.int16)
    places = np.arange(len(document)) + 2 * (document + 1)
    numbers[places] = _table(words, known)[codes]
    return numbers, places, document


def _batches(numbers: np.ndarray, places: np.ndarray, size: int = BATCH):
    for i in range(0, len(places), size):
        at = places[i:i + size]
        yield i, np.stack([numbers[at + o] for o in WINDOW]), numbers[at]


def _trained(docs: DataFrame, words: Vocabulary, flat: np.ndarray) -> DataFrame:
    """One row for each task: ``seen`` words and the ``model`` it came to, from ``flat`` on."""
    names = words.words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = pa.array(names, pa.large_binary()), Trainer(flat)
        for _, texts in text_slices(batches):
            numbers, places, _ = _numbered(texts, known)
            for _, window, target in _batches(numbers, places):
                own.step(window, target)
        if own.seen:
            yield _model_row(own.seen, own.model.flat)

    return ids_and_bytes(docs).mapInArrow(run, "seen long, model binary")


def _model_row(seen: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"seen": pa.array([seen], pa.int64()),
                                       "model": pa.array([flat.astype(np.float32).tobytes()], pa.binary())})


def _mean(spark: SparkSession, models: DataFrame, flat: np.ndarray) -> np.ndarray:
    """Mean of the models, weighted by the words each has seen; ``flat`` if there is none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(flat)), 0
        for batch in batches:
            for n, model in zip(*(c.to_pylist() for c in batch.columns)):
                total += n * np.frombuffer(model, np.float32).astype(np.float64)
                seen += n
        if seen:
            yield _model_row(seen, total / seen)

    models = saved(spark, models, "lm-models")
    n = models.count()
    while n > 1:
        n = -(-n // GROUP)
        models = saved(spark, models.repartition(n).mapInArrow(run, "seen long, model binary"), "lm-models")
    row = models.first()
    return flat if row is None else np.frombuffer(bytes(row.model), np.float32)


def train(spark: SparkSession, docs: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and parameters, from all documents."""
    words = vocabulary(spark, docs)
    flat = Network.start(words.counts).flat
    first = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FIRST_ROUND)) == 0
    for part in (docs.where(first), docs.where(~first)):
        flat = _mean(spark, _trained(part, words, flat), flat)
    return words, flat


def _rare_shares(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``row, share, n`` for each row that holds rare words: how many, and the sum of the logarithms of
    their shares of their buckets. Equal rows go as one, with all their words."""
    names = words.words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, held, size = pa.array(names, pa.large_binary()), [], [], 0
        for part, texts in text_slices(batches):
            rows += part.column("row").to_pylist()
            held += texts
            size += sum(map(len, texts))
            if size >= SHARE_BYTES:
                yield from written(rows, held, known)
                rows, held, size = [], [], 0
        if held:
            yield from written(rows, held, known)

    def written(rows: list[int], texts: list[bytes], known: pa.Array) -> Iterator[pa.RecordBatch]:
        found, codes, document = _words(texts)
        rare = (pc.index_in(found, value_set=known).is_null().to_numpy(zero_copy_only=False))[codes]
        pairs, n = np.unique(codes[rare].astype(np.int64) * len(texts) + document[rare], return_counts=True)
        word = pairs // len(texts)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        in_rows = pa.StructArray.from_arrays(
            [pa.array(np.array(rows, np.int64)[pairs % len(texts)]), pa.array(n.astype(np.int32))], ["row", "n"])
        holders = pa.ListArray.from_arrays(pa.array(np.append(starts, len(pairs)).astype(np.int32)), in_rows)
        own = found.take(pa.array(word[starts])).cast(pa.binary())
        batch = pa.RecordBatch.from_arrays([own, holders], ["word", "holders"])
        for a in range(0, batch.num_rows, 8 * OUT_ROWS):
            yield batch.slice(a, 8 * OUT_ROWS)

    held = docs.mapInArrow(run, "word binary, holders array<struct<row: long, n: int>>")
    buckets = F.array(*[F.lit(n).cast("long") for n in words.counts[WORDS:]])
    whole = F.get(buckets, F.pmod(F.crc32("word"), F.lit(BUCKETS)).cast("int"))
    # A word that the corpus doesn't hold counts as one more.
    share = F.when(F.col("n").isNull(), -F.log(whole + 1.0)).otherwise(F.log(F.col("n") / whole))
    each = held.join(words.counted, "word", "left").select(share.alias("share"), F.inline("holders"))
    return each.groupBy("row").agg(F.sum(F.col("share") * F.col("n")).alias("share"), F.sum("n").alias("n"))


def score(docs: DataFrame, words: Vocabulary, flat: np.ndarray) -> DataFrame:
    """``doc_id, n_tokens, log_prob, mean_log_prob`` of every row, over its whole text.

    ``log_prob`` is the sum of the natural logarithms; a null or empty text has no words, the sum 0
    and no mean. Repeated rows stay; extra columns are left behind; an empty table gives an empty
    one.
    """
    names = words.words

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = pa.array(names, pa.large_binary()), Network(flat.copy())
        for part, texts in text_slices(batches):
            numbers, places, document = _numbered(texts, known)
            sums = np.zeros(len(texts))
            for i, window, target in _batches(numbers, places, SCORED):
                logs = model.log_probabilities(window, target)
                sums += np.bincount(document[i:i + SCORED], weights=logs, minlength=len(texts))
            n = np.bincount(document, minlength=len(texts))
            rare = np.bincount(document[numbers[places] >= WORDS], minlength=len(texts))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "row": part.column("row"), "n_tokens": pa.array(n.astype(np.int64)),
                "n_rare": pa.array(rare.astype(np.int64)), "network": pa.array(sums)})

    plain = ids_and_bytes(docs)
    keyed = plain.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = keyed.mapInArrow(run, "doc_id long, row long, n_tokens long, n_rare long, network double")
    shares = _rare_shares(keyed.select("row", "text"), words)
    # Equal rows share one sum over all their words.
    part = F.coalesce(F.col("share") * (F.col("n_rare") / F.col("n")), F.lit(0.0))
    summed = rows.join(shares, "row", "left").select("doc_id", "n_tokens", (F.col("network") + part).alias("log_prob"))
    return summed.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
