"""Best-fit packing planned over a histogram of lengths.

Documents are cut into pieces of at most the capacity. Only the count of each length goes to the
driver (as many numbers as the capacity at most); best fit with the longest first is carried out
on these counts, many equal pieces at a time. The plan says which ranks of a length go to which
sequences, and each piece takes its slot by its rank within its length. Ranks come from counts for
each task and length, so that a length that holds most pieces is ranked in parallel.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, ids_and_bytes, saved, text_slices
from courtlake.llm.tokens import encoder, id_lists

#: Columns of a plan: pieces of ``length`` from ``rank`` on, ``each`` to a sequence, from sequence
#: ``sequence`` on, the first of each at ``offset``.
PLAN = ("length", "rank", "each", "sequence", "offset")


def plan_slots(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit, longest first, over counts: rows of ``PLAN`` sorted by length and rank."""
    rows: list[tuple[int, int, int, int, int]] = []
    free: list[int] = []  # room left in open sequences, ascending
    open_: dict[int, deque[tuple[int, int]]] = {}  # room: (first sequence, how many)
    sequences = 0

    def put(room: int, first: int, many: int) -> None:
        if room not in open_:
            insort(free, room)
            open_[room] = deque()
        open_[room].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                room = free[at]
                first, many = open_[room].popleft()
                if not open_[room]:
                    del open_[room], free[at]
            else:
                room, first = capacity, sequences
                many = -(-left // (capacity // length))
                sequences += many
            each = room // length
            full = min(many, left // each)
            used = full
            if full:
                rows.append((length, rank, each, first, capacity - room))
                put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < many:  # the last sequence takes what is left
                rows.append((length, rank, left, first + full, capacity - room))
                put(room - left * length, first + full, 1)
                used, rank, left = full + 1, rank + left, 0
            if used < many:
                put(room, first + used, many - used)
    return np.array(sorted(rows), np.int64).reshape(-1, len(PLAN))


def cut_pieces(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int,
               capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, nth, ids``: each document's pieces.

    ``nth`` counts the pieces of one length within one task. Only documents longer than the
    capacity are cut; then the first piece is the one that may be shorter.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()),
        ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer, keeps_space).ids, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for part, texts in text_slices(batches, encoding=True):
            rows, cut = [], []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                total = len(ids) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[4 * a:4 * b]), task, seen[b - a]))
                    cut.append(ids[4 * a:4 * b])
                    seen[b - a] += 1
            columns = dict(zip(schema.names, zip(*rows)))
            yield arrow_batch(schema, **columns, ids=id_lists(cut))

    return ids_and_bytes(docs).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long, "
             "ids array<int>")


def _placed(pieces: DataFrame, plan: np.ndarray) -> DataFrame:
    """Add ``sequence_id, offset``; the plan has a few rows a length, whatever the corpus."""
    high = 1 << 40
    key = plan[:, 0] * high + plan[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            slot = plan[np.searchsorted(key, length * high + rank, "right") - 1]
            nth, each = rank - slot[:, 1], slot[:, 2]
            table = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            table["sequence_id"] = pa.array(slot[:, 3] + nth // each)
            table["offset"] = pa.array(slot[:, 4] + nth % each * length)
            yield pa.RecordBatch.from_pydict(table)

    kept = [f"{n} {t}" for n, t in pieces.dtypes if n != "rank"]
    return pieces.mapInArrow(run, ", ".join([*kept, "sequence_id long", "offset long"]))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, keeps_space: bool = True,
         end_id: int = 2, capacity: int = 1024, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` ids.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and ``ids``. Null
    and empty texts are one piece of the end id. Repeated rows and rows without doc_id are packed
    like others; extra columns are left behind; an empty table gives an empty one.
    """
    pieces = saved(spark, cut_pieces(docs, tokenizer, keeps_space, end_id, capacity), "packing-pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    bases = saved(spark, counts.withColumn("base", F.sum("n").over(before) - F.col("n")),
                  "packing-bases")
    histogram = {r.length: r.n for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_slots(histogram, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = pieces.join(bases.select("length", "task", "base"), ["length", "task"]).select(
        *columns, (F.col("base") + F.col("nth")).alias("rank"))
    return _placed(ranked, plan)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the pieces of each sequence joined (no more than the capacity)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
