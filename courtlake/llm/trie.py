"""The prefix trie of conversations, by halving depths (van Emde Boas recursion).

A trie of height 2^j is cut at half depth into an upper trie and a lower forest under each cut prefix.
Both are tries of half the height and are treated in the same way, all of one size at once, so a
trie of depth D takes log2(D) rounds however many conversations share a turn:

1. Upwards, blocks of 1, 2, 4, ... turns get fingerprints, each made of its two halves. A half
   is a cut prefix of the trie that starts where the block starts.
2. Downwards, every block learns the name of all that stands before it: a left half keeps the name of
   its trie, a right half is in the forest under its left sibling's prefix. At blocks of one turn
   this names the trie's nodes. A node then goes by its smallest member and its depth.
3. Totals are grafted upwards: what a node adds to a subtree it adds, at each round where it was in a
   lower forest, to that forest's total, and the total goes to the path above the cut. These
   paths together are the path to the root, so nothing is counted twice.

A step works on rows (conversation, block), never on whole conversations or on the members of a
node, so neither a very long conversation nor a turn that all conversations share is one task's.
Below a node with a single member there is nothing to add up: its subtree is one path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from courtlake.llm.common import arrow_batch, saved

KEY = ["conv_id", "pos"]


def number_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, chars``: turns in order, with a fingerprint of role and text.

    Turns are ordered by ``turn`` (null first), equal ones by role and text; null role and text are
    empty. Rows without conv_id are left out. The rows are sorted as one table and numbered by
    counts for each task, since one conversation may hold much of the table.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
        F.monotonically_increasing_id().alias("row")).where("conv_id is not null")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    own = F.monotonically_increasing_id()
    ordered = saved(
        spark,
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", F.shiftright(own, 33).alias("task"), own.alias("nth"),
            F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
            F.length("text").cast("long").alias("chars")),
        "trie-turns")
    counts = ordered.groupBy("conv_id", "task").agg(F.min("nth").alias("first"), F.count("*").alias("many"))
    before = F.sum("many").over(Window.partitionBy("conv_id").orderBy("task")) - F.col("many")
    bases = saved(spark, counts.select("conv_id", "task", (before - F.col("first")).alias("base")), "trie-bases")
    return ordered.join(bases, ["conv_id", "task"]).select(
        "conv_id", (F.col("nth") + F.col("base")).alias("pos"), "a", "b", "chars")


def with_shared_openings(spark: SparkSession, turns: DataFrame, every: int = 100,
                         most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Numbered turns and all ids, each conversation's opening exchanged for that of its group.

    The first h turns of conversation c (h = crc32 of the decimal id, modulo ``most`` + 1) give way to
    the first h of conversation c - c % ``every`` (all if fewer, none if it is absent).
    """
    conv = F.col("conv_id")
    ids = saved(spark, turns.where("pos = 0").select(
        "conv_id", (conv - F.pmod(conv, F.lit(every))).alias("source"),
        F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(most + 1)).alias("h")), "trie-ids")
    openings = saved(spark, turns.where((F.col("pos") < most) & (F.pmod(conv, F.lit(every)) == 0))
                     .withColumnRenamed("conv_id", "source"), "trie-openings")
    sizes = openings.groupBy("source").agg(F.count("*").alias("size"))
    known = ids.join(sizes, "source", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("size", F.lit(0))).alias("given"))
    known = saved(spark, known, "trie-given")
    taken = ids.join(openings, "source").where("pos < h").select(*KEY, "a", "b", "chars")
    kept = turns.join(known, "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "a", "b", "chars")
    return taken.unionByName(kept), ids.select("conv_id")


def _pair(*columns: Column | str) -> tuple[Column, Column]:
    """Two independent 64-bit fingerprints of the columns."""
    return F.xxhash64(F.lit(2), *columns), F.xxhash64(F.lit(3), *columns)


def _blocks(spark: SparkSession, turns: DataFrame, rounds: int) -> list[DataFrame]:
    """For each round ``conv_id, block, a, b`` and, above the first, the left half's ``la, lb``."""
    levels = [turns.select("conv_id", F.col("pos").alias("block"), "a", "b")]
    for _ in range(rounds):
        left = F.col("block") % 2 == 0
        halves = levels[-1].groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(
            *[F.max(F.when(side, F.col(c))).alias(n + c)
              for side, n in ((left, "l"), (~left, "r")) for c in "ab"])
        a, b = _pair("la", "lb", "ra", "rb")
        levels.append(saved(spark, halves.select("conv_id", "block", a.alias("a"), b.alias("b"), "la", "lb"),
                            "trie-blocks"))
    return levels


def _named(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b``: a name of the prefix that ends with each turn."""
    depth = turns.agg(F.max("pos")).first()[0]
    rounds = 0 if depth is None else int(depth).bit_length()
    levels = _blocks(spark, turns, rounds)
    names = levels[-1].select("conv_id", "block", *[c for c in levels[-1].columns if c in ("la", "lb")],
                              F.lit(0).cast("long").alias("sa"), F.lit(0).cast("long").alias("sb"))
    for level in levels[-2::-1]:
        above = names.select("conv_id", F.col("block").alias("up"), F.col("la").alias("ua"),
                             F.col("lb").alias("ub"), "sa", "sb")
        right = F.col("block") % 2 == 1
        under = _pair("sa", "sb", "ua", "ub")
        joined = level.withColumn("up", F.shiftright("block", 1)).join(above, ["conv_id", "up"])
        names = saved(spark, joined.select(
            *level.columns, F.when(right, under[0]).otherwise(F.col("sa")).alias("sa"),
            F.when(right, under[1]).otherwise(F.col("sb")).alias("sb")), "trie-names")
    if not rounds:  # at most one turn each
        names = turns.select("conv_id", F.col("pos").alias("block"), "a", "b",
                             F.lit(0).cast("long").alias("sa"), F.lit(0).cast("long").alias("sb"))
    end = _pair("sa", "sb", "a", "b")
    return names.select("conv_id", F.col("block").alias("pos"), end[0].alias("a"), end[1].alias("b"))


def _grafted(nodes: DataFrame, member: DataFrame) -> DataFrame:
    """``node, pos, leaves, saved`` that lower forests add to each node above them.

    ``nodes(node, pos, leaves, saved)`` are those that add something; ``member(conv_id, pos, node)``
    has every turn's node.
    """
    # The rounds in which a node was in a lower forest: the bits of its place.
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda j: F.call_function("getbit", F.col("pos"), j) == 1))
    cut = F.expr("shiftleft(shiftright(pos, bit), bit)")
    forests = nodes.withColumn("bit", bit).groupBy("node", cut.alias("cut"), "bit").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # The same forest may have come under several of its members: it goes by its cut node.
    by_cut = forests.join(
        member.select(F.col("conv_id").alias("node"), (F.col("pos") + 1).alias("cut"), F.col("node").alias("top")),
        ["node", "cut"]).groupBy("top", "cut", "bit").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    path = F.expr("sequence(cut - shiftleft(1L, bit), cut - 1)")
    return by_cut.select(F.col("top").alias("conv_id"), F.explode(path).alias("pos"), "leaves", "saved").join(
        member, KEY).groupBy("node", "pos").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _digests(ends: DataFrame) -> DataFrame:
    """``node, pos, ends_sha256`` of ``ends(node, pos, conv_id)``.

    A digest is one pass over its ids in order. Sorted tasks write them as text first, so that the task
    that digests a node of very many ends reads a row for some thousands of them.
    """
    texts = pa.schema([("node", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()), ("text", pa.string())])
    digests = pa.schema([("node", pa.int64()), ("pos", pa.int64()), ("ends_sha256", pa.string())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, pos, conv = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "pos", "conv_id"))
            new = np.flatnonzero((node[1:] != node[:-1]) | (pos[1:] != pos[:-1])) + 1
            starts = np.concatenate([[0], new])
            ids = list(map(str, conv.tolist()))
            yield arrow_batch(texts, node=pa.array(node[starts]), pos=pa.array(pos[starts]),
                              first=pa.array(conv[starts]),
                              text=[",".join(ids[a:b]) for a, b in zip(starts, [*starts[1:], len(ids)])])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            rows = zip(*[batch.column(c).to_pylist() for c in ("node", "pos", "text")])
            for node, pos, text in rows:
                if (node, pos) == key:
                    sha.update(b"," + text.encode())
                else:
                    if key:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (node, pos), hashlib.sha256(text.encode())
            if done:
                yield arrow_batch(digests, **dict(zip(digests.names, zip(*done))))
        if key:
            yield arrow_batch(digests, node=[key[0]], pos=[key[1]], ends_sha256=[sha.hexdigest()])

    order = ["node", "pos", "conv_id"]
    written = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        write, "node long, pos long, first long, text string")
    return written.repartition("node", "pos").sortWithinPartitions("node", "pos", "first").mapInArrow(
        digest, "node long, pos long, ends_sha256 string")


def prefix_trie(spark: SparkSession, turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``turns(conv_id, pos, a, b, chars)``.

    ``ids(conv_id)`` are all conversations, also those without a turn; ids are unique and
    places gapless from 0 (``number_turns`` makes them so). ``conv_id`` is a node's smallest member,
    ``depth`` 0 the root; ``n_convs`` counts members, ``n_children`` and ``n_leaves`` nodes;
    ``saved_tokens`` sums over the subtree what members beyond the first repeat of the last text;
    ``ends_sha256`` digests the ids of members that end here. No ids give no node.
    """
    turns = saved(spark, turns, "trie-rebuilt")
    named = saved(spark, _named(spark, turns).join(turns.select(*KEY, "chars"), KEY), "trie-named")
    prefix = ["pos", "a", "b"]
    nodes = saved(
        spark,
        named.groupBy(*prefix).agg(F.min("conv_id").alias("node"), F.count("*").alias("n"),
                                   F.max("chars").alias("chars")), "trie-nodes")
    member = saved(spark, named.join(nodes.select(*prefix, "node", "n"), prefix).select(*KEY, "node", "n"),
                   "trie-members")
    everyone = ids.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    parents = member.select(F.col("conv_id").alias("node"), (F.col("pos") + 1).alias("pos"),
                            F.col("node").alias("parent"), F.col("n").alias("parent_n"))
    linked = nodes.join(parents, ["node", "pos"], "left").select(
        "node", "pos", "n", "chars", F.coalesce("parent", F.lit(everyone.least)).alias("parent"),
        F.coalesce("parent_n", F.lit(everyone.n)).alias("parent_n"))
    linked = saved(spark, linked, "trie-linked")
    children = linked.groupBy(F.col("parent").alias("node"), (F.col("pos") - 1).alias("pos")).agg(
        F.count("*").alias("n_children"))
    known = saved(spark, linked.join(children, ["node", "pos"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "trie-known")
    # A node of one member is the top of a path with one leaf; below it nothing adds anything.
    alone = F.col("n") == 1
    adds = known.where((F.col("n") > 1) | (F.col("parent_n") > 1) | (F.col("pos") == 0)).select(
        "node", "pos", F.when(alone | (F.col("n_children") == 0), 1).otherwise(0).alias("leaves"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    adds = saved(spark, adds, "trie-adds")
    total = adds.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).first()
    grafted = _grafted(adds, member.select(*KEY, "node")).withColumnsRenamed({"leaves": "g_leaves", "saved": "g_saved"})
    # Where each conversation ends: its last node, or the root.
    last = member.groupBy("conv_id").agg(F.max(F.struct("pos", "node")).alias("last"))
    ends = ids.join(last, "conv_id", "left").select(
        F.coalesce("last.node", F.lit(everyone.least)).alias("node"),
        F.coalesce("last.pos", F.lit(-1)).cast("long").alias("pos"), "conv_id")
    digests = saved(spark, _digests(ends), "trie-ends")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    below = known.join(adds.drop("n"), ["node", "pos"], "left").join(grafted, ["node", "pos"], "left").join(
        digests, ["node", "pos"], "left")
    zero = F.lit(0)
    found = below.select(
        F.col("node").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children",
        F.when(alone, 1).otherwise(F.col("leaves") + F.coalesce("g_leaves", zero)).cast("long").alias("n_leaves"),
        F.when(alone, 0).otherwise(F.col("saved") + F.coalesce("g_saved", zero)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
    if not everyone.n:
        return found
    opened, closed = (df.where("pos = -1").first() for df in (children, digests))
    root = (everyone.least, 0, None, everyone.n, opened.n_children if opened else 0, total.leaves or 1,
            total.saved or 0, closed.ends_sha256 if closed else hashlib.sha256(b"").hexdigest())
    return found.unionByName(spark.createDataFrame([root], found.schema))
