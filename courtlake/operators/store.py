"""The gold tables as Parquet, with keyed merges.

Every table is split by a hash of its first key column. A merge stages its source once, reads and
rewrites only the buckets that the source touches, and commits them as one snapshot
(:mod:`courtlake.operators.snapshots`): readers see all of a merge or nothing of it.
One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.functions.numbers import store_char, store_decimal, store_int
from courtlake.operators.refs import Reference, all_references, fk_flags
from courtlake.operators.sinks import play_order
from courtlake.operators.snapshots import BUCKET, SnapshotTable, bucket_of
from courtlake.operators.upsert import new_rows, upsert
from courtlake.schemas import GOLD, GoldTable
from courtlake.session import compiled, shared_dir
from courtlake.sources.files import path_exists, remove

# Hidden date of a stored row. Of a dimension row: the date whose box score first
# brought it, null when a dimension load did. Of a dated fact: the date it is from.
AS_OF = "_as_of"
# Of a source row: it was counted by an earlier load already.
AGAIN = "_again"


@dataclass(frozen=True)
class GoldStore:
    spark: SparkSession
    root: str
    fact_buckets: int
    dimension_buckets: int

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def snapshots(self, table: str) -> SnapshotTable:
        spec = GOLD[table]
        return SnapshotTable(self.spark, self.path(table), f"{spec.schema}, {AS_OF} date", tuple(spec.primary_key))

    def buckets(self, table: str) -> int:
        return self.dimension_buckets if table in schemas.DIMENSIONS else self.fact_buckets

    def bucket_of(self, table: str) -> Column:
        return bucket_of(GOLD[table].primary_key[0], self.buckets(table))


def create_tables(spark: SparkSession, root: str, fact_buckets: int = 64,
                  dimension_buckets: int = 1) -> GoldStore:
    """Create what is absent; an existing store keeps its bucket counts.

    Choose ``fact_buckets`` so that one bucket is a few file sizes large.
    """
    layout = f"{root}/_layout"
    if not path_exists(spark, f"{layout}/_SUCCESS"):
        spark.createDataFrame(
            [(fact_buckets, dimension_buckets)], "fact_buckets int, dimension_buckets int"
        ).coalesce(1).write.mode("overwrite").json(layout)
    kept = spark.read.schema("fact_buckets int, dimension_buckets int").json(layout).first()
    store = GoldStore(spark, root, kept.fact_buckets, kept.dimension_buckets)
    for table in GOLD:
        store.snapshots(table).create()
    return store


def scan_gold(store: GoldStore, table: str) -> DataFrame:
    return _scan_buckets(store, table).drop(BUCKET, AS_OF)


def _scan_buckets(store: GoldStore, table: str, buckets: list[int] | None = None) -> DataFrame:
    return store.snapshots(table).scan(buckets)


def typed_store(df: DataFrame, table: GoldTable) -> DataFrame:
    """Assignment of every supplied column to its stored type (see ``store_*``)."""
    numeric = ("double", "float", "bigint", "int", "smallint", "tinyint")
    kinds = dict(df.dtypes)
    columns = []
    for name in df.columns:
        kind = table.columns.get(name)
        column = F.col(name)
        if kind is None:
            columns.append(column)
            continue
        if kind.startswith("decimal"):
            precision, scale = kind[8:-1].split(",")
            column = store_decimal(column, int(precision), int(scale))
        elif kind.startswith("char"):
            column = store_char(column, int(kind[5:-1]))
        elif kind == "int" and kinds[name] in ("double", "float"):
            column = store_int(column)
        elif kind == "int" and kinds[name] in numeric:
            column = column.cast("int")
        else:
            column = column.cast(kind)
        columns.append(column.alias(name))
    return df.select(*columns)


def references_of(store: GoldStore, table: str, dated: bool = False) -> list[Reference]:
    """The references of a table against the stored dimensions.

    ``dated``: the checked rows have a ``game_date``, and do not see a dimension
    row that only a later date's box score brought.
    """
    return [
        Reference(column, _scan_buckets(store, dimension).select(key, AS_OF), key, dimension,
                  AS_OF if dated else None)
        for column, dimension, key in GOLD[table].references
    ]


def unstorable(df: DataFrame, table: GoldTable) -> Column:
    """Why a row can't be stored: the columns whose values their types don't hold; null if none."""
    kinds, found = dict(df.dtypes), []
    for name in df.columns:
        kind, column = table.columns.get(name), F.col(name)
        if kind is None or kind == kinds[name]:
            continue
        if kind.startswith("char"):
            bad = F.length(F.rtrim(column)) > int(kind[5:-1])
        else:
            number = kinds[name] in ("double", "float")
            stored = F.rint(column) if kind == "int" and number else column
            bad = column.isNotNull() & stored.try_cast(kind).isNull()
            bad = bad & ~F.isnan(column) if number else bad
        found.append(F.when(bad, f"{name}: no {kind}"))
    return F.nullif(F.concat_ws(", ", *found), F.lit("")) if found else F.lit(None).cast("string")


def merge_table(store: GoldStore, table: str, source: DataFrame,
                reduce: Callable[[DataFrame], DataFrame] = lambda rows: rows,
                rejects: list[DataFrame] | None = None, unique: bool = False) -> DataFrame:
    """Upsert ``source`` into a stored table; returns (table, staged, loaded, dropped).

    ``reduce`` leaves one row per key among those that pass the references.
    Columns of ``source`` that the table lacks serve these two steps only; of these
    ``game_date`` is also kept as the row's date: a fact never gives way to one of
    an earlier date, in whatever order they are loaded. Rows marked ``_again`` are
    merged but not counted. An empty source writes nothing.

    A value that its column can't hold fails the merge; where a list of ``rejects`` is given,
    its row is left out instead, and (source columns, ``_reason``, ``_raw``) are added to the list.
    ``unique``: ``reduce`` is known to leave one row for each key.
    """
    spec = GOLD[table]
    dated = "game_date" in source.columns and "game_date" not in spec.columns
    references = references_of(store, table, dated)
    if rejects is None:
        typed = typed_store(source, spec)
    else:
        fits = F.col("_reason").isNull()
        marked = source.withColumn("_reason", unstorable(source, spec))
        raw = F.when(~fits, F.to_json(F.struct(*[F.col(c) for c in source.columns if c in spec.columns])))
        marked = marked.withColumn("_raw", raw)
        # A row that doesn't fit gives up its values before they are cast.
        typed = typed_store(marked.select(*[
            F.when(fits, F.col(c)).alias(c) if c in spec.columns and c not in spec.primary_key[:1] else F.col(c)
            for c in marked.columns]), spec)
    # The source is computed once, with a flag for each reference; all else reads this copy.
    passes = all_references(references) & (F.col("_reason").isNull() if rejects is not None else F.lit(True))
    path = shared_dir(store.spark, f"staged-{table}")
    flagged = fk_flags(typed, references).select(
        *typed.columns, store.bucket_of(table).alias(BUCKET), passes.alias("_ok"))
    with compiled(flagged.sparkSession):
        flagged.write.parquet(path)
    staged_rows = store.spark.read.schema(flagged.schema).parquet(path)
    counted = ~F.col(AGAIN) if AGAIN in source.columns else F.lit(True)
    per_bucket = staged_rows.groupBy(BUCKET).agg(
        F.count_if(counted).alias("staged"), F.count_if(counted & F.col("_ok")).alias("loaded"),
        F.count_if("_ok").alias("merged"),
        *([F.count("_reason").alias("bad")] if rejects is not None else []),
    ).collect()
    staged, loaded = sum(r.staged for r in per_bucket), sum(r.loaded for r in per_bucket)
    touched = sorted(r[BUCKET] for r in per_bucket if r.merged)
    kept_copy = rejects is not None and any(r.bad for r in per_bucket)
    if kept_copy:
        rejects.append(staged_rows.where("_reason is not null"))
    if touched:
        supplied = [c for c in typed.columns if c in spec.columns]
        if set(supplied) - set(spec.primary_key):
            row_date = F.col("game_date") if dated else F.lit(None).cast("date")
            supplied.append(row_date.alias(AS_OF))
        accepted = reduce(staged_rows.where("_ok").drop("_ok", BUCKET)).select(*supplied)
        old = _scan_buckets(store, table, touched).drop(BUCKET)
        # Where there are rows to meet, the count of each key costs nothing beside the join.
        first = unique and not set(touched) & set(store.snapshots(table).current().parts)
        merged = upsert(old, accepted, list(spec.primary_key), AS_OF if dated else None, unique=first)
        store.snapshots(table).replace(_placed(store, table, merged), touched)
    if not kept_copy:
        remove(store.spark, path)
    return store.spark.createDataFrame(
        [(table, staged, loaded, staged - loaded)],
        "table string, staged bigint, loaded bigint, dropped bigint",
    )


def append_absent(store: GoldStore, table: str, stubs: DataFrame, unique: bool = False) -> None:
    """Insert rows whose key the table lacks; known rows are neither read in full nor rewritten.

    A column ``since`` of the stubs becomes the rows' date. ``unique``: no key comes twice.
    """
    spec = GOLD[table]
    known = scan_gold(store, table)
    fresh = new_rows(known, typed_store(stubs, spec), list(spec.primary_key), unique=unique)
    row_date = F.col("since") if "since" in stubs.columns else F.lit(None).cast("date")
    complete = fresh.select(*[
        F.col(c) if c in fresh.columns else F.lit(None).cast(t).alias(c)
        for c, t in spec.columns.items()
    ], row_date.alias(AS_OF))
    store.snapshots(table).append(_placed(store, table, complete))


def date_back(store: GoldStore, table: str, stubs: DataFrame) -> None:
    """Let stubs of an earlier date take the place of stubs that a later date had brought.

    Rows of a dimension load stay as they are. Nothing is written when none is earlier.
    """
    spec = GOLD[table]
    key = spec.primary_key[0]
    held = _scan_buckets(store, table).select(F.col(key).alias("_held"), F.col(AS_OF).alias("_from"))
    typed = typed_store(stubs, spec).withColumnRenamed("since", AS_OF)
    earlier = typed.join(held, (F.col(key) == F.col("_held")) & (F.col(AS_OF) < F.col("_from")), "left_semi")
    touched = [r[0] for r in earlier.select(store.bucket_of(table)).distinct().collect()]
    if touched:
        old = _scan_buckets(store, table, touched).drop(BUCKET)
        store.snapshots(table).replace(_placed(store, table, upsert(old, earlier, [key])), touched)


def brought_by(store: GoldStore, table: str, dates: DataFrame) -> DataFrame:
    """(key, since) of the dimension rows that the box scores of these dates first brought."""
    key = GOLD[table].primary_key[0]
    rows = _scan_buckets(store, table).select(key, F.col(AS_OF).alias("since"))
    return rows.join(dates.select(F.col("game_date").alias("since")).distinct(), "since", "left_semi")


def _placed(store: GoldStore, table: str, df: DataFrame) -> DataFrame:
    """Rows with their bucket, dealt out for few files per bucket."""
    placed = df.withColumn(BUCKET, store.bucket_of(table)).hint("rebalance", BUCKET)
    return placed.sortWithinPartitions(BUCKET, *play_order()) if table == "fact_play_by_play" else placed
