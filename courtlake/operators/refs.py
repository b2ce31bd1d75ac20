"""Foreign keys: keep rows whose references exist, and account for the others.

No side is broadcast by hand. Spark broadcasts the referenced keys when their
size is below its threshold (checked again at run time) and otherwise joins by
shuffle, where adaptive execution splits a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """``column`` of the checked rows must occur as ``key`` in ``dimension``.

    ``since`` names an optional date column of the dimension: the reference
    then counts only for rows whose ``row_date`` is not before it.
    """

    column: str
    dimension: DataFrame
    key: str
    name: str
    since: str | None = None
    row_date: str = "game_date"

    def keys(self, unique: bool = False) -> DataFrame:
        columns = [F.col(self.key).alias("_ref_key")]
        if self.since:
            columns.append(F.col(self.since).alias("_ref_since"))
        keys = self.dimension.where(F.col(self.key).isNotNull()).select(*columns)
        if not unique:
            return keys
        if not self.since:
            return keys.distinct()
        # Several starts of one key: no start at all, else the earliest.
        known = F.count_if(F.col("_ref_since").isNull()) > 0
        return keys.groupBy("_ref_key").agg(
            F.when(~known, F.min("_ref_since")).alias("_ref_since")
        )

    def condition(self) -> Column:
        match = F.col(self.column) == F.col("_ref_key")
        if self.since:
            open_start = F.col("_ref_since").isNull()
            match = match & (open_start | (F.col("_ref_since") <= F.col(self.row_date)))
        return match


def fk_filter(df: DataFrame, references: list[Reference]) -> DataFrame:
    """Rows for which every reference exists; a null reference drops the row."""
    for reference in references:
        df = df.join(reference.keys(), reference.condition(), "left_semi")
    return df


def fk_flags(df: DataFrame, references: list[Reference]) -> DataFrame:
    """All rows, with one boolean ``_fk_<name>`` per reference."""
    for reference in references:
        flag = f"_fk_{reference.name}"
        keys = reference.keys(unique=True).withColumn("_ref_hit", F.lit(True))
        df = (
            df.join(keys, reference.condition(), "left")
            .withColumn(flag, F.coalesce("_ref_hit", F.lit(False)))
            .drop("_ref_key", "_ref_hit", *(["_ref_since"] if reference.since else []))
        )
    return df


def all_references(references: list[Reference]) -> Column:
    ok = F.lit(True)
    for reference in references:
        ok = ok & F.col(f"_fk_{reference.name}")
    return ok


def fk_rejects(df: DataFrame, references: list[Reference], table: str) -> DataFrame:
    """(table, fk, key, n): how many rows miss which referenced key."""
    flagged = fk_flags(df, references)
    missing = F.array(*[
        F.struct(
            F.lit(r.name).alias("fk"), F.col(r.column).cast("string").alias("key"),
            (~F.col(f"_fk_{r.name}")).alias("missing"),
        )
        for r in references
    ])
    return (
        flagged.select(F.inline(F.filter(missing, lambda m: m["missing"])))
        .groupBy("fk", "key").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("table"), "fk", "key", "n")
    )
