"""Data contracts: every check of a dataset in one aggregation.

The distinct count of the primary key makes Spark aggregate in two steps (per
key, then per group), both with partial sums on the map side, so neither a big
group nor a hot key is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.functions.numbers import coerce_double
from courtlake.schemas import Contract
from courtlake.session import written_once

# The texts of issues, as reports show them.
DUPLICATE_TEXT = "DUPLICATE PK: %s rows on {key}"
MISSING_TEXT = "MISSING COLUMN: {column}"
NULL_TEXT = "NULL: {column} has %s/%s nulls"
ROWS_TEXT = "ROW COUNT: %s rows (expected ≥{least})"
RANGE_TEXT = "RANGE: {column} has %s values {side} {bound}"


def _filled(text: str, *numbers: Column) -> Column:
    """The text with a number in place of each ``%s``; a format would be parsed anew for each row and check."""
    first, *rest = text.split("%s")
    return F.concat(F.lit(first), *[
        part for n, after in zip(numbers, rest) for part in (n.cast("string"), F.lit(after))])


def _numeric(df: DataFrame, column: str) -> Column:
    """The column as a double without NaN; text that is no number counts as missing."""
    kind = dict(df.dtypes)[column]
    value = coerce_double(column) if kind == "string" else F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        missing = missing | F.isnan(column)
    return missing


def pct_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_null, n_total, pct_null) per column, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.count_if(_is_missing(df, c)).alias(f"_null_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_null_{i}").alias("n_null"))
        for i, c in enumerate(columns)
    ])
    return counted.select("n_total", F.inline(rows)).select(
        "column", "n_null", "n_total",
        F.try_divide(F.col("n_null") * F.lit(100.0), F.col("n_total")).alias("pct_null"),
    )


def conditional_counts(df: DataFrame, conditions: dict[str, Column],
                       by: list[str] | None = None) -> DataFrame:
    """Per condition, how many rows meet it (``n_*``) and whether any does (``any_*``)."""
    counts = [F.count_if(c).alias(f"n_{name}") for name, c in conditions.items()]
    counted = df.groupBy(*(by or [])).agg(*counts)
    return counted.select("*", *[(F.col(f"n_{n}") > 0).alias(f"any_{n}") for n in conditions])


def check_contract(df: DataFrame, contract: Contract, source: str,
                   group: str | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """Contract results as (source, n_total, checks), one row per group.

    ``source`` names the dataset; with ``group`` each value of that column is a
    dataset of its own called ``source/value``, and apart for each value of the
    columns ``within``. ``checks`` lists every check with
    its number of offending rows; zero means passed. Not-null columns that do not
    exist are reported, range columns that do not exist are ignored.
    """
    aggregates = [F.count(F.lit(1)).alias("_total")]
    checks: list[tuple[str, str | None, Column, Column, Column]] = []
    nothing = F.lit(None).cast("string")

    if contract.primary_key:
        key = list(contract.primary_key)
        aggregates.append(F.count_distinct(F.struct(*key)).alias("_keys"))
        repeated = F.col("_total") - F.col("_keys")
        text = _filled(DUPLICATE_TEXT.format(key=key), repeated)
        checks.append(("pk_unique", ",".join(key), repeated, nothing, text))
    for i, column in enumerate(contract.not_null):
        if column not in df.columns:
            text = F.lit(MISSING_TEXT.format(column=column))
            checks.append(("missing_column", column, F.lit(1).cast("bigint"), nothing, text))
            continue
        name = f"_null_{i}"
        aggregates.append(F.count_if(_is_missing(df, column)).alias(name))
        text = _filled(NULL_TEXT.format(column=column), F.col(name), F.col("_total"))
        checks.append(("not_null", column, F.col(name), nothing, text))
    if contract.min_rows is not None:
        least = contract.min_rows
        short = F.when(F.col("_total") < least, F.lit(least) - F.col("_total")).otherwise(0)
        text = _filled(ROWS_TEXT.format(least=least), F.col("_total"))
        checks.append(("min_rows", None, short.cast("bigint"), F.lit(str(least)), text))
    for i, (column, lowest, highest) in enumerate(contract.ranges):
        if column not in df.columns:
            continue
        value = _numeric(df, column)
        for side, bound, outside in (
            ("below", lowest, value < F.lit(lowest)), ("above", highest, value > F.lit(highest)),
        ):
            if bound is None:
                continue
            name = f"_{side}_{i}"
            aggregates.append(F.count_if(outside).alias(name))
            text = _filled(
                RANGE_TEXT.format(column=column, side=side, bound=bound), F.col(name))
            checks.append((f"range_{side}", column, F.col(name), F.lit(str(bound)), text))

    by = [F.col(group).alias("_group")] if group else []
    grouped = df.groupBy(*by, *within).agg(*aggregates)
    label = (
        F.concat_ws("/", F.lit(source), F.coalesce(F.col("_group").cast("string"), F.lit("null")))
        if group else F.lit(source)
    )
    listed = F.array(*[
        F.struct(
            F.lit(seq).alias("seq"), F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"), n_bad.alias("n_bad"),
            bound.alias("bound"), message.alias("message"),
        )
        for seq, (check, column, n_bad, bound, message) in enumerate(checks)
    ])
    return grouped.select(label.alias("source"), F.col("_total").alias("n_total"),
                          listed.alias("checks"))


def check_pk_unique(df: DataFrame, key: list[str], source: str, group: str | None = None) -> DataFrame:
    return check_contract(df, Contract(primary_key=tuple(key)), source, group)


def check_not_null(df: DataFrame, columns: list[str], source: str, group: str | None = None) -> DataFrame:
    return check_contract(df, Contract(not_null=tuple(columns)), source, group)


def check_range(df: DataFrame, column: str, lowest, highest, source: str,
                group: str | None = None) -> DataFrame:
    return check_contract(df, Contract(ranges=((column, lowest, highest),)), source, group)


def check_min_rows(df: DataFrame, min_rows: int, source: str, group: str | None = None) -> DataFrame:
    return check_contract(df, Contract(min_rows=min_rows), source, group)


def all_checks(results: DataFrame) -> DataFrame:
    """Long form: one row per source and check."""
    return results.select("source", "n_total", F.inline("checks")).select(
        "source", "seq", "check", "column", "n_bad", "n_total", "bound", "message"
    )


def issues(results: DataFrame) -> DataFrame:
    """Long form of the failed checks only."""
    failed = F.filter("checks", lambda c: c["n_bad"] > 0)
    return all_checks(results.withColumn("checks", failed))


def passed_failed(results: DataFrame) -> DataFrame:
    """(checked, passed, failed) over all sources."""
    has_issue = F.exists("checks", lambda c: c["n_bad"] > 0)
    return results.agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~has_issue).alias("passed"),
        F.count_if(has_issue).alias("failed"),
    )


def validation_report(*results: DataFrame) -> DataFrame:
    """Totals line and one line per issue: (source, seq, line).

    Nothing checked gives an empty report.
    """
    everything = results[0]
    for other in results[1:]:
        everything = everything.unionByName(other)
    # Both parts read the failed checks, which are found in one pass over the checked rows.
    failed = F.filter("checks", lambda c: c["n_bad"] > 0)
    everything = written_once(everything.sparkSession, everything.withColumn("checks", failed), "checked")
    totals = passed_failed(everything).where("checked > 0").select(
        F.lit("*").alias("source"), F.lit(-1).alias("seq"),
        F.concat(F.lit("checked "), "checked", F.lit(", passed "), "passed",
                 F.lit(", failed "), "failed").alias("line"),
    )
    return totals.unionByName(
        issues(everything).select("source", "seq", F.col("message").alias("line"))
    )


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "source string, seq int, line string")
