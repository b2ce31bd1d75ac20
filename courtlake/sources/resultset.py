"""Result-set documents: ``resultSets[{name, headers[], rowSet[][]}]``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode_resultset(docs: DataFrame, position: int | None = 0, name: str | None = None) -> DataFrame:
    """One row per row of the wanted result set.

    The set is chosen by position, or by ``name`` (the first one so called).
    Output: the other columns of ``docs``, ``_row_pos``, and ``row``, a map from
    header to cell text. A row whose length differs from the header has a null
    ``row``; the caller decides whether that fails its file.
    """
    carried = [c for c in docs.columns if c != "resultSets"]
    if name is not None:
        chosen = F.get(F.filter("resultSets", lambda rs: rs["name"] == name), F.lit(0))
    else:
        chosen = F.get(F.col("resultSets"), F.lit(position))
    picked = docs.select(*carried, chosen.alias("_set"))
    rows = picked.select(
        *carried, F.col("_set.headers").alias("_headers"),
        F.posexplode("_set.rowSet").alias("_row_pos", "_cells"),
    )
    fits = F.size("_headers") == F.size("_cells")
    return rows.select(
        *carried, "_row_pos", F.when(fits, F.map_from_arrays("_headers", "_cells")).alias("row")
    )


def header_column(name: str, alias: str | None = None) -> Column:
    """Cell text under a header."""
    return F.col("row")[name].alias(alias or name)


def project_row(rows: DataFrame, headers: list[str], keep: list[str] | None = None) -> DataFrame:
    """Named columns out of decoded rows."""
    kept = [c for c in rows.columns if c != "row"] if keep is None else keep
    return rows.select(*kept, *[header_column(h) for h in headers])
