"""Documents of the given tables as files: one for each order date."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.session import shared_dir
from harness.registry import table


def put_files(texts: DataFrame, folder: str) -> str:
    """Write ``texts(file_key, text)`` as ``<folder>/<file_key>.json``, each task its own; the folder."""
    place = Path(urlparse(folder).path)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place.mkdir(parents=True, exist_ok=True)
        for batch in batches:
            for row in batch.to_pylist():
                (place / f"{row['file_key']}.json").write_text(row["text"])
            yield batch.select(["file_key"])

    texts.select("file_key", "text").mapInArrow(write, "file_key string").count()
    return folder


def files_by_date(spark, sf_dir: str, name: str, item: Column, start: str, separator: str, end: str,
                  broken: Column | None = None) -> str:
    """A folder with a file for each order date: its orders' items by key between ``start`` and ``end``.

    The file of a date on which ``broken`` holds for any order breaks off after its items.
    """
    rows = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_key")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", item.alias("item")))).alias("items"),
        F.max(F.lit(False) if broken is None else broken).alias("broken"),
    )
    text = F.concat(F.lit(start), F.array_join("items.item", separator),
                    F.when(F.col("broken"), separator).otherwise(end))
    return put_files(rows.select("file_key", text.alias("text")), shared_dir(spark, name))
