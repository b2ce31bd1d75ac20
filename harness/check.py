"""Compare registered queries with their SQL: ``python -m harness.check SF_DIR [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from harness.registry import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(arrow_table, names) -> Counter:
    columns = [arrow_table.column(n).to_pylist() for n in names]
    return Counter(tuple(_value(v) for v in row) for row in zip(*columns))


def _types(arrow_table) -> dict[str, str]:
    alias = {"large_string": "string", "date32[day]": "date"}
    return {f.name: alias.get(str(f.type), str(f.type)) for f in arrow_table.schema}


def compare(spark, con, sf_dir: str, key: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    mine = QUERIES[key](spark, sf_dir).toArrow()
    if key not in ORACLES:
        return [] if mine.num_rows else ["no rows"]
    theirs = con.sql(ORACLES[key]).to_arrow_table()
    problems = []
    if _types(mine) != _types(theirs):
        a, b = _types(mine), _types(theirs)
        both = {n: (a.get(n), b.get(n)) for n in sorted({*a, *b}) if a.get(n) != b.get(n)}
        problems.append(f"types differ: {both}")
    if set(mine.column_names) == set(theirs.column_names):
        names = sorted(mine.column_names)
        left, right = _rows(mine, names), _rows(theirs, names)
        if left != right:
            problems.append(
                f"rows differ: {mine.num_rows} here, {theirs.num_rows} in SQL; only here"
                f" {list((left - right).items())[:3]}; only in SQL {list((right - left).items())[:3]};"
                f" columns {names}"
            )
    if mine.num_rows == 0:
        problems.append("no rows")
    return problems


def main() -> int:
    import harness.queries  # noqa: F401  registers everything
    from courtlake.session import build_session

    sf_dir, keys = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for key in keys:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, key)
        except Exception as error:  # report every query, then fail
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not problems else 'FAIL'} {key} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
        failed += [key] if problems else []
    print(f"{len(keys) - len(failed)}/{len(keys)} agree", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
