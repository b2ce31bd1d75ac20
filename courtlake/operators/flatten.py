"""Nested documents to flat rows, and renames to a target layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.functions.text import extras, get_or_default

# Bits of a row position below its side: wider than any array's positions.
SIDE_SHIFT = 40


def flatten_sides(docs: DataFrame, payload: str = "boxScoreAdvanced") -> DataFrame:
    """One row per player, home side first, with the team fields copied down.

    Output: the other columns of ``docs``, ``side`` (HOME/AWAY), ``team``,
    ``player`` and ``statistics`` (maps of text, so absent and null stay apart)
    and ``_row_pos``. A document without payload, side or players gives no rows.
    All JSON is parsed inside the generators: what a generator puts out is never
    computed again by a later filter.
    """
    carried = [c for c in docs.columns if c != payload]
    home = F.struct(F.lit("HOME").alias("side"), F.col(f"{payload}.homeTeam").alias("team"))
    away = F.struct(F.lit("AWAY").alias("side"), F.col(f"{payload}.awayTeam").alias("team"))
    sides = docs.where(F.col(payload).isNotNull()).select(
        *carried, F.posexplode(F.array(home, away)).alias("_side_pos", "_side")
    )
    players = F.transform(
        F.from_json(F.col("_side.team")["players"], schemas.PLAYER_LIST),
        lambda p: F.struct(
            p.alias("player"),
            F.coalesce(
                F.from_json(p["statistics"], schemas.STATISTICS),
                F.create_map().cast(schemas.STATISTICS),
            ).alias("statistics"),
        ),
    )
    return sides.select(
        *carried, "_side_pos", F.col("_side.side").alias("side"), F.col("_side.team").alias("team"),
        F.posexplode(players).alias("_player_pos", "_player"),
    ).select(
        *carried, "side", F.map_filter("team", lambda k, _: k != "players").alias("team"),
        "_player.player", "_player.statistics",
        # Home players come first whatever their number.
        (F.shiftleft(F.col("_side_pos").cast("bigint"), SIDE_SHIFT) + F.col("_player_pos")).alias("_row_pos"),
    )


def literal_side(condition: Column, when_true: str = "HOME", otherwise: str = "AWAY") -> Column:
    return F.when(condition, when_true).otherwise(otherwise)


def player_columns(statistics: str = "statistics") -> dict[str, Column]:
    """Base columns of a flattened player; a statistic of the same name replaces one."""
    base = {
        out: F.col("player")[field] if out == "PERSON_ID" else get_or_default("player", field)
        for out, field in schemas.PLAYER_FIELDS.items()
    }
    base["TEAM_ID"] = F.col("team")["teamId"]
    base["TEAM_TRICODE"] = get_or_default("team", "teamTricode")
    base["TEAM_TYPE"] = F.col("side")
    return {
        name: F.when(
            F.map_contains_key(statistics, F.lit(name)), F.col(statistics)[name]
        ).otherwise(column)
        for name, column in base.items()
    }


def spread_map(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """One text column per map key, replacing the map.

    Without ``keys`` the set of columns is the union over all rows; only the
    distinct names reach the driver, where the schema that they make is kept anyway.
    """
    names = map_key_names(df, column) if keys is None else keys
    others = [c for c in df.columns if c != column and c not in names]
    return df.select(*others, *[F.col(column)[k].alias(k) for k in names])


def map_key_names(df: DataFrame, column: str) -> list[str]:
    found = df.select(F.explode(F.map_keys(column)).alias("k")).distinct()
    return sorted(row.k for row in found.collect())


def open_columns(df: DataFrame, column: str, declared: list[str]) -> DataFrame:
    """Declared keys as columns, everything else kept in ``extras``."""
    others = [c for c in df.columns if c != column]
    return df.select(
        *others, *[F.col(column)[k].alias(k) for k in declared],
        extras(column, declared).alias("extras"),
    )


def conform(df: DataFrame, mapping: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Rename and project to a target layout (target <- source).

    A missing source column is an error, as in any projection.
    """
    return df.select(
        *[F.col(source).alias(target) for target, source in mapping.items()], *(keep or [])
    )


def concat_frames(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
