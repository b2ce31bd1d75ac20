"""Declared schemas, keys and contracts. Nothing is ever inferred from the data."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# Raw documents. The field names are those of the JSON files.
# Maps of text keep an absent key and an explicit null apart.
# --------------------------------------------------------------------------
MANIFEST_DOC = "game_date string, game_ids array<string>"
BOXSCORE_DOC = "boxScoreAdvanced struct<homeTeam: map<string,string>, awayTeam: map<string,string>>"
PLAYER_LIST = "array<map<string,string>>"
STATISTICS = "map<string,string>"
ACTIONS_DOC = "game struct<actions: array<map<string,string>>>"
RESULT_SET_DOC = (
    "resultSets array<struct<name: string, headers: array<string>, rowSet: array<array<string>>>>"
)
PLAYERS_DOC = "id string, full_name string, first_name string, last_name string, is_active boolean"

# --------------------------------------------------------------------------
# Silver columns. Names as delivered in the documents.
# --------------------------------------------------------------------------
PLAYER_FIELDS = {
    "PERSON_ID": "personId",
    "FIRST_NAME": "firstName",
    "FAMILY_NAME": "familyName",
    "NAME_I": "nameI",
    "POSITION": "position",
    "COMMENT": "comment",
    "JERSEY_NUM": "jerseyNum",
}
BOXSCORE_STATISTICS = [
    "minutes", "offensiveRating", "defensiveRating", "netRating", "usagePercentage",
    "trueShootingPercentage", "effectiveFieldGoalPercentage", "PIE",
]
ACTION_FIELDS = [
    "actionNumber", "clock", "period", "teamId", "personId", "actionType", "subType",
    "description", "shotDistance", "scoreHome", "scoreAway", "isFieldGoal",
]
SHOT_FIELDS = [
    "GRID_TYPE", "GAME_EVENT_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_NAME",
    "PERIOD", "MINUTES_REMAINING", "SECONDS_REMAINING", "EVENT_TYPE", "ACTION_TYPE", "SHOT_TYPE",
    "SHOT_ZONE_BASIC", "SHOT_ZONE_AREA", "SHOT_ZONE_RANGE", "SHOT_DISTANCE", "LOC_X", "LOC_Y",
    "SHOT_ATTEMPTED_FLAG", "SHOT_MADE_FLAG", "GAME_DATE", "HTM", "VTM",
]
# Spark does not tell GAME_DATE from the partition column game_date, so the
# shot's own date is stored under this name.
SHOT_DATE = "SHOT_DATE"
TEAM_TEXT_FIELDS = [
    "SEASON_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID", "MATCHUP", "WL", "MIN",
]
TEAM_COUNT_FIELDS = [
    "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB", "AST", "STL", "BLK",
    "TOV", "PF",
]
TEAM_PERCENT_FIELDS = ["FG_PCT", "FG3_PCT", "FT_PCT"]

# Order of the input, carried from the scan to every "keep the first" decision.
ORDER_COLUMNS = "_manifest_pos bigint, _row_pos bigint"

SILVER = {
    "boxscores": (
        "GAME_ID string, PERSON_ID bigint, FIRST_NAME string, FAMILY_NAME string, NAME_I string,"
        " POSITION string, COMMENT string, JERSEY_NUM string, TEAM_ID bigint, TEAM_TRICODE string,"
        " TEAM_TYPE string, minutes string, offensiveRating double, defensiveRating double,"
        " netRating double, usagePercentage double, trueShootingPercentage double,"
        " effectiveFieldGoalPercentage double, PIE double, extras map<string,string>, "
        + ORDER_COLUMNS
    ),
    "pbp": (
        "GAME_ID string, actionNumber bigint, clock string, period bigint, teamId bigint,"
        " personId bigint, actionType string, subType string, description string,"
        " shotDistance double, scoreHome bigint, scoreAway bigint, isFieldGoal boolean,"
        " clock_seconds double, extras map<string,string>, " + ORDER_COLUMNS
    ),
    "shot_chart": (
        "GAME_ID string, GRID_TYPE string, GAME_EVENT_ID bigint, PLAYER_ID bigint,"
        " PLAYER_NAME string, TEAM_ID bigint, TEAM_NAME string, PERIOD bigint,"
        " MINUTES_REMAINING string, SECONDS_REMAINING string, EVENT_TYPE string,"
        " ACTION_TYPE string, SHOT_TYPE string, SHOT_ZONE_BASIC string, SHOT_ZONE_AREA string,"
        " SHOT_ZONE_RANGE string, SHOT_DISTANCE double, LOC_X double, LOC_Y double,"
        " SHOT_ATTEMPTED_FLAG boolean, SHOT_MADE_FLAG boolean, SHOT_DATE date, HTM string,"
        " VTM string, extras map<string,string>, " + ORDER_COLUMNS
    ),
}
SILVER_PARTITIONS = "season int, game_date date"
SILVER_KEYS = {
    "boxscores": ["GAME_ID", "PERSON_ID"],
    "pbp": ["GAME_ID", "actionNumber"],
    "shot_chart": ["GAME_ID", "GAME_EVENT_ID"],
}
DATASETS = list(SILVER_KEYS)


# --------------------------------------------------------------------------
# Data contracts. Keys, bounds and row minimums.
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    """What a dataset promises; ``ranges`` holds (column, lowest, highest), None = open."""

    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    min_rows: int | None = None
    ranges: tuple[tuple[str, int | None, int | None], ...] = ()


CONTRACTS = {
    "boxscores": Contract(
        primary_key=("GAME_ID", "PERSON_ID"),
        not_null=("GAME_ID", "PERSON_ID", "TEAM_ID"),
        min_rows=10,
        ranges=(
            ("offensiveRating", 0, 300),
            ("defensiveRating", 0, 300),
            ("usagePercentage", 0, 1),
            ("trueShootingPercentage", 0, 2),
            ("PIE", -1, 1),
        ),
    ),
    "pbp": Contract(
        primary_key=("GAME_ID", "actionNumber"),
        not_null=("GAME_ID", "actionNumber", "period", "actionType"),
        min_rows=100,
        ranges=(
            ("period", 1, 10),
            ("clock_seconds", 0, 720),
            ("shotDistance", 0, 94),
            ("scoreHome", 0, None),
            ("scoreAway", 0, None),
        ),
    ),
    "shot_chart": Contract(
        primary_key=("GAME_ID", "GAME_EVENT_ID"),
        not_null=("GAME_ID", "GAME_EVENT_ID", "PLAYER_ID", "TEAM_ID", "PERIOD"),
        ranges=(
            ("PERIOD", 1, 10),
            ("LOC_X", -250, 250),
            ("LOC_Y", -50, 900),
            ("SHOT_DISTANCE", 0, 94),
        ),
    ),
    "players": Contract(
        primary_key=("id",),
        not_null=("id", "full_name", "first_name", "last_name"),
        min_rows=4000,
    ),
    "teams": Contract(
        primary_key=("GAME_ID", "TEAM_ID"),
        not_null=("GAME_ID", "TEAM_ID", "GAME_DATE", "PTS"),
        min_rows=50000,
        ranges=(("PTS", 0, 200), ("FG_PCT", 0, 1), ("FG3_PCT", 0, 1), ("FT_PCT", 0, 1)),
    ),
}
# Per-game results are named after these, as in "boxscore/0010500001".
CONTRACT_SOURCES = {"boxscores": "boxscore", "pbp": "pbp", "shot_chart": "shots"}


# --------------------------------------------------------------------------
# Gold star schema. Tables, columns, types, keys and references.
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class GoldTable:
    """Columns with their stored types, primary key, and (column, table, column) references."""

    columns: dict[str, str]
    primary_key: tuple[str, ...]
    references: tuple[tuple[str, str, str], ...] = ()

    @property
    def schema(self) -> str:
        types = {c: ("string" if t.startswith("char") else t) for c, t in self.columns.items()}
        return ", ".join(f"{c} {t}" for c, t in types.items())


GOLD = {
    "teams": GoldTable(
        {"id": "int", "abbreviation": "string", "team_name": "string"},
        ("id",),
    ),
    "games": GoldTable(
        {"game_id": "string", "season_id": "int", "game_date": "date"},
        ("game_id",),
    ),
    "players": GoldTable(
        {"player_id": "int", "first_name": "string", "last_name": "string",
         "is_active": "boolean"},
        ("player_id",),
    ),
    "fact_player_stats": GoldTable(
        {"game_id": "string", "player_id": "int", "team_id": "int",
         "start_position": "char(3)", "comment": "string", "minutes": "decimal(8,2)",
         "off_rating": "decimal(8,3)", "def_rating": "decimal(8,3)",
         "net_rating": "decimal(8,3)", "usg_pct": "decimal(8,3)", "ts_pct": "decimal(8,3)",
         "efg_pct": "decimal(8,3)", "pie": "decimal(8,3)"},
        ("game_id", "player_id"),
        (("game_id", "games", "game_id"), ("player_id", "players", "player_id"),
         ("team_id", "teams", "id")),
    ),
    "fact_team_stats": GoldTable(
        {"game_id": "string", "team_id": "int", "matchup": "string", "wl": "char(1)",
         "minutes": "decimal(8,2)", "pts": "int", "plus_minus": "int",
         "off_rating": "decimal(8,3)", "def_rating": "decimal(8,3)",
         "net_rating": "decimal(8,3)", "pace": "decimal(8,3)"},
        ("game_id", "team_id"),
        (("game_id", "games", "game_id"), ("team_id", "teams", "id")),
    ),
    "fact_play_by_play": GoldTable(
        {"game_id": "string", "action_number": "int", "period": "int",
         "clock_seconds": "decimal(10,2)", "team_id": "int", "player_id": "int",
         "action_type": "string", "sub_type": "string", "description": "string",
         "shot_distance": "int", "score_home": "int", "score_away": "int",
         "is_field_goal": "boolean"},
        ("game_id", "action_number"),
        (("game_id", "games", "game_id"),),
    ),
    "fact_shots": GoldTable(
        {"game_id": "string", "game_event_id": "int", "player_id": "int", "team_id": "int",
         "period": "int", "loc_x": "decimal(10,2)", "loc_y": "decimal(10,2)",
         "shot_distance": "int", "shot_attempted_flag": "boolean",
         "shot_made_flag": "boolean", "shot_zone_basic": "string", "shot_zone_area": "string",
         "shot_zone_range": "string"},
        ("game_id", "game_event_id"),
        (("game_id", "games", "game_id"), ("player_id", "players", "player_id")),
    ),
}
DIMENSIONS = ["teams", "players", "games"]
FACTS = ["fact_team_stats", "fact_player_stats", "fact_play_by_play", "fact_shots"]

# Gold column <- silver column.
GOLD_FROM_SILVER = {
    "players": {"player_id": "id", "first_name": "first_name", "last_name": "last_name",
                "is_active": "is_active"},
    "teams": {"id": "TEAM_ID", "abbreviation": "TEAM_ABBREVIATION", "team_name": "TEAM_NAME"},
    "games": {"game_id": "GAME_ID", "season_id": "SEASON_ID", "game_date": "GAME_DATE"},
    "fact_player_stats": {
        "game_id": "GAME_ID", "player_id": "PERSON_ID", "team_id": "TEAM_ID",
        "start_position": "POSITION", "comment": "COMMENT", "minutes": "minutes",
        "off_rating": "offensiveRating", "def_rating": "defensiveRating",
        "net_rating": "netRating", "usg_pct": "usagePercentage",
        "ts_pct": "trueShootingPercentage", "efg_pct": "effectiveFieldGoalPercentage",
        "pie": "PIE",
    },
    "fact_team_stats": {
        "game_id": "GAME_ID", "team_id": "TEAM_ID", "matchup": "MATCHUP", "wl": "WL",
        "minutes": "MIN", "pts": "PTS", "plus_minus": "PLUS_MINUS",
    },
    "fact_play_by_play": {
        "game_id": "GAME_ID", "action_number": "actionNumber", "period": "period",
        "clock_seconds": "clock_seconds", "team_id": "teamId", "player_id": "personId",
        "action_type": "actionType", "sub_type": "subType", "description": "description",
        "shot_distance": "shotDistance", "score_home": "scoreHome", "score_away": "scoreAway",
        "is_field_goal": "isFieldGoal",
    },
    "fact_shots": {
        "game_id": "GAME_ID", "game_event_id": "GAME_EVENT_ID", "player_id": "PLAYER_ID",
        "team_id": "TEAM_ID", "period": "PERIOD", "loc_x": "LOC_X", "loc_y": "LOC_Y",
        "shot_distance": "SHOT_DISTANCE", "shot_attempted_flag": "SHOT_ATTEMPTED_FLAG",
        "shot_made_flag": "SHOT_MADE_FLAG", "shot_zone_basic": "SHOT_ZONE_BASIC",
        "shot_zone_area": "SHOT_ZONE_AREA", "shot_zone_range": "SHOT_ZONE_RANGE",
    },
}
# Silver dataset each date's fact is loaded from.
FACT_DATASETS = {
    "fact_player_stats": "boxscores",
    "fact_play_by_play": "pbp",
    "fact_shots": "shot_chart",
}
