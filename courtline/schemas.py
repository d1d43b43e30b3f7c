"""Declared schemas of the landing documents and of the four relational tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# Player stat fields of a game document, in document order, with the column
# each is stored in.
# ---------------------------------------------------------------------------
STAT_FIELD_TO_COLUMN: dict[str, str] = {
    "Points": "points",
    "FieldGoalsMade2": "fg_made_2",
    "FieldGoalsAttempted2": "fg_attempted_2",
    "FieldGoalsMade3": "fg_made_3",
    "FieldGoalsAttempted3": "fg_attempted_3",
    "FreeThrowsMade": "ft_made",
    "FreeThrowsAttempted": "ft_attempted",
    "OffensiveRebounds": "offensive_rebounds",
    "DefensiveRebounds": "defensive_rebounds",
    "TotalRebounds": "total_rebounds",
    "Assistances": "assists",
    "Steals": "steals",
    "Turnovers": "turnovers",
    "BlocksFavour": "blocks_favor",
    "BlocksAgainst": "blocks_against",
    "FoulsCommited": "fouls_committed",
    "FoulsReceived": "fouls_received",
    "Valuation": "valuation",
    "Plusminus": "plus_minus",
}
# Referees value marking a placeholder game that must be skipped.
INVALID_REFEREES = "N/D, N/D, N/D"
# Landing layout: <prefix>/<season code>/<game number>.json
LANDING_PREFIX = "data/boxscore_json"

# The 20 statistics averaged over the previous three games, in feature order.
ROLLING_STATS: list[str] = [
    "valuation", "seconds", "points", "fg_made_2", "fg_attempted_2", "fg_made_3",
    "fg_attempted_3", "ft_made", "ft_attempted", "offensive_rebounds",
    "defensive_rebounds", "total_rebounds", "assists", "steals", "turnovers",
    "blocks_favor", "blocks_against", "fouls_committed", "fouls_received", "plus_minus",
]

# Nullable integer stats of boxscore_record, in table order (after `seconds`).
BOX_STATS: list[str] = [
    "points", "fg_made_2", "fg_attempted_2", "fg_made_3", "fg_attempted_3",
    "ft_made", "ft_attempted", "offensive_rebounds", "defensive_rebounds",
    "total_rebounds", "assists", "steals", "turnovers", "blocks_favor",
    "blocks_against", "fouls_committed", "fouls_received", "valuation", "plus_minus",
]
# ---------------------------------------------------------------------------

BOX_COLUMNS: list[str] = [
    "id", "player_id", "game_id", "team_id", "played_for_home", "is_starter", "seconds",
    *BOX_STATS,
]

TEAMS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
])

PLAYERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("player_code", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
])

GAMES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("home_team_id", T.LongType(), False),
    T.StructField("away_team_id", T.LongType(), False),
    T.StructField("game_code", T.StringType(), False),
    T.StructField("home_team_score", T.IntegerType(), True),
    T.StructField("away_team_score", T.IntegerType(), True),
])

BOXSCORE = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("player_id", T.LongType(), False),
        T.StructField("game_id", T.LongType(), False),
        T.StructField("team_id", T.LongType(), False),
        T.StructField("played_for_home", T.BooleanType(), True),
        T.StructField("is_starter", T.BooleanType(), True),
        T.StructField("seconds", T.IntegerType(), False),
    ]
    + [T.StructField(c, T.IntegerType(), True) for c in BOX_STATS]
)

# Natural (unique) keys of each table.
NATURAL_KEYS: dict[str, list[str]] = {
    "teams": ["name"],
    "players": ["player_code"],
    "games": ["game_code"],
    "boxscore_record": ["player_id", "game_id"],
}

# Foreign keys: (child table, child column, parent table).
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("games", "home_team_id", "teams"),
    ("games", "away_team_id", "teams"),
    ("boxscore_record", "player_id", "players"),
    ("boxscore_record", "game_id", "games"),
    ("boxscore_record", "team_id", "teams"),
]

# Raw landing document.  Only fields the pipeline reads are declared; the
# reader ignores the rest.  Player lines and scores stay variants, so a value of
# an unexpected type is that line's or score's affair and not the document's.
_TEAM_SIDE = T.StructType([
    T.StructField("tmr", T.StructType([T.StructField("Team", T.StringType())])),
    T.StructField("totr", T.StructType([T.StructField("Points", T.VariantType())])),
    T.StructField("PlayersStats", T.ArrayType(T.VariantType())),
])
# What a player line is read as; a field that cannot be is null there.
LINE_TEXTS = ["Player_ID", "Player", "Team", "Minutes"]
LINE = "struct<" + ", ".join([*(f"{f}: string" for f in LINE_TEXTS), *(f"{f}: double" for f in STAT_FIELD_TO_COLUMN)]) + ">"

DOCUMENT = T.StructType([
    T.StructField("Referees", T.StringType()),
    T.StructField("Stats", T.ArrayType(_TEAM_SIDE)),
    # The text of a document that is no JSON or is built in another way than declared.
    T.StructField("_corrupt_record", T.StringType()),
])
