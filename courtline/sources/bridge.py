"""Deterministic projection of the provided TPC-H-style tables onto the four
box-score tables, the landing documents and the fetch responses.

The rules are fixture definitions (FIXTURES.md section 4); every one of them is
written as a plain column expression so the same rule can be restated in the
DuckDB oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtline.operators.scan import running_scan, window_scan
from courtline.schemas import BOX_COLUMNS, INVALID_REFEREES, LANDING_PREFIX, ROLLING_STATS, STAT_FIELD_TO_COLUMN
from courtline.sources.tables import read_table

N_TEAMS = 25
# Ids of one date that a block of the season's numbering spans; it holds no more games than that.
GAMES_PER_BLOCK = 1 << 24
VALID_REFEREES = "Ref A, Ref B, Ref C"

# Order that picks the first lineitem row of an (order, supplier) pair and
# orders a roster; it is a total order on the provided data.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax", "l_linestatus", "l_returnflag"]


def teams(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "nation", ["n_nationkey", "n_name"]).select(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))


def player_code(key: Column) -> Column:
    text = key.cast("string")  # padded to six digits; a longer key stays whole
    return F.concat(F.lit("P"), F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0")))


def players(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "supplier", ["s_suppkey", "s_name"]).select(
        F.col("s_suppkey").alias("id"), player_code(F.col("s_suppkey")).alias("player_code"),
        F.col("s_name").alias("name"))


def _home(custkey: Column) -> Column:
    return custkey % N_TEAMS


def _away(custkey: Column, orderkey: Column) -> Column:
    return (custkey % N_TEAMS + 1 + orderkey % (N_TEAMS - 1)) % N_TEAMS


def games(spark: SparkSession, base: str, skew_safe: bool = True) -> DataFrame:
    """One game per order; game number = rank in the season by (date, key)."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    g = o.select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").cast("string").alias("_season"),
        F.col("o_orderdate").alias("_date"),
        F.col("o_custkey").alias("_cust"),
    )
    # A season is one group whose size grows with the data: it is cut by date and, within a date, by stretches of ids.
    if skew_safe:
        g = running_scan(g, ["_season"], ["_date", "id"], row_number="_game_number",
                         block=F.struct("_date", F.floor(F.col("id") / GAMES_PER_BLOCK)))
    else:
        g = window_scan(g, ["_season"], ["_date", "id"], row_number="_game_number")
    return g.select(
        "id",
        _home(F.col("_cust")).alias("home_team_id"),
        _away(F.col("_cust"), F.col("id")).alias("away_team_id"),
        F.concat(F.col("_game_number").cast("string"), F.lit("E"), F.col("_season")).alias("game_code"),
        (F.lit(60) + (F.col("id") * 13) % 40).cast("int").alias("home_team_score"),
        (F.lit(60) + (F.col("id") * 7) % 40).cast("int").alias("away_team_score"),
    )


def stat_sql(i: int, partkey: str = "l_partkey", linenumber: str = "l_linenumber") -> str:
    """i-th statistic in ROLLING_STATS order, as a SQL expression."""
    v = f"({partkey} * {2 * i + 3} + {linenumber} + {i}) % 23"
    if ROLLING_STATS[i] in ("valuation", "plus_minus"):
        v = f"{v} - 5"
    v = f"CAST({v} AS INT)"
    if ROLLING_STATS[i] == "points":
        v = f"CASE WHEN {partkey} % 37 = 0 THEN CAST(NULL AS INT) ELSE {v} END"
    return v


def stat_expr(i: int, partkey: Column, linenumber: Column) -> Column:
    """Column form of :func:`stat_sql` over arbitrary columns."""
    v = (partkey * (2 * i + 3) + linenumber + i) % 23
    if ROLLING_STATS[i] in ("valuation", "plus_minus"):
        v = v - 5
    v = v.cast("int")
    if ROLLING_STATS[i] == "points":
        v = F.when(partkey % 37 == 0, F.lit(None).cast("int")).otherwise(v)
    return v


def _order_sides(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders", ["o_orderkey", "o_custkey"])
    return o.select(
        F.col("o_orderkey").alias("_ok"),
        _home(F.col("o_custkey")).alias("_home"),
        _away(F.col("o_custkey"), F.col("o_orderkey")).alias("_away"),
    )


def boxscore(spark: SparkSession, base: str) -> DataFrame:
    """First lineitem row per (order, supplier) becomes one box-score row."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_suppkey", *LINE_ORDER])
    # First row per (order, supplier): row_number() == 1 is planned with a
    # WindowGroupLimit before the shuffle, so duplicates are dropped map-side
    # and a hot order does not pile up on one task.
    w = Window.partitionBy("l_orderkey", "l_suppkey").orderBy(*LINE_ORDER)
    first = li.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1) \
        .select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_linestatus")
    rows = first.join(_order_sides(spark, base), F.col("l_orderkey") == F.col("_ok"), "inner") \
        .drop("_ok")
    # One more than the largest supplier key keeps (order, supplier) pairs apart in one number.
    span = li.agg(F.greatest(F.lit(100000), F.max("l_suppkey") + 1)).scalar()
    rows = rows.withColumn("_id", F.col("l_orderkey") * span + F.col("l_suppkey"))
    sql = {
        "id": "_id",
        "player_id": "l_suppkey",
        "game_id": "l_orderkey",
        "team_id": "CASE WHEN l_linestatus = 'O' THEN _home ELSE _away END",
        "played_for_home": "l_linestatus = 'O'",
        "is_starter": "l_linenumber <= 5",
        **{name: stat_sql(i) for i, name in enumerate(ROLLING_STATS)},
    }
    return rows.selectExpr(*[f"{sql[c]} AS {c}" for c in BOX_COLUMNS])


def boxscore_keys(spark: SparkSession, base: str) -> DataFrame:
    """Game and player of every lineitem row, repeats included: where the rows of :func:`boxscore` lie in an order, at the cost of a read."""
    return read_table(spark, base, "lineitem", ["l_orderkey", "l_suppkey"]).toDF("game_id", "player_id")


def minutes_text(quantity: Column, linenumber: Column, partkey: Column) -> Column:
    """`MM:SS` from quantity and line number, `DNP` for a player who sat out."""
    mmss = F.format_string("%02d:%02d", quantity.cast("int"), linenumber)
    return F.when(partkey % 37 == 0, F.lit("DNP")).otherwise(mmss)


def document_lines(spark: SparkSession, base: str) -> DataFrame:
    """Every lineitem row that becomes a player line of a game document (no dedupe), as given, with the player's name."""
    # The roster aggregation groups by order: partitioned by it before, every line is shuffled once and joined in its place.
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_suppkey", *LINE_ORDER]).repartition("l_orderkey")
    sup = read_table(spark, base, "supplier", ["s_suppkey", "s_name"])
    # supplier is a dimension whose size is fixed by the TPC-H scale rule;
    # AQE decides broadcast at run time from its measured size.
    return li.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "inner").select(
        F.col("l_orderkey").alias("game_id"),
        (F.col("l_linestatus") != "O").alias("away"),
        *LINE_ORDER, "l_suppkey", "s_name",
    )


def _line(x: Column, game_id: Column) -> Column:
    """A player line as the document has it, of a row of :func:`document_lines`."""
    pk, ln = x["l_partkey"], x["l_linenumber"]
    stats = {name: stat_expr(i, pk, ln) for i, name in enumerate(ROLLING_STATS)}
    return F.struct(
        F.concat(player_code(x["l_suppkey"]), F.lit(" ")).alias("Player_ID"),
        F.concat(x["s_name"], F.lit("#"), (game_id % 3).cast("string")).alias("Player"),
        F.when(ln <= 5, 1).otherwise(0).alias("IsStarter"),
        minutes_text(x["l_quantity"], ln, pk).alias("Minutes"),
        *[stats[col].alias(field) for field, col in STAT_FIELD_TO_COLUMN.items()],
    )


def documents(spark: SparkSession, base: str) -> DataFrame:
    """One nested JSON document per game: (file_key, season_code, game_number, game_id, body)."""
    g = games(spark, base)
    t = teams(spark, base)
    lines = document_lines(spark, base)
    # A roster is one game's lines: bounded by the number of lines per order.  They are collected as
    # given and spelled out where the document is written, so no wide line is shuffled or sorted.
    both = lines.groupBy("game_id").agg(F.sort_array(F.collect_list(
        F.struct("away", *LINE_ORDER, "l_suppkey", "s_name"))).alias("_r"))
    rosters = both.select("game_id", F.filter("_r", lambda x: ~x["away"]).alias("h"),
                          F.filter("_r", lambda x: x["away"]).alias("a"))
    home_t = t.select(F.col("id").alias("_hid"), F.col("name").alias("_hname"))
    away_t = t.select(F.col("id").alias("_aid"), F.col("name").alias("_aname"))
    d = (g.join(rosters, g.id == rosters.game_id, "left")
         .join(home_t, F.col("home_team_id") == F.col("_hid"), "left")
         .join(away_t, F.col("away_team_id") == F.col("_aid"), "left"))

    def roster(arr: str, team: str) -> Column:
        return F.transform(F.coalesce(F.col(arr), F.array()), lambda x: _line(x, F.col("id")).withField(
            "Team", F.concat(F.col(team), F.lit("  "))))

    body = F.struct(
        F.when(F.col("id") % 50 == 0, F.lit(INVALID_REFEREES)).otherwise(F.lit(VALID_REFEREES)).alias("Referees"),
        F.array(
            F.struct(F.struct(F.col("_hname").alias("Team")).alias("tmr"),
                     F.struct(F.col("home_team_score").alias("Points")).alias("totr"),
                     roster("h", "_hname").alias("PlayersStats")),
            F.struct(F.struct(F.col("_aname").alias("Team")).alias("tmr"),
                     F.struct(F.col("away_team_score").alias("Points")).alias("totr"),
                     roster("a", "_aname").alias("PlayersStats")),
        ).alias("Stats"),
    )
    season_code = F.concat(F.lit("E"), F.substring("game_code", -4, 4))
    number = F.expr("substring(game_code, 1, length(game_code) - 5)")
    return d.select(
        F.concat_ws("/", F.lit(LANDING_PREFIX), season_code, F.concat(number, F.lit(".json"))).alias("file_key"),
        season_code.alias("season_code"),
        number.cast("long").alias("game_number"),
        F.col("id").alias("game_id"),
        F.to_json(body).alias("body"),
    )


def fetch_responses(spark: SparkSession, base: str) -> DataFrame:
    """`events` re-read as API responses: (id, season, status, body)."""
    e = read_table(spark, base, "events", ["event_id", "user_id", "event_type", "props"])
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("season"),
        F.when(F.col("event_type") == "error", F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.col("props").alias("body"),
    )
