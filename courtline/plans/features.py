"""Leakage-free training features for the next-game valuation model.

Plan shape (each step is a DataFrame transformation; Catalyst plans the whole
thing as one job):

    games --> game_info --> team_games (2 rows per game) --> cumulative_win
                   |          (blocked running scan per (team, season))
                   +--> LEFT JOIN cumulative_win's teams of the round, a row per game
    player_box (box JOIN these games, the ratios of both teams picked from the round,
                21 window exprs on (player_id, season) by game_number)

Ratios meet the narrow box rows, so the wide rows with the means are never shuffled.

Window W1 is partitioned by (player_id, season): a player's season is bounded
by the schedule, so a plain window is the right operator, and
``hot_groups=True`` asks for the form that splits it.  Window W2 (team, season)
is different: there are few teams, and a team's season grows with the data, so
it runs through :func:`courtline.operators.scan.running_scan`, which splits a
hot group into blocks by game number.  Nothing is measured to choose a plan, and joins
are left to the optimizer: it broadcasts a side only by its size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Callable
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.functions.scalar import game_number_of, season_of, winning_team
from courtline.operators.rolling import next_value_sql, shifted_frame_features, trailing_mean_sql
from courtline.operators.scan import running_scan, window_scan
from courtline.schemas import ROLLING_STATS
from courtline.session import default_blocks

PLAYER_SEASON = ["player_id", "season"]
TEAM_SEASON = ["team_id", "season"]
# Game numbers of a season that a block of the running totals spans: a team has one game a number and competition.
NUMBERS_PER_BLOCK = 1 << 16
# Feature rows that a part of the sorted table takes, and those below which a part is not worth a task.
PART_ROWS = 1 << 18
FEW_ROWS = 1 << 16
OPPONENT = "CASE WHEN _home = team_id THEN _away ELSE _home END"


def game_code_rejects(games: DataFrame) -> DataFrame:
    """Games whose code holds no game number, with a reason; :func:`game_info` leaves them out."""
    return games.filter(game_number_of(F.col("game_code")).isNull()).select(
        "id", "game_code", F.lit("game code without a number").alias("reason"))


def game_info(games: DataFrame) -> DataFrame:
    """Games with season, number and winner; see :func:`game_code_rejects` for those left out."""
    games = games.filter(game_number_of(F.col("game_code")).isNotNull())
    hs, as_ = F.col("home_team_score"), F.col("away_team_score")
    return games.select(
        "id", "game_code",
        season_of(F.col("game_code")).alias("season"),
        game_number_of(F.col("game_code")).alias("game_number"),
        "home_team_id", "away_team_id", "home_team_score", "away_team_score",
        winning_team(F.col("home_team_id"), F.col("away_team_id"), hs, as_).alias("winning_team_id"),
    )


def join_box_games(box: DataFrame, gi: DataFrame, gi_extra: tuple[str, ...] = ()) -> DataFrame:
    """Box rows with their game's season/number/teams/scores (inner join on game id)."""
    g = gi.selectExpr("id AS _gid", "season", "game_number", "home_team_id AS _home", "away_team_id AS _away",
                      "home_team_score AS _hs", "away_team_score AS _as", *gi_extra)
    return box.join(g, box.game_id == g._gid, "inner").drop("_gid")


def player_box(box: DataFrame, gi: DataFrame, n: int = 3, gi_extra: tuple[str, ...] = (),
               extra: tuple[str, ...] = (), hot_groups: bool = False, before: tuple[str, ...] = ()) -> DataFrame:
    """b.*, season, game_number, opponent_team_id, trailing means, next valuation, win_ind.

    ``gi_extra`` are further game columns to bring along, ``before`` SQL
    expressions of the joined row evaluated before the frames, ``extra`` further
    SQL expressions evaluated after them.  ``hot_groups=True`` computes
    the frame features with :func:`shifted_frame_features`, which needs no
    task to hold a whole player-season.
    """
    j = join_box_games(box, gi, gi_extra)
    if before:
        j = j.selectExpr(*[c for c in j.columns if c not in gi_extra], *before)
    # game_id breaks ties in game_number, which only occur if two competitions
    # share a season code; it keeps the frame reproducible.
    order = ["game_number", "game_id"]
    means = [f"avg_last_{n}_{c}" for c in ROLLING_STATS]
    head = [*box.columns, "season", "game_number",
            f"{OPPONENT} AS opponent_team_id"]
    tail = ["CASE WHEN (_home = team_id AND _hs > _as) OR (_away = team_id AND _as > _hs) THEN 1 ELSE 0 END"
            " AS win_ind", *extra]
    if hot_groups:
        f = shifted_frame_features(j, ROLLING_STATS, PLAYER_SEASON, order, n=n,
                                   lead_col="valuation", lead_alias="next_game_valuation")
        return f.selectExpr(*head, *means, "next_game_valuation", *tail)
    return j.selectExpr(
        *head,
        *trailing_mean_sql(ROLLING_STATS, PLAYER_SEASON, order, n=n),
        next_value_sql("valuation", PLAYER_SEASON, order, "next_game_valuation"),
        *tail,
    )


def team_games(gi: DataFrame, keep_game_id: bool = False) -> DataFrame:
    """Two rows per game (home, away) with a win flag against the winner column."""
    rows = gi.select(
        "season", "game_number", F.col("id").alias("_game_id"), "winning_team_id",
        F.inline(F.array(F.struct(F.col("home_team_id").alias("team_id")),
                         F.struct(F.col("away_team_id").alias("team_id")))),
    )
    out = rows.select(
        "season", "game_number", "team_id",
        F.when(F.col("team_id") == F.col("winning_team_id"), F.lit(1)).otherwise(F.lit(0)).alias("win"),
        "_game_id",
    )
    return out if keep_game_id else out.drop("_game_id")


def cumulative_win(gi: DataFrame, skew_safe: bool = True, before: DataFrame | None = None) -> DataFrame:
    """Per (team, season, game): wins before, games before, running win ratio.

    ``before`` (season, team_id, wins, games) are totals of games that precede
    those of ``gi``; without a row a team starts at zero.

    Team-seasons are cut into stretches of game numbers; ``skew_safe=False``
    scans each with one plain window.
    """
    tg = team_games(gi, keep_game_id=True)
    order, sums = ["game_number", "_game_id"], {"cum_wins": "win"}
    if skew_safe:
        s = running_scan(tg, TEAM_SEASON, order, row_number="_rn", exclusive_sums=sums,
                         block=F.floor(F.col("game_number") / NUMBERS_PER_BLOCK))
    else:
        s = window_scan(tg, TEAM_SEASON, order, row_number="_rn", exclusive_sums=sums)
    played, wins = (F.col("_rn") - 1).cast("long"), F.col("cum_wins").cast("long")
    if before is not None:
        s = s.join(before.select(*TEAM_SEASON, "wins", "games"), TEAM_SEASON, "left")
        played, wins = played + F.coalesce("games", F.lit(0)), wins + F.coalesce("wins", F.lit(0))
    return s.select(
        "season", "team_id", "game_number", wins.alias("cum_wins"), played.alias("games_played_before"),
        F.when(played == 0, F.lit(0.0)).otherwise(wins.cast("double") / played.cast("double")).alias("cum_win_ratio"),
    )


def training_features(games: DataFrame, box: DataFrame, n: int = 3, skew_safe: bool = True,
                      hot_groups: bool = False) -> DataFrame:
    """The 54-column feature table (unsorted; sort at a sink that needs it).

    Both teams' running ratios are those of (season, team, game number); a
    row whose team has no such game gets null.  They are picked from the round
    before the frames (:func:`round_pairs_sql`); over plain windows
    (``skew_safe=False``) they are joined after them (:func:`with_ratios`).
    """
    gi = game_info(games)
    entries = round_entries(cumulative_win(gi, skew_safe=skew_safe))
    if skew_safe:
        sides = gi.join(entries, ROUND, "left")
        return with_pairs(player_box(box, sides, n=n, gi_extra=("entries",), before=(f"{round_pairs_sql()} AS _pairs",),
                                     extra=("_pairs",), hot_groups=hot_groups))
    sides = gi.join(entries.select(*ROUND, F.transform("entries", lambda e: e["team"]).alias("_teams")), ROUND, "left")
    return with_ratios(player_box(box, sides, n=n, gi_extra=("_teams",), extra=("_teams",), hot_groups=hot_groups), entries)


ROUND = ["season", "game_number"]


def round_entries(cw: DataFrame) -> DataFrame:
    """(season, game_number, entries): the teams that play under a number and their ratios, two a competition."""
    return cw.groupBy(*ROUND).agg(F.collect_list(F.struct(F.col("team_id").alias("team"), F.col("cum_win_ratio").alias("ratio"))).alias("entries"))


RATIO_OF_RATIOS = ("CASE WHEN opponent_win_ratio = 0 THEN CAST(NULL AS DOUBLE) "
                   "ELSE team_win_ratio / opponent_win_ratio END AS win_ratio_ratio")


def round_pairs_sql() -> str:
    """Both ratios of a box row with its game's sides and the ``entries`` of its round, as an array: one pair as a rule.

    These are the rows of the two left joins of :func:`with_ratios`: as many as
    there are pairs of entries where season codes collide, one of nulls without an opponent.
    """
    nobody = "array(named_struct('team', CAST(NULL AS BIGINT), 'ratio', CAST(NULL AS DOUBLE)))"
    own = "if(exists(entries, e -> e.team = team_id), team_id, NULL)"
    pairs = (f"flatten(transform(filter(entries, b -> b.team = {OPPONENT}), b -> transform("
             f"filter(concat(entries, {nobody}), a -> a.team <=> {own}), "
             "a -> named_struct('team_win_ratio', a.ratio, 'opponent_win_ratio', b.ratio))))")
    none = "array(named_struct('team_win_ratio', CAST(NULL AS DOUBLE), 'opponent_win_ratio', CAST(NULL AS DOUBLE)))"
    # A round of one game, as is the rule, has two teams: they are compared in place.
    of = "CASE {0} WHEN entries[0].team THEN entries[0].ratio WHEN entries[1].team THEN entries[1].ratio END"
    other = f"({OPPONENT})"
    one = (f"array(named_struct('team_win_ratio', CASE WHEN {other} IN (entries[0].team, entries[1].team) THEN {of.format('team_id')} END, "
           f"'opponent_win_ratio', {of.format(other)}))")
    return (f"CASE WHEN size(entries) = 2 AND entries[0].team <> entries[1].team THEN {one} "
            f"ELSE coalesce(nullif({pairs}, array()), {none}) END")


def with_pairs(rows: DataFrame) -> DataFrame:
    """The player rows with the ratios that stand in their ``_pairs``; see :func:`round_pairs_sql`."""
    return rows.selectExpr(*[c for c in rows.columns if c != "_pairs"], "inline(_pairs)").selectExpr("*", RATIO_OF_RATIOS)


def with_ratios(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """The player rows with both teams' ratios, as two left joins on (season, team, game number) give them.

    ``rows`` hold the teams of their round in ``_teams``.  The opponent, a side
    of the row's game, is always one of them; the own team need not be.  So the
    pairs of entries of a round, and each entry beside none, are all that the two
    joins could find, and the wide rows meet them once.  Where season codes
    collide a team has several entries and a row several results.
    """
    one = entries.select(*ROUND, "entries", F.explode("entries").alias("_b"))
    nobody = F.array(F.struct(F.lit(None).cast("long").alias("team"), F.lit(None).cast("double").alias("ratio")))
    pairs = one.select(*ROUND, "_b", F.explode(F.concat("entries", nobody)).alias("_a")).selectExpr(
        "season AS _s", "game_number AS _n", "_a.team AS _own", "_b.team AS _other",
        "_a.ratio AS team_win_ratio", "_b.ratio AS opponent_win_ratio")
    own = F.when(F.array_contains("_teams", F.col("team_id")), F.col("team_id"))
    j = rows.join(pairs, (F.col("season") == F.col("_s")) & (F.col("game_number") == F.col("_n"))
                  & (F.col("opponent_team_id") == F.col("_other")) & own.eqNullSafe(F.col("_own")), "left")
    return j.selectExpr(
        *[c for c in rows.columns if c != "_teams"], "team_win_ratio", "opponent_win_ratio",
        RATIO_OF_RATIOS,
    )


def sorted_features(features: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The feature table in (game_id, player_id) order, for a sink that needs it.

    ``orderBy`` is a range-partitioned global sort: sampled bounds, one
    shuffle, every partition sorted locally -- no single-task sort.  Its sample
    is a run of everything below it.  ``keys`` (game_id, player_id), read at less
    cost and lying about as the rows do, give the bounds instead, so the frames
    run once (:func:`range_parts`); they only decide how even the parts are.
    """
    order = ["game_id", "player_id"]
    if keys is None:
        return features.orderBy(*order)
    parts, part = range_parts(keys, *order)
    return part(features, "_part").repartitionById(parts, "_part").drop("_part").sortWithinPartitions(*order)


def range_parts(keys: DataFrame, first: str, then: str, part_rows: int = PART_ROWS,
                few_rows: int = FEW_ROWS) -> tuple[int, Callable[[DataFrame, str], DataFrame]]:
    """Parts that cut the order of two whole numbers, as many ``keys`` rows in each: their number, and a function that adds a row's.

    A part takes up to ``part_rows`` rows, and no fewer than ``few_rows`` while
    there are shuffle partitions for it.  Bounds are percentiles of ``first``.  A
    value that fills a part by itself gets parts of its own, by percentiles of
    ``then``.  Nulls come first, as in the order.
    """
    rows = keys.count()
    parts = max(-(-rows // part_rows), min(default_blocks(keys.sparkSession), -(-rows // few_rows)), 1)
    accuracy = max(10_000, 20 * parts)
    cuts = keys.agg(F.percentile_approx(first, [i / parts for i in range(1, parts)], accuracy)).first()[0] if parts > 1 else None
    times = Counter(cuts or ())
    # Whole numbers beyond 2^53 may share a double, so a bucket, with their neighbours: they are not cut.
    hot = {v: n for v, n in times.items() if n > 1 and abs(v) < 1 << 53}
    # A bucket ends where the next value begins; that of a hot value holds no other.
    starts = sorted({float(v) for v in times} | {float(v + 1) for v in hot})
    within: dict[int, list[int]] = {}
    if hot:
        most = max(hot.values())
        found = keys.filter(F.col(first).isin(*hot)).groupBy(first).agg(
            F.percentile_approx(then, [i / most for i in range(1, most)], accuracy)).collect()
        for v, steps in found:
            bucket = bisect_right(starts, float(v))
            within[bucket] = sorted({*within.get(bucket, []), *(steps[i * most // hot[v] - 1] for i in range(1, hot[v]) if steps)})
    offsets = [0, *accumulate(1 + len(within.get(b, ())) for b in range(len(starts) + 1))]

    def part(df: DataFrame, name: str) -> DataFrame:
        if not starts:
            return df.withColumn(name, F.lit(0))
        cut = Bucketizer(splits=[float("-inf"), *starts, float("inf")], inputCol="_first", outputCol="_bucket", handleInvalid="keep")
        out = cut.transform(df.withColumn("_first", F.col(first).cast("double")))
        at = number = F.col("_bucket").cast("int")
        if within:
            after = F.create_map(*[F.lit(x) for b, steps in within.items() for x in (b, steps)])
            at = F.get(F.lit(offsets), number) + F.when(
                number.isin(*within), F.size(F.filter(after[number], lambda x: x <= F.col(then)))).otherwise(0)
        return out.withColumn(name, F.when(F.col(first).isNull(), 0).otherwise(at)).drop("_first", "_bucket")

    return offsets[-1], part


def opponent_ratio(games: DataFrame, box: DataFrame) -> DataFrame:
    """Keys plus the ratio columns of the feature table."""
    f = training_features(games, box)
    return f.select("id", "team_id", "opponent_team_id", "team_win_ratio", "opponent_win_ratio", "win_ratio_ratio")
