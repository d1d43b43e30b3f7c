"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the provided tables (through the bridge in :mod:`courtline.sources.bridge`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline import oracle as O
from courtline.plans import features as FE
from courtline.schemas import ROLLING_STATS
from courtline.sources import bridge as B


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


def _gb(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return B.games(spark, base), B.boxscore(spark, base)


# --------------------------------------------------------------- features

@register("training_features", O.features_sql("SELECT * FROM tf"))
def q_training_features(spark, base):
    g, b = _gb(spark, base)
    return FE.training_features(g, b)


@register("rolling_means", O.features_sql(
    f"SELECT id, player_id, game_id, season, game_number, {O.ROLLING_COLS} FROM pb"))
def q_rolling_means(spark, base):
    g, b = _gb(spark, base)
    pb = FE.player_box(b, FE.game_info(g))
    return pb.select("id", "player_id", "game_id", "season", "game_number",
                     *[f"avg_last_3_{c}" for c in ROLLING_STATS])


@register("next_valuation", O.features_sql(
    "SELECT id, player_id, season, game_number, valuation, next_game_valuation FROM pb"))
def q_next_valuation(spark, base):
    g, b = _gb(spark, base)
    pb = FE.player_box(b, FE.game_info(g))
    return pb.select("id", "player_id", "season", "game_number", "valuation", "next_game_valuation")


@register("team_games", O.features_sql("SELECT season, game_number, team_id, win FROM tg"))
def q_team_games(spark, base):
    return FE.team_games(FE.game_info(B.games(spark, base)))


@register("cumulative_win", O.features_sql(
    "SELECT season, team_id, game_number, cum_wins, games_played_before, cum_win_ratio FROM cw"))
def q_cumulative_win(spark, base):
    return FE.cumulative_win(FE.game_info(B.games(spark, base)))


@register("winning_team", O.features_sql(
    "SELECT pb.id, pb.game_id, pb.team_id, gi.winning_team_id, pb.win_ind "
    "FROM pb JOIN gi ON pb.game_id = gi.id"))
def q_winning_team(spark, base):
    g, b = _gb(spark, base)
    gi = FE.game_info(g)
    pb = FE.player_box(b, gi)
    w = gi.select(F.col("id").alias("_gid"), "winning_team_id")
    return pb.join(w, pb.game_id == w._gid).select("id", "game_id", "team_id", "winning_team_id", "win_ind")


@register("opponent_ratio", O.features_sql(
    "SELECT id, team_id, opponent_team_id, team_win_ratio, opponent_win_ratio, win_ratio_ratio FROM tf"))
def q_opponent_ratio(spark, base):
    g, b = _gb(spark, base)
    return FE.opponent_ratio(g, b)


@register("parse_game_code", O.features_sql("SELECT id, game_code, season, game_number FROM gi"))
def q_parse_game_code(spark, base):
    return FE.game_info(B.games(spark, base)).select("id", "game_code", "season", "game_number")


@register("join_box_games", O.features_sql(
    "SELECT b.id, b.game_id, gi.season, gi.game_number, gi.home_team_id, gi.away_team_id "
    "FROM boxscore_record b JOIN gi ON b.game_id = gi.id"))
def q_join_box_games(spark, base):
    g, b = _gb(spark, base)
    j = FE.join_box_games(b, FE.game_info(g))
    return j.select("id", "game_id", "season", "game_number",
                    F.col("_home").alias("home_team_id"), F.col("_away").alias("away_team_id"))



# ------------------------------------------------------- prepare
from courtline.plans import prepare as PR  # noqa: E402
from courtline.schemas import BOX_COLUMNS  # noqa: E402
from courtline.session import materialize, scratch_path  # noqa: E402

_FEATURE_COLS = [*BOX_COLUMNS, "season", "game_number", "opponent_team_id",
                 *[f"avg_last_3_{c}" for c in ROLLING_STATS], "next_game_valuation", "win_ind",
                 "team_win_ratio", "opponent_win_ratio", "win_ratio_ratio"]
_PREP_COLS = ["next_game_valuation"] + [c for c in _FEATURE_COLS
                                       if c not in ("next_game_valuation", "id", "game_id", "team_id", "win_ind")]


def _prep_select() -> str:
    out = []
    for c in _PREP_COLS:
        if c == "next_game_valuation":
            out.append("CAST(COALESCE(next_game_valuation, AVG(next_game_valuation) OVER "
                       "(PARTITION BY season, player_id)) AS DOUBLE) AS next_game_valuation")
        elif c in ("played_for_home", "is_starter"):
            out.append(f"CAST({c} AS INTEGER) AS {c}")
        elif c == "win_ratio_ratio":
            out.append("COALESCE(win_ratio_ratio, 0.0::DOUBLE) AS win_ratio_ratio")
        else:
            out.append(c)
    return "SELECT " + ", ".join(out) + " FROM tf"


_PREP = {"prep": _prep_select()}
_TEST = PR.DEFAULT_TEST_SEASON


def _features(spark, base):
    g, b = _gb(spark, base)
    return FE.training_features(g, b)


@register("season_target_avg", O.features_sql(
    "SELECT season, player_id, AVG(next_game_valuation) AS season_avg_target FROM tf GROUP BY season, player_id"))
def q_season_target_avg(spark, base):
    return PR.season_target_avg(_features(spark, base))


@register("fill_target", O.features_sql(
    "SELECT id, season, player_id, CAST(COALESCE(next_game_valuation, AVG(next_game_valuation) OVER "
    "(PARTITION BY season, player_id)) AS DOUBLE) AS next_game_valuation FROM tf"))
def q_fill_target(spark, base):
    return PR.fill_target(_features(spark, base)).select("id", "season", "player_id", "next_game_valuation")


@register("preprocess", O.features_sql("SELECT * FROM prep", _PREP))
def q_preprocess(spark, base):
    return PR.preprocess(_features(spark, base))


@register("split_train", O.features_sql(f"SELECT * FROM prep WHERE season IS DISTINCT FROM '{_TEST}'", _PREP))
def q_split_train(spark, base):
    return PR.split(PR.preprocess(_features(spark, base)), _TEST)[0]


@register("split_test", O.features_sql(f"SELECT * FROM prep WHERE season IS NOT DISTINCT FROM '{_TEST}'", _PREP))
def q_split_test(spark, base):
    return PR.split(PR.preprocess(_features(spark, base)), _TEST)[1]


@register("split_counts", O.features_sql(
    f"SELECT CASE WHEN season IS NOT DISTINCT FROM '{_TEST}' THEN 'test' ELSE 'train' END AS part, "
    "CAST(COUNT(*) AS BIGINT) AS rows FROM prep GROUP BY 1", _PREP))
def q_split_counts(spark, base):
    return PR.split_counts(PR.preprocess(_features(spark, base)), _TEST)


@register("csv_sink", O.features_sql(
    f"SELECT CASE WHEN season IS NOT DISTINCT FROM '{_TEST}' THEN 'test' ELSE 'train' END AS part, * FROM prep", _PREP))
def q_csv_sink(spark, base):
    out = None
    for part, df in zip(("train", "test"), _prepared(spark, base)):
        path = PR.write_csv(df, scratch_path(spark, "csv_sink", part, unique=True))
        back = PR.read_csv(spark, path, df.schema).withColumn("part", F.lit(part))
        out = back if out is None else out.unionByName(back)
    return out


# ------------------------------------------------------------ normalise
from courtline.plans import normalise as NO  # noqa: E402
from courtline.functions import scalar as SC  # noqa: E402


def _docs(spark, base):
    return NO.parse_documents(B.documents(spark, base))


def _norm(spark, base):
    return NO.normalise(_docs(spark, base))


@register("normalise_teams", O.bridge_sql("SELECT id, name FROM n_teams", O.NORMALISE))
def q_normalise_teams(spark, base):
    return _norm(spark, base).teams


@register("normalise_players", O.bridge_sql("SELECT id, player_code, name FROM n_players", O.NORMALISE))
def q_normalise_players(spark, base):
    return _norm(spark, base).players


@register("normalise_games", O.bridge_sql(
    "SELECT id, home_team_id, away_team_id, game_code, home_team_score, away_team_score FROM n_games",
    O.NORMALISE))
def q_normalise_games(spark, base):
    return _norm(spark, base).games


@register("normalise_boxscore", O.bridge_sql(f"SELECT {', '.join(BOX_COLUMNS)} FROM n_box", O.NORMALISE))
def q_normalise_boxscore(spark, base):
    return _norm(spark, base).boxscore


@register("first_seen_players", O.bridge_sql(
    "SELECT player_code, pname AS name, file_key AS first_file_key FROM lines QUALIFY row_number() OVER "
    f"(PARTITION BY player_code ORDER BY file_key, away, {O.LINE_ORDER_SQL}) = 1", O.NORMALISE))
def q_first_seen_players(spark, base):
    return NO.first_seen_players(_docs(spark, base))


@register("drop_invalid_games", O.bridge_sql("SELECT file_key, game_code FROM docs", O.NORMALISE))
def q_drop_invalid_games(spark, base):
    valid, _ = NO.split_documents(_docs(spark, base))
    return NO.game_sides(valid).select("file_key", "game_code")


@register("minutes_to_seconds", """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 37 = 0 THEN 'DNP' ELSE lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0')
    || ':' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END AS minutes,
  CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) * 60 + l_linenumber END AS seconds
FROM lineitem""")
def q_minutes_to_seconds(spark, base):
    from courtline.sources.tables import read_table
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_partkey"])
    m = B.minutes_text(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_partkey"))
    return li.select("l_orderkey", "l_linenumber", m.alias("minutes")) \
        .withColumn("seconds", SC.minutes_to_seconds(F.col("minutes")))


# Landing keys made from the bridge games; every 1000th file is named `abc`.
_PATHS_SQL = {"paths": """SELECT id, 'data/boxscore_json/E' || right(game_code, 4) || '/' ||
  CASE WHEN id % 1000 = 0 THEN 'abc' ELSE left(game_code, length(game_code) - 5) END || '.json' AS path
FROM games"""}
_PARSED_SQL = {"parsed": """SELECT id, path, regexp_extract(path, '([^/]+)/[^/]+$', 1) AS season_code,
  TRY_CAST(replace(regexp_extract(path, '([^/]+)$', 1), '.json', '') AS BIGINT) AS file_number,
  split_part(regexp_extract(path, '([^/]+)$', 1), '.', 1) || regexp_extract(path, '([^/]+)/[^/]+$', 1) AS game_code
FROM paths"""}


def _paths(spark, base):
    g = B.games(spark, base)
    stem = F.when(F.col("id") % 1000 == 0, F.lit("abc")).otherwise(
        F.substring(F.col("game_code"), F.lit(1), F.length("game_code") - 5))
    season = F.substring(F.col("game_code"), -4, 4)
    return g.select("id", F.concat(F.lit("data/boxscore_json/E"), season, F.lit("/"), stem, F.lit(".json")).alias("path"))


def _parsed(spark, base):
    p = _paths(spark, base)
    return p.select("id", "path", SC.path_season(F.col("path")).alias("season_code"),
                    SC.path_file_number(F.col("path")).alias("file_number"),
                    SC.game_code_from_path(F.col("path")).alias("game_code"))


@register("game_code_from_path", O.bridge_sql("SELECT * FROM parsed", _PATHS_SQL, _PARSED_SQL))
def q_game_code_from_path(spark, base):
    return _parsed(spark, base)


@register("max_file_number", O.bridge_sql(
    "SELECT season_code, max(file_number) AS max_file_number, "
    "CAST(count(*) FILTER (WHERE file_number IS NULL) AS BIGINT) AS rejected_names "
    "FROM parsed GROUP BY season_code", _PATHS_SQL, _PARSED_SQL))
def q_max_file_number(spark, base):
    from courtline.streaming.incremental import max_file_number
    return max_file_number(_parsed(spark, base))


# Mark per season for the incremental filter: half of the season's largest number; one season has none yet.
_MARKS_SQL = {"marks": "SELECT season_code, max(file_number) // 2 AS last_id FROM parsed "
                       "WHERE season_code <> 'E1998' GROUP BY season_code"}


def _marks(parsed):
    from courtline.streaming.incremental import max_file_number
    return max_file_number(parsed).filter(F.col("season_code") != "E1998").select(
        "season_code", (F.col("max_file_number") / 2).cast("long").alias("last_id"))


@register("incremental_filter", O.bridge_sql(
    "SELECT p.path, p.season_code, p.file_number FROM parsed p LEFT JOIN marks m ON p.season_code = m.season_code "
    "WHERE p.file_number > coalesce(m.last_id, 0)", _PATHS_SQL, _PARSED_SQL, _MARKS_SQL))
def q_incremental_filter(spark, base):
    from courtline.streaming.incremental import above_marks
    parsed = _parsed(spark, base)
    marks = _marks(parsed)
    return above_marks(parsed, marks).select("path", "season_code", "file_number")



# ------------------------------------------------------ upsert / load
from courtline.streaming import incremental as INC  # noqa: E402
from courtline.sources import landing as LA  # noqa: E402

_SPLIT_SEASON = "E1999"


def _docs_between(docs, lo=None, hi=None):
    season = SC.path_season(F.col("file_key"))
    if lo is not None:
        docs = docs.filter(season >= F.lit(lo))
    if hi is not None:
        docs = docs.filter(season <= F.lit(hi))
    return docs


def _upserted(spark, base):
    docs = _docs(spark, base)
    target = NO.normalise(_docs_between(docs, hi=_SPLIT_SEASON))
    return NO.normalise(_docs_between(docs, lo=_SPLIT_SEASON), target=target)


# Loading the later seasons into tables built from the earlier ones gives the
# same ids as one load: every key's first sighting is in landing-key order.
@register("upsert_teams", O.bridge_sql("SELECT id, name FROM n_teams", O.NORMALISE))
def q_upsert_teams(spark, base):
    return _upserted(spark, base).teams


@register("upsert_players", O.bridge_sql("SELECT id, player_code, name FROM n_players", O.NORMALISE))
def q_upsert_players(spark, base):
    return _upserted(spark, base).players


@register("upsert_games", O.bridge_sql(
    "SELECT id, home_team_id, away_team_id, game_code, home_team_score, away_team_score FROM n_games",
    O.NORMALISE))
def q_upsert_games(spark, base):
    return _upserted(spark, base).games


@register("upsert_boxscore", O.bridge_sql(f"SELECT {', '.join(BOX_COLUMNS)} FROM n_box", O.NORMALISE))
def q_upsert_boxscore(spark, base):
    return _upserted(spark, base).boxscore


def _table_list(n):
    n.boxscore  # a load's lines first: the other tables are then read from the same copy
    return [("teams", n.teams), ("players", n.players), ("games", n.games), ("boxscore_record", n.boxscore)]


@register("replay_is_noop", O.bridge_sql(
    "SELECT 'teams' AS table_name, CAST(count(*) - count(DISTINCT name) AS BIGINT) AS new_rows FROM n_teams "
    "UNION ALL SELECT 'players', count(*) - count(DISTINCT player_code) FROM n_players "
    "UNION ALL SELECT 'games', count(*) - count(DISTINCT game_code) FROM n_games "
    "UNION ALL SELECT 'boxscore_record', count(*) - count(DISTINCT (player_id, game_id)) FROM n_box", O.NORMALISE))
def q_replay_is_noop(spark, base):
    docs = _docs(spark, base)
    once = NO.normalise(docs)
    twice = NO.normalise(docs, target=once)
    before = _summary(once).select("table_name", F.col("rows").alias("_before"))
    after = _summary(twice).select("table_name", F.col("rows").alias("_after"))
    return after.join(before, "table_name").select(
        "table_name", (F.col("_after") - F.col("_before")).cast("long").alias("new_rows"))


_SUMMARY_SQL = ("SELECT 'teams' AS table_name, CAST(count(*) AS BIGINT) AS rows, max(id) AS max_id FROM n_teams "
                "UNION ALL SELECT 'players', count(*), max(id) FROM n_players "
                "UNION ALL SELECT 'games', count(*), max(id) FROM n_games "
                "UNION ALL SELECT 'boxscore_record', count(*), max(id) FROM n_box")


def _summary(n):
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows"), F.max("id").cast("long").alias("max_id"))
             .select(F.lit(name).alias("table_name"), "rows", "max_id") for name, df in _table_list(n)]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@register("transform_all", O.bridge_sql(_SUMMARY_SQL, O.NORMALISE))
def q_transform_all(spark, base):
    store = INC.TableStore(spark, INC.fresh_area(spark, "transform_all"))
    docs = _docs(spark, base)
    INC.load_batch(store, docs, 0)
    INC.load_batch(store, docs, 1)  # full reprocess again: idempotent
    return _summary(store.read())


# Of every eleven documents, by game id: one is cut short, one has no referees, one a stat in each line that is no number,
# one odd minutes, one a score that is no number, and one numbers in other spellings, which load.
_FAULTY_SQL = """SELECT file_key, 'document' AS level, 'unparsable document or field of a wrong type' AS reason
FROM all_docs WHERE id % 11 = 1
UNION ALL SELECT file_key, 'document', 'a side''s Points is no number' FROM all_docs WHERE id % 11 = 8
UNION ALL SELECT d.file_key, 'player line', 'Steals is no number'
FROM all_docs d JOIN lineitem l ON l.l_orderkey = d.id JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE d.id % 50 <> 0 AND d.id % 11 = 4
UNION ALL SELECT file_key, 'document', 'missing Referees' FROM all_docs WHERE id % 11 = 2
UNION ALL SELECT d.file_key, 'player line', 'minutes has no '':'''
FROM all_docs d JOIN lineitem l ON l.l_orderkey = d.id JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE d.id % 50 <> 0 AND d.id % 11 = 6 AND l.l_partkey % 37 = 0"""


def _loosely_typed(body):
    """The same document with booleans, decimals and texts in the place of whole numbers."""
    for old, new in ((r'"IsStarter":1', '"IsStarter":true'), (r'"IsStarter":0', '"IsStarter":false'), (r'"Steals":(\d+)', '"Steals":$1.0'),
                     (r'"Assistances":(\d+)', '"Assistances":"$1"'), (r'"totr":\{"Points":(\d+)', '"totr":{"Points":$1.0')):
        body = F.regexp_replace(body, old, new)
    return body


@register("normalise_loose_types", O.bridge_sql(f"SELECT {', '.join(BOX_COLUMNS)} FROM n_box", O.NORMALISE))
def q_normalise_loose_types(spark, base):
    """Box rows from documents whose numbers are spelled as booleans, decimals and texts."""
    return NO.normalise(NO.parse_documents(B.documents(spark, base).withColumn("body", _loosely_typed(F.col("body"))))).boxscore


def _faulty_docs(spark, base):
    d = B.documents(spark, base)
    body, kind = F.col("body"), F.col("game_id") % 11
    faulty = (F.when(kind == 1, F.substring(body, F.lit(1), F.floor(F.length(body) / 2).cast("int")))
              .when(kind == 2, F.replace(body, F.lit('"Referees"'), F.lit('"Refs"')))
              .when(kind == 4, F.regexp_replace(body, r'"Steals":(\d+)', '"Steals":"x$1"'))
              .when(kind == 6, F.replace(body, F.lit('"Minutes":"DNP"'), F.lit('"Minutes":"10"')))
              .when(kind == 8, F.regexp_replace(body, r'"totr":\{"Points":\d+', '"totr":{"Points":[1]'))
              .when(kind == 9, _loosely_typed(body))
              .otherwise(body))
    return NO.parse_documents(d.withColumn("body", faulty))


def _landing_docs(spark, base):
    d = B.documents(spark, base)
    return d.select("season_code", "game_number", F.from_json("body", NO.DOCUMENT).alias("doc"))


@register("scan_landing_json", O.bridge_sql(f"SELECT {', '.join(BOX_COLUMNS)} FROM n_box", O.NORMALISE))
def q_scan_landing_json(spark, base):
    path = LA.write_landing(_landing_docs(spark, base), INC.fresh_area(spark, "landing"))
    return NO.normalise(LA.read_landing(spark, path, "partitioned")).boxscore


_ALL_DOCS_SQL = {"all_docs": """SELECT g.id,
  'data/boxscore_json/E' || right(g.game_code, 4) || '/' || left(g.game_code, length(g.game_code) - 5)
    || '.json' AS file_key,
  CASE WHEN g.id % 50 = 0 THEN 'N/D, N/D, N/D' ELSE 'Ref A, Ref B, Ref C' END AS referees,
  th.name AS home_team, ta.name AS away_team, g.home_team_score AS home_points, g.away_team_score AS away_points,
  CAST((SELECT count(*) FROM lineitem l WHERE l.l_orderkey = g.id) AS INTEGER) AS players
FROM games g JOIN teams th ON th.id = g.home_team_id JOIN teams ta ON ta.id = g.away_team_id"""}


@register("load_rejects", O.bridge_sql(_FAULTY_SQL, _ALL_DOCS_SQL))
def q_load_rejects(spark, base):
    """Rejects as a reader finds them in the store after a load of faulty documents."""
    store = INC.TableStore(spark, INC.fresh_area(spark, "load_rejects"))
    INC.load_batch(store, _faulty_docs(spark, base), 0)
    return store.read().rejects


@register("landing_sink", O.bridge_sql(
    "SELECT file_key, referees, home_team, away_team, home_points, away_points, players FROM all_docs",
    _ALL_DOCS_SQL))
def q_landing_sink(spark, base):
    path = LA.write_landing(_landing_docs(spark, base), INC.fresh_area(spark, "landing"))
    d = LA.read_landing(spark, path, "partitioned")
    s0, s1 = F.col("doc.Stats")[0], F.col("doc.Stats")[1]
    return d.select("file_key", F.col("doc.Referees").alias("referees"),
                    s0["tmr"]["Team"].alias("home_team"), s1["tmr"]["Team"].alias("away_team"),
                    F.try_variant_get(s0["totr"]["Points"], "$", "int").alias("home_points"),
                    F.try_variant_get(s1["totr"]["Points"], "$", "int").alias("away_points"),
                    (F.size(s0["PlayersStats"]) + F.size(s1["PlayersStats"])).alias("players"))


@register("landing_overwrite_key", O.bridge_sql(
    "SELECT file_key, CASE WHEN id % 6 = 0 THEN 'second' WHEN id % 3 = 0 THEN 'later' WHEN id % 2 = 0 THEN 'second' ELSE referees END AS referees "
    "FROM all_docs", _ALL_DOCS_SQL))
def q_landing_overwrite_key(spark, base):
    """Three puts: all documents, every third one twice over, then every second one; the last put under a key counts."""
    docs = materialize(B.documents(spark, base)).select("game_id", "season_code", "game_number", F.from_json("body", NO.DOCUMENT).alias("doc"))
    store = LA.LandingStore(spark, INC.fresh_area(spark, "landing_store"))

    def changed(rows, to):
        return rows.withColumn("doc", F.col("doc").withField("Referees", F.lit(to)))

    store.put(docs)
    third = docs.filter("game_id % 3 = 0")
    store.put(changed(third, "earlier").withColumn("n", F.lit(1)).unionByName(changed(third, "later").withColumn("n", F.lit(2))), order="n")
    store.put(changed(docs.filter("game_id % 2 = 0"), "second"))
    return store.read().select("file_key", F.col("doc.Referees").alias("referees"))


@register("landing_changes", O.bridge_sql("""SELECT season || '/' || CAST(page AS VARCHAR) AS page, CASE WHEN page % 4 = 0 THEN 'vanished'
  WHEN bool_or(id % 40 = 0) THEN 'rewritten' END AS change
FROM (SELECT id, 'E' || right(game_code, 4) AS season, CAST(left(game_code, length(game_code) - 5) AS BIGINT) // 100 AS page FROM games)
GROUP BY season, page HAVING page % 4 = 0 OR (bool_or(id % 40 = 0) AND page % 4 <> 3)
UNION ALL SELECT DISTINCT 'E' || right(game_code, 4) || '/' || CAST(CAST(left(game_code, length(game_code) - 5) AS BIGINT) // 100 + 100000 AS VARCHAR), 'new'
FROM games WHERE (CAST(left(game_code, length(game_code) - 5) AS BIGINT) // 100) % 5 = 1"""))
def q_landing_changes(spark, base):
    """Pages of a hundred documents landed twice: changes between the two listings, by contents."""
    root = INC.fresh_area(spark, "landing_listing")
    page, body = F.col("page"), F.col("body")

    def landed(listing, when, page, body):
        return F.when(when, F.struct(F.lit(listing).alias("listing"), page.alias("page"), body.alias("body")))

    def listed(name):
        found = LA.listing(spark, f"{root}/listing={name}")
        return found.withColumn("page", F.concat_ws("/", F.regexp_extract_all("file", F.lit("=([^/]+)/"))))

    # A page lies in one task for both landings, so the documents are made and shuffled once, and copied nowhere else.
    corrected = F.when((F.col("game_id") % 40 == 0) & (page % 4 != 3), "corrected").otherwise(body)
    d = B.documents(spark, base).withColumn("page", F.floor(F.col("game_number") / 100)).repartition("season_code", "page")
    both = d.select("season_code", "game_number", F.inline(F.filter(F.array(
        landed("first", F.lit(True), page, body), landed("second", page % 4 != 0, page, corrected),
        landed("second", page % 5 == 1, page + 100000, body)), lambda x: x.isNotNull())))
    for name in ("first", "second"):  # a landing without a document is there, too
        spark.createDataFrame([], "body string").write.json(f"{root}/listing={name}")
    both.sortWithinPartitions("listing", "season_code", "page", "game_number").write.mode("append") \
        .partitionBy("listing", "season_code", "page").option("compression", "gzip").json(root)
    return LA.listing_changes(listed("first"), listed("second"), by="page")


_NATURAL_BOX_COLS = ["player_code", "game_code", "team_name", "played_for_home", "is_starter", "seconds",
                     *[c for c in BOX_COLUMNS[7:]]]


def _natural_box(n):
    p = n.players.select(F.col("id").alias("player_id"), "player_code")
    g = n.games.select(F.col("id").alias("game_id"), "game_code")
    t = n.teams.select(F.col("id").alias("team_id"), F.col("name").alias("team_name"))
    return n.boxscore.join(p, "player_id").join(g, "game_id").join(t, "team_id").select(*_NATURAL_BOX_COLS)


@register("stream_incremental", O.bridge_sql(
    "SELECT p.player_code, g.game_code, t.name AS team_name, b.played_for_home, b.is_starter, b.seconds, "
    + ", ".join(f"b.{c}" for c in BOX_COLUMNS[7:])
    + " FROM n_box b JOIN n_players p ON p.id = b.player_id JOIN n_games g ON g.id = b.game_id "
      "JOIN n_teams t ON t.id = b.team_id", O.NORMALISE))
def q_stream_incremental(spark, base):
    landing = LA.write_landing(_landing_docs(spark, base), INC.fresh_area(spark, "landing"))
    root = INC.fresh_area(spark, "stream")
    store = INC.run_incremental(spark, landing, f"{root}/tables", f"{root}/checkpoint", max_files_per_trigger=8)
    return _natural_box(store.read())


# ------------------------------------------------------------ keyed access, audits
from courtline.operators import audit as AU  # noqa: E402
from courtline.schemas import FOREIGN_KEYS, NATURAL_KEYS  # noqa: E402


def _stored_bridge(spark, base):
    """The four bridge tables as the first version of a table store."""
    t = _bridge_tables(spark, base)
    store = INC.TableStore(spark, INC.fresh_area(spark, "bridge_store"))
    rejects = spark.createDataFrame([], "file_key string, level string, reason string")
    store.commit(NO.Normalised(t["teams"], t["players"], t["games"], t["boxscore_record"], rejects), 0, "")
    return store


def _bridge_tables(spark, base):
    return {"teams": B.teams(spark, base), "players": B.players(spark, base),
            "games": B.games(spark, base), "boxscore_record": B.boxscore(spark, base)}


@register("scan_table", O.bridge_sql("""SELECT 'teams' AS table_name, id, name AS label FROM teams
UNION ALL SELECT 'players', id, player_code || ' ' || name FROM players
UNION ALL SELECT 'games', id, game_code || ' ' || CAST(home_team_score AS VARCHAR) FROM games
UNION ALL SELECT 'boxscore_record', id, CAST(player_id AS VARCHAR) || ' ' || CAST(game_id AS VARCHAR) FROM boxscore_record"""))
def q_scan_table(spark, base):
    t = _bridge_tables(spark, base)
    label = {"teams": F.col("name"), "players": F.concat_ws(" ", "player_code", "name"),
             "games": F.concat_ws(" ", "game_code", F.col("home_team_score").cast("string")),
             "boxscore_record": F.concat_ws(" ", F.col("player_id").cast("string"), F.col("game_id").cast("string"))}
    parts = [df.select(F.lit(name).alias("table_name"), "id", label[name].alias("label")) for name, df in t.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_LABELS = {"teams": "name", "players": "concat_ws(' ', player_code, name)", "games": "concat_ws(' ', game_code, CAST(home_team_score AS {text}))",
           "boxscore_record": "concat_ws(' ', CAST(player_id AS {text}), CAST(game_id AS {text}))"}


@register("lookup_by_id", O.bridge_sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, r.id AS requested_id, x.label FROM (SELECT id FROM {t} UNION ALL SELECT -1 - id FROM {t} "
    f"UNION ALL SELECT id FROM {t} WHERE id % 7 = 0) r "
    f"LEFT JOIN (SELECT id, {label.format(text='VARCHAR')} AS label FROM {t}) x ON x.id = r.id" for t, label in _LABELS.items())))
def q_lookup_by_id(spark, base):
    """Every id of each of the four stored tables, some asked for twice, and as many that are not there."""
    store = _stored_bridge(spark, base)
    out = None
    for name, label in _LABELS.items():
        ids = store.table(name).select("id")
        ids = ids.unionByName(ids.select((-1 - F.col("id")).alias("id"))).unionByName(ids.filter("id % 7 = 0"))
        found = store.lookup(name, ids)
        found = found.select(F.lit(name).alias("table_name"), "requested_id", F.when(
            F.col(found.columns[1]).isNotNull(), F.expr(label.format(text="STRING"))).alias("label"))
        out = found if out is None else out.unionByName(found)
    return out


# All ids of the four tables, and as many absent ones, are deleted in this order.  Box rows of every third game stay out of it at first.
_DELETE_SQL = {
    "asked": "SELECT 1 AS step, 'teams' AS table_name, id FROM teams UNION ALL SELECT 1, 'teams', -1 - id FROM teams "
             "UNION ALL SELECT 2, 'boxscore_record', id FROM boxscore_record WHERE game_id % 3 <> 0 "
             "UNION ALL SELECT 3, 'games', id FROM games UNION ALL SELECT 3, 'games', -1 - id FROM games "
             "UNION ALL SELECT 4, 'players', id FROM players UNION ALL SELECT 4, 'players', -1 - id FROM players "
             "UNION ALL SELECT 5, 'boxscore_record', id FROM boxscore_record UNION ALL SELECT 6, 'games', id FROM games "
             "UNION ALL SELECT 7, 'teams', id FROM teams WHERE id % 2 = 0",
    "outcomes": """SELECT a.*, CASE WHEN a.id < 0 THEN 'absent'
  WHEN step = 1 AND (EXISTS (SELECT 1 FROM games g WHERE g.home_team_id = a.id OR g.away_team_id = a.id)
    OR EXISTS (SELECT 1 FROM boxscore_record b WHERE b.team_id = a.id)) THEN 'refused'
  WHEN step = 3 AND EXISTS (SELECT 1 FROM boxscore_record b WHERE b.game_id = a.id AND b.game_id % 3 = 0) THEN 'refused'
  WHEN step = 4 AND EXISTS (SELECT 1 FROM boxscore_record b WHERE b.player_id = a.id AND b.game_id % 3 = 0) THEN 'refused'
  WHEN step = 5 AND (SELECT b.game_id % 3 <> 0 FROM boxscore_record b WHERE b.id = a.id) THEN 'absent'
  WHEN step = 6 AND NOT EXISTS (SELECT 1 FROM boxscore_record b WHERE b.game_id = a.id AND b.game_id % 3 = 0) THEN 'absent'
  WHEN step = 7 AND NOT EXISTS (SELECT 1 FROM games g WHERE g.home_team_id = a.id OR g.away_team_id = a.id)
    AND NOT EXISTS (SELECT 1 FROM boxscore_record b WHERE b.team_id = a.id) THEN 'absent'
  ELSE 'deleted' END AS outcome FROM asked a""",
    "left_over": "SELECT t.table_name, t.id FROM (SELECT 'teams' AS table_name, id FROM teams UNION ALL SELECT 'players', id FROM players "
                 "UNION ALL SELECT 'games', id FROM games UNION ALL SELECT 'boxscore_record', id FROM boxscore_record) t "
                 "WHERE NOT EXISTS (SELECT 1 FROM outcomes o WHERE o.table_name = t.table_name AND o.id = t.id AND o.outcome = 'deleted')",
}


@register("delete_restrict", O.bridge_sql(
    "SELECT CAST(step AS INTEGER) AS step, table_name, id, outcome FROM outcomes UNION ALL SELECT 8, table_name, id, 'remains' FROM left_over",
    _DELETE_SQL))
def q_delete_restrict(spark, base):
    """Outcomes of seven deletions from stored tables, one after the other, and the rows a reader finds afterwards."""
    store = _stored_bridge(spark, base)
    # What is asked for: the ids as they stand before the first deletion, read from the store.
    t = {name: store.table(name) for name in ("teams", "players", "games", "boxscore_record")}

    def ids(name, absent=False):
        own = t[name].select("id")
        return own.unionByName(own.select((-1 - F.col("id")).alias("id"))) if absent else own

    steps = [("teams", ids("teams", True)), ("boxscore_record", t["boxscore_record"].filter("game_id % 3 <> 0").select("id")),
             ("games", ids("games", True)), ("players", ids("players", True)), ("boxscore_record", ids("boxscore_record")),
             ("games", ids("games")), ("teams", ids("teams").filter("id % 2 = 0"))]
    out = None
    for number, (name, wanted) in enumerate(steps, 1):
        got = store.delete(name, wanted).select(F.lit(number).alias("step"), "table_name", "id", "outcome")
        out = got if out is None else out.unionByName(got)
    for name in t:
        out = out.unionByName(store.table(name).select(F.lit(8).alias("step"), F.lit(name).alias("table_name"), "id",
                                                       F.lit("remains").alias("outcome")))
    return out


# Faults planted into the tables: a player in seven comes twice, a game in eleven has no home team, the ids of games of one
# in thirteen are those of other tables' rows, and box rows point to players and games that are not there.
_PLANTED_SQL = {
    "f_players": "SELECT * FROM players UNION ALL SELECT id + 1000000, player_code, name || ' again' FROM players WHERE id % 7 = 0",
    "f_games": "SELECT id, CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN -1 ELSE home_team_id END AS home_team_id, away_team_id, game_code FROM games",
    "f_box": "SELECT id, CASE WHEN id % 17 = 0 THEN player_id + 1000000 ELSE player_id END AS player_id, game_id, team_id FROM boxscore_record",
    "r_games": "SELECT id, CASE WHEN home_team_id IS NULL THEN 'home_team_id is null' WHEN home_team_id = -1 THEN 'home_team_id has no parent' END AS reason FROM f_games",
    "r_players": "SELECT id, CASE WHEN id >= 1000000 THEN 'player_code is taken' END AS reason FROM f_players",
    "r_box": "SELECT b.id, CASE WHEN b.id % 17 = 0 THEN 'player_id has no parent' WHEN g.reason IS NOT NULL THEN 'game_id has no parent' END AS reason "
             "FROM f_box b JOIN r_games g ON g.id = b.game_id",
}


@register("load_constraints", O.bridge_sql("""SELECT 'teams:' || CAST(id AS VARCHAR) AS row_key, 'stored' AS outcome FROM teams
UNION ALL SELECT 'players:' || CAST(id AS VARCHAR), coalesce(reason, 'stored') FROM r_players
UNION ALL SELECT 'games:' || CAST(id AS VARCHAR), coalesce(reason, 'stored') FROM r_games
UNION ALL SELECT 'boxscore_record:' || CAST(id AS VARCHAR), coalesce(reason, 'stored') FROM r_box""", _PLANTED_SQL))
def q_load_constraints(spark, base):
    """Every row of a load with planted faults: stored, or why it is a reject."""
    t = _bridge_tables(spark, base)
    again = t["players"].filter("id % 7 = 0").select((F.col("id") + 1000000).alias("id"), "player_code", F.concat("name", F.lit(" again")).alias("name"))
    t["players"] = t["players"].unionByName(again)
    t["games"] = t["games"].withColumn("home_team_id", F.expr(
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN -1L ELSE home_team_id END"))
    t["boxscore_record"] = t["boxscore_record"].withColumn("player_id", F.expr("if(id % 17 = 0, player_id + 1000000, player_id)"))
    store = INC.TableStore(spark, INC.fresh_area(spark, "load_constraints"))
    INC.load_tables(store, t, 0, most_rejected=0.5)
    out = store.table("rejects").select(F.col("file_key").alias("row_key"), F.col("reason").alias("outcome"))
    for name in ("teams", "players", "games", "boxscore_record"):
        out = out.unionByName(store.table(name).select(F.concat(F.lit(f"{name}:"), F.col("id").cast("string")), F.lit("stored")).toDF("row_key", "outcome"))
    return out


_UNIQUE_KEYS = {t: [k, ["id"]] for t, k in NATURAL_KEYS.items()}


def _unique_sql() -> str:
    parts = ["SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS key_columns, "
             "CAST(count(*) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
             "FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"]
    for t, ks in _UNIQUE_KEYS.items():
        for k in ks:
            parts.append(f"SELECT '{t}', '{','.join(k)}', count(*), coalesce(sum(n), 0) FROM "
                         f"(SELECT count(*) AS n FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


@register("audit_unique", O.bridge_sql(_unique_sql()))
def q_audit_unique(spark, base):
    from courtline.sources.tables import read_table
    t = _bridge_tables(spark, base)
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_linenumber"])
    raw = AU.duplicate_keys(li, ["l_orderkey", "l_linenumber"], "lineitem")
    return raw.unionByName(AU.audit_unique(t, _UNIQUE_KEYS))


def _not_null_sql() -> str:
    from courtline.schemas import BOXSCORE, GAMES, PLAYERS, TEAMS
    parts = []
    for t, schema in (("teams", TEAMS), ("players", PLAYERS), ("games", GAMES), ("boxscore_record", BOXSCORE)):
        for f in schema.fields:
            parts.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {f.name} IS NULL) AS BIGINT) AS nulls FROM {t}")
    return " UNION ALL ".join(parts)


@register("audit_not_null", O.bridge_sql(_not_null_sql()))
def q_audit_not_null(spark, base):
    return AU.audit_not_null(_bridge_tables(spark, base))


_FK_PARENTS_SQL = {
    "teams_k": "SELECT * FROM teams WHERE id % 10 <> 0",
    "players_k": "SELECT * FROM players WHERE id % 10 <> 0",
    "games_k": "SELECT * FROM games WHERE id % 10 <> 0",
}


def _fk_sql() -> str:
    parts = []
    for child, col, parent in FOREIGN_KEYS:
        child_rel = f"{child}_k" if child != "boxscore_record" else "boxscore_record"
        parts.append(f"SELECT '{child}' AS child_table, '{col}' AS column_name, '{parent}' AS parent_table, "
                     f"CAST(count(*) AS BIGINT) AS orphans FROM {child_rel} c "
                     f"WHERE c.{col} IS NOT NULL AND c.{col} NOT IN (SELECT id FROM {parent}_k)")
    return " UNION ALL ".join(parts)


@register("audit_foreign_keys", O.bridge_sql(_fk_sql(), _FK_PARENTS_SQL))
def q_audit_foreign_keys(spark, base):
    t = _bridge_tables(spark, base)
    kept = {name: df.filter(F.col("id") % 10 != 0) for name, df in t.items() if name != "boxscore_record"}
    kept["boxscore_record"] = t["boxscore_record"]
    return AU.audit_foreign_keys(kept, FOREIGN_KEYS)


# ------------------------------------------------------------ fetch bookkeeping
_SPEC_SQL = {"spec": "SELECT 'E' || season AS season_code, max(game_number) AS max_game_id FROM gi GROUP BY season"}


def _spec(spark, base):
    gi = FE.game_info(B.games(spark, base))
    return gi.groupBy(F.concat(F.lit("E"), F.col("season")).alias("season_code")) \
        .agg(F.max("game_number").alias("max_game_id"))


@register("fetch_plan", O.features_sql(
    "SELECT season_code, game_id, 'boxscore?gamecode=' || CAST(game_id AS VARCHAR) || '&seasoncode=' || season_code "
    "AS url, 'data/boxscore_json/' || season_code || '/' || CAST(game_id AS VARCHAR) || '.json' AS landing_key "
    "FROM (SELECT season_code, CAST(unnest(generate_series(1, max_game_id)) AS BIGINT) AS game_id FROM spec "
    "WHERE max_game_id >= 1)", _SPEC_SQL))
def q_fetch_plan(spark, base):
    return INC.fetch_plan(_spec(spark, base))


_OUTCOMES_SQL = {"responses": """SELECT event_id AS id, CAST(user_id AS VARCHAR) AS season,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, props AS body FROM events""",
                 "outcomes": """SELECT season, id, (status = 200 AND coalesce(json_valid(body), false)) AS success,
  CASE WHEN status = 200 AND coalesce(json_valid(body), false) THEN NULL
       WHEN status = 200 THEN 'JSON decode error: invalid JSON'
       ELSE 'Failed to fetch data for season: ' || season || ' game ID: ' || CAST(id AS VARCHAR)
            || ' - Status: ' || CAST(status AS VARCHAR) END AS error
FROM responses"""}


def _outcomes(spark, base):
    return INC.classify_fetch(B.fetch_responses(spark, base))


@register("classify_fetch", O.with_ctes("SELECT * FROM outcomes", _OUTCOMES_SQL))
def q_classify_fetch(spark, base):
    return _outcomes(spark, base)


@register("fetch_summary", O.with_ctes(
    "SELECT season, success, CAST(count(*) AS BIGINT) AS attempts FROM outcomes GROUP BY season, success",
    _OUTCOMES_SQL))
def q_fetch_summary(spark, base):
    return INC.fetch_summary(_outcomes(spark, base))


@register("success_prefix", O.with_ctes(
    "SELECT o.* FROM outcomes o JOIN (SELECT season, min(id) FILTER (WHERE NOT success) AS fail "
    "FROM outcomes GROUP BY season) f ON f.season = o.season WHERE f.fail IS NULL OR o.id < f.fail",
    _OUTCOMES_SQL))
def q_success_prefix(spark, base):
    return INC.success_prefix(_outcomes(spark, base))


_STATE_SQL = {"state": "SELECT 'transform' AS stage, 'E' || season AS season, "
                       "CAST(max(game_number) AS BIGINT) AS last_id FROM gi GROUP BY season"}


def _state(spark, base):
    gi = FE.game_info(B.games(spark, base))
    return gi.groupBy(F.concat(F.lit("E"), F.col("season")).alias("season")).agg(
        F.max("game_number").cast("long").alias("last_id")).select(F.lit("transform").alias("stage"), "*")


@register("watermark_state", O.features_sql("SELECT * FROM state", _STATE_SQL))
def q_watermark_state(spark, base):
    """What a second reader finds after one version with half marks and one with the whole ones."""
    st = _state(spark, base)
    root = INC.fresh_area(spark, "marks")
    INC.MarkStore(spark, root).advance(st.withColumn("last_id", (F.col("last_id") / 2).cast("long")))
    INC.MarkStore(spark, root).advance(st)
    INC.MarkStore(spark, root).advance(st.withColumn("last_id", F.lit(1).cast("long")))  # never lowered
    return INC.MarkStore(spark, root).read()


@register("advance_marks", O.with_ctes("""SELECT 'fetch' AS stage, s.season,
  CAST(greatest(s.last_id, max(o.id)) AS BIGINT) AS last_id
FROM (SELECT season, min(id) AS last_id FROM outcomes GROUP BY season) s
LEFT JOIN (SELECT season, min(id) FILTER (WHERE NOT success) AS fail FROM outcomes GROUP BY season) f ON f.season = s.season
LEFT JOIN outcomes o ON o.season = s.season AND (f.fail IS NULL OR o.id < f.fail)
GROUP BY s.season, s.last_id""", _OUTCOMES_SQL))
def q_advance_marks(spark, base):
    outcomes = _outcomes(spark, base)
    old = outcomes.groupBy("season").agg(F.min("id").alias("last_id")).select(F.lit("fetch").alias("stage"), "season", "last_id")
    return INC.advance_marks(old, INC.success_prefix(outcomes), "fetch")


@register("watermark_merge", O.features_sql("""SELECT coalesce(o.stage, u.stage) AS stage,
  coalesce(o.season, u.season) AS season, CAST(coalesce(u.last_id, o.last_id) AS BIGINT) AS last_id
FROM (SELECT stage, season, last_id // 2 AS last_id FROM state) o
FULL OUTER JOIN (SELECT stage, season, last_id FROM state WHERE season >= 'E1999'
                 UNION ALL SELECT 'fetch', season, last_id FROM state) u
  ON o.stage = u.stage AND o.season = u.season""", _STATE_SQL))
def q_watermark_merge(spark, base):
    st = _state(spark, base)
    old = st.select("stage", "season", (F.col("last_id") / 2).cast("long").alias("last_id"))
    updates = st.filter(F.col("season") >= "E1999").unionByName(st.withColumn("stage", F.lit("fetch")))
    return INC.merge_marks(old, updates)


@register("metric_tail", """SELECT event_id AS step, ts, value FROM events WHERE event_type = 'view'
ORDER BY ts DESC, event_id DESC LIMIT 5""")
def q_metric_tail(spark, base):
    from courtline.sources.tables import read_table
    e = read_table(spark, base, "events", ["event_id", "ts", "event_type", "value"])
    return e.filter(F.col("event_type") == "view").orderBy(F.col("ts").desc(), F.col("event_id").desc()) \
        .limit(5).select(F.col("event_id").alias("step"), "ts", "value")


# ------------------------------------------------------------ model (K1-K3, E5)
from courtline.plans import model as MO  # noqa: E402


@register("mae", O.features_sql(
    "SELECT season, CAST(count(*) AS BIGINT) AS n, avg(abs(points - avg_last_3_points)) AS mae "
    "FROM tf WHERE points IS NOT NULL GROUP BY season"))
def q_mae(spark, base):
    return MO.mae_frame(_features(spark, base), "points", "avg_last_3_points", by=["season"])


def _prepared(spark, base):
    """(train, test) of one stored copy: training, its means and the scored rows all read it."""
    return PR.split(materialize(PR.preprocess(_features(spark, base))), _TEST)


def _trained(spark, base):
    train, test = _prepared(spark, base)
    return MO.fit(train), test


# A label with signal, of given columns only: what a trainer has to find, and a predicted mean does not.
_SIGNAL = "avg_last_3_points * 2 + if(played_for_home = 1, 15, 0) + avg_last_3_assists"


def _with_signal(df):
    return df.withColumn("next_game_valuation", F.expr(_SIGNAL).cast("double"))


@register("train_gbt_signal", O.features_sql(f"""SELECT 'validation_mae' AS metric, count(*) AS n, true AS under_half_of_mean
FROM prep WHERE season IS NOT DISTINCT FROM '{_TEST}'""", _PREP))
def q_train_gbt_signal(spark, base):
    """The same training on a label that the features determine: the error has to be under half of that of the training mean."""
    train, test = (_with_signal(x) for x in _prepared(spark, base))
    scored = MO.score(MO.fit(train), test).withColumn("_mean", train.agg(F.avg("next_game_valuation")).scalar())
    label = F.col("next_game_valuation")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(label - F.col("prediction"))).alias("_mae"),
                      F.avg(F.abs(label - F.col("_mean"))).alias("_base")).select(
        F.lit("validation_mae").alias("metric"), "n", (F.col("_mae") < 0.5 * F.col("_base")).alias("under_half_of_mean"))


@register("training_curve_tail", O.features_sql(f"""SELECT CAST(r AS INTEGER) AS round, (SELECT count(*) FROM prep
  WHERE season IS NOT DISTINCT FROM '{_TEST}') AS n, true AS below_first_round FROM (SELECT unnest(range(96, 101)) AS r)""", _PREP))
def q_training_curve_tail(spark, base):
    """The last five of the training's hundred rounds: rows measured, and whether the error fell below the first round's."""
    train, test = (_with_signal(x) for x in _prepared(spark, base))
    curve = MO.training_curve(MO.fit(train), test)
    first = curve.filter("round = 1").select(F.col("mae").alias("_first"))
    return curve.withColumn("_first", first.scalar()).orderBy(F.desc("round")).limit(5).select(
        "round", "n", (F.col("mae") < F.col("_first")).alias("below_first_round"))


@register("score_stored_model", O.features_sql(f"""SELECT player_id, CAST(season AS INTEGER) AS season, game_number,
  next_game_valuation IS NOT NULL AS labelled, true AS scored, true AS as_in_batch
FROM tf WHERE season IS NOT DISTINCT FROM '{_TEST}'"""))
def q_score_stored_model(spark, base):
    """Every row of the test season, last games without a label included, streamed through a stored model read by another reader."""
    root = INC.fresh_area(spark, "score")
    train, _ = _prepared(spark, base)
    path = MO.save_model(MO.fit(train, rounds=20), f"{root}/model")
    fresh = PR.split(PR.preprocess(_features(spark, base), mode="as_written"), _TEST)[1]
    fresh.write.parquet(f"{root}/rows")
    stream = spark.readStream.schema(fresh.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/rows")
    out = MO.score_stream(stream, path, f"{root}/scored", f"{root}/checkpoint")
    key = ["player_id", "season", "game_number", "opponent_team_id"]
    batch = MO.score(MO.load_model(path), spark.read.parquet(f"{root}/rows")).select(
        *key, F.col("next_game_valuation").alias("_label"), F.col("prediction").alias("_batch"))
    p = F.col("prediction")
    return out.join(batch, key, "left").select(
        "player_id", "season", "game_number", F.col("next_game_valuation").isNotNull().alias("labelled"),
        (p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))).alias("scored"), (p == F.col("_batch")).alias("as_in_batch"))


@register("train_gbt", O.features_sql(f"""SELECT 'validation_mae' AS metric, count(*) AS n, true AS near_mean_or_better
FROM prep WHERE season IS NOT DISTINCT FROM '{_TEST}' AND next_game_valuation IS NOT NULL""", _PREP))
def q_train_gbt(spark, base):
    """Rows that the metric is taken over, and whether it is within a tenth of predicting the training mean, or better.

    The given statistics are pseudo-random, so no model can do much better than that.
    """
    train, test = _prepared(spark, base)
    scored = MO.score(MO.fit(train), test).withColumn("_mean", train.agg(F.avg("next_game_valuation")).scalar())
    label = F.col("next_game_valuation")
    return scored.filter(label.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(label - F.col("prediction"))).alias("_mae"),
        F.avg(F.abs(label - F.col("_mean"))).alias("_base")).select(
        F.lit("validation_mae").alias("metric"), "n", (F.col("_mae") < 1.1 * F.col("_base")).alias("near_mean_or_better"))


@register("score_batch", O.features_sql(f"""SELECT player_id, CAST(season AS INTEGER) AS season, game_number, next_game_valuation, true AS scored
FROM prep WHERE season IS NOT DISTINCT FROM '{_TEST}'""", _PREP))
def q_score_batch(spark, base):
    """Every row of the test part with its label, and that it got a finite prediction."""
    model, test = _trained(spark, base)
    p = F.col("prediction")
    return MO.score(model, test).select("player_id", "season", "game_number", "next_game_valuation",
                                        (p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))).alias("scored"))



# ------------------------------------------------------------ later additions (G1, Q5/Q6)

@register("features_sorted_sink", O.features_sql("SELECT * FROM tf ORDER BY game_id, player_id"))
def q_features_sorted_sink(spark, base):
    g, b = _gb(spark, base)
    path = scratch_path(spark, "features_sorted", unique=True)
    # The games are read for the frames, the running wins and their block totals, so they are numbered once.
    FE.sorted_features(FE.training_features(materialize(g), b), B.boxscore_keys(spark, base)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("transform_mark_update", O.bridge_sql("""SELECT 'transform' AS stage, p.season_code AS season,
  greatest(max(p.file_number), max(m.last_id)) AS last_id
FROM parsed p LEFT JOIN marks m ON p.season_code = m.season_code GROUP BY p.season_code""",
    _PATHS_SQL, _PARSED_SQL, _MARKS_SQL))
def q_transform_mark_update(spark, base):
    parsed = _parsed(spark, base)
    marks = _marks(parsed)
    old = marks.select(F.lit("transform").alias("stage"), F.col("season_code").alias("season"), "last_id")
    # first what is new, then a late batch of old keys, which must not lower a mark
    fresh = INC.transform_marks(old, INC.above_marks(parsed, marks).select("season_code", "file_number"))
    late = parsed.filter(F.col("file_number") <= 2).select("season_code", "file_number")
    return INC.transform_marks(fresh, late)



@register("rolling_means_hot_groups", O.features_sql(
    f"SELECT id, player_id, game_id, season, game_number, {O.ROLLING_COLS}, next_game_valuation FROM pb"))
def q_rolling_means_hot_groups(spark, base):
    """F1-F21 through the skew-safe frame operator (no task holds a whole player-season)."""
    g, b = _gb(spark, base)
    pb = FE.player_box(b, FE.game_info(g), hot_groups=True)
    return pb.select("id", "player_id", "game_id", "season", "game_number",
                     *[f"avg_last_3_{c}" for c in ROLLING_STATS], "next_game_valuation")


# ------------------------------------------------------------ features kept up by batches
from courtline.streaming.feature_store import FeatureStore  # noqa: E402

# The second of two loads: the later half of every season, and of one season the games with odd ids, among them earlier ones.
_LATE_SEASON = "1995"
_HALVES_SQL = {"halves": f"""SELECT id, season, if(season = '{_LATE_SEASON}', id % 2 = 1,
  game_number > (max(game_number) OVER (PARTITION BY season)) // 2) AS second FROM gi"""}


def _loaded_in_halves(spark, base):
    g, b = (materialize(x) for x in _gb(spark, base))  # the tables as they are given to every load
    gi = FE.game_info(g)
    half = gi.groupBy("season").agg(F.floor(F.max("game_number") / 2).alias("_half"))
    second = gi.join(half, "season").filter(F.when(F.col("season") == _LATE_SEASON, F.col("id") % 2 == 1).otherwise(
        F.col("game_number") > F.col("_half"))).select("id")
    store = FeatureStore(spark, INC.fresh_area(spark, "features"))
    for number, how in enumerate(("left_anti", "left_semi")):
        games = g.join(second, "id", how)
        box = b.join(second.withColumnRenamed("id", "game_id"), "game_id", how).select(*b.columns)
        store.load(games, box, g, b, number)
    return store


@register("features_incremental", O.features_sql("SELECT * FROM tf"))
def q_features_incremental(spark, base):
    """The feature table after two loads, one season of the second being rebuilt."""
    return _loaded_in_halves(spark, base).read()


@register("features_incremental_report", O.features_sql(f"""SELECT CAST(1 AS BIGINT) AS load,
  CAST(count(*) AS BIGINT) AS new_rows, CAST(0 AS BIGINT) AS relabelled_rows, CAST(0 AS BIGINT) AS rebuilt_seasons
FROM tf JOIN halves h ON h.id = tf.game_id WHERE NOT h.second
UNION ALL SELECT 2, (SELECT count(*) FROM tf JOIN halves h ON h.id = tf.game_id WHERE h.second OR h.season = '{_LATE_SEASON}'),
  (SELECT count(*) FROM (SELECT player_id FROM tf JOIN halves h ON h.id = tf.game_id WHERE h.season <> '{_LATE_SEASON}'
                         GROUP BY player_id, h.season HAVING bool_or(h.second) AND bool_or(NOT h.second))), 1""", _HALVES_SQL))
def q_features_incremental_report(spark, base):
    """Rows that each load wrote: new ones, and the row before each player's first new one, whose label became known."""
    return _loaded_in_halves(spark, base).commits().select(
        F.col("version").alias("load"), "new_rows", "relabelled_rows", "rebuilt_seasons")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.run for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}
