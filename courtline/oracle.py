"""Independent DuckDB statements of each registered query (the correctness oracle).

Each statement is self-contained: the bridge tables are restated as CTEs over
the provided tables, followed by the query's own CTEs and final SELECT.
Column names and types are aligned with the Spark side (BIGINT ids, INTEGER
stats, DOUBLE means and ratios).
"""

from __future__ import annotations

from courtline.schemas import BOX_COLUMNS, ROLLING_STATS, STAT_FIELD_TO_COLUMN


def _stat_sql(i: int, pk: str = "l_partkey", ln: str = "l_linenumber") -> str:
    name = ROLLING_STATS[i]
    v = f"({pk} * {2 * i + 3} + {ln} + {i}) % 23"
    if name in ("valuation", "plus_minus"):
        v = f"{v} - 5"
    v = f"CAST({v} AS INTEGER)"
    if name == "points":
        v = f"CASE WHEN {pk} % 37 = 0 THEN NULL ELSE {v} END"
    return v


LINE_ORDER_SQL = ("l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_quantity, "
                  "l_discount, l_tax, l_linestatus, l_returnflag")

_HOME = "o_custkey % 25"
_AWAY = "(o_custkey % 25 + 1 + o_orderkey % 24) % 25"


def _box_select() -> str:
    stats = {name: _stat_sql(i) for i, name in enumerate(ROLLING_STATS)}
    cols = {
        "id": "l_orderkey * (SELECT greatest(100000, max(l_suppkey) + 1) FROM lineitem) + l_suppkey",
        "player_id": "l_suppkey",
        "game_id": "l_orderkey",
        "team_id": f"CASE WHEN l_linestatus = 'O' THEN {_HOME} ELSE {_AWAY} END",
        "played_for_home": "l_linestatus = 'O'",
        "is_starter": "l_linenumber <= 5",
        **stats,
    }
    return ",\n  ".join(f"{cols[c]} AS {c}" for c in BOX_COLUMNS)


def _code_sql(key: str) -> str:
    """`P` and the key, padded to six digits; a longer key stays whole."""
    return f"'P' || repeat('0', greatest(0, 6 - length(CAST({key} AS VARCHAR)))) || CAST({key} AS VARCHAR)"


BRIDGE = {
    "teams": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
    "players": f"SELECT s_suppkey AS id, {_code_sql('s_suppkey')} AS player_code, s_name AS name FROM supplier",
    "games": f"""SELECT o_orderkey AS id, {_HOME} AS home_team_id, {_AWAY} AS away_team_id,
  CAST(row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS VARCHAR)
    || 'E' || CAST(year(o_orderdate) AS VARCHAR) AS game_code,
  CAST(60 + (o_orderkey * 13) % 40 AS INTEGER) AS home_team_score,
  CAST(60 + (o_orderkey * 7) % 40 AS INTEGER) AS away_team_score
FROM orders""",
    "boxscore_record": f"""SELECT {_box_select()}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY {LINE_ORDER_SQL}) AS _first
      FROM lineitem) l
JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE _first = 1""",
}


def _means(n: int = 3) -> str:
    return ", ".join(f"coalesce(avg(p.{c}), 0.0::DOUBLE) AS avg_last_{n}_{c}" for c in ROLLING_STATS)


# The feature columns from their contract (FIXTURES.md section 3), by plain lookups and self-joins: trailing means over
# the rows numbered just before, running wins by counting a team's earlier games, the opponent as the game's other side.
FEATURES = {
    "gi": """SELECT id, game_code, substr(game_code, length(game_code) - 3) AS season,
  TRY_CAST(regexp_replace(game_code, '.{5}$', '') AS BIGINT) AS game_number,
  home_team_id, away_team_id, home_team_score, away_team_score,
  if(coalesce(home_team_score > away_team_score, false), home_team_id, away_team_id) AS winning_team_id
FROM games WHERE TRY_CAST(regexp_replace(game_code, '.{5}$', '') AS BIGINT) IS NOT NULL""",
    "sides": """SELECT season, game_number, id AS game_id, winning_team_id, s.team AS team_id, s.other AS other_id,
  coalesce(s.mine > s.theirs, false) AS outright
FROM (SELECT *, unnest([{'team': home_team_id, 'other': away_team_id, 'mine': home_team_score, 'theirs': away_team_score},
                        {'team': away_team_id, 'other': home_team_id, 'mine': away_team_score, 'theirs': home_team_score}]) AS s
      FROM gi)""",
    "tg": "SELECT season, game_number, game_id, team_id, CAST(team_id = winning_team_id AS INTEGER) AS win FROM sides",
    "cw": """SELECT t.season, t.team_id, t.game_number,
  CAST(count(*) FILTER (WHERE e.win = 1) AS BIGINT) AS cum_wins, CAST(count(e.game_id) AS BIGINT) AS games_played_before,
  if(count(e.game_id) = 0, 0.0::DOUBLE, count(*) FILTER (WHERE e.win = 1)::DOUBLE / count(e.game_id)::DOUBLE) AS cum_win_ratio
FROM tg t LEFT JOIN tg e ON e.season = t.season AND e.team_id = t.team_id
  AND (e.game_number, e.game_id) < (t.game_number, t.game_id)
GROUP BY t.season, t.team_id, t.game_number, t.game_id""",
    "numbered": """SELECT b.*, gi.season, gi.game_number, gi.home_team_id AS _home,
  row_number() OVER (PARTITION BY b.player_id, gi.season ORDER BY gi.game_number, b.game_id) AS nth
FROM boxscore_record b JOIN gi ON gi.id = b.game_id""",
    "recent": f"""SELECT n.player_id, n.season, n.nth, {_means()}
FROM numbered n LEFT JOIN numbered p ON p.player_id = n.player_id AND p.season = n.season AND n.nth - p.nth BETWEEN 1 AND 3
GROUP BY n.player_id, n.season, n.nth""",
    "pb": """SELECT n.* EXCLUDE (_home, nth), coalesce(s.other_id, n._home) AS opponent_team_id,
  r.* EXCLUDE (player_id, season, nth), f.valuation AS next_game_valuation,
  CAST(coalesce(s.outright, false) AS INTEGER) AS win_ind
FROM numbered n JOIN recent r USING (player_id, season, nth)
LEFT JOIN numbered f ON f.player_id = n.player_id AND f.season = n.season AND f.nth = n.nth + 1
LEFT JOIN sides s ON s.game_id = n.game_id AND s.team_id = n.team_id""",
    "ratios": "SELECT season, game_number, team_id AS who, cum_win_ratio AS ratio FROM cw",
    "tf": """SELECT pb.*, mine.ratio AS team_win_ratio, theirs.ratio AS opponent_win_ratio,
  mine.ratio / nullif(theirs.ratio, 0) AS win_ratio_ratio
FROM pb
LEFT JOIN ratios mine ON (mine.season, mine.game_number, mine.who) = (pb.season, pb.game_number, pb.team_id)
LEFT JOIN ratios theirs ON (theirs.season, theirs.game_number, theirs.who) = (pb.season, pb.game_number, pb.opponent_team_id)""",
}


def with_ctes(select: str, *groups: dict[str, str]) -> str:
    """Prefix ``select`` with the CTE groups, in order."""
    parts = []
    for g in groups:
        parts.extend(f"{name} AS (\n{sql}\n)" for name, sql in g.items())
    return "WITH " + ",\n".join(parts) + "\n" + select


def bridge_sql(select: str, *more: dict[str, str]) -> str:
    return with_ctes(select, BRIDGE, *more)


def features_sql(select: str, *more: dict[str, str]) -> str:
    return with_ctes(select, BRIDGE, FEATURES, *more)


ROLLING_COLS = ", ".join(f"avg_last_3_{c}" for c in ROLLING_STATS)
DOC_STAT_FIELDS = list(STAT_FIELD_TO_COLUMN)


# ------------------------------------------------------------ normalisation
_LINE_ORDER_X = ", ".join(f"x.{c.strip()}" for c in LINE_ORDER_SQL.split(","))


def _doc_stat_sql() -> str:
    cols = []
    for i, name in enumerate(ROLLING_STATS):
        if name == "seconds":
            continue
        cols.append(f"COALESCE({_stat_sql(i, 'x.l_partkey', 'x.l_linenumber')}, 0) AS {name}")
    by_name = {c.rsplit(' AS ', 1)[1]: c for c in cols}
    from courtline.schemas import BOX_STATS
    return ",\n  ".join(by_name[c] for c in BOX_STATS)


def normalise_ctes(valid_filter: str = "TRUE") -> dict[str, str]:
    """Expected tables of loading the bridge documents (``valid_filter`` on docs)."""
    return {
        "docs": f"""SELECT g.id AS src_game, g.home_team_id AS h, g.away_team_id AS a,
  g.home_team_score, g.away_team_score,
  'data/boxscore_json/E' || right(g.game_code, 4) || '/' || left(g.game_code, length(g.game_code) - 5)
    || '.json' AS file_key,
  g.game_code, right(g.game_code, 4) AS season
FROM games g WHERE g.id % 50 <> 0 AND ({valid_filter})""",
        "team_sides": """SELECT d.file_key, 0 AS side, t.name FROM docs d JOIN teams t ON t.id = d.h
UNION ALL SELECT d.file_key, 1 AS side, t.name FROM docs d JOIN teams t ON t.id = d.a""",
        "n_teams": """SELECT CAST(row_number() OVER (ORDER BY file_key, side) AS BIGINT) AS id, name, file_key, side
FROM (SELECT * FROM team_sides QUALIFY row_number() OVER (PARTITION BY name ORDER BY file_key, side) = 1)""",
        "lines": f"""SELECT d.file_key, d.game_code, d.season, (l.l_linestatus <> 'O') AS away, l.*,
  {_code_sql('l.l_suppkey')} AS player_code,
  s.s_name || '#' || CAST(l.l_orderkey % 3 AS VARCHAR) AS pname
FROM docs d JOIN lineitem l ON l.l_orderkey = d.src_game JOIN supplier s ON s.s_suppkey = l.l_suppkey""",
        "n_players": f"""SELECT CAST(row_number() OVER (ORDER BY x.file_key, x.away, {_LINE_ORDER_X}) AS BIGINT) AS id,
  x.player_code, x.pname AS name
FROM (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY player_code
      ORDER BY file_key, away, {LINE_ORDER_SQL}) = 1) x""",
        "n_games": """SELECT CAST(row_number() OVER (ORDER BY d.file_key) AS BIGINT) AS id,
  th.id AS home_team_id, ta.id AS away_team_id, d.game_code, d.home_team_score, d.away_team_score,
  d.file_key, d.season
FROM docs d
JOIN teams t1 ON t1.id = d.h JOIN n_teams th ON th.name = t1.name
JOIN teams t2 ON t2.id = d.a JOIN n_teams ta ON ta.name = t2.name""",
        "n_box": f"""SELECT g.id * 4294967296 + p.id AS id,
  p.id AS player_id, g.id AS game_id,
  CASE WHEN NOT x.away THEN g.home_team_id ELSE g.away_team_id END AS team_id,
  NOT x.away AS played_for_home, x.l_linenumber <= 5 AS is_starter,
  CASE WHEN x.l_partkey % 37 = 0 THEN 0 ELSE CAST(x.l_quantity AS INTEGER) * 60 + x.l_linenumber END AS seconds,
  {_doc_stat_sql()},
  x.file_key, x.away, x.season
FROM (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY game_code, player_code
      ORDER BY away, {LINE_ORDER_SQL}) = 1) x
JOIN n_players p ON p.player_code = x.player_code JOIN n_games g ON g.game_code = x.game_code""",
    }


NORMALISE = normalise_ctes()
