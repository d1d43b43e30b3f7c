"""Game documents -> teams, players, games, boxscore_record.

The source processes one document at a time and one row per transaction; here
a whole set of documents is one DataFrame and every table is produced by set
operations.  Processing order (which fixes ids and "first write wins") is the
landing key order, then home before away, then roster position:

* teams    first seen by (file_key, side)       -- name kept as written
* players  first seen by (file_key, position)   -- code stripped, first name wins
* games    first seen by (file_key)             -- code = file stem + folder
* box rows first seen by (file_key, position) per (player_id, game_id)

Inputs the source would crash on (missing referees, minutes without ':',
null minutes, null codes or names) are routed to ``rejects`` with a reason, and
so is a player line with a statistic that is no number.  Whole numbers in any
spelling (7, 7.0, true, "7") are taken, fractions rounded as the database does;
a missing or null statistic counts as 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.scalar import (
    SECONDS_REASON, game_code_from_path, minutes_reject_reason, minutes_to_seconds, py_strip, variant_number, variant_truth, variant_wrong_number, whole_number)
from courtline.operators.key_index import KeyIndex
from courtline.operators.upsert import insert_if_absent
from courtline.session import materialize
from courtline.schemas import BOX_COLUMNS, BOX_STATS, DOCUMENT, INVALID_REFEREES, LINE, STAT_FIELD_TO_COLUMN


@dataclass
class Normalised:
    teams: DataFrame
    players: DataFrame
    games: DataFrame
    boxscore: DataFrame
    rejects: DataFrame
    # rows this load added to each table (equal to the tables without a target)
    new: dict[str, DataFrame] | None = None
    # of stored tables: where their natural keys are looked up, and the greatest id given so far
    index: KeyIndex | None = None
    max_ids: dict[str, int] | None = None


# Game and player ids side by side make a box row's id: one game's rows never wait for another's to be numbered.
PLAYER_SPAN = 1 << 32


def parse_documents(raw: DataFrame, body_col: str = "body", key_col: str = "file_key") -> DataFrame:
    """``(file_key, doc)`` with the JSON body parsed by the declared schema."""
    return raw.select(F.col(key_col).alias("file_key"), F.from_json(
        F.col(body_col), DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("doc"))


def is_invalid_game(doc: F.Column) -> F.Column:
    """Placeholder game: referees equal the sentinel exactly."""
    return doc["Referees"] == F.lit(INVALID_REFEREES)


def _malformed(doc: Column) -> tuple[Column, Column]:
    """Whether a document cannot be loaded, and the reason."""
    # A value of a wrong type must not pass for a missing one, which counts as 0.
    broken = doc.isNull() | doc["_corrupt_record"].isNotNull()
    few = F.coalesce(F.size(doc["Stats"]), F.lit(0)) < 2
    scores = [F.get(doc["Stats"], i)["totr"]["Points"] for i in (0, 1)]
    no_score = variant_wrong_number(scores[0], variant_number(scores[0])) | variant_wrong_number(scores[1], variant_number(scores[1]))
    reason = (F.when(broken, F.lit("unparsable document or field of a wrong type"))
              .when(doc["Referees"].isNull(), F.lit("missing Referees"))
              .when(few, F.lit("fewer than two team sides"))
              .otherwise(F.lit("a side's Points is no number")))
    return broken | doc["Referees"].isNull() | few | no_score, reason


def _loadable(doc: Column) -> Column:
    return ~_malformed(doc)[0] & ~is_invalid_game(doc)


def split_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid documents, rejects).  Placeholder games are dropped silently."""
    malformed, reason = _malformed(F.col("doc"))
    rejects = docs.filter(malformed).select("file_key", F.lit("document").alias("level"), reason.alias("reason"))
    valid = docs.filter(_loadable(F.col("doc")))
    return valid, rejects


def game_sides(valid: DataFrame) -> DataFrame:
    """One row per valid document with its game code, team names and scores."""
    return valid.select(*_side_columns(F.col("doc")))


def _side_columns(doc: Column) -> list[Column]:
    s0, s1 = F.get(doc["Stats"], F.lit(0)), F.get(doc["Stats"], F.lit(1))
    return [
        F.col("file_key"),
        game_code_from_path(F.col("file_key")).alias("game_code"),
        s0["tmr"]["Team"].alias("home_name"),
        s1["tmr"]["Team"].alias("away_name"),
        whole_number(variant_number(s0["totr"]["Points"])).alias("home_team_score"),
        whole_number(variant_number(s1["totr"]["Points"])).alias("away_team_score"),
    ]


def player_lines(docs: DataFrame, keep: Column | None = None) -> DataFrame:
    """One row per player line, of documents that ``keep`` holds for: home roster first, then away, with its position.

    ``line`` is the line read field by field, null where a roster's entry is no
    object, and ``raw`` the entry as it is in the document.
    """
    doc = F.col("doc")
    roster = _roster(doc)
    exploded = docs.select(*_side_columns(doc)[:4], F.posexplode(roster if keep is None else F.when(keep, roster)).alias("pos", "raw"))
    return exploded.select("file_key", "game_code", "home_name", "away_name", "pos",
                           F.try_variant_get("raw", "$", LINE).alias("line"), "raw")


def _roster(doc: Column) -> Column:
    sides = [F.get(doc["Stats"], F.lit(i))["PlayersStats"] for i in (0, 1)]
    return F.concat(*[F.coalesce(side, F.array()) for side in sides])


def line_fault(line: Column, raw: Column) -> Column:
    """The first statistic of a player line that is there and no number, as a reason; null where all can be stored."""
    # Most lines have all numbers; the document is asked again only for those that do not.  It is asked by one expression
    # over all fields: a branch for each makes code that the JVM does not compile, for every line.
    fields = F.map_entries(F.try_variant_get(raw, "$", "map<string, variant>"))
    wrong = F.transform(F.filter(fields, lambda f: variant_wrong_number(f["value"], variant_number(f["value"]))), lambda f: f["key"])
    first = F.get(F.array_intersect(F.array(*[F.lit(f) for f in STAT_FIELD_TO_COLUMN]), wrong), 0)
    sound = reduce(Column.__and__, [F.abs(line[f]) < 2147483647 for f in STAT_FIELD_TO_COLUMN])
    return F.when(line.isNull(), F.lit("player line is no object")).when(sound, F.lit(None)).otherwise(F.concat(first, F.lit(" is no number")))


def normalise(docs: DataFrame, target: Normalised | None = None) -> "Load":
    """Load parsed documents ``(file_key, doc)`` into the four tables.

    With ``target`` the rows are inserted into existing tables (insert-if-absent
    on each natural key, first write wins, new ids after the current maximum).
    Each table is built when it is first asked for, with what it needs.
    """
    return Load(docs, target)


class Load:
    """The tables of one load; see :class:`Normalised` for the attributes."""

    GAME = ["id", "home_team_id", "away_team_id", "game_code", "home_team_score", "away_team_score"]

    def __init__(self, docs: DataFrame, target: Normalised | None):
        self._target = target
        self._known: dict[str, DataFrame] = {}
        self._docs = docs

    @cached_property
    def _decoded(self) -> DataFrame:
        """All that a load needs of its documents, decoded once: a row per player line, and one without a line for a document without.

        Documents feed every insert, and the range sampling of id assignments.  Decoded
        fields take a small part of the room of the parsed documents, and a document
        is made, parsed and tested once for its tables and its rejects.
        """
        doc, line, raw = F.col("doc"), F.col("line"), F.col("raw")
        # No filter on the parsed documents: pushed below the parser it would parse each of them once for every
        # field that it tests.  What is not to be loaded has no lines and is left out of the copy's reading.
        malformed, why = _malformed(doc)
        docs = self._docs.select("file_key", "doc", F.when(malformed, why).alias("_fault"), _loadable(doc).alias("_loadable"))
        # What a document's lines share is computed before they are told apart: once a document, not once a line.  So are
        # the lines read: behind the generator all their fields would be one method, too long for the JVM to compile.
        entries = F.transform(_roster(doc), lambda x: F.struct(F.try_variant_get(x, "$", LINE).alias("line"), x.alias("raw")))
        docs = docs.select("file_key", "_fault", "_loadable", *_side_columns(doc)[1:], F.when(F.col("_loadable"), entries).alias("_entries"))
        rows = docs.select(*[c for c in docs.columns if c != "_entries"], F.posexplode_outer("_entries").alias("pos", "_entry")) \
            .select("*", "_entry.line", "_entry.raw")
        # Seconds out of range are null in the copy, which tells them from those that are accepted (:attr:`_lines`).
        reason = (F.when(line.isNotNull() & line["Player_ID"].isNull(), F.lit("Player_ID is null"))
                  .when(line.isNotNull() & line["Player"].isNull(), F.lit("Player is null"))
                  .otherwise(F.coalesce(line_fault(line, raw), minutes_reject_reason(line["Minutes"], F.lit(0)))))
        return materialize(rows.select(
            *[c for c in rows.columns if c not in ("_entry", "raw", "line")], py_strip(line["Player_ID"]).alias("player_code"),
            line["Player"].alias("player_name"), F.coalesce(py_strip(line["Team"]) == F.col("home_name"), F.lit(False)).alias("played_for_home"),
            variant_truth(F.try_variant_get(raw, "$.IsStarter", "variant")).alias("is_starter"), minutes_to_seconds(line["Minutes"]).alias("seconds"),
            *[F.coalesce(whole_number(line[field]), F.lit(0)).alias(col) for field, col in STAT_FIELD_TO_COLUMN.items()],
            reason.alias("_reason")))

    @cached_property
    def _sides(self) -> DataFrame:
        if "_decoded" not in self.__dict__:  # no lines were asked for
            doc = F.col("doc")
            return materialize(self._docs.select(*_side_columns(doc), _loadable(doc).alias("_loadable"))).filter("_loadable").drop("_loadable")
        first = self._decoded.filter(F.col("_loadable") & (F.coalesce("pos", F.lit(0)) == 0))
        return first.select("file_key", "game_code", "home_name", "away_name", "home_team_score", "away_team_score")

    @cached_property
    def _team_batch(self) -> DataFrame:
        sides = self._sides
        return sides.select("file_key", F.lit(0).alias("side"), F.col("home_name").alias("name")) \
            .unionByName(sides.select("file_key", F.lit(1).alias("side"), F.col("away_name").alias("name")))

    @cached_property
    def _lines(self) -> DataFrame:
        out_of_range = F.when(F.col("seconds").isNull(), F.lit(SECONDS_REASON))
        return self._decoded.filter(F.col("pos").isNotNull()).withColumn("_reason", F.coalesce("_reason", out_of_range))

    def _insert(self, name: str, batch: DataFrame, key: list[str], order: list[str], **options) -> tuple[DataFrame, DataFrame]:
        target = self._target
        if target is None:
            return insert_if_absent(None, batch, key, order, **options)
        if getattr(target, "index", None) is not None:
            # The batch is looked up, inserted and resolved: one copy of it keeps those plans short.
            batch = materialize(batch)
            table = "boxscore_record" if name == "boxscore" else name
            self._known[name] = target.index.lookup(table, batch)
            options |= {"known": self._known[name], "start": target.max_ids.get(table, 0) + 1}
        return insert_if_absent(getattr(target, name), batch, key, order, **options)

    def _resolved(self, name: str, inserted: tuple[DataFrame, DataFrame], key: str) -> DataFrame:
        """(id, key) for this load's keys at least: from the index and the new rows where there is an index."""
        known = self._known.get(name)
        if known is None:
            return inserted[1].select("id", key)
        return known.select("id", key).unionByName(inserted[0].select("id", key))

    @cached_property
    def _teams(self) -> tuple[DataFrame, DataFrame]:
        return self._insert("teams", self._team_batch.filter(F.col("name").isNotNull()), ["name"], ["file_key", "side"])

    @cached_property
    def _players(self) -> tuple[DataFrame, DataFrame]:
        # Players are loaded before any stat row (as by the source), so a line whose
        # minutes cannot be stored still registers its player.
        batch = self._lines.filter(F.col("player_code").isNotNull() & F.col("player_name").isNotNull()) \
            .select("file_key", "pos", "player_code", F.col("player_name").alias("name"))
        return self._insert("players", batch, ["player_code"], ["file_key", "pos"])

    def _with_team_ids(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the ids of the two teams that the document itself names."""
        teams = self._resolved("teams", self._teams, "name")
        home = teams.select(F.col("id").alias("home_team_id"), F.col("name").alias("home_name"))
        away = teams.select(F.col("id").alias("away_team_id"), F.col("name").alias("away_name"))
        return rows.join(home, "home_name", "inner").join(away, "away_name", "inner")

    @cached_property
    def _games(self) -> tuple[DataFrame, DataFrame]:
        batch = self._with_team_ids(self._sides).select("file_key", *self.GAME[1:])
        return self._insert("games", batch, ["game_code"], ["file_key"])

    @cached_property
    def _boxscore(self) -> tuple[DataFrame, DataFrame]:
        lines = self._lines  # decoded first: the games are read from the same copy
        # Ids are resolved by natural key (no positional pairing).
        g = self._resolved("games", self._games, "game_code").withColumnRenamed("id", "game_id")
        p = self._resolved("players", self._players, "player_code").withColumnRenamed("id", "player_id")
        good = self._with_team_ids(lines.filter(F.col("_reason").isNull()))
        batch = good.join(g, "game_code", "inner").join(p, "player_code", "inner").select(
            "file_key", "pos", "player_id", "game_id",
            F.when(F.col("played_for_home"), F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"),
            "played_for_home", "is_starter", "seconds", *BOX_STATS)
        return self._insert("boxscore", batch, ["player_id", "game_id"], ["file_key", "pos"],
                            id_expr=F.col("game_id") * PLAYER_SPAN + F.col("player_id"))

    @cached_property
    def teams(self) -> DataFrame:
        return self._teams[1].select("id", "name")

    @cached_property
    def players(self) -> DataFrame:
        return self._players[1].select("id", "player_code", "name")

    @cached_property
    def games(self) -> DataFrame:
        return self._games[1].select(*self.GAME)

    @cached_property
    def boxscore(self) -> DataFrame:
        return self._boxscore[1].select(*BOX_COLUMNS)

    @cached_property
    def rejects(self) -> DataFrame:
        documents = self._decoded.filter(F.col("_fault").isNotNull()).select(
            "file_key", F.lit("document").alias("level"), F.col("_fault").alias("reason"))
        teams = self._team_batch.filter(F.col("name").isNull()).select(
            "file_key", F.lit("team").alias("level"), F.lit("team name is null").alias("reason"))
        lines = self._lines.filter(F.col("_reason").isNotNull()).select(
            "file_key", F.lit("player line").alias("level"), F.col("_reason").alias("reason"))
        return documents.unionByName(teams).unionByName(lines)

    @cached_property
    def new(self) -> dict[str, DataFrame]:
        self._decoded  # before the sides, which are then read from it
        return {"teams": self._teams[0].select("id", "name"),
                "players": self._players[0].select("id", "player_code", "name"),
                "games": self._games[0].select(*self.GAME),
                "boxscore_record": self._boxscore[0].select(*BOX_COLUMNS)}


def first_seen_players(docs: DataFrame) -> DataFrame:
    """Player code with the first name seen for it and where it was first seen."""
    lines = player_lines(docs, keep=_loadable(F.col("doc"))).select("file_key", "pos", py_strip(F.col("line.Player_ID")).alias("player_code"),
                                       F.col("line.Player").alias("name"))
    packed = lines.filter(F.col("player_code").isNotNull()).groupBy("player_code").agg(
        F.min(F.struct("file_key", "pos", "name")).alias("f"))
    return packed.select("player_code", F.col("f.name").alias("name"), F.col("f.file_key").alias("first_file_key"))
