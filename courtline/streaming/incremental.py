"""Incremental loading: high-water marks, fetch bookkeeping and the file stream.

The source keeps its marks in small YAML objects and walks file listings in
Python.  Here marks are a state table ``(stage, season, last_id)``, listings
are DataFrames of landing keys, and the incremental transform is a Structured
Streaming query over the landing directory whose checkpoint records which
files were processed.  Each micro-batch runs the same batch functions
(:func:`courtline.plans.normalise.normalise`) and inserts with first write
wins, so a replayed batch adds nothing.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.scalar import path_file_number, path_season
from courtline.operators.audit import delete_restrict, lookup_by_id, taken_keys, violation, with_orphans
from courtline.operators.key_index import KeyIndex
from courtline.plans.normalise import Normalised, normalise
from courtline.schemas import BOXSCORE, FOREIGN_KEYS, GAMES, LANDING_PREFIX, NATURAL_KEYS, PLAYERS, TEAMS
from courtline.session import materialize, scratch_path

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results:
# request address and failure messages of the fetch step.
# ---------------------------------------------------------------------------
REQUEST_FORMAT = "{base}?gamecode={game_id}&seasoncode={season}"
JSON_ERROR_PREFIX = "JSON decode error: "
STATUS_ERROR_FORMAT = "Failed to fetch data for season: {season} game ID: {game_id} - Status: {status}"
SAVE_ERROR_FORMAT = "Failed to save JSON for season: {season} game ID: {game_id}"
# ---------------------------------------------------------------------------
DEFAULT_BASE_URL = "boxscore"


# ------------------------------------------------------------ landing keys

def max_file_number(parsed: DataFrame) -> DataFrame:
    """Largest file number per season; names that are not integers are skipped and counted."""
    return parsed.groupBy("season_code").agg(
        F.max("file_number").alias("max_file_number"),
        F.count_if(F.col("file_number").isNull()).cast("long").alias("rejected_names"),
    )


def above_marks(parsed: DataFrame, marks: DataFrame) -> DataFrame:
    """Keys whose number is strictly above their season's mark (numeric, not lexical).

    A season without a mark has nothing processed yet: its mark counts as 0.
    ``marks`` is one row per season, and the join lets AQE broadcast it at run
    time.
    """
    m = marks.select(F.col("season_code").alias("_season"), F.col("last_id").alias("_mark"))
    j = parsed.join(m, parsed.season_code == m._season, "left")
    return j.filter(F.col("file_number") > F.coalesce(F.col("_mark"), F.lit(0))).drop("_season", "_mark")


# ------------------------------------------------------------ fetch bookkeeping

def fetch_plan(spec: DataFrame, base_url: str = DEFAULT_BASE_URL, chunk: int = 100_000) -> DataFrame:
    """Every (season, id) of a backfill spec ``(season_code, max_game_id)`` with its address and key.

    The range is expanded in two levels -- first into chunks of ``chunk``
    ids, which are hash-distributed, then each chunk into its ids -- so a
    season with a huge range is generated by many tasks, not by the one task
    holding its spec row.  ``sequence(1, 0)`` would count down, so a spec with
    ``max_game_id < 1`` yields nothing.
    """
    top = F.col("max_game_id").cast("long")
    n_chunks = F.when(top >= 1, F.floor((top - 1) / chunk) + 1).otherwise(F.lit(0)).cast("long")
    chunks = spec.select("season_code", top.alias("_top"),
                         F.explode(F.when(n_chunks >= 1, F.sequence(F.lit(0).cast("long"), n_chunks - 1))
                                   .otherwise(F.array().cast("array<bigint>"))).alias("_chunk"))
    chunks = chunks.repartition("season_code", "_chunk")
    lo = F.col("_chunk") * chunk + 1
    hi = F.least(F.col("_top"), (F.col("_chunk") + 1) * chunk)
    rows = chunks.select("season_code", F.explode(F.sequence(lo, hi)).alias("game_id"))
    url = F.format_string(REQUEST_FORMAT.replace("{base}", "%s").replace("{game_id}", "%d")
                          .replace("{season}", "%s"), F.lit(base_url), F.col("game_id"), F.col("season_code"))
    key = F.concat_ws("/", F.lit(LANDING_PREFIX), F.col("season_code"),
                      F.concat(F.col("game_id").cast("string"), F.lit(".json")))
    return rows.select("season_code", "game_id", url.alias("url"), key.alias("landing_key"))


def classify_fetch(responses: DataFrame) -> DataFrame:
    """Responses ``(id, season, status, body)`` -> ``(season, id, success, error)``.

    Two more columns are read where there are any: ``transport_error``, the
    text of a request that got no response, and ``saved``, false where the
    document could not be stored.
    """
    has = lambda c, kind: F.col(c) if c in responses.columns else F.lit(None).cast(kind)
    broken, saved = has("transport_error", "string"), F.coalesce(has("saved", "boolean"), F.lit(True))
    fetched = broken.isNull() & F.coalesce(F.col("status") == 200, F.lit(False))
    parsed_ok = F.try_parse_json(F.col("body")).isNotNull()

    def text(form: str) -> Column:
        names = re.findall(r"\{(\w+)\}", form)
        kinds = {"season": ("%s", "season"), "game_id": ("%d", "id"), "status": ("%d", "status")}
        return F.format_string(re.sub(r"\{(\w+)\}", lambda m: kinds[m[1]][0], form), *[F.col(kinds[n][1]) for n in names])

    err = (F.when(broken.isNotNull(), broken)
           .when(~fetched, text(STATUS_ERROR_FORMAT))
           .when(~parsed_ok, F.lit(JSON_ERROR_PREFIX + "invalid JSON"))
           .when(~saved, text(SAVE_ERROR_FORMAT)))
    return responses.select("season", "id", (fetched & parsed_ok & saved).alias("success"), err.alias("error"))


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("season", "success").agg(F.count(F.lit(1)).alias("attempts"))


def success_prefix(outcomes: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Per season, the attempts from the mark upward that precede the first failure.

    The first failing id per season is a grouped ``min`` (partial aggregation,
    no ordered window); rows are kept when below it.  ``marks`` (season,
    last_id) restricts each season to ids >= its mark.
    """
    rows = outcomes
    if marks is not None:
        m = marks.select(F.col("season").alias("_ms"), F.col("last_id").alias("_mark"))
        rows = rows.join(m, rows.season == m._ms, "left") \
            .filter(F.col("_mark").isNull() | (F.col("id") >= F.col("_mark"))).drop("_ms", "_mark")
    first_fail = rows.groupBy("season").agg(F.min(F.when(~F.col("success"), F.col("id"))).alias("_fail"))
    f = first_fail.select(F.col("season").alias("_fs"), "_fail")
    j = rows.join(f, rows.season == f._fs, "inner")
    return j.filter(F.col("_fail").isNull() | (F.col("id") < F.col("_fail"))).drop("_fs", "_fail")


def advance_marks(old: DataFrame, kept: DataFrame, stage: str, as_written: bool = False) -> DataFrame:
    """New mark per season = last kept id; never lowered unless ``as_written``.

    The source refetches the last id and, when that fails, lowers the mark by
    one; ``as_written=True`` reproduces that (a season with no kept id gets
    ``old - 1``).
    """
    last = kept.groupBy("season").agg(F.max("id").alias("_new"))
    o = old.filter(F.col("stage") == stage).select("season", F.col("last_id").alias("_old"))
    j = o.join(last, "season", "full_outer")
    if as_written:
        new = F.coalesce(F.col("_new"), F.col("_old") - 1)
    else:
        new = F.greatest(F.col("_old"), F.col("_new"))
    return j.select(F.lit(stage).alias("stage"), "season", new.cast("long").alias("last_id"))


def transform_marks(old: DataFrame, batch_keys: DataFrame, stage: str = "transform") -> DataFrame:
    """New transform mark per season from the keys *processed in this batch*.

    The mark is the largest numeric file number of the batch (non-numeric
    names are skipped); it is never lowered by a batch of late files, and a
    season with no file in the batch keeps it.  ``batch_keys`` is
    ``(season_code, file_number)``.
    """
    latest = max_file_number(batch_keys).filter(F.col("max_file_number").isNotNull()).select(
        F.lit(stage).alias("stage"), F.col("season_code").alias("season"),
        F.col("max_file_number").alias("last_id"))
    return raised_marks(old, latest)


def _both_marks(old: DataFrame, updates: DataFrame) -> DataFrame:
    u = updates.select("stage", "season", F.col("last_id").alias("_new"))
    o = old.select("stage", "season", F.col("last_id").alias("_old"))
    return o.join(u, ["stage", "season"], "full_outer")


def merge_marks(old: DataFrame, updates: DataFrame) -> DataFrame:
    """Keep every value not passed: ``coalesce(new, old)`` over a full outer join on (stage, season)."""
    return _both_marks(old, updates).select(
        "stage", "season", F.coalesce(F.col("_new"), F.col("_old")).cast("long").alias("last_id"))


def raised_marks(old: DataFrame, updates: DataFrame) -> DataFrame:
    """The larger of both marks per (stage, season)."""
    return _both_marks(old, updates).select(
        "stage", "season", F.greatest(F.col("_new"), F.col("_old")).cast("long").alias("last_id"))


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if there is no such path, and only then."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class MarkStore:
    """State table ``(stage, season, last_id)`` in versions: every change is a new version, the last one counts."""

    SCHEMA = "stage string, season string, last_id long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _version(self) -> int:
        done = read_if_present(self.spark, f"{self.root}/_versions", "version long")
        return 0 if done is None else done.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        """The current marks; no rows before the first write."""
        v = self._version()
        if not v:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.root}/version={v}")

    def advance(self, updates: DataFrame) -> int:
        """Raise marks to those of ``updates``, never lowering one; the version counts once its number is written."""
        v = self._version() + 1
        raised_marks(self.read(), updates).write.mode("overwrite").parquet(f"{self.root}/version={v}")
        self.spark.createDataFrame([(v,)], "version long").write.mode("append").parquet(f"{self.root}/_versions")
        return v


# ------------------------------------------------------------ versioned tables

TABLES = ("teams", "players", "games", "boxscore_record", "rejects")
# Parents before children.
SCHEMAS = {"teams": TEAMS, "players": PLAYERS, "games": GAMES, "boxscore_record": BOXSCORE}
COMMITS = "version long, query_id string, batch_id long, delta string, max_ids map<string,bigint>"


class TableStore:
    """The four tables and the rejects as append-only Parquet deltas plus a commit log.

    Each batch writes only the rows it added, under ``<root>/<table>/delta=<n>/``,
    sorted by id with Bloom filters on it, and their natural keys in hash buckets
    (:class:`courtline.operators.key_index.KeyIndex`), and then appends its
    commit row, which also states the greatest id of each table.  A reader takes
    the union of the deltas that are committed, so a batch that failed half way is
    invisible and its retry simply overwrites its own directories.  Inserts ask
    the index for the buckets that a batch's keys fall in, so the work of a batch
    follows the batch.  A batch is known by its query and its number within that
    query: a query that starts over has batches of its own.

    Deleted ids are tombstones under the same log: a row goes where a later
    version names its id.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def committed_batches(self) -> DataFrame | None:
        """The commit log; None before the first commit.  A log that cannot be read is an error."""
        return read_if_present(self.spark, f"{self.root}/_commits", COMMITS)

    def latest(self) -> int | None:
        done = self.committed_batches()
        return None if done is None else done.agg(F.max("version")).first()[0]

    def holds(self, batch_id: int, query_id: str) -> bool:
        done = self.committed_batches()
        return done is not None and not done.filter(
            (F.col("batch_id") == batch_id) & (F.col("query_id") == query_id)).isEmpty()

    def _kept(self, done: DataFrame) -> DataFrame:
        return done.groupBy("delta").agg(F.max("version").alias("version"))

    def _deleted(self, done: DataFrame) -> dict[str, DataFrame]:
        """Tombstones (id, version) of the tables that have any."""
        out = {}
        for name in NATURAL_KEYS:
            gone = read_if_present(self.spark, f"{self.root}/_deleted/{name}", "id long, outcome string, delta string")
            if gone is not None:
                out[name] = gone.filter("outcome = 'deleted'").join(self._kept(done), "delta").groupBy(F.col("id").alias("_gone_id")).agg(F.max("version").alias("_gone_version"))
        return out

    def table(self, name: str) -> DataFrame | None:
        """One table's committed rows that no later deletion names; None before the first commit."""
        done = self.committed_batches()
        return None if done is None else self._table(name, done, self._deleted(done))

    def _table(self, name: str, done: DataFrame, deleted: dict[str, DataFrame]) -> DataFrame:
        rows = self.spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}") \
            .withColumn("delta", F.col("delta").cast("string"))
        if name not in deleted:
            return rows.join(self._kept(done), "delta", "left_semi").drop("delta")
        gone = deleted[name]
        return rows.join(self._kept(done), "delta").join(
            gone, (F.col("id") == gone._gone_id) & (F.col("version") < gone._gone_version), "left_anti").drop("delta", "version")

    def read(self) -> Normalised | None:
        done = self.committed_batches()
        if done is None:
            return None
        deleted = self._deleted(done)
        t = {name: self._table(name, done, deleted) for name in TABLES}
        most = done.select(F.explode("max_ids").alias("t", "m")).groupBy("t").agg(F.max("m")).collect()  # one row a table
        index = KeyIndex(self.spark, f"{self.root}/_keys", NATURAL_KEYS)
        index.kept, index.deleted = self._kept(done), deleted
        return Normalised(t["teams"], t["players"], t["games"], t["boxscore_record"], t["rejects"], index=index,
                          max_ids={name: m or 0 for name, m in most})

    def lookup(self, name: str, ids: DataFrame) -> DataFrame:
        """Every requested id of a table with its row, nulls where there is none."""
        return lookup_by_id(self.table(name), ids)

    def get(self, name: str, id_: int) -> DataFrame:
        """The row of one id, at most one; the id reaches the files' statistics, page indexes and Bloom filters."""
        return self.table(name).filter(F.col("id") == F.lit(id_)).limit(1)

    def _commit_log(self, query_id: str, batch_id: int, delta: str, max_ids: dict[str, int]) -> int:
        v = (self.latest() or 0) + 1
        self.spark.createDataFrame([(v, query_id, int(batch_id), delta, max_ids)], COMMITS) \
            .coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return v

    def commit(self, tables: Normalised, batch_id: int, query_id: str) -> int:
        deltas = tables.new or {"teams": tables.teams, "players": tables.players, "games": tables.games,
                                "boxscore_record": tables.boxscore}
        deltas = {**deltas, "rejects": tables.rejects}
        delta = f"b{int(batch_id)}-{hashlib.sha256(query_id.encode()).hexdigest()[:16]}"
        index, max_ids = KeyIndex(self.spark, f"{self.root}/_keys", NATURAL_KEYS), {}
        for name in TABLES:
            path, rows = f"{self.root}/{name}/delta={delta}", deltas[name]
            if name == "rejects":
                rows.write.mode("overwrite").parquet(path)
                continue
            seen = Observation()
            rows.observe(seen, F.max("id").alias("m")).sortWithinPartitions("id").write.mode("overwrite") \
                .option("parquet.bloom.filter.enabled#id", "true").parquet(path)
            if seen.get["m"] is not None:
                max_ids[name] = seen.get["m"]
            index.write(name, self.spark.read.schema(rows.schema).parquet(path), delta)
        return self._commit_log(query_id, batch_id, delta, max_ids)

    def delete(self, name: str, ids: DataFrame) -> DataFrame:
        """Delete rows of a table by id where no row of another table refers to them; (table_name, id, outcome) per requested id.

        Outcomes are ``deleted``, ``refused`` (a child refers to it) and ``absent``.
        They are written first, once: those that say ``deleted`` are the tombstones.
        They count with the commit, so a deletion that fails half way deletes nothing.
        """
        children = [(self.table(child), column) for child, column, parent in FOREIGN_KEYS if parent == name]
        outcomes, _ = delete_restrict(self.table(name), ids, children, name)
        delta = f"d{uuid.uuid4().hex}"
        path = f"{self.root}/_deleted/{name}/delta={delta}"
        outcomes.write.parquet(path)
        done = self.spark.read.schema(outcomes.schema).parquet(path)
        self._commit_log(f"delete {name}", 0, delta, {})
        return done


class ConstraintError(ValueError):
    """Too large a share of a load's rows breaks a constraint; nothing of the load was committed."""


def load_tables(store: TableStore, tables: dict[str, DataFrame], batch_id: int, query_id: str = "", most_rejected: float = 0.1) -> dict[str, dict[str, int]]:
    """Commit rows of the four tables that keep their constraints, store the others as rejects; counts per table and reason.

    Not-null columns, unique keys and ids, against stored rows too, and foreign
    keys, against stored and accepted parents, are tested in the order of the
    foreign keys, so a rejected parent takes its children along.  The rows are
    written once, with the missing parents; their keys are tested alone, so whole
    rows are shuffled for neither, save for keys where too many to broadcast are
    taken.  If the violations are more than ``most_rejected`` of a table's rows,
    the load is refused.
    """
    stored = store.read()
    counts, accepted, rejects = {}, {}, None
    for name, schema in SCHEMAS.items():
        columns = [f.name for f in schema.fields]
        old = None if stored is None else getattr(stored, "boxscore" if name == "boxscore_record" else name)
        parents = {}
        for child, column, parent in FOREIGN_KEYS:
            if child == name:
                ids = accepted[parent].select("id")
                parents[column] = ids if stored is None else ids.unionByName(getattr(stored, parent).select("id"))
        rows = materialize(with_orphans(tables[name].select(*columns), parents).withColumn("_row", F.monotonically_increasing_id()))
        keys = [NATURAL_KEYS[name], ["id"]]
        taken = materialize(taken_keys(rows, keys, None if old is None else {tuple(k): old.select(*k) for k in keys}))
        required = [f.name for f in schema.fields if not f.nullable]
        tested = rows.join(taken, "_row", "left").withColumn("violation", violation(required, keys))
        n, bad = tested.agg(F.count(F.lit(1)), F.count("violation")).first()
        if bad > most_rejected * n:
            raise ConstraintError(f"{bad} of {n} rows of {name} break a constraint")
        accepted[name] = rows.dropna(subset=required).filter("_orphan IS NULL").join(taken, "_row", "left_anti").select(*columns)
        turned_away = tested.filter("violation IS NOT NULL").select(
            F.concat(F.lit(f"{name}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))).alias("file_key"),
            F.lit("row").alias("level"), F.col("violation").alias("reason"))
        rejects = turned_away if rejects is None else rejects.unionByName(turned_away)
        counts[name] = {"rows": n, "rejected": bad}
    store.commit(Normalised(accepted["teams"], accepted["players"], accepted["games"], accepted["boxscore_record"], rejects), batch_id, query_id)
    return counts


def load_batch(store: TableStore, docs: DataFrame, batch_id: int, query_id: str = "") -> bool:
    """Insert one batch of parsed documents; a batch of that query already committed is skipped (False)."""
    if store.holds(batch_id, query_id):
        return False
    store.commit(normalise(docs, target=store.read()), batch_id, query_id)
    return True


def run_incremental(spark: SparkSession, landing: str, store_root: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, layout: str = "partitioned") -> TableStore:
    """Process every landing file not yet seen, in micro-batches, then stop.

    The query is known by the id that its checkpoint holds.  After a batch is
    committed the transform marks in ``<store_root>/_marks`` advance to its files.
    """
    from courtline.sources.landing import read_landing_stream

    store, marks = TableStore(spark, store_root), MarkStore(spark, f"{store_root.rstrip('/')}/_marks")
    stream = read_landing_stream(spark, landing, max_files_per_trigger, layout)

    def batch(df: DataFrame, number: int) -> None:
        query = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
        load_batch(store, df, number, query)
        keys = df.select(path_season(F.col("file_key")).alias("season_code"), path_file_number(F.col("file_key")).alias("file_number"))
        marks.advance(transform_marks(marks.read(), keys))

    q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return store


def fresh_area(spark: SparkSession, name: str) -> str:
    """A new directory below the shared scratch root."""
    return scratch_path(spark, name, unique=True)
