"""What is shuffled and stored: the plans and files that keep a load's disk near its input."""

from courtline.plans import features as FE
from courtline.plans import prepare as PR
from courtline.session import local_path, materialize
from tests.test_features import _box, _games


def _plan(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def _tables(spark):
    games = _games(spark, [(10, 1, 2, "1E2001", 80, 70), (20, 1, 3, "1U2001", 50, 70), (11, 2, 1, "2E2001", 90, 60),
                           (12, 4, 4, "3E2001", 75, 75), (13, 2, 1, "4E2001", 60, 99), (14, 1, 2, "1E2002", 60, 99)])
    box = _box(spark, [(i, p, g, t, True, 100 * i, i if i % 3 else None, i) for i, (p, g, t) in enumerate(
        (p, g, t) for p in (7, 8) for g in (10, 20, 11, 12, 13, 14) for t in (1, 2, 9))])
    return games, box


def test_ratios_picked_before_the_frames_equal_the_join_after_them(spark):
    games, box = _tables(spark)
    # a player comes once a game, so that the frames have one order
    box = box.dropDuplicates(["player_id", "game_id"]).unionByName(box.filter("player_id = 7 AND team_id = 9").selectExpr(
        *["player_id + 10 AS player_id" if c == "player_id" else c for c in box.columns])).localCheckpoint()
    got = sorted(map(str, FE.training_features(games, box).collect()))
    assert got == sorted(map(str, FE.training_features(games, box, skew_safe=False).collect()))
    assert len(got) > box.count()  # colliding codes fan out


def test_rows_with_means_are_not_shuffled(spark):
    games, box = _tables(spark)
    plan = _plan(PR.preprocess(FE.training_features(games, box)))
    frames = next(i for i, line in enumerate(plan) if "Window [avg(valuation" in line or "Window [avg(seconds" in line)
    assert not [line for line in plan[:frames] if "Exchange" in line]


def test_copies_are_compressed_and_keep_rows_and_types(spark):
    df = spark.range(200_000).selectExpr("id % 7 AS a", "'some text that repeats' AS b", "array(named_struct('x', 1, 'y', id % 3)) AS c",
                                         "parse_json('{\"k\": 1}') AS v", "CAST(NULL AS DOUBLE) AS n")
    copy = materialize(df)
    assert copy.dtypes == df.dtypes and copy.count() == 200_000
    assert copy.selectExpr("sum(a)", "sum(variant_get(v, '$.k', 'int'))").first() == df.selectExpr("sum(a)", "sum(variant_get(v, '$.k', 'int'))").first()
    import os
    size = sum(os.path.getsize(local_path(f)) for f in copy.inputFiles())
    assert size < 200_000 * 10
    assert materialize(df.filter("a < 0")).count() == 0


def test_frames_across_cuts_of_hot_and_null_groups(spark):
    import random
    from courtline.operators.rolling import shifted_frame_features, with_trailing_features
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "hot", "hot", "hot", "x"]), rnd.choice([None, 1]), i, rnd.choice([None, 1, 2, 7])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, h int, o int, v int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "80")  # blocks of fewer rows than a frame
    try:
        a = shifted_frame_features(df, ["v"], ["g", "h"], ["o"], lead_col="v", lead_alias="nv", hot_rows=100)
        b = with_trailing_features(df, ["v"], ["g", "h"], ["o"], lead_col="v", lead_alias="nv")
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
        plan = "\n".join(_plan(a))
        assert "explode" not in plan and "sum(" not in plan  # every row moves once, not once for each frame it is in
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_document_is_parsed_once(spark):
    from courtline.plans import normalise as NO
    raw = spark.createDataFrame([("a/E2001/1.json", "{}")], "file_key string, body string")
    lines = NO.player_lines(NO.parse_documents(raw), keep=NO._loadable(NO.F.col("doc")))
    optimized = lines._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json") + optimized.count("JsonToStructsEvaluator") == 1, optimized


def test_landing_and_csv_are_compressed(spark, tmp_area):
    import glob
    from pyspark.sql import functions as F
    from courtline.sources import landing as LA
    from tests.test_normalise import _docs, _fixture
    rows = _docs(spark, _fixture()).select(F.regexp_extract("file_key", r"([^/]+)/[^/]+$", 1).alias("season_code"),
                                           F.regexp_extract("file_key", r"([^/]+)\.json$", 1).alias("game_number"), "doc")
    path = LA.write_landing(rows, f"{tmp_area}/landing")
    files = glob.glob(f"{local_path(path)}/*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert LA.read_landing(spark, path).count() == len(_fixture())
    assert LA.listing(spark, path).count() == len(files)
    csv = PR.write_csv(spark.range(5).toDF("a"), f"{tmp_area}/csv")
    assert glob.glob(f"{local_path(csv)}/part-*.csv.gz") and PR.read_csv(spark, csv, spark.range(5).toDF("a").schema).count() == 5


def test_minutes_beyond_a_double_are_rejected_whatever_the_seconds(spark):
    from pyspark.sql import functions as F
    from courtline.functions import scalar as SC
    df = spark.createDataFrame([("1e400:",), ("1e400:x",), ("5:x",)], "m string")
    assert [r[0] for r in df.select(SC.minutes_to_seconds(F.col("m"))).collect()] == [None, None, 0]


def test_constraints_are_tested_without_shuffling_whole_rows(spark):
    import random
    from courtline.operators.audit import taken_keys, violation, with_orphans
    rnd = random.Random(5)
    pick = lambda *v: rnd.choice([None, *v])
    rows = [(pick(*range(90)), pick(1, 2, 3), pick(*range(30)), pick("x", "y")) for _ in range(150)]
    parents, stored = {"a": [1, 2, None], "b": list(range(25))}, [(3, 7), (1, 1), (None, 2)]
    ids = {c: spark.createDataFrame([(v,) for v in values], "id long") for c, values in parents.items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, "id long, a long, b long, name string").repartition("b")
        plan = _plan(with_orphans(df, {"b": ids["b"]}))
        assert len([x for x in plan if "Exchange" in x]) == 2, plan  # the rows by b, as they come, and the parents
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    copy = materialize(with_orphans(df, ids).selectExpr("*", "monotonically_increasing_id() AS _row"))
    keys = [["a", "b"], ["id"]]
    taken = materialize(taken_keys(copy, keys, {("a", "b"): spark.createDataFrame(stored, "a long, b long")}))
    plan = _plan(copy.join(taken, "_row", "left_anti"))
    assert [x for x in plan if "BroadcastExchange" in x] and not [x for x in plan if " Exchange" in x], plan
    got = {r["_row"]: r for r in copy.join(taken, "_row", "left").withColumn("v", violation(["name"], keys)).collect()}
    every = [got[r] for r in sorted(got)]
    assert len(every) == 150 and {r["v"] for r in every} >= {None, "name is null", "a,b is taken", "id is taken", "a has no parent", "b has no parent"}

    def first(r, key):
        same = [x for x in every if all(x[k] == r[k] for k in key)]
        return min(same, key=lambda x: (x["id"] is not None, x["id"] or 0, x["_row"]))["_row"] == r["_row"]

    for r in every:
        want = None
        if r["name"] is None:
            want = "name is null"
        elif None not in (r["a"], r["b"]) and ((r["a"], r["b"]) in stored or not first(r, ["a", "b"])):
            want = "a,b is taken"
        elif r["id"] is not None and not first(r, ["id"]):
            want = "id is taken"
        elif r["a"] is not None and r["a"] not in parents["a"]:
            want = "a has no parent"
        elif r["b"] is not None and r["b"] not in parents["b"]:
            want = "b has no parent"
        assert r["v"] == want, r


def test_a_deletion_shuffles_each_reference_once_and_writes_its_outcomes_once(spark, tmp_area):
    import os
    from courtline.operators.audit import delete_restrict
    from courtline.plans.normalise import Normalised
    from courtline.streaming.incremental import TableStore
    games, box = _tables(spark)
    ids = spark.createDataFrame([(10,), (99,)], "id long")
    outcomes, _ = delete_restrict(games, ids, [(box, "game_id")], "games")
    assert [x for x in _plan(outcomes) if "HashAggregate(keys=[_cid" in x]
    assert {r.id: r.outcome for r in outcomes.collect()} == {10: "refused", 99: "absent"}
    store = TableStore(spark, tmp_area)
    none = spark.createDataFrame([], "file_key string, level string, reason string")
    store.commit(Normalised(spark.createDataFrame([(1, "a")], "id long, name string"), spark.createDataFrame([], "id long, player_code string, name string"),
                            games, box.filter("game_id <> 10"), none), 0, "")
    asked = store.table("games").select("id")
    store.delete("games", ids)
    assert sorted(os.listdir(local_path(tmp_area))) == ["_commits", "_deleted", "_keys", "boxscore_record", "games", "players", "rejects", "teams"]
    # outcomes without a commit count for nothing, refused and absent ids are no tombstones
    spark.createDataFrame([("games", 11, "deleted")], "table_name string, id long, outcome string").write.parquet(f"{tmp_area}/_deleted/games/delta=dlost")
    assert store.delete("games", ids.selectExpr("id + 1 AS id")).collect()[0].outcome != "deleted"
    assert sorted(r.id for r in store.table("games").collect()) == [11, 12, 13, 14, 20]
    assert sorted(r.id for r in asked.collect()) == [10, 11, 12, 13, 14, 20]  # a table read before a deletion stays as it was


def test_sorted_sink_runs_the_frames_once_and_keeps_every_row_in_order(spark, tmp_area):
    from pyspark.sql import functions as F
    games, box = _tables(spark)
    features = FE.training_features(games, box)
    path = f"{tmp_area}/sorted"
    ordered = FE.sorted_features(features, box.select("game_id", "player_id"))
    plan = "\n".join(_plan(ordered))
    # a range partitioning would run all that is below it for its sample
    assert "Exchange rangepartitioning" not in plan and plan.count("Window [avg(valuation") == 1
    ordered.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    got = [tuple(r)[:-1] for r in spark.read.parquet(path).orderBy("_part", "game_id", "player_id").collect()]
    assert sorted(map(str, got)) == sorted(map(str, map(tuple, features.collect())))


def test_parts_follow_the_order_whatever_the_keys(spark):
    import random
    rnd = random.Random(7)
    big = 1 << 60
    keys = [(5, rnd.randint(0, 40)) for _ in range(300)] + [(rnd.choice([None, -3, 9, big, big + 1, big + 2]), rnd.choice([None, 1, 2])) for _ in range(200)] \
        + [(i, 1) for i in range(20, 220)] + [(7, 3)] * 150 + [(8, None)] * 80
    df = spark.createDataFrame(keys, "game_id long, player_id long")
    nulls_first = lambda k: [(v is not None, v or 0) for v in k]
    want = sorted(keys, key=nulls_first)
    for rows in (None, df.limit(0), df, df.filter("game_id = 5"), df.filter("game_id IS NULL OR player_id IS NULL"), df.filter("game_id > 100")):
        parts, part = FE.range_parts(df if rows is None else rows, "game_id", "player_id", part_rows=40, few_rows=20)
        placed = part(df, "p").collect()
        assert all(0 <= r.p < parts for r in placed)
        # every part is one stretch of the order
        assert [(r.game_id, r.player_id) for r in sorted(placed, key=lambda r: (r.p, nulls_first(r[:2])))] == want
        if rows is df:
            sizes = [sum(r.p == i for r in placed) for i in range(parts)]
            # what has one key cannot be cut; the players of a game that fills parts are
            assert sum(s > 160 for s in sizes) == 0 and len({r.p for r in placed if r.game_id == 5}) > 4
    got = FE.sorted_features(df, df).select("game_id", "player_id", FE.F.spark_partition_id().alias("p")).collect()
    assert [tuple(r[:2]) for r in sorted(got, key=lambda r: (r.p, nulls_first(r[:2])))] == want


def test_only_documents_that_nothing_else_tells_apart_are_written_out(spark):
    from courtline.sources import landing as LA

    rows = [("E1", "1", "a", 1), ("E1", "1", "b", 2), ("E1", "1", "c", 2), ("E1", "2", "d", 1), (None, "3", "e", 1), (None, "3", "f", 1),
            ("E2", "1", None, 1), ("E2", "1", "g", None)]
    docs = spark.createDataFrame(rows, "season_code string, game_number string, r string, n int").selectExpr(
        "season_code", "game_number", "named_struct('Referees', r) AS doc", "n")
    for order, want in (("n", {("E1", "1", "c"), ("E1", "2", "d"), (None, "3", "f"), ("E2", "1", None)}),
                        (None, {("E1", "1", "c"), ("E1", "2", "d"), (None, "3", "f"), ("E2", "1", None)})):
        got = LA._last_of_key(docs, order)
        assert got.columns == docs.columns
        assert {(r.season_code, r.game_number, r.doc.Referees) for r in got.collect()} == want
        plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
        texts = plan.count("to_json(") + plan.count("structstojson")
        assert 0 < texts == plan.count("case when (_equal")


def test_a_load_reads_its_lines_once_and_keeps_what_it_stores(spark):
    """Box rows are ready in the decoded copy, and what a document's lines share is computed below the generator."""
    import json

    from courtline.plans import normalise as NO

    def line(code, **more):
        return {"Player_ID": code, "Player": "x", "Team": "Reds", "Minutes": "10:00", "Points": 5, **more}

    lines = [line("P1"), line("P2", Valuation="x", Points=[1], Steals=None, Extra="y"), line("P3", Steals="y", Height="tall"),
             line("P4", Minutes="99999999999:00"), line("P5", Minutes="25"), line("P6", Points=None, Minutes="0:30")]
    doc = {"Referees": "A", "Stats": [{"tmr": {"Team": t}, "totr": {"Points": 1}, "PlayersStats": x} for t, x in (("Reds", lines), ("Blues", []))]}
    kept = []
    copy = NO.materialize
    try:
        NO.materialize = lambda df: kept.append(df) or copy(df)
        load = NO.normalise(NO.parse_documents(spark.createDataFrame([("a/E1/1.json", json.dumps(doc))], "file_key string, body string")))
        decoded = load._decoded
    finally:
        NO.materialize = copy
    assert {"seconds", "points", "plus_minus", "player_name"} <= set(decoded.columns) and "line" not in decoded.columns
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    above = plan[:next(i for i, x in enumerate(plan) if "Generate posexplode" in x)]
    assert not any("doc#" in x for x in above)
    assert [r.reason for r in load.rejects.orderBy("reason").collect()] == [
        "Points is no number", "Steals is no number", "minutes has no ':'", "seconds out of integer range"]
    assert sorted((r.seconds, r.points) for r in load.boxscore.collect()) == [(30, 0), (600, 5)]


def test_copies_are_compressed_by_zstandard(spark):
    from glob import glob

    import pyarrow.parquet as pq

    files = glob(f"{local_path(materialize(spark.range(9)).inputFiles()[0]).rsplit('/', 1)[0]}/*.parquet")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups} == {"ZSTD"}


def test_pages_are_landed_twice_from_one_shuffle_and_no_copy(spark, monkeypatch):
    from courtline import catalog as C

    games = [(f"data/boxscore_json/E{2000 + n % 2}/{n}.json", f"E{2000 + n % 2}", n, n, f'{{"n":{n}}}') for n in range(0, 1200, 7)]
    made = []

    def documents(*_):
        made.append(1)
        return spark.createDataFrame(games, "file_key string, season_code string, game_number long, game_id long, body string")

    monkeypatch.setattr(C.B, "documents", documents)
    monkeypatch.setattr(C, "materialize", lambda df: (_ for _ in ()).throw(AssertionError("documents are copied")))
    got = sorted(map(tuple, C.q_landing_changes(spark, "").collect()))
    pages = {}
    for _, season, n, i, _ in games:
        pages.setdefault((season, n // 100), []).append(i)
    want = [(f"{s}/{p}", "vanished") for s, p in pages if p % 4 == 0] + [(f"{s}/{p + 100000}", "new") for s, p in pages if p % 5 == 1]
    want += [(f"{s}/{p}", "rewritten") for (s, p), ids in pages.items() if p % 4 not in (0, 3) and any(i % 40 == 0 for i in ids)]
    assert got == sorted(want) and {c for _, c in got} == {"vanished", "new", "rewritten"} and len(made) == 1
    monkeypatch.setattr(C.B, "documents", lambda *_: documents().filter("game_number < 100"))
    assert {c for _, c in C.q_landing_changes(spark, "").collect()} == {"vanished"}
