import json

from courtline.streaming import incremental as INC


def _outcomes(spark, rows):
    return spark.createDataFrame(rows, "season string, id long, success boolean, error string")


def test_success_prefix_and_marks(spark):
    out = _outcomes(spark, [("E1", 7, True, None), ("E1", 8, True, None), ("E1", 9, False, "x"),
                            ("E1", 10, True, None), ("E2", 5, False, "x"), ("E2", 6, True, None)])
    marks = spark.createDataFrame([("fetch", "E1", 7), ("fetch", "E2", 5)], "stage string, season string, last_id long")
    kept = INC.success_prefix(out, marks.select("season", "last_id"))
    assert sorted((r.season, r.id) for r in kept.collect()) == [("E1", 7), ("E1", 8)]
    new = {r.season: r.last_id for r in INC.advance_marks(marks, kept, "fetch").collect()}
    # the first id of E2 failed: the mark is not lowered
    assert new == {"E1": 8, "E2": 5}
    lowered = {r.season: r.last_id for r in INC.advance_marks(marks, kept, "fetch", as_written=True).collect()}
    assert lowered == {"E1": 8, "E2": 4}


def test_merge_marks_keeps_values_not_passed(spark):
    old = spark.createDataFrame([("fetch", "E1", 3), ("transform", "E1", 2)], "stage string, season string, last_id long")
    upd = spark.createDataFrame([("fetch", "E1", 9), ("fetch", "E2", 1)], "stage string, season string, last_id long")
    got = sorted(tuple(r) for r in INC.merge_marks(old, upd).collect())
    assert got == [("fetch", "E1", 9), ("fetch", "E2", 1), ("transform", "E1", 2)]


def test_fetch_plan_guards_empty_range(spark):
    spec = spark.createDataFrame([("E1", 3), ("E2", 0)], "season_code string, max_game_id int")
    rows = INC.fetch_plan(spec, "http://host/box").collect()
    assert [(r.season_code, r.game_id) for r in rows] == [("E1", 1), ("E1", 2), ("E1", 3)]
    assert rows[0].url == "http://host/box?gamecode=1&seasoncode=E1"
    assert rows[0].landing_key == "data/boxscore_json/E1/1.json"


def test_classify_fetch(spark):
    resp = spark.createDataFrame([(1, "E1", 200, '{"a": 1}'), (2, "E1", 200, "{not json"), (3, "E1", 404, "")],
                                 "id long, season string, status int, body string")
    got = {r.id: (r.success, r.error) for r in INC.classify_fetch(resp).collect()}
    assert got[1] == (True, None)
    assert got[2][0] is False and got[2][1].startswith("JSON decode error")
    assert got[3] == (False, "Failed to fetch data for season: E1 game ID: 3 - Status: 404")


def test_incremental_filter_is_numeric(spark):
    parsed = spark.createDataFrame([("a/E1/9.json", "E1", 9), ("a/E1/10.json", "E1", 10), ("a/E1/abc.json", "E1", None),
                                    ("a/E2/50.json", "E2", 50)], "path string, season_code string, file_number long")
    marks = spark.createDataFrame([("E1", 9)], "season_code string, last_id long")
    # a season without a mark has nothing processed yet
    assert sorted(r.path for r in INC.above_marks(parsed, marks).collect()) == ["a/E1/10.json", "a/E2/50.json"]
    mx = {r.season_code: (r.max_file_number, r.rejected_names) for r in INC.max_file_number(parsed).collect()}
    assert mx == {"E1": (10, 1), "E2": (50, 0)}


def test_transform_marks_from_batch_and_kept_when_empty(spark):
    old = spark.createDataFrame([("transform", "E1", 5), ("transform", "E2", 7)], "stage string, season string, last_id long")
    batch = spark.createDataFrame([("E1", 9), ("E1", None), ("E1", 12)], "season_code string, file_number long")
    got = sorted(tuple(r) for r in INC.transform_marks(old, batch).collect())
    # E1 advances to the largest number of its batch; E2 had no file and keeps its mark
    assert got == [("transform", "E1", 12), ("transform", "E2", 7)]


def test_fetch_plan_chunked_expansion_is_complete(spark):
    spec = spark.createDataFrame([("E1", 2500), ("E2", 1), ("E3", 1000)], "season_code string, max_game_id int")
    rows = INC.fetch_plan(spec, chunk=1000).select("season_code", "game_id").collect()
    got = sorted((r.season_code, r.game_id) for r in rows)
    expect = sorted([("E1", i) for i in range(1, 2501)] + [("E2", 1)] + [("E3", i) for i in range(1, 1001)])
    assert got == expect


def test_late_batch_does_not_lower_a_mark(spark):
    old = spark.createDataFrame([("transform", "E1", 9)], "stage string, season string, last_id long")
    late = spark.createDataFrame([("E1", 3)], "season_code string, file_number long")
    assert [r.last_id for r in INC.transform_marks(old, late).collect()] == [9]


def test_marks_are_kept_in_versions(spark, tmp_area):
    marks = lambda n: spark.createDataFrame([("transform", "E1", n)], INC.MarkStore.SCHEMA)
    assert INC.MarkStore(spark, tmp_area).read().count() == 0
    for n, want in ((3, 3), (9, 9), (4, 9)):
        INC.MarkStore(spark, tmp_area).advance(marks(n))
        assert [tuple(r) for r in INC.MarkStore(spark, tmp_area).read().collect()] == [("transform", "E1", want)]


def test_fetch_outcomes_without_response_or_save(spark):
    rows = [(1, "E1", None, None, "timed out", None), (2, "E1", 200, "{}", None, False), (3, "E1", 200, "{}", None, True)]
    resp = spark.createDataFrame(rows, "id long, season string, status int, body string, transport_error string, saved boolean")
    got = {r.id: (r.success, r.error) for r in INC.classify_fetch(resp).collect()}
    assert got == {1: (False, "timed out"), 2: (False, "Failed to save JSON for season: E1 game ID: 2"), 3: (True, None)}


def _doc(key, teams=("X", "Y"), line=("P1 ", "N", 1, "10:00", "X  "), referees="R"):
    fields = {"Player_ID": line[0], "Player": line[1], "IsStarter": line[2], "Minutes": line[3], "Team": line[4], "Points": 3}
    sides = [{"tmr": {"Team": t}, "totr": {"Points": 70}, "PlayersStats": [fields] if i == 0 else []} for i, t in enumerate(teams)]
    return key, json.dumps({"Referees": referees, "Stats": sides})


def _docs(spark, *docs):
    from courtline.plans.normalise import parse_documents
    return parse_documents(spark.createDataFrame(list(docs), "file_key string, body string"))


def test_batches_of_a_new_query_are_loaded(spark, tmp_area):
    store = INC.TableStore(spark, tmp_area)
    one, two = _docs(spark, _doc("d/E1/1.json")), _docs(spark, _doc("d/E1/2.json"))
    assert INC.load_batch(store, one, 0, "first") and not INC.load_batch(store, one, 0, "first")
    assert INC.load_batch(store, two, 0, "second")
    assert store.read().games.count() == 2 and store.read().teams.count() == 2


def test_unreadable_commit_log_is_an_error(spark, tmp_area):
    import glob
    import os

    import pytest

    from courtline.session import local_path
    store = INC.TableStore(spark, tmp_area)
    INC.load_batch(store, _docs(spark, _doc("d/E1/1.json")), 0)
    for f in glob.glob(f"{local_path(tmp_area)}/_commits/*"):
        open(f, "wb").write(b"not parquet, long enough to have a footer")
    for f in glob.glob(f"{local_path(tmp_area)}/_commits/.*.crc"):
        os.remove(f)
    with pytest.raises(Exception):
        INC.load_batch(store, _docs(spark, _doc("d/E1/2.json")), 1)


def test_rejects_are_stored(spark, tmp_area):
    store = INC.TableStore(spark, tmp_area)
    bad = _doc("d/E1/2.json", line=("P2", "N", 1, "ten", "X"))
    worse = ("d/E1/3.json", json.dumps({"Stats": []}))
    INC.load_batch(store, _docs(spark, _doc("d/E1/1.json"), _doc("d/E1/4.json", line=("P4", "N", 0, "1", "X")), bad, worse), 0)
    got = sorted((r.file_key, r.level) for r in store.read().rejects.collect())
    assert got == [("d/E1/3.json", "document"), ("d/E1/4.json", "player line")]


def test_rows_of_a_relanded_document_get_its_own_teams(spark, tmp_area):
    store = INC.TableStore(spark, tmp_area)
    INC.load_batch(store, _docs(spark, _doc("d/E1/1.json")), 0)
    INC.load_batch(store, _docs(spark, _doc("d/E1/1.json", teams=("Y", "X"), line=("P9", "N", 1, "5:00", "Y"))), 1)
    t = store.read()
    names = {r.id: r.name for r in t.teams.collect()}
    players = {r.id: r.player_code for r in t.players.collect()}
    assert {players[r.player_id]: names[r.team_id] for r in t.boxscore.collect()} == {"P1": "X", "P9": "Y"}
