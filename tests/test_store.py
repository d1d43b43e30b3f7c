"""The table store's key index and deletions, and the feature store, against whole rebuilds."""
import random
import re

import pytest

from courtline.plans import features as FE
from courtline.plans import model as MO
from courtline.plans import normalise as NO
from courtline.schemas import BOX_STATS, BOXSCORE, GAMES
from courtline.streaming import incremental as INC
from courtline.streaming.feature_store import FeatureStore, LoadReport
from tests.test_normalise import _doc, _docs, _line


def _key(season, n):
    return f"data/boxscore_json/{season}/{n}.json"


def _season(first, last, season="E2023"):
    """Games of one season, two box rows each; player codes come back every fourth game."""
    return [(_key(season, n), _doc("Reds", "Blues", n, 3, [_line(f"P{n % 4}", f"Name {n % 4}", "Reds", points=n)],
                                   [_line(f"Q{n % 4}", f"Other {n % 4}", "Blues")])) for n in range(first, last)]


def test_a_batch_reads_the_keys_it_hits_and_no_stored_table(spark, tmp_area):
    store = INC.TableStore(spark, tmp_area)
    INC.load_batch(store, _docs(spark, _season(1, 120)), 0)
    batch = _season(118, 123) + [(_key("E2023", 3), _doc("Reds", "Blues", 1, 1, [_line("P3", "Late", "Reds"), _line("NEW", "New", "Reds")], []))]
    load = NO.normalise(_docs(spark, batch), target=store.read())
    for name, rows in load.new.items():
        files = rows.inputFiles()
        assert not [f for f in files if "_keys" not in f and f"/{name}/" in f], name
    plan = load.new["boxscore_record"]._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "_keys/boxscore_record" in line or ("player_id" in line and "PartitionFilters" in line))
    pruned = re.search(r"PartitionFilters: \[.*?bucket#\d+ IN \(([^)]*)\)", scan)
    assert pruned and len(pruned[1].split(",")) <= 6, scan  # of six games
    INC.load_batch(store, _docs(spark, batch), 1)
    got = store.read()
    whole = NO.normalise(_docs(spark, _season(1, 123)[:2] + [
        (_key("E2023", 3), _doc("Reds", "Blues", 3, 3, [_line("P3", "Name 3", "Reds", points=3), _line("NEW", "New", "Reds")],
                                [_line("Q3", "Other 3", "Blues")]))] + _season(4, 123)))

    def natural(n):
        p = {r.id: r.player_code for r in n.players.collect()}
        g = {r.id: r.game_code for r in n.games.collect()}
        return sorted((p[r.player_id], g[r.game_id], r.points, r.is_starter, r.played_for_home) for r in n.boxscore.collect())

    assert natural(got) == natural(whole)
    ids = [r.id for r in got.players.collect()]
    assert len(ids) == len(set(ids)) == 9 and max(ids) == 9
    assert got.boxscore.count() == got.boxscore.select("id").distinct().count()
    assert store.get("games", got.games.first().id).count() == 1 and store.get("games", -5).count() == 0


def test_deletions_take_effect_and_keys_can_come_back(spark, tmp_area):
    store = INC.TableStore(spark, tmp_area)
    INC.load_batch(store, _docs(spark, _season(1, 6)), 0)

    def ids(values):
        return spark.createDataFrame([(v,) for v in values], "id long")

    t = store.read()
    game = t.games.filter("game_code = '2E2023'").first().id
    box = [r.id for r in t.boxscore.filter(f"game_id = {game}").collect()]
    out = {r.id: r.outcome for r in store.delete("games", ids([game, 999])).collect()}
    assert out == {game: "refused", 999: "absent"} and store.table("games").count() == 5
    assert {r.outcome for r in store.delete("boxscore_record", ids(box)).collect()} == {"deleted"}
    assert [r.outcome for r in store.delete("games", ids([game])).collect()] == ["deleted"]
    assert [r.outcome for r in store.delete("games", ids([game])).collect()] == ["absent"]
    assert store.table("games").count() == 4 and store.table("boxscore_record").count() == 8
    # the game comes back with a new id, its box rows too
    assert INC.load_batch(store, _docs(spark, _season(1, 6)), 1)
    t = store.read()
    again = t.games.filter("game_code = '2E2023'").first().id
    assert again == 6 and t.boxscore.count() == 10 and t.boxscore.filter(f"game_id = {again}").count() == 2
    # a deletion that was not committed is not there
    ids([again]).write.parquet(f"{tmp_area}/_deleted/games/delta=dlost")
    assert store.table("games").count() == 5


def _table(spark, games, box):
    full = []
    for rid, player, game, team, home, value in box:
        stats = {c: (value * (i + 3)) % 17 for i, c in enumerate(BOX_STATS)}
        stats["valuation"] = value
        full.append((rid, player, game, team, home, False, value * 10, *[stats[c] for c in BOX_STATS]))
    return spark.createDataFrame(games, GAMES), spark.createDataFrame(full, BOXSCORE)


def _league(seed=3, games=40):
    r = random.Random(seed)
    g, b, rid = [], [], 0
    for i in range(1, games + 1):
        season = 2001 + i % 2
        home, away = r.sample(range(1, 6), 2)
        g.append((i, home, away, f"{(i + 1) // 2}E{season}", r.choice([None, 70, 80, 90]), r.choice([70, 80, 90])))
        for player in r.sample(range(1, 12), 5):
            rid += 1
            b.append((rid, player, i, r.choice([home, away]), True, r.randrange(1, 30)))
    return g, b


@pytest.mark.parametrize("case", ["follows", "late", "collision", "stray", "new player"])
def test_features_by_batches_equal_a_rebuild(spark, tmp_area, case):
    g, b = _league()
    first = {x[0] for x in g if x[0] <= 20}
    if case == "late":
        first -= {4, 9}
    if case == "collision":  # another competition of the season with a number that is taken
        g.append((100, 1, 2, "3U2001", 99, 1))
        b.append((1000, 3, 100, 1, True, 8))
    if case == "stray":  # a team that is no side of its game
        b.append((1000, 60, 30, 77, True, 8))
    extra = {}
    if case == "new player":  # a box row of a game that is stored
        b.append((1000, 50, 7, next(x[1] for x in g if x[0] == 7), True, 8))
        extra = {1000}
    games, box = _table(spark, g, b)
    store = FeatureStore(spark, tmp_area)
    assert store.read() is None
    new_game = ~games.id.isin(sorted(first))
    later = ~box.game_id.isin(sorted(first)) | box.id.isin(sorted(extra))
    one = store.load(games.filter(~new_game), box.filter(~later), games.filter(~new_game), box.filter(~later), 0)
    assert one.relabelled_rows == 0 and one.new_rows == box.filter(~later).count()
    two = store.load(games.filter(new_game), box.filter(later), games, box, 1)
    assert two.rebuilt_seasons == {"follows": 0, "late": 2, "collision": 1, "stray": 1, "new player": 1}[case]
    if case == "follows":
        assert two.new_rows == box.filter(later).count() and 0 < two.relabelled_rows <= 22
    assert store.load(games.filter(new_game), box.filter(later), games, box, 1) is None  # known already
    want = FE.training_features(games, box)
    got = store.read().select(*want.columns)

    def rows(df):
        return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())

    assert rows(got) == rows(want)
    assert isinstance(two, LoadReport) and store.commits().count() == 2


def test_every_row_is_scored_and_the_curve_is_that_of_the_trees(spark, tmp_area):
    rows = [(float(i % 7 * 2) if i % 5 else None, "2001", i % 7, (i * 3) % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "next_game_valuation double, season string, a int, b int").repartition(3)
    model = MO.fit(df, rounds=12)
    assert MO.score(model, df).filter("prediction IS NOT NULL").count() == 200
    curve = MO.training_curve(model, df).orderBy("round").collect()
    assert [c.round for c in curve] == list(range(1, 13)) and {c.n for c in curve} == {160}
    labelled = MO.score(model, df.filter("next_game_valuation IS NOT NULL"))
    assert abs(MO.mae_frame(labelled, "next_game_valuation", "prediction").first().mae - curve[-1].mae) < 1e-9
    # each round's error again from the trees one by one
    trees = model.stages[1]
    points = model.stages[0].transform(MO.model_frame(df.filter("next_game_valuation IS NOT NULL"))).collect()
    for k in (1, 5, 12):
        each = [sum(w * t.predict(p.features) for w, t in zip(trees.treeWeights[:k], trees.trees[:k])) for p in points]
        mae = sum(abs(p.next_game_valuation - e) for p, e in zip(points, each)) / len(points)
        assert abs(mae - curve[k - 1].mae) < 1e-9
    again = MO.load_model(MO.save_model(model, f"{tmp_area}/model"))
    want = sorted(map(str, MO.score(model, df).select("a", "b", "prediction").collect()))
    assert sorted(map(str, MO.score(again, df).select("a", "b", "prediction").collect())) == want
    df.write.parquet(f"{tmp_area}/rows")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_area}/rows")
    out = MO.score_stream(stream, f"{tmp_area}/model", f"{tmp_area}/out", f"{tmp_area}/ckpt")
    assert sorted(map(str, out.select("a", "b", "prediction").collect())) == want


def test_odd_values_cost_a_line_at_most(spark):
    lines = [_line("P1", "Ann", "Reds", starter=True, points=7.0), _line("P2", "Bob", "Reds", starter=False, points="9"),
             _line("P3", "Cy", "Reds", points="x"), _line("P4", "Dee", "Reds", points=True, starter="0"), _line("P5", "Ed", "Reds", points=2.5),
             _line("P6", "Flo", "Reds", points=[1]), _line("P7", "Gus", "Reds", points=1e30), _line(8, 9, "Reds", starter=[]), "no line", None,
             _line("P9", "Hal", "Reds", starter=2.0, points=-2.5), _line("P10", "Ida", "Reds", starter="")]
    n = NO.normalise(_docs(spark, [(_key("E2023", 1), _doc("Reds", "Blues", 80.0, True, lines, [])),
                                   (_key("E2023", 2), _doc("Reds", "Blues", "many", 1, lines[:1], [])),
                                   (_key("E2023", 3), _doc("Reds", "Blues", None, 1, lines[:1], []))]))
    codes = {r.id: r.player_code for r in n.players.collect()}
    games = {r.game_code: r for r in n.games.collect()}
    assert set(games) == {"1E2023", "3E2023"} and games["1E2023"].home_team_score == 80 and games["1E2023"].away_team_score == 1
    assert games["3E2023"].home_team_score is None
    got = {codes[r.player_id]: (r.points, r.is_starter) for r in n.boxscore.filter(f"game_id = {games['1E2023'].id}").collect()}
    assert got == {"P1": (7, True), "P2": (9, False), "P4": (1, True), "P5": (3, True), "8": (5, False), "P9": (-3, True), "P10": (5, False)}
    reasons = sorted((r.level, r.reason) for r in n.rejects.collect())
    assert reasons == [("document", "a side's Points is no number")] + [("player line", "Points is no number")] * 3 \
        + [("player line", "player line is no object")] * 2


def test_loads_are_refused_above_a_share_of_rejects(spark, tmp_area):
    games, box = _table(spark, *_league())
    teams = spark.createDataFrame([(i, f"T{i}") for i in range(1, 6)] + [(6, None), (1, "T9"), (7, "T2")], "id long, name string")
    players = spark.createDataFrame([(i, f"P{i}", "x") for i in range(1, 11)], "id long, player_code string, name string")  # not 11
    tables = {"teams": teams, "players": players, "games": games, "boxscore_record": box}
    store = INC.TableStore(spark, tmp_area)
    with pytest.raises(INC.ConstraintError):
        INC.load_tables(store, tables, 0, most_rejected=0.01)
    assert store.read() is None
    counts = INC.load_tables(store, tables, 0, most_rejected=0.5)
    orphans = box.filter("player_id = 11").count()
    assert counts["teams"] == {"rows": 8, "rejected": 3} and counts["boxscore_record"]["rejected"] == orphans > 0
    reasons = {r.reason for r in store.table("rejects").collect()}
    assert reasons == {"name is null", "id is taken", "name is taken", "player_id has no parent"}
    # the same rows again are all taken
    again = INC.load_tables(store, {**tables, "boxscore_record": box.filter("player_id < 11")}, 1, most_rejected=1.0)
    assert all(c["rows"] == c["rejected"] for c in again.values()) and store.table("games").count() == 40
