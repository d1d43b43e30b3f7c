from courtline.plans import features as FE
from courtline.plans import prepare as PR
from courtline.schemas import BOX_STATS, BOXSCORE, GAMES


def _games(spark, rows):
    return spark.createDataFrame(rows, GAMES)


def _box(spark, rows):
    """rows: (id, player, game, team, home?, seconds, points, valuation)"""
    full = []
    for rid, pl, g, t, home, sec, pts, val in rows:
        stats = {c: 1 for c in BOX_STATS}
        stats["points"], stats["valuation"] = pts, val
        full.append((rid, pl, g, t, home, False, sec, *[stats[c] for c in BOX_STATS]))
    return spark.createDataFrame(full, BOXSCORE)


def _setup(spark):
    # season 2001: team 1 v team 2 four times; game 3 is a tie
    games = _games(spark, [
        (10, 1, 2, "1E2001", 80, 70),
        (11, 2, 1, "2E2001", 90, 60),
        (12, 1, 2, "3E2001", 75, 75),
        (13, 2, 1, "4E2001", 60, 99),
    ])
    box = _box(spark, [
        (1, 7, 10, 1, True, 100, 10, 5),
        (2, 7, 11, 1, False, 200, None, 7),
        (3, 7, 12, 1, True, 300, 20, 9),
        (4, 7, 13, 1, False, 400, 30, 11),
        (5, 8, 10, 2, False, 50, 4, 3),  # player 8 plays a single game
    ])
    return games, box


def test_trailing_means_and_label(spark):
    games, box = _setup(spark)
    f = {r.id: r for r in FE.training_features(games, box).collect()}
    # first game of the season: means are 0
    assert f[1].avg_last_3_points == 0.0 and f[1].avg_last_3_valuation == 0.0
    # null points among the previous games: mean over the others only
    assert f[3].avg_last_3_points == 10.0
    assert f[4].avg_last_3_points == 15.0
    assert f[4].avg_last_3_valuation == (5 + 7 + 9) / 3
    assert f[4].avg_last_3_seconds == 200.0
    # label = next game's valuation, null on the last game and for a one-game season
    assert [f[i].next_game_valuation for i in (1, 2, 3, 4, 5)] == [7, 9, 11, None, None]


def test_win_ratios_and_ties(spark):
    games, box = _setup(spark)
    f = {r.id: r for r in FE.training_features(games, box).collect()}
    # before game 1 nobody played: ratio 0, opponent ratio 0 -> ratio of ratios null
    assert f[1].team_win_ratio == 0.0 and f[1].opponent_win_ratio == 0.0 and f[1].win_ratio_ratio is None
    # game 1 won by team 1 (home); before game 2 team 1 = 1/1, team 2 = 0/1
    assert f[2].team_win_ratio == 1.0 and f[2].opponent_win_ratio == 0.0 and f[2].win_ratio_ratio is None
    # game 2 won by team 2 (home); before game 3 both 1/2
    assert f[3].team_win_ratio == 0.5 and f[3].win_ratio_ratio == 1.0
    # game 3 tied: away (team 2) is counted the winner in the running ratio ...
    assert f[4].team_win_ratio == 1 / 3 and f[4].opponent_win_ratio == 2 / 3
    # ... while win_ind is 0 for both sides of the tie
    assert f[3].win_ind == 0
    assert f[1].win_ind == 1 and f[2].win_ind == 0 and f[4].win_ind == 1


def test_skew_safe_equals_window(spark):
    games, box = _setup(spark)
    a = sorted(tuple(r) for r in FE.cumulative_win(FE.game_info(games), skew_safe=True).collect())
    b = sorted(tuple(r) for r in FE.cumulative_win(FE.game_info(games), skew_safe=False).collect())
    assert a == b


def test_preprocess_and_split(spark):
    games, box = _setup(spark)
    f = FE.training_features(games, box)
    p = PR.preprocess(f)
    assert p.columns[0] == "next_game_valuation" and len(p.columns) == 50
    assert not {"id", "game_id", "team_id", "win_ind"} & set(p.columns)
    assert dict(p.dtypes)["played_for_home"] == "int"
    rows = {(r.player_id, r.game_number): r.next_game_valuation for r in p.collect()}
    # intended fill: the player's season mean of the known labels; one-game season stays null
    assert rows[(7, 4)] == (7 + 9 + 11) / 3 and rows[(8, 1)] is None
    as_written = {(r.player_id, r.game_number): r.next_game_valuation
                  for r in PR.preprocess(f, mode="as_written").collect()}
    assert as_written[(7, 4)] is None
    train, test = PR.split(p, "2001")
    assert test.count() == 5 and train.count() == 0
    assert {r.part: r.rows for r in PR.split_counts(p, "2001").collect()} == {"test": 5}


def test_row_of_neither_team_has_no_own_ratio(spark):
    games = _games(spark, [(10, 1, 2, "1E2001", 80, 70), (11, 1, 2, "2E2001", 80, 70)])
    box = _box(spark, [(1, 7, 11, 9, True, 100, 10, 5)])
    row = FE.training_features(games, box).first()
    assert row.team_win_ratio is None and row.win_ratio_ratio is None and row.win_ind == 0


def test_games_without_a_number_are_rejected(spark):
    games = _games(spark, [(10, 1, 2, "xE2001", 80, 70), (11, 1, 2, "3000000000E2001", 80, 70)])
    assert [r.game_number for r in FE.game_info(games).collect()] == [3000000000]
    assert [(r.id, r.reason) for r in FE.game_code_rejects(games).collect()] == [(10, "game code without a number")]


def test_colliding_season_codes_fan_out(spark):
    # E2001 and U2001 share season "2001" and game numbers: the keyed joins fan out
    games = _games(spark, [(10, 1, 2, "1E2001", 80, 70), (20, 1, 3, "1U2001", 50, 70),
                           (11, 2, 1, "2E2001", 90, 60)])
    box = _box(spark, [(1, 7, 10, 1, True, 100, 10, 5), (2, 7, 20, 1, True, 100, 10, 5),
                       (3, 7, 11, 1, False, 100, 10, 5)])
    assert FE.training_features(games, box).count() > 3


def test_hot_group_frames_equal_window(spark):
    games, box = _setup(spark)
    a = sorted(tuple(r) for r in FE.training_features(games, box, hot_groups=True).collect())
    assert a == sorted(tuple(r) for r in FE.training_features(games, box).collect())


def test_fill_of_hot_groups_equals_window(spark):
    games, box = _setup(spark)
    f = FE.training_features(games, box)
    a = sorted(map(str, PR.fill_target(f, hot_groups=True).collect()))
    assert a == sorted(map(str, PR.fill_target(f).collect()))


def test_shifted_frames_random_against_window(spark):
    import random
    from courtline.operators.rolling import shifted_frame_features, with_trailing_features
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 9)}", i, rnd.choice([None, 1, 2, 7]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "grp string, o int, v int")
    a = shifted_frame_features(df, ["v"], ["grp"], ["o"], lead_col="v", lead_alias="nv")
    b = with_trailing_features(df, ["v"], ["grp"], ["o"], lead_col="v", lead_alias="nv")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_csv_sink_round_trip_and_count(spark, tmp_area):
    games, box = _setup(spark)
    p = PR.preprocess(FE.training_features(games, box))
    path, rows = PR.write_csv_counted(p, f"{tmp_area}/train")
    assert rows == 5
    back = PR.read_csv(spark, path, p.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, p.collect()), key=str)
