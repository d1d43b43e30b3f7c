from pyspark.sql import functions as F

from courtline.functions import scalar as SC


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_minutes_to_seconds_cases(spark):
    cases = {"12:30": 750, "00:00": 0, "DNP": 0, "": 0, "12:xx": 0, "12:30.5": 751, "12:30:15": 750,
             "5d:00": 0, " 7:05 ": 425}
    got = _one(spark, SC.minutes_to_seconds, list(cases))
    assert got == list(cases.values())


def test_minutes_rejects(spark):
    got = _one(spark, SC.minutes_to_seconds, ["25", None])
    assert got == [None, None]
    reasons = _one(spark, SC.minutes_reject_reason, ["25", None, "DNP", "12:30"])
    assert reasons == ["minutes has no ':'", "minutes is null", None, None]


def test_rounding_is_half_away_from_zero(spark):
    assert _one(spark, SC.minutes_to_seconds, ["0:0.5", "0:1.5", "0:2.5"]) == [1, 2, 3]


def test_py_strip_matches_python(spark):
    values = ["  P1 ", "\tP2\n", " P3 ", "P 4", ""]
    assert _one(spark, SC.py_strip, values) == [v.strip() for v in values]


def test_game_code_from_path_and_parts(spark):
    paths = ["data/boxscore_json/E2023/12.json", "data/boxscore_json/U2024/abc.json"]
    assert _one(spark, SC.game_code_from_path, paths) == ["12E2023", "abcU2024"]
    assert _one(spark, SC.path_season, paths) == ["E2023", "U2024"]
    assert _one(spark, SC.path_file_number, paths) == [12, None]


def test_game_code_parts(spark):
    codes = ["12E2023", "1E1999", "E2023"]
    assert _one(spark, SC.season_of, codes) == ["2023", "1999", "2023"]
    assert _one(spark, SC.game_number_of, codes) == [12, 1, None]


def test_game_number_beyond_the_integer_range(spark):
    assert _one(spark, SC.game_number_of, ["3000000000E2023", "x1E2023"]) == [3000000000, None]


def test_winner(spark):
    df = spark.createDataFrame([(1, 2, 80, 70), (1, 2, 70, 80), (1, 2, 75, 75), (1, 2, None, 75)],
                               "h int, a int, hs int, as_ int")
    rows = df.select(SC.winning_team(F.col("h"), F.col("a"), F.col("hs"), F.col("as_"))).collect()
    # a tie or a missing score makes the away team the winner
    assert [r[0] for r in rows] == [1, 2, 2, 2]
