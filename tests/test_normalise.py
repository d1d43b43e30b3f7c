import json

from courtline.plans import normalise as NO


def _line(code, name, team, minutes="10:00", starter=1, points=5, **extra):
    d = {"Player_ID": code, "Player": name, "Team": team, "IsStarter": starter, "Minutes": minutes,
         "Points": points, "Valuation": 3}
    d.update(extra)
    return d


def _doc(home, away, hs, as_, home_lines, away_lines, referees="A, B, C"):
    return {"Referees": referees, "Stats": [
        {"tmr": {"Team": home}, "totr": {"Points": hs}, "PlayersStats": home_lines},
        {"tmr": {"Team": away}, "totr": {"Points": as_}, "PlayersStats": away_lines},
    ]}


def _docs(spark, items):
    raw = spark.createDataFrame([(k, json.dumps(d)) for k, d in items], "file_key string, body string")
    return NO.parse_documents(raw)


def _fixture():
    return [
        ("data/boxscore_json/E2023/2.json", _doc("Reds", "Blues", 80, 70,
                                                 [_line("P1 ", "Ann-b", "Reds  ")],
                                                 [_line("P2", "Bob", "Blues", points=None, starter=None)])),
        ("data/boxscore_json/E2023/10.json", _doc("Blues", "Reds", 60, 61,
                                                  [_line(" P1", "Ann-a", "Blues"), _line("P3", "Cy", "Nobody")],
                                                  [_line("P1", "Ann-c", "Reds"), _line("P4", "Dee", "Reds",
                                                                                      minutes="DNP")])),
        ("data/boxscore_json/E2023/11.json", _doc("Reds", "Blues", 1, 2, [], [], referees="N/D, N/D, N/D")),
        ("data/boxscore_json/E2023/12.json", _doc("Reds", "Blues", 1, 2, [_line("P9", "Zed", "Reds", minutes="25")],
                                                  [])),
    ]


def test_tables_from_documents(spark):
    n = NO.normalise(_docs(spark, _fixture()))
    teams = {r.name: r.id for r in n.teams.collect()}
    # files are processed in key order: 10.json before 2.json
    assert teams == {"Blues": 1, "Reds": 2}
    players = {r.player_code: (r.id, r.name) for r in n.players.collect()}
    # first name wins, in landing-key order (10.json first), codes stripped
    assert players["P1"] == (1, "Ann-a")
    assert set(players) == {"P1", "P2", "P3", "P4", "P9"}
    games = {r.game_code: r for r in n.games.collect()}
    # the placeholder game is skipped
    assert set(games) == {"10E2023", "2E2023", "12E2023"}
    assert games["10E2023"].home_team_id == teams["Blues"] and games["10E2023"].away_team_score == 61
    box = {(r.player_id, r.game_id): r for r in n.boxscore.collect()}
    g10, g2 = games["10E2023"].id, games["2E2023"].id
    # a player on both rosters of a game: one row, home side kept
    p1 = box[(players["P1"][0], g10)]
    assert p1.played_for_home and p1.team_id == teams["Blues"]
    # row team matching neither side goes to the away team
    assert box[(players["P3"][0], g10)].team_id == teams["Reds"]
    # null stat -> 0, null IsStarter -> false, DNP -> 0 seconds
    p2 = box[(players["P2"][0], g2)]
    assert p2.points == 0 and p2.is_starter is False and p2.fg_made_2 == 0
    assert box[(players["P4"][0], g10)].seconds == 0
    assert box[(players["P1"][0], g2)].seconds == 600
    # minutes without ':' cannot be stored: routed to rejects, not loaded
    assert (players["P9"][0], games["12E2023"].id) not in box
    reasons = {r.reason for r in n.rejects.collect()}
    assert "minutes has no ':'" in reasons


def test_reload_is_first_write_wins(spark):
    docs = _docs(spark, _fixture())
    first = NO.normalise(docs)
    changed = [("data/boxscore_json/E2023/2.json", _doc("Reds", "Blues", 99, 0,
                                                        [_line("P1", "Other", "Reds", points=40)], []))]
    again = NO.normalise(_docs(spark, changed), target=first)
    before = sorted(tuple(r) for r in first.games.collect())
    after = sorted(tuple(r) for r in again.games.collect())
    assert before == after
    assert sorted(tuple(r) for r in first.boxscore.collect()) == sorted(tuple(r) for r in again.boxscore.collect())
    assert sorted(tuple(r) for r in first.players.collect()) == sorted(tuple(r) for r in again.players.collect())


def test_new_rows_get_ids_after_max(spark):
    first = NO.normalise(_docs(spark, _fixture()))
    more = [("data/boxscore_json/E2024/1.json", _doc("Greens", "Reds", 10, 20,
                                                     [_line("P7", "Gus", "Greens")], []))]
    n = NO.normalise(_docs(spark, more), target=first)
    teams = {r.name: r.id for r in n.teams.collect()}
    assert teams["Greens"] == 3
    assert {r.player_code: r.id for r in n.players.collect()}["P7"] == 6
    assert max(r.id for r in n.games.collect()) == 4


def test_first_seen_players(spark):
    got = {r.player_code: r.name for r in NO.first_seen_players(_docs(spark, _fixture())).collect()}
    assert got["P1"] == "Ann-a"
