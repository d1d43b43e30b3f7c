"""Plan-shape checks: what the optimiser must keep doing as the code changes."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_preprocess_over_stored_tables_sorts_twice_and_forces_no_broadcast(spark, tmp_area):
    from courtline.plans import features as FE
    from courtline.plans import prepare as PR
    from courtline.sources import bridge
    bridge.games(spark, SF).write.parquet(f"{tmp_area}/games")
    bridge.boxscore(spark, SF).write.parquet(f"{tmp_area}/box")
    games, box = spark.read.parquet(f"{tmp_area}/games"), spark.read.parquet(f"{tmp_area}/box")
    pre = PR.preprocess(FE.training_features(games, box, skew_safe=False))
    plan = _plan(pre)
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 4 and "ResolvedHint" not in pre._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [player_id") == 1


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_single_partition_exchange(spark):
    lines = _plan(E.entry(spark)).split("\n")
    # the one value of a scalar subquery, from one partial maximum per task, is all that meets in one task
    for i, line in enumerate(lines):
        assert "SinglePartition" not in line or "partial_max" in lines[i + 1]


def test_scan_reads_only_needed_columns(spark):
    df = E.queries()["minutes_to_seconds"](spark, SF)
    plan = _plan(df)
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "l_partkey" in schema and "l_shipdate" not in schema and "l_extendedprice" not in schema


def test_filter_reaches_the_scan(spark):
    plan = _plan(E.queries()["metric_tail"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_no_python_udf_anywhere(spark):
    for name in ("training_features", "normalise_boxscore", "classify_fetch"):
        plan = _plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
