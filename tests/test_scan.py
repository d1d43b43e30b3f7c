import random

from courtline.operators.scan import dense_ids, running_scan, window_scan


def _rows(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        # one hot group holding about a third of the rows
        g = "hot" if rnd.random() < 0.35 else f"g{rnd.randint(0, 20)}"
        out.append((g, rnd.randint(0, 50), i, rnd.choice([0, 1, None])))
    return out


def test_running_scan_equals_window(spark):
    df = spark.createDataFrame(_rows(3000, 1), "grp string, k int, uid int, v int")
    kw = dict(row_number="rn", exclusive_sums={"cum": "v"})
    fast = running_scan(df, ["grp"], ["k", "uid"], blocks=7, **kw)
    ref = window_scan(df, ["grp"], ["k", "uid"], **kw)
    a = sorted(tuple(r) for r in fast.select("grp", "uid", "rn", "cum").collect())
    b = sorted(tuple(r) for r in ref.select("grp", "uid", "rn", "cum").collect())
    assert a == b


def test_running_scan_plain_python(spark):
    rows = _rows(500, 2)
    df = spark.createDataFrame(rows, "grp string, k int, uid int, v int")
    got = {r.uid: (r.rn, r.cum) for r in running_scan(df, ["grp"], ["k", "uid"], blocks=5, row_number="rn",
                                                      exclusive_sums={"cum": "v"}).collect()}
    expect = {}
    for g in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        total = 0
        for i, r in enumerate(seq):
            expect[r[2]] = (i + 1, total)
            total += r[3] or 0
    assert got == expect


def test_dense_ids_consecutive(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in random.Random(3).sample(range(5000), 1200)], "key string")
    ids = dense_ids(df, ["key"], start=11).orderBy("key").collect()
    assert [r.id for r in ids] == list(range(11, 11 + 1200))


def test_running_scan_keeps_null_groups(spark):
    rows = [(None, 1, 1, 1), (None, 2, 2, 1), ("a", 1, 3, 1), ("a", 2, 4, None), ("a", 3, 5, 1)]
    df = spark.createDataFrame(rows, "grp string, k int, uid int, v int")
    got = sorted((r.uid, r.rn, r.cum) for r in running_scan(df, ["grp"], ["k", "uid"], blocks=3, row_number="rn",
                                                            exclusive_sums={"cum": "v"}).collect())
    assert got == [(1, 1, 0), (2, 2, 1), (3, 1, 0), (4, 2, 1), (5, 3, 1)]
