"""Property tests: Spark column rules against plain-Python statements of them."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtline.functions import scalar as SC

REJECT = object()


def python_minutes(text):
    """The source rule: int(float(MM) * 60) + float(SS); ValueError -> 0; other errors reject."""
    if text is None:
        return REJECT
    parts = text.split(":")
    try:
        minutes = float(parts[0])
        if len(parts) < 2:
            return REJECT  # IndexError in the source
        value = int(minutes * 60) + float(parts[1])
    except ValueError:
        return 0
    except OverflowError:
        return REJECT  # int() of an infinite float
    if not math.isfinite(value):
        return REJECT
    # stored into an integer column: rounded half away from zero, within range
    stored = int(math.copysign(math.floor(abs(value) + 0.5), value))
    return stored if -2**31 <= stored < 2**31 else REJECT


piece = st.text(alphabet="0123456789.-e x", min_size=0, max_size=5)
minutes_text = st.one_of(
    st.builds(lambda a, b: f"{a}:{b}", piece, piece),
    st.builds(lambda a, b, c: f"{a}:{b}:{c}", piece, piece, piece),
    piece,
    st.none(),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(minutes_text, min_size=40, max_size=80))
def test_minutes_rule_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "m string")
    got = [r[0] for r in df.select(SC.minutes_to_seconds(F.col("m"))).collect()]
    for v, g in zip(values, got):
        want = python_minutes(v)
        assert (g is None) if want is REJECT else (g == want), (v, g, want)


strip_text = st.text(alphabet=" \t\n  ab", max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(strip_text, min_size=20, max_size=40))
def test_strip_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(SC.py_strip(F.col("s"))).collect()]
    assert got == [v.strip() for v in values]
