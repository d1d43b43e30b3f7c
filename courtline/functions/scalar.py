"""Scalar column functions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip() sees it (Unicode White_Space plus the
# ASCII separators), expressed as a Java regex class.
_PY_WS = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: also removes tabs, newlines and no-break spaces."""
    return F.regexp_replace(c, rf"^{_PY_WS}+|{_PY_WS}+$", "")


def season_of(game_code: Column) -> Column:
    """Season = last four characters of the game code."""
    return F.substring(game_code, -4, 4)


def game_number_of(game_code: Column) -> Column:
    """Game number = game code without its last five characters, as a long; null where it is no such number."""
    return F.substring(game_code, F.lit(1), F.length(game_code) - 5).try_cast("long")


def winning_team(home_id: Column, away_id: Column, home_score: Column, away_score: Column) -> Column:
    """Home team when it scored strictly more, otherwise (tie, null) the away team."""
    return F.when(home_score > away_score, home_id).otherwise(away_id)


SECONDS_REASON = "seconds out of integer range"
_MINUTES_OK = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def minutes_to_seconds(minutes: Column) -> Column:
    """``MM:SS`` -> seconds as the source computes them, rounded to an integer.

    ``int(float(MM) * 60) + float(SS)``; a part that is not a number gives 0
    (e.g. ``DNP``, ``12:xx``, empty); parts after the second are ignored.  The
    value is stored in an integer column, which rounds half away from zero.
    Inputs the source cannot handle at all (no ``:`` in a numeric text, null,
    a value outside the integer range) give null here;
    :func:`minutes_reject_reason` names them.
    """
    parts = F.split(minutes, ":", -1)
    mm_txt, ss_txt = F.get(parts, 0), F.get(parts, 1)
    mm_ok = mm_txt.rlike(_MINUTES_OK)
    ss_ok = ss_txt.rlike(_MINUTES_OK)
    mm = F.trim(mm_txt).try_cast("double")
    ss = F.trim(ss_txt).try_cast("double")
    value = F.floor(mm * 60) + ss
    # Python's int() truncates toward zero; floor differs only for negatives.
    value = F.when(mm * 60 < 0, F.ceil(mm * 60) + ss).otherwise(value)
    # Out of integer range (or infinite): the database would refuse the row,
    # so it is a reject (null), not a failed job.
    seconds = F.round(value, 0).try_cast("int")
    return (
        F.when(minutes.isNull(), F.lit(None).cast("int"))
        .when(~mm_ok, F.lit(0))
        .when(ss_txt.isNull(), F.lit(None).cast("int"))
        .when(F.abs(mm * 60) == float("inf"), F.lit(None).cast("int"))  # the source fails before it reads the seconds
        .when(~ss_ok, F.lit(0))
        .otherwise(seconds)
    )


def minutes_reject_reason(minutes: Column, seconds: Column | None = None) -> Column:
    """Why the source would fail on a minutes value (null when it is accepted); ``seconds`` are its seconds where they are known."""
    parts = F.split(minutes, ":", -1)
    return (
        F.when(minutes.isNull(), F.lit("minutes is null"))
        .when(F.get(parts, 0).rlike(_MINUTES_OK) & F.get(parts, 1).isNull(), F.lit("minutes has no ':'"))
        .when((minutes_to_seconds(minutes) if seconds is None else seconds).isNull(), F.lit(SECONDS_REASON))
    )


_INT_MAX = 2147483647


def whole_number(value: Column) -> Column:
    """A double as an integer column stores it: rounded half away from zero; null beyond its range."""
    rounded = F.round(value, 0)
    return F.when(F.abs(rounded) <= _INT_MAX, rounded).cast("int")


def variant_number(v: Column) -> Column:
    """The number that a JSON value stands for: numbers, booleans as 1 and 0, texts of a number; null for any other."""
    return F.try_variant_get(v, "$", "double")


def variant_wrong_number(v: Column, number: Column) -> Column:
    """Whether a JSON value that is there and not JSON null gives no integer."""
    return F.coalesce(v.isNotNull() & ~F.is_variant_null(v) & whole_number(number).isNull(), F.lit(False))


def variant_truth(v: Column) -> Column:
    """Python's truth of a JSON value; false where there is none."""
    kind, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    return F.coalesce(F.when(F.is_variant_null(v), F.lit(False)).when(kind == "STRING", text != "")
                      .when(variant_number(v).isNotNull(), variant_number(v) != 0)
                      .otherwise(~F.to_json(v).isin("[]", "{}")), F.lit(False))


def game_code_from_path(path: Column) -> Column:
    """``.../E2023/12.json`` -> ``12E2023`` (file stem + parent folder)."""
    file_part = F.element_at(F.split(path, "/"), -1)
    folder = F.element_at(F.split(path, "/"), -2)
    stem = F.element_at(F.split(file_part, r"\."), 1)
    return F.concat(stem, folder)


def path_season(path: Column) -> Column:
    """Parent folder of a landing key (the season code)."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def path_file_number(path: Column) -> Column:
    """File number of a landing key, null when the name is not an integer."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"\.json", "").try_cast("long")
