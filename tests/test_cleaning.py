from datetime import date, datetime

import pytest
from helpers import rows

from matchlake import schemas as s
from matchlake.operators import shaping

DECLARED = s.contract("""
    bigint     n
    double     x
    boolean    b
    date       d
    timestamp  t
    string     name
    json       payload
    string     absent
""")
TEXT = "n string, x string, b string, d string, t string, name string, payload string, extra string"


def cleaned(spark, **values):
    names = [f.split()[0] for f in TEXT.split(", ")]
    df = spark.createDataFrame([tuple(values.get(n) for n in names)], TEXT)
    return shaping.clean(df, DECLARED).first()


@pytest.mark.parametrize("text", ["NaN", "None", "Null", "nan", "null", ""])
def test_sentinels_become_null(spark, text):
    row = cleaned(spark, n=text, x=text, b=text, d=text, t=text, name=text, payload=text, extra=text)
    assert tuple(row)[:7] == (None,) * 7
    assert row["extra"] == text


@pytest.mark.parametrize("text, number", [
    ("12", 12), ("12.0", 12), ("12.7", None), ("abc", None), (" 12 ", 12), ("1e3", 1000),
    ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None),
    ("12.0000000000001", None), ("-3", -3),
])
def test_integers(spark, text, number):
    assert cleaned(spark, n=text)["n"] == number


@pytest.mark.parametrize("text, number", [
    ("1.5", 1.5), ("1e2", 100.0), ("12d", None), ("abc", None), ("7", 7.0),
])
def test_doubles(spark, text, number):
    assert cleaned(spark, x=text)["x"] == number


@pytest.mark.parametrize("text, moment", [
    ("2024-02-03", datetime(2024, 2, 3)),
    ("2024-02-03T04:05:06", datetime(2024, 2, 3, 4, 5, 6)),
    ("2024-02-03T04:05:06.789", datetime(2024, 2, 3, 4, 5, 6, 789000)),
    ("2024-02-03T04:05:06Z", datetime(2024, 2, 3, 4, 5, 6)),
    ("20240203", datetime(2024, 2, 3)),
    ("10:00:00", None), ("2024-13-45", None), ("soon", None),
])
def test_times(spark, text, moment):
    row = cleaned(spark, t=text, d=text)
    assert row["t"] == moment
    assert row["d"] == (moment and date(moment.year, moment.month, moment.day))


def test_json_is_left_alone_and_absent_columns_are_not_added(spark):
    row = cleaned(spark, payload='{"a": [1, null]}', name="NULL")
    assert row["payload"] == '{"a": [1, null]}'
    assert row["name"] == "NULL"
    assert "absent" not in row.asDict()


def test_lists_become_json_text(spark):
    df = spark.createDataFrame([([60.0, 40.0],)], "payload array<double>")
    assert shaping.clean(df, DECLARED).first()["payload"] == "[60.0,40.0]"


def test_strict_variant_fails_on_bad_numbers(spark):
    df = spark.createDataFrame([("abc",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shaping.clean(df, DECLARED, strict=True).collect()


def test_align_fills_drops_and_orders(spark):
    df = spark.createDataFrame([("x", 1)], "extra string, n int")
    aligned = shaping.align(df, DECLARED)
    assert aligned.columns == DECLARED.names
    assert aligned.schema["n"].dataType == DECLARED["n"].dataType
    assert rows(aligned) == [(1, None, None, None, None, None, None, None)]


def test_name_repair(spark):
    df = spark.createDataFrame([("N''Golo", None), ("O''Neil", "N''N''")], "player string, other string")
    fixed = shaping.repair_names(df, ["player", "other", "absent"])
    assert rows(fixed) == [("N'Golo", None), ("O''Neil", "N'N'")]
