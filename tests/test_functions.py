import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from clickflow.functions import jsons, numbers, text, times


@pytest.fixture
def apply(spark):
    """Results of a column function over a list of single values."""

    def run(function, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [row.r for row in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]

    return run


def test_emptiness(apply):
    assert apply(text.is_empty, [None, "", "a"]) == [True, True, False]
    assert apply(text.is_not_empty, [None, "", "a"]) == [False, False, True]


def test_trim_comma_drops_at_most_one_on_each_side(apply):
    values = [",a,", "a,b", ",,a,,", ",", ",,", "", "a,\n"]
    assert apply(text.trim_comma, values) == ["a", "a,b", ",a,", "", "", "", "a,\n"]


def test_pad_two(apply):
    assert apply(text.pad_two, ["1", "12", "123", ""]) == ["01", "12", "0123", "0"]


def test_csv_to_ids(apply):
    assert apply(text.csv_to_ids, ["1,2,", "", None, "7", "5,,,"]) == [[1, 2], None, None, [7], [5]]


@pytest.mark.parametrize("bad", ["x", "1,,2", ",1", "1,x"])
def test_csv_to_ids_rejects_other_tokens(apply, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(text.csv_to_ids, [bad])


def test_any_of(apply):
    values = ["a", "b,c", "bc", "", None]
    assert apply(lambda c: text.any_of(c, ["a", "c"]), values) == [True, True, False, False, None]
    assert apply(lambda c: text.any_of(c, []), ["a"]) == [False]


def test_kv_encode_writes_null_as_text(spark):
    df = spark.sql("SELECT 'a' AS x, CAST(NULL AS INT) AS y, '' AS z")
    record = text.kv_encode([("x", F.col("x")), ("y", F.col("y")), ("z", F.col("z"))])
    assert df.select(record).first()[0] == "x=a|y=null|z="


def test_kv_get(apply):
    values = ["k=1|j=2", "k=|j=2", "k=1|k=2", "j=2", "", None, "k", "k=a=b", "k=1=", "kk=3|k=4", "k==1"]
    expected = ["1", None, "1", None, None, None, None, None, "1", "4", None]
    assert apply(lambda c: text.kv_get(c, "|", "k"), values) == expected
    assert apply(lambda c: text.kv_get(c, ".", "k"), ["j=2.k=1"]) == ["1"]


def test_kv_set(apply):
    values = ["k=1|j=2", "j=2", "k=1|k=2", "k|j=1", "j=1|k=a=b", "k=1||", ""]
    expected = ["k=9|j=2", "j=2", "k=9|k=2", "k=9|j=1", "j=1|k=9", "k=9", ""]
    assert apply(lambda c: text.kv_set(c, "|", "k", "9"), values) == expected
    assert apply(lambda c: text.kv_set(c, ";", "k", "9"), ["j=1;k=2"]) == ["j=1|k=9"]


def test_split_csv():
    assert text.split_csv(None) is None
    assert text.split_csv("") is None
    assert text.split_csv("a,,b,") == ("a", "b")


def test_parse_time_accepts_one_digit_parts(apply):
    good = dt.datetime(2019, 1, 5, 8, 12, 33)
    values = ["2019-01-05 8:12:33", "2019-1-5 08:12:33", "x", None]
    assert apply(times.parse_time, values) == [good, good, None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        apply(times.parse_time_strict, ["x"])


def test_comparisons_of_time_text(spark):
    rows = [("2019-01-05 8:00:00", "2019-01-05 09:00:00"), ("2019-01-05 09:00:00", "bad"), ("b", "a")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        times.before(F.col("a"), F.col("b")).alias("before"),
        times.after(F.col("a"), F.col("b")).alias("after"),
        times.minus(F.col("a"), F.col("b")).alias("minus"),
    )
    assert [tuple(r) for r in df.collect()] == [(True, False, -3600), (False, False, 0), (False, False, 0)]
    assert df.schema["minus"].dataType.simpleString() == "int"


def test_formats(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2019-01-05 08:02:03.9' AS t, DATE'2019-01-05' AS d")
    row = df.select(
        times.format_time(F.col("t")).alias("time"),
        times.format_date(F.col("t")).alias("day"),
        times.date_hour(times.format_time(F.col("t"))).alias("hour"),
        times.today(F.col("d")).alias("today"),
        times.yesterday(F.col("d")).alias("yesterday"),
        (times.today() >= "2024-01-01").alias("clock"),
        (times.yesterday() < times.today()).alias("order"),
    ).first()
    assert tuple(row) == (
        "2019-01-05 08:02:03", "2019-01-05", "2019-01-05_08", "2019-01-05", "2019-01-04", True, True,
    )


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = "2024-03-10 02:30:00"  # skipped by daylight saving time
        df = spark.sql(f"SELECT TIMESTAMP_NTZ'{gap}' AS t")
        assert df.select(times.format_time(F.col("t"))).first()[0] == gap
        long = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:59:59' AS a, TIMESTAMP_NTZ'2024-03-10 03:00:00' AS b")
        assert long.select(times.seconds_between(F.col("b"), F.col("a"))).first()[0] == 3601
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_hour_is_textual(apply):
    assert apply(times.date_hour, ["2019-01-05 8:12:33"]) == ["2019-01-05_8"]


def test_ratio(spark):
    df = spark.createDataFrame([(57, 200), (1, 3), (2, 3), (0, 0), (0, 5), (5, 5)], "p bigint, t bigint")
    assert [r[0] for r in df.select(numbers.ratio("p", "t")).collect()] == [0.29, 0.33, 0.67, 0.0, 0.0, 1.0]


def test_format_double_rounds_the_exact_binary_value(apply):
    random.seed(7)
    values = [0.285, 0.125, -0.125, 1.115, 1.005, 0.0, 1e-300, 123456789.125, 9e15 + 1, 1e300, 0.005, 0.015]
    values += [random.uniform(-2, 2) for _ in range(300)]
    values += [random.randint(0, 400) / 200 for _ in range(100)]
    values += [random.uniform(0, 1) * 10 ** random.randint(-20, 16) for _ in range(300)]
    for scale in (0, 2, 6):
        unit = Decimal(1).scaleb(-scale)
        expected = []
        for value in values:
            big = abs(value) >= 2**53 / 10**scale
            expected.append(value if big else float(Decimal(value).quantize(unit, ROUND_HALF_UP)))
        assert apply(lambda c, s=scale: numbers.format_double(c, s), values, "double") == expected


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_format_double_raises_on_non_numbers(apply, bad):
    with pytest.raises(Exception, match="cannot round"):
        apply(lambda c: numbers.format_double(c, 2), [bad], "double")


def test_format_double_keeps_null(apply):
    assert apply(lambda c: numbers.format_double(c, 2), [None], "double") == [None]


def test_json_reads(apply):
    assert apply(lambda c: jsons.first_of_array(c, "f"), ['{"f":["a","b"]}', '{"f":[]}', "{}"]) == ["a", None, None]
    assert apply(lambda c: jsons.field_of_first(c, "k"), ['[{"k":"v"},{"k":"w"}]', "[]"]) == ["v", None]
