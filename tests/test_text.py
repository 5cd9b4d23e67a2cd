import pytest

from dockwatch.functions import text as X
from dockwatch.sources import lake


def apply(spark, build, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.v for r in df.select("i", build("t").alias("v")).orderBy("i").collect()]


def test_soft_int(spark):
    assert apply(spark, X.soft_int, ["", " 12 ", "-3", "12.5", "1e3", "NaN", "abc", None, "99999999999999999999"]) == [
        None, 12, -3, None, None, None, None, None, None]


def test_soft_double(spark):
    assert apply(spark, X.soft_double, ["", " 12 ", "-3", "12.5", "1e3", "NaN", "abc", None, "1."]) == [
        None, 12.0, -3.0, 12.5, None, None, None, None, None]


def test_coords(spark):
    values = ["48.8, 2.3", "48.8", "", None]
    assert apply(spark, lambda c: X.split_coords(c)[0], values) == [48.8, 48.8, None, None]
    assert apply(spark, lambda c: X.split_coords(c)[1], values) == [2.3, None, None, None]


def test_whitespace(spark):
    values = ["A  B", "A\tB", "A  B", " A ", None, "A B"]
    assert apply(spark, X.squash_ws, values) == ["A B", "A B", "A  B", "A", None, "A B"]
    assert apply(spark, X.has_extra_ws, values) == [True, False, False, True, None, False]


def test_codes(spark):
    values = ["1001", "75056", "750561", "", None, " 92012 "]
    assert apply(spark, X.pad_code, values) == ["01001", "75056", "75056", None, None, "92012"]
    assert apply(spark, lambda c: X.dept_of(X.pad_code(c)), values) == ["01", "75", "75", None, None, "92"]


def test_flags(spark):
    assert apply(spark, X.flag01, ["0", "1", " 1 ", "x", None]) == [False, True, True, None, None]
    assert apply(spark, X.flag_yes_no, ["OUI", "non", "?", None]) == [True, False, None, None]


@pytest.mark.parametrize("types, mechanical, ebike", [
    ('[{"mechanical": 8}, {"ebike": 1}]', "8", "1"),
    ('[{"ebike": 1}, {"mechanical": 8}]', "8", "1"),
    ("[{}, {}]", None, None),
    ('[{"mechanical": 3}]', "3", None),
    ('[{"cargo": 2}, {"ebike": 5}]', None, "5"),
    ('[{"ebike": 5}, {"ebike": 6}]', None, "6"),
    ("null", None, None),
])
def test_types_of_a_message(spark, types, mechanical, ebike):
    message = '{"station_id": 7, "stationCode": null, "num_bikes_available_types": %s}' % types
    row = lake.flatten_raw_status(spark.createDataFrame([(message,)], "value string")).first()
    assert (row.station_id, row.station_code, row.bikes_mechanical, row.bikes_electric) == ("7", None, mechanical, ebike)


def test_percentage_and_status(spark):
    df = spark.createDataFrame([(0, 0), (1, 8), (3, 7)], "a long, n long")
    assert [r[0] for r in df.select(X.pct("a", "n")).collect()] == [None, 12.5, 42.86]
    pairs = spark.createDataFrame([(5, 0), (5, 2), (5, 5), (0, 0)], "b long, a long")
    assert [r[0] for r in pairs.select(X.compare_status("b", "a")).collect()] == ["OK", "reduced", "accepted", "OK"]
