import pytest

from hourmill.functions.names import pick, prefix_columns, require, snake_columns, snake_name


@pytest.mark.parametrize(
    "raw,clean",
    [
        (" C CustKey ", "c_custkey"),
        ("Acct.Bal ($)", "acct_bal"),
        ("__MKT Segment__", "mkt_segment"),
        ("wind_speed_10m", "wind_speed_10m"),
        ("A--b  c", "a_b_c"),
        ("readingDate", "readingdate"),
    ],
)
def test_snake_name(raw, clean):
    assert snake_name(raw) == clean


def test_snake_columns_one_projection(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "C-D"])
    out = snake_columns(df)
    assert out.columns == ["a_b", "c_d"]
    assert out.collect()[0] == (1, 2)


def test_snake_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError, match="both clean"):
        snake_columns(df)


def test_pick_ignores_missing_and_repeats(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert pick(df, ["c", "zz", "a", "c"]).columns == ["c", "a"]


def test_require(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    require(df, ["a"])
    with pytest.raises(ValueError, match=r"energy lacks price; it has "):
        require(df, ["a", "price"], "energy")


def test_prefix_non_keys(spark):
    df = spark.createDataFrame([(1, 2.0)], ["timestamp", "pm10"])
    assert prefix_columns(df, "aq_").columns == ["timestamp", "aq_pm10"]
