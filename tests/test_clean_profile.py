import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, profile, scale


def test_sanitize_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c-d` int")
    assert clean.sanitize_columns(df).columns == ["ab", "cd"]
    with pytest.raises(ValueError):
        clean.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `ab` int"))


def test_nonfinite_and_replace(spark):
    df = spark.createDataFrame([(1, float("nan"), "x,y"), (2, float("inf"), "z"), (3, 1.5, None)],
                               "ID long, v double, s string")
    out = clean.nonfinite_to_null(df).collect()
    assert [r["v"] for r in out] == [None, None, 1.5]
    rep = clean.replace_values(df, {"s": {"z": "Z", None: "missing"}}).orderBy("ID").collect()
    assert [r["s"] for r in rep] == ["x,y", "Z", "missing"]
    assert clean.strip_commas(df).orderBy("ID").first()["s"] == "x y"


def test_label_encode_sorted_strings(spark):
    df = spark.createDataFrame([(1, "b"), (2, "10"), (3, "2"), (4, "b")], "ID long, y string")
    enc, mapping = clean.label_encode(df, "y")
    assert {r["ID"]: r["y"] for r in enc.collect()} == {1: 2, 2: 0, 3: 1, 4: 2}


def test_profile_and_modes(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.0, "b"), (3, 4.0, "b"), (4, 6.0, "a")],
                               "ID long, x double, c string")
    p = {r["metric"]: r["value"] for r in profile.profile(df).collect()}
    assert p == {"dataframe rows": 4, "missing.x": 1}
    modes = {r["metric"]: r["value"] for r in profile.column_modes(df, ["c"]).collect()}
    assert modes == {"stats.c_mode": "a"}  # tie -> smallest


def test_standardize_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "ID long, x double, k double")
    model = scale.fit_standard_scaler(df, ["x", "k"])
    assert model.means["x"] == 2.0 and math.isclose(model.stds["x"], 1.0)
    out = {r["ID"]: (r["x"], r["k"]) for r in model.transform(df).collect()}
    assert out[1] == (-1.0, 0.0) and out[3] == (None, 0.0)


def test_schema_report_dtype_histogram_selectors(spark):
    df = spark.createDataFrame([(1, 2.0, "a", True)], "ID long, x double, c string, b boolean")
    rep = {r["column"]: r["dtype"] for r in profile.schema_report(df).collect()}
    assert rep == {"ID": "bigint", "x": "double", "c": "string", "b": "boolean"}
    hist = {r["metric"]: r["value"] for r in profile.dtype_histogram(df, "predfs").collect()}
    assert hist["dtypes.predfs.bigint"] == 1 and hist["dtypes.predfs.string"] == 1
    assert clean.numeric_columns(df, ["ID"]) == ["x"]
    assert clean.categorical_columns(df) == ["c", "b"]
    assert clean.align_columns(df, ["c", "ID"]).columns == ["c", "ID"]
    assert clean.select_columns(df, "ID,%20x").columns == ["ID", "x"]
    assert clean.select_complement(df, "c").columns == ["ID", "x", "b"]


def test_replacements_of_another_type_and_the_text_null(spark):
    from tabforge.operators import clean
    df = spark.createDataFrame([(1, "Y", 3), (2, "N", None), (3, "null", 5), (4, None, 7), (5, "x", 7)], "ID int, s string, n int")
    got = {r["ID"]: r["s"] for r in clean.replace_values(df, {"s": {"Y": 1, "N": 0}}).collect()}
    assert got == {1: "1", 2: "0", 3: "null", 4: None, 5: "x"}
    got = {r["ID"]: r["s"] for r in clean.replace_values(df, {"s": {"null": "text", None: "gone"}}).collect()}
    assert got == {1: "Y", 2: "N", 3: "text", 4: "gone", 5: "x"}
    got = {r["ID"]: r["n"] for r in clean.replace_values(df, {"n": {"7": 0.5, "null": 9}}).collect()}
    assert got == {1: 3.0, 2: 9.0, 3: 5.0, 4: 0.5, 5: 0.5}
    got = {r["ID"]: r["n"] for r in clean.replace_values(df, {"n": {"7": "many"}}).collect()}
    assert got == {1: "3", 2: None, 3: "5", 4: "many", 5: "many"}
