from pyspark.sql import types as T

from basketlab.functions import casts


def test_column_to_int(spark):
    df = spark.createDataFrame([(12.9,), (-12.9,)], "x double")
    out, ok = casts.column_to_int(df, "x")
    assert ok and [r.x for r in out.collect()] == [12, -12]
    for bad in [[(1.0,), (None,)], [(1.0,), (float("nan"),)]]:
        df = spark.createDataFrame(bad, "x double")
        out, ok = casts.column_to_int(df, "x")
        assert not ok and out.schema["x"].dataType == T.DoubleType()
    df = spark.createDataFrame([("1",), ("abc",)], "x string")
    out, ok = casts.column_to_int(df, "x")
    assert not ok and out.schema["x"].dataType == T.StringType()
    df = spark.createDataFrame([("12.9",)], "x string")   # like int('12.9'): fails
    assert casts.column_to_int(df, "x")[1] is False


def test_column_to_date(spark):
    df = spark.createDataFrame([("2020-01-02",), (None,)], "x string")
    out, ok = casts.column_to_date(df, "x")
    assert ok and out.schema["x"].dataType == T.DateType()
    assert [str(r.x) for r in out.collect()] == ["2020-01-02", "None"]
    df = spark.createDataFrame([("2020-01-02",), ("zz",)], "x string")
    out, ok = casts.column_to_date(df, "x")
    assert not ok and out.schema["x"].dataType == T.StringType()
    df = spark.createDataFrame([("02/01/2020",)], "x string")
    out, ok = casts.column_to_date(df, "x", "dd/MM/yyyy")
    assert ok and str(out.first().x) == "2020-01-02"


def test_convert_columns_flags_each_column(spark):
    df = spark.createDataFrame([(1.5, "2020-01-02", "a", None), (2.0, None, "b", "x")],
                               "i double, d string, bad string, n string")
    out, ok = casts.convert_columns(df, [("i", "int"), ("d", "date"), ("bad", "int"),
                                         ("n", "date", "yyyy")])
    assert ok == {"i": True, "d": True, "bad": False, "n": False}
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types == {"i": T.LongType(), "d": T.DateType(), "bad": T.StringType(),
                     "n": T.StringType()}
    assert [r.i for r in out.orderBy("bad").collect()] == [1, 2]
    empty, ok = casts.convert_columns(df.limit(0), [("bad", "int")])
    assert ok == {"bad": True} and empty.schema["bad"].dataType == T.LongType()
