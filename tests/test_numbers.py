from pyspark.sql import functions as F

from huddlekit.functions.exprs import to_double, to_long


def test_number_suffixes_are_junk(spark):
    texts = ["8658d", "1f", "2.D", "3F", "0x10", "8658.0", " 7 ", "1e3", None, ""]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select(
        to_long(F.col("s")).alias("n"), to_double(F.col("s")).alias("x")).collect()
    assert [r["n"] for r in got] == [None, None, None, None, None, 8658, 7, 1000, None, None]
    assert [r["x"] for r in got] == [None, None, None, None, None, 8658.0, 7.0, 1000.0, None, None]
