from pyspark.sql import functions as F

from huddlekit.functions.markup import extract, infobox_pattern
from huddlekit.functions.personnel import parse_legacy

NBSP = "\u00a0"


def test_legacy_personnel_with_unicode_space(spark):
    df = spark.createDataFrame([(f"1{NBSP}RB, 1 TE, 3{NBSP}{NBSP}WR",)], "p string")
    p = parse_legacy("p")
    r = df.select(p["n_rb"].alias("rb"), p["n_te"].alias("te"), p["n_wr"].alias("wr")).first()
    assert (r.rb, r.te, r.wr) == (1, 1, 3)


def test_infobox_field_with_unicode_space(spark):
    box = f"{{{{Box\n| lead{NBSP}={NBSP}Ann Lee\n|{NBSP}aide = Bo\nCy\n}}}}"
    df = spark.createDataFrame([(box,)], "t string")
    r = df.select(F.trim(extract("t", infobox_pattern("lead"))).alias("lead"),
                  extract("t", infobox_pattern("aide")).alias("aide"),
                  extract("t", infobox_pattern("none")).alias("none")).first()
    assert (r.lead, r.aide, r.none) == ("Ann Lee", "Bo\nCy", None)
