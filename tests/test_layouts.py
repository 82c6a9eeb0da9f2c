"""Layout guard over every declared table, and the guard's own refusals."""
import pytest
from pyspark.sql import types as T

from huddlekit.operators.contracts import ADP_SCHEMA
from huddlekit.operators.fingerprint import FINGERPRINT_SCHEMA
from huddlekit.operators.jobs import ADP_CLUSTER, BRIDGE_SCHEMA, COORDINATOR_CLUSTER, COORDINATOR_SCHEMA
from huddlekit.plans.streams import SNAPSHOT_SCHEMA
from huddlekit.sources.store import check_layout

FP = T.StructType([T.StructField(c, T.DoubleType() if t == "double" else
                                 (T.LongType() if t == "bigint" else T.StringType()))
                   for c, t in FINGERPRINT_SCHEMA])

LAYOUTS = {
    "ff_adp": (ADP_SCHEMA, ("snapshot_date",), ADP_CLUSTER),
    "ff_player_xref": (BRIDGE_SCHEMA, (), ()),
    "nfl_coordinators": (COORDINATOR_SCHEMA, (), COORDINATOR_CLUSTER),
    "team_scheme_week": (FP, ("season",), ("week", "team")),
    "event_snapshots": (SNAPSHOT_SCHEMA, ("capture_day",), ("event_id",)),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_declared_layouts_are_valid(name):
    schema, part, clus = LAYOUTS[name]
    check_layout(schema, part, clus, table=name)


def test_guard_refuses_bad_layouts():
    s = T.StructType([T.StructField("week", T.DoubleType()), T.StructField("a", T.StringType())])
    with pytest.raises(ValueError, match="type double"):
        check_layout(s, (), ("week",))
    with pytest.raises(ValueError, match="not declared"):
        check_layout(s, ("season",), ())
    with pytest.raises(ValueError, match="at most 4"):
        check_layout(s, (), ("a",) * 5)


def test_season_scoped_check_prunes_partitions(spark, tmp_path):
    import uuid

    from huddlekit.operators.quality import reconcile_check
    from huddlekit.sources.store import create_table_if_missing
    name = f"pw_{uuid.uuid4().hex[:10]}"
    schema = T.StructType([T.StructField("fantasy_points_standard", T.DoubleType()),
                           T.StructField("receptions", T.LongType()),
                           T.StructField("fantasy_points_ppr", T.DoubleType()),
                           T.StructField("season", T.LongType())])
    create_table_if_missing(spark, name, schema, partition_by=("season",), location=str(tmp_path / name))
    spark.createDataFrame([(10.0, 2, 12.0, 2024), (5.0, 1, 9.0, 2025)], schema).write.insertInto(name)
    out = reconcile_check(spark.table(name), season=2025)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season#" in plan and "= 2025)" in plan
    r = out.first()
    assert (r.season, r.n, r.n_unreconciled, r.passed) == (2025, 1, 1, False)
