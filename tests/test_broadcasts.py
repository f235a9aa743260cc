"""What the driver gets of large tables."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from placeweave.plans import registry
from placeweave.session import with_settings

SF = Path("/root/testdata/sf0.001")


def _broadcast(df) -> int:
    """Bytes of the largest table that the driver built for a join."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        elif kind == "BroadcastExchangeExec":
            most = max(most, plan.metrics().apply("dataSize").value())
        todo += [plan.children().apply(k) for k in range(plan.children().size())]
    return most


def test_many_rows_of_a_small_file_are_not_broadcast(spark, tmp_path):
    """60,000 sites whose file is small do not go to the driver, and fixed tables are still no shuffle."""
    for path in SF.glob("*.parquet"):
        if path.stem != "customer":
            (tmp_path / path.name).symlink_to(path)
    customers = spark.range(60_000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"))
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    pairs = registry.QUERIES["address_matches"](spark, str(tmp_path)).groupBy().count()
    assert 0 <= _broadcast(pairs) < 4 << 20
    states = registry.QUERIES["profile_coordinates"](spark, str(tmp_path))
    assert 0 < _broadcast(states) < 4 << 20


def test_a_session_keeps_its_own_bounds(spark):
    """Queries of other parts run under the bounds that the session has."""
    key, counted = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    own = spark.sparkContext.getConf().get(key, None)
    registry.QUERIES["priority_merge"](spark, str(SF))
    assert (spark.conf.get(key), spark.conf.get(counted)) == ("64k", "1m")
    with_settings(spark)
    assert spark.conf.get(key) == (own or "10485760b") and spark.conf.get(counted, None) is None
