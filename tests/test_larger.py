"""What only larger tables show: ties, late years, repeated names."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions import normalize as Z
from placeweave.plans import registry


def test_epoch_beyond_year_9999(spark):
    """F8: the year comes without a sign, and no number fails the query."""
    rows = spark.createDataFrame([(699_999_999_300_000,), (10**17,), (0,)], "v long")
    got = [x[0] for x in rows.select(Z.epoch_ms_to_iso(F.col("v").cast("string"))).collect()]
    assert got == ["24152-02-12", None, "1970-01-01"]


def test_first_category_of_one_arrival(spark, tmp_path):
    """of rows of one arrival the one stored first stays, whichever file Spark reads first."""
    cols = "l_orderkey long, l_partkey long, l_linenumber int, l_discount double"
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    for name, rows in (("a", [(0, 0, 1, 0.01)]), ("b", [(0, 0, 1, 0.09)] + [(k, k, 1, 0.05) for k in range(1, 5000)])):
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(str(tmp_path / name))
        next((tmp_path / name).glob("*.parquet")).rename(folder / f"{name}.parquet")
    got = registry.QUERIES["keep_first_categories"](spark, str(tmp_path)).where("site_id = 0 and category = 0").collect()
    assert [round(x.confidence, 6) for x in got] == [0.9]


def _planned_rows(df) -> int:
    """Most rows that an operator of the executed plan gave."""
    df.collect()
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif plan.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(plan.plan())
        if plan.metrics().contains("numOutputRows"):
            most = max(most, plan.metrics().apply("numOutputRows").value())
        todo += [plan.children().apply(k) for k in range(plan.children().size())]
    return most


def test_name_scores_join_distinct_names(spark, tmp_path):
    """ten thousand parts of few names make few pairs."""
    spark.range(10_000).select(F.concat(F.lit("red bolt "), (F.col("id") % 4).cast("string")).alias("p_name"), F.lit(1).alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    got = registry.QUERIES["name_scores"](spark, str(tmp_path))
    assert got.count() == 16
    assert _planned_rows(got) <= 20_000
