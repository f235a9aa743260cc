"""Work that is dealt over tasks, however few files hold the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.plans import registry, views

SF = "/root/testdata/sf0.001"


def test_a_small_file_is_several_tasks(spark):
    assert views.table(spark, SF, "customer").rdd.getNumPartitions() == 1
    for rows in (views.sites(spark, SF), views.incoming(spark, SF), registry.QUERIES["battlefield_sites"](spark, SF)):
        busy = rows.groupBy(F.spark_partition_id()).count()
        assert busy.count() >= 4


def test_records_of_a_merge_are_normalised_once(spark):
    from placeweave.operators import batches, resolve

    ticks = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        ticks.add(1)
        return x

    rows = spark.range(50).select(
        "id", F.lit(None).cast("string").alias("nris_refnum"), F.lit("Old Mill").alias("name"), F.lit("TX").alias("state"), F.lit("Waco").alias("city"),
        F.concat((F.col("id") % 5).cast("string"), F.lit(" Elm Street")).alias("address"), *[F.lit(None).cast("double").alias(c) for c in ("latitude", "longitude")],
    )
    told = resolve.keyed(rows, "id")
    found = batches.assignments(told.withColumn("city_key", counted("city_key")), told.where("id < 3"), passes=(1, 2)).collect()
    assert ticks.value == 50  # before, once for each use of the records
    assert {r.record_id: r.site_id if r.site_id is not None else r.leader_id for r in found} == {k: k % 5 for k in range(50)}
    assert {r.score for r in found if not r.inserted and r["pass"] == 2} == {100.0}
