"""Registered queries that run as streams: tables land in drops, a stream reads each, the result is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.plans import views
from placeweave.plans.registry import query
from placeweave.session import shared_folder
from placeweave.streaming import incremental, master


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _written(stream: DataFrame, folder: str, mode: str = "append"):
    return stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").trigger(availableNow=True).start()


_DROPS = 3


@query(
    f"""
WITH r AS (SELECT o_custkey AS ref, o_orderkey % {_DROPS} AS drop_no, o_orderkey AS seen, CASE WHEN o_orderkey % 4 = 0 THEN 'name ' || o_orderkey WHEN o_orderkey % 4 = 1 THEN '' END AS name,
  CASE WHEN o_orderkey % 7 = 0 THEN 'city ' || o_orderkey END AS city, o_orderkey % 11 = 0 AS flag FROM orders WHERE o_custkey IS NOT NULL)
SELECT ref, arg_min(name, (drop_no, seen)) FILTER (WHERE name <> '') AS name, arg_min(city, (drop_no, seen)) FILTER (WHERE city <> '') AS city, bool_or(flag) AS flag FROM r GROUP BY ref"""
)
def streamed_master(spark, sf_dir):
    """All orders in three drops, upserted by customer into a master table by a stream."""
    k = F.col("o_orderkey")
    rows = views.table(spark, sf_dir, "orders").where("o_custkey is not null").select(
        F.col("o_custkey").alias("ref"), F.when(k % 4 == 0, F.concat(F.lit("name "), k.cast("string"))).when(k % 4 == 1, "").alias("name"),
        F.when(k % 7 == 0, F.concat(F.lit("city "), k.cast("string"))).alias("city"), (k % 11 == 0).alias("flag"), k.alias("at"),
    )
    folder = _folder(spark)
    drops = [rows.where(F.col("at") % _DROPS == n) for n in range(_DROPS)]
    master.landed_in_turn(drops, f"{folder}/in", lambda s: master.upsert_stream(s, f"{folder}/master", f"{folder}/checkpoint", "ref", "at", ["flag"]))
    return master.read_master(spark, f"{folder}/master")


#: Deliveries: everything, a fifth again five minutes later, a seventh with another value.
_DELIVERED = """
WITH landed AS (
  SELECT 0 AS drop_no, event_id, ts, 'v' || event_type AS v FROM events
  UNION ALL SELECT 1, event_id, ts + INTERVAL 5 MINUTE, 'v' || event_type FROM events WHERE event_id % 5 = 0
  UNION ALL SELECT 2, event_id, ts + INTERVAL 1 HOUR, 'changed' FROM events WHERE event_id % 7 = 0),
marks AS (SELECT d.drop_no, (SELECT max(ts) FROM landed l WHERE l.drop_no < d.drop_no) AS newest FROM (SELECT DISTINCT drop_no FROM landed) d),
"""


def _deliveries(spark, sf_dir) -> list[DataFrame]:
    events = views.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    told = F.concat(F.lit("v"), "event_type")
    minutes = lambda n: F.col("ts") + F.expr(f"INTERVAL {n} MINUTES")
    return [
        events.select("event_id", "ts", told.alias("v")),
        events.where("event_id % 5 = 0").select("event_id", minutes(5).alias("ts"), told.alias("v")),
        events.where("event_id % 7 = 0").select("event_id", minutes(60).alias("ts"), F.lit("changed").alias("v")),
    ]


@query(
    _DELIVERED
    + """admitted AS (SELECT l.* FROM landed l JOIN marks USING (drop_no) WHERE newest IS NULL OR ts > newest - INTERVAL 3 DAY)
SELECT event_id, v, CAST(min(drop_no) AS INTEGER) AS first_drop FROM admitted GROUP BY event_id, v"""
)
def streamed_redelivery(spark, sf_dir):
    """Each delivered row once; what comes after the watermark is late and goes."""
    folder = _folder(spark)
    drops = [d.withColumn("drop_no", F.lit(n)) for n, d in enumerate(_deliveries(spark, sf_dir))]

    def run(stream):
        marked = stream.withWatermark("ts", "3 days").withColumn("checksum", F.sha2("v", 256))
        return _written(marked.dropDuplicatesWithinWatermark(["event_id", "checksum"]), folder)

    master.landed_in_turn(drops, f"{folder}/in", run)
    return spark.read.parquet(f"{folder}/out").select("event_id", "v", F.col("drop_no").alias("first_drop"))


@query(
    _DELIVERED
    + """admitted AS (SELECT l.*, time_bucket(INTERVAL '1 hour', ts) AS started FROM landed l JOIN marks USING (drop_no) WHERE newest IS NULL OR time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR > newest - INTERVAL 2 HOUR)
SELECT started, v, count(*) AS n FROM admitted WHERE started + INTERVAL 1 HOUR <= (SELECT max(ts) FROM landed) - INTERVAL 2 HOUR GROUP BY 1, 2"""
)
def streamed_windows(spark, sf_dir):
    """Events of an hour in closed windows: rows of windows that the watermark has passed are late."""
    folder = _folder(spark)
    master.landed_in_turn(_deliveries(spark, sf_dir), f"{folder}/in", lambda s: _written(incremental.progress_windows(s.withColumnRenamed("v", "stage"), "stage", "ts"), folder))
    return spark.read.parquet(f"{folder}/out").select("started", F.col("stage").alias("v"), "n")
