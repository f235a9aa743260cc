"""A master table that micro-batches upsert (R01): leaves of hashed keys and a manifest.

A leaf holds the rows whose key's hash ends in ``depth`` bits of ``value``; one that
grows beyond its limit is split by further bits when it is written.  A manifest is a small
table of leaves, one for each version: a batch reads and writes the leaves of its keys, lists them
in the next manifest beside the untouched ones, and drops what no kept version lists.
Manifests are DataFrames as well; the driver sees the paths that a batch touches.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from placeweave.operators.tables import upsert_first_wins
from placeweave.session import staged

#: Rows of a leaf before it is split, and versions that stay readable.
LEAF_ROWS, KEPT = 200_000, 2
#: Leaves of rows without a key, one a batch, are put together beyond so many.
LOOSE = 16
_MANIFEST = "depth int, value long, path string, rows long, schema string"


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def versions(spark: SparkSession, master: str) -> list[int]:
    """The complete versions of the table, the oldest first."""
    fs, path = _folder(spark, f"{master}/manifest")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if n.startswith("v=") and fs.exists(_folder(spark, f"{master}/manifest/{n}/_SUCCESS")[1])]
    return sorted(int(n[2:]) for n in done)


def manifest(spark: SparkSession, master: str, version: int) -> DataFrame:
    """(depth, value, path, rows, schema): a row for each leaf; a depth of -1 is one of rows without a key."""
    return spark.read.schema(_MANIFEST).parquet(f"{master}/manifest/v={version}")


def _low_bits(h: Column, depth: Column) -> Column:
    return h.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), depth) - 1)


def _in_leaves(rows: DataFrame, leaves: DataFrame, key: str) -> DataFrame:
    """``rows`` with __h, depth and value of the leaf of their key.

    A key meets the leaves once for each depth that occurs, which are few.
    """
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]  # 64 at most
    spread = rows.withColumn("__h", F.xxhash64(key)).withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    spread = spread.withColumn("value", _low_bits(F.col("__h"), F.col("depth")))
    return spread.join(leaves.select("depth", "value"), ["depth", "value"])


def _read(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_master(spark: SparkSession, master: str, version: int | None = None) -> DataFrame:
    """The table at a kept version, the newest by default."""
    leaves = manifest(spark, master, versions(spark, master)[-1] if version is None else version)
    rows = leaves.collect()  # a row a leaf
    return _read(spark, [r["path"] for r in rows if r["path"]], StructType.fromJson(json.loads(rows[0]["schema"])))


def upsert(spark: SparkSession, master: str, batch: DataFrame, number: int, key: str, order: str, flags: list[str], leaf_rows: int = LEAF_ROWS) -> None:
    """Merge batch ``number`` into the table as its next version.

    Existing non-empty values stay, empty ones are filled, flags are or-ed; rows without a key
    are added.  A version that is there is not written again, so a repeated batch changes nothing;
    what a lost attempt wrote is overwritten.
    """
    known = versions(spark, master)
    if known and known[-1] >= number:
        return
    schema = batch.drop(order).schema
    told = schema.json()
    now = manifest(spark, master, known[-1]) if known else spark.createDataFrame([(0, 0, None, 0, told)], _MANIFEST)
    keyed_leaves = staged(now.where("depth >= 0"))
    fresh = staged(batch)
    touched = staged(_in_leaves(fresh.where(F.col(key).isNotNull()).select(key).distinct(), keyed_leaves, key).select("depth", "value").distinct())
    leaves = keyed_leaves.join(touched, ["depth", "value"], "left_semi")
    loose = [r["path"] for r in now.where("depth < 0 and path is not null").select("path").collect()]  # LOOSE at most
    merge_loose = len(loose) >= LOOSE
    paths = [r["path"] for r in leaves.where("path is not null").select("path").collect()]  # of the leaves the batch touches
    merged = upsert_first_wins(_read(spark, paths, schema), fresh.where(F.col(key).isNotNull()), key, order, flags).select(*schema.names)
    placed = staged(_in_leaves(merged, leaves, key))
    # a leaf that is too large is cut by as many further bits as make its parts small
    sizes = placed.groupBy("depth", "value").agg(F.count("*").alias("n"))
    deeper = sizes.withColumn("to", F.least(F.lit(62), F.col("depth") + F.ceil(F.log2(F.greatest(F.col("n") / leaf_rows, F.lit(1.0)))).cast("int"))).drop("n")
    cut = placed.join(deeper, ["depth", "value"]).withColumn("value", _low_bits(F.col("__h"), F.col("to"))).withColumn("depth", F.col("to"))
    rest = fresh.where(F.col(key).isNull()).select(*schema.names)
    rest = rest.unionByName(_read(spark, loose, schema)) if merge_loose else rest
    named = cut.select(*schema.names, F.concat_ws("_", "depth", "value").alias("leaf")).unionByName(rest.withColumn("leaf", F.lit(f"-1_{number}")))
    target = f"{master}/data/v={number}"
    named.repartition("leaf").write.mode("overwrite").partitionBy("leaf").parquet(target)
    # split leaves without a row of their own stay listed, so that every key has a leaf
    listed = deeper.where("to > depth").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("shiftleft(1L, to - depth) - 1")))).select(F.col("to").alias("depth"), (F.col("value") + F.expr("shiftleft(k, depth)")).alias("value"))
    listed = listed.unionByName(deeper.where("to = depth").select("depth", "value"))
    found = spark.read.parquet(target).groupBy("leaf").agg(F.count("*").alias("rows")) if not named.isEmpty() else spark.createDataFrame([], "leaf string, rows long")
    found = found.select(F.split("leaf", "_")[0].cast("int").alias("depth"), F.split("leaf", "_")[1].cast("long").alias("value"), F.concat(F.lit(f"{target}/leaf="), "leaf").alias("path"), "rows")
    added = listed.join(found, ["depth", "value"], "left").unionByName(found.where("depth < 0")).select("depth", "value", "path", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.lit(told).alias("schema"))
    kept = keyed_leaves.join(touched, ["depth", "value"], "left_anti").unionByName(now.where("depth < 0") if not merge_loose else now.limit(0))
    kept.unionByName(added).coalesce(1).write.mode("overwrite").parquet(f"{master}/manifest/v={number}")
    drop_old(spark, master)


def drop_old(spark: SparkSession, master: str, keep: int = KEPT) -> None:
    """Remove versions before the last ``keep`` and the leaves that only they list."""
    known = versions(spark, master)
    if len(known) <= keep:
        return
    listed = manifest(spark, master, known[-keep])
    for v in known[-keep + 1 :]:
        listed = listed.unionByName(manifest(spark, master, v))
    for v in known[:-keep]:
        gone = manifest(spark, master, v).where("path is not null").select("path").join(listed.select("path"), "path", "left_anti")
        for r in gone.collect():  # the leaves that one batch touched
            fs, path = _folder(spark, r["path"])
            fs.delete(path, True)
        fs, path = _folder(spark, f"{master}/manifest/v={v}")
        fs.delete(path, True)


def upsert_stream(stream: DataFrame, master: str, checkpoint: str, key: str, order: str, flags: list[str], leaf_rows: int = LEAF_ROWS) -> StreamingQuery:
    """Merge every micro-batch into the table and stop when all is read."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, master, batch, number, key, order, flags, leaf_rows)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed_in_turn(drops: list[DataFrame], folder: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land one drop after the other and let a stream read each before the next comes."""
    for k, drop in enumerate(drops):
        drop.write.mode("overwrite").parquet(f"{folder}/drop={k}")
        stream = drop.sparkSession.readStream.schema(drop.schema).option("recursiveFileLookup", True).parquet(folder)
        run(stream).awaitTermination()
