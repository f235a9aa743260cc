"""Session settings, and the package on the executors."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the library relies on; all of them can be changed while Spark runs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # texts are long: small batches keep the Python workers and the JVM small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

_PACKAGE = Path(__file__).resolve().parent


#: Where rows are few bytes but names, scores and addresses cost much: shuffled data for which a task is made.
LEAST_SHARE = "64k"
#: What Spark may broadcast there of what it reckons from files, and of what it has counted after a shuffle.
#: Names are far smaller in files than as rows, and letter pairs or cells that come out of a row are not reckoned, so
#: tables that were reckoned below Spark's ten megabytes were up to 430 in the driver.
LEAST_FILE, LEAST_COUNTED = "64k", "1m"


def with_settings(spark: SparkSession, least_share: str = "1m", least_file: str | None = None, least_counted: str | None = None) -> SparkSession:
    """Set what the library relies on; ``least_share`` is the least that Spark puts in a task after a shuffle.

    ``least_file`` and ``least_counted`` bound what is broadcast; without them the session's own bounds hold.
    """
    at_start = spark.sparkContext.getConf()
    broadcast = {"spark.sql.autoBroadcastJoinThreshold": least_file, "spark.sql.adaptive.autoBroadcastJoinThreshold": least_counted}
    broadcast = {key: value or at_start.get(key, None) for key, value in broadcast.items()}
    for key, value in {**SETTINGS, "spark.sql.adaptive.coalescePartitions.minPartitionSize": least_share, **broadcast}.items():
        if value is None:
            spark.conf.unset(key)
        elif spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's modules to the executors, once per Spark context.

    A cluster where the package is installed does not need it; elsewhere Python
    workers import it from the file that Spark distributes.
    """
    context = spark.sparkContext
    if getattr(context, "_placeweave_shipped", False):
        return spark
    target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{_PACKAGE.name}_modules.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for module in sorted(_PACKAGE.rglob("*.py")):
            archive.write(module, module.relative_to(_PACKAGE.parent))
    context.addPyFile(str(target))
    context._placeweave_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's checkpoint folder.

    ``spark.checkpoint.dir`` decides; only where it is unset and Spark runs on one
    machine (as in tests) a folder of our own is set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage, and what the table holds outlives lost executors.
    ``discard`` removes it; what a result still reads stays as long as the folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
