"""Derived categories, request batches and replies (J13-J15, W-a, W-b, W-d, W-e, W14, K17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.constants import AREA_NATURES, ERAS
from placeweave.functions.scores import era_confidence
from placeweave.operators.tables import insert_or_ignore, numbered

#: Ids that are ranked together.
COARSE = 100_000


def eras(spark) -> DataFrame:
    rows = [(i + 1, *e) for i, e in enumerate(ERAS)]
    return spark.createDataFrame(rows, "era_no int, era string, era_start int, era_end int")


def area_natures(spark) -> DataFrame:
    return spark.createDataFrame(AREA_NATURES, "area string, nature string")


def era_overlaps(periods: DataFrame) -> DataFrame:
    """Eras of each period with a confidence; the twelve eras are broadcast."""
    dim = F.broadcast(eras(periods.sparkSession))
    start, end = F.coalesce(F.nullif("start_year", F.lit(0)), F.lit(0)), F.coalesce(F.nullif("end_year", F.lit(0)), F.lit(2026))
    meets = (start <= F.coalesce("era_end", F.lit(2026))) & (end >= F.coalesce("era_start", F.lit(0)))
    found = periods.join(dim, meets).withColumn("confidence", era_confidence(*[F.col(c) for c in ("start_year", "end_year", "era_start", "era_end")]))
    return found.where("confidence is not null").select("site_id", "period_id", "era_no", "era", "confidence")


def top_eras(periods: DataFrame, k: int = 3) -> DataFrame:
    """The k surest (period, era) pairs of a site; only then each era once, at its best rank."""
    order = Window.partitionBy("site_id").orderBy(F.desc("confidence"), "period_id", "era_no")
    ranked = era_overlaps(periods).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.groupBy("site_id", "era").agg(F.min(F.struct("rank", "confidence")).alias("b")).select("site_id", "era", "b.rank", "b.confidence")


def top_natures(areas: DataFrame, k: int = 3) -> DataFrame:
    """Natures of a site's areas in the order they are first met, at most k."""
    first = (
        areas.join(F.broadcast(area_natures(areas.sparkSession)), "area")
        .where("nature is not null")
        .groupBy("site_id", "nature")
        .agg(F.min("area_id").alias("first"))
    )
    order = Window.partitionBy("site_id").orderBy("first", "nature")
    return first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("site_id", "nature", "rank")


def chunk_numbers(df: DataFrame, by: list[str], order: str, size: int, name: str = "chunk") -> DataFrame:
    """Consecutive chunks of ``size`` rows inside each group, in the order of a whole number."""
    places = numbered(df, by, [order], F.floor(F.col(order) / COARSE), "__place")
    return places.withColumn(name, F.floor(F.col("__place") / size).cast("long")).drop("__place")


def request_batches(sites: DataFrame, size: int, by: list[str]) -> DataFrame:
    """Groups of sites as JSON arrays for a classifier outside.

    Batches are numbered inside each value of ``by``.
    """
    batched = chunk_numbers(sites, by, "site_id", size, "batch")
    cells = [c for c in sites.columns if c not in by]
    body = F.array_sort(F.collect_list(F.struct("site_id", *[c for c in cells if c != "site_id"])))  # of one batch
    return batched.groupBy(*by, "batch").agg(F.count("*").alias("n"), F.to_json(body).alias("request"))


def breaker_cutoff(batches: DataFrame, by: list[str], order: str, failed: str, run: int = 5) -> DataFrame:
    """Batches that count as run: up to and with the first row of ``run`` failures (W-e).

    Gaps and islands: failures in a row share the number of successes before them.
    """
    w = Window.partitionBy(*by).orderBy(order)
    marked = batches.withColumn("__island", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(w))
    inside = Window.partitionBy(*by, "__island").orderBy(order)
    marked = marked.withColumn("__streak", F.sum(F.when(F.col(failed), 1).otherwise(0)).over(inside))
    stops = marked.where(F.col("__streak") == run).groupBy(*by).agg(F.min(order).alias("__stop"))
    return marked.join(stops, by, "left").where(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).drop("__island", "__streak", "__stop")


def apply_classifications(current: DataFrame, derived: DataFrame, replies: DataFrame, dimension: DataFrame) -> DataFrame:
    """Category rows with derived ones first, then replied ones, once per (site, kind, category).

    ``dimension`` (kind, slug, category): unknown slugs are left out, ``unknown_slugs`` has
    them.  A missing rank counts 1, a missing confidence 0.5, a missing source ``ai``.
    """
    cols = ["site_id", "kind", "slug", "rank", "confidence", "source", "arrival"]
    both = derived.withColumn("arrival", F.struct(F.lit(0), "arrival")).select(*cols).unionByName(replies.withColumn("arrival", F.struct(F.lit(1), "arrival")).select(*cols))
    known = both.join(dimension, ["kind", "slug"]).select(
        "site_id", "kind", "category", F.coalesce("rank", F.lit(1)).alias("rank"), F.coalesce("confidence", F.lit(0.5)).alias("confidence"),
        F.coalesce("source", F.lit("ai")).alias("source"), "arrival",
    )
    sound = F.col("rank").between(1, 3) & F.col("confidence").between(0, 1)
    return insert_or_ignore(current, known, ["site_id", "kind", "category"], sound, "arrival")


def unknown_slugs(replies: DataFrame, dimension: DataFrame) -> DataFrame:
    """(kind, slug, n) of what replies name and the dimension does not have."""
    return replies.join(dimension.select("kind", "slug"), ["kind", "slug"], "left_anti").groupBy("kind", "slug").agg(F.count("*").alias("n"))
