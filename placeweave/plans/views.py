"""Site-shaped views of the given tables, in Spark and (the same) in SQL.

``sites`` turns customers into sites with every kind of dirt the normalisers meet;
``incoming`` has all of them as new records that are disturbed, and suppliers
that match nothing.  Categories, periods and areas come from line items and orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.constants import AREA_NATURES, STATE_CODES

CODES = list(dict.fromkeys(STATE_CODES.values()))[:25]
NAMES = list(STATE_CODES)[:25]
AREAS = [a for a, _ in AREA_NATURES]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` dealt over twice as many tasks as run at once, if their files make fewer.

    A small file is one task, however long its rows take: a name or an address costs far
    more than reading it.
    """
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks, by) if rows.rdd.getNumPartitions() < tasks else rows


_LIST = ", ".join
#: Expressions that both engines read; k is the customer's key.
_COLUMNS = {
    "site_id": "k",
    "nris_refnum": "CASE WHEN k % 4 <> 0 THEN lpad(CAST(k % 1000 AS VARCHAR(20)), 8, '6') END",
    "name": "coalesce(p_name, 'Place') || ' ' || CAST(k % 40 AS VARCHAR(20)) || "
    "CASE k % 4 WHEN 1 THEN ' National Historic Site' WHEN 2 THEN ' NHS' WHEN 3 THEN ' (ruins)' ELSE '' END",
    "state": "CASE WHEN k % 37 = 0 THEN 'zz' WHEN k % 5 = 0 THEN long_state ELSE short_state END",
    "city": "CASE WHEN k % 6 <> 0 THEN upper(r_name) END",
    "county": "CASE WHEN k % 7 <> 0 THEN lower(r_name) || ' o''neil county' END",
    "address": "CASE WHEN k % 3 <> 0 THEN CAST(k % 300 AS VARCHAR(20)) || ' North Main Street' END",
    "latitude": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 17 = 0 THEN CAST(0 AS DOUBLE) WHEN k % 13 = 0 THEN lon0 ELSE lat0 END",
    "longitude": "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 AND k % 17 <> 0 THEN lat0 ELSE lon0 END",
    "date_constructed": "CASE k % 6 WHEN 0 THEN CAST(1700 + k % 300 AS VARCHAR(20)) "
    "WHEN 1 THEN CAST(k % 12 + 1 AS VARCHAR(20)) || '/' || CAST(k % 28 + 1 AS VARCHAR(20)) || '/' || CAST(1800 + k % 200 AS VARCHAR(20)) "
    "WHEN 2 THEN 'March ' || CAST(k % 28 + 1 AS VARCHAR(20)) || ', ' || CAST(1850 + k % 100 AS VARCHAR(20)) "
    "WHEN 3 THEN CAST(1800 + k % 200 AS VARCHAR(20)) || '-05-' || lpad(CAST(k % 28 + 1 AS VARCHAR(20)), 2, '0') "
    "WHEN 4 THEN CAST(1000000000001 + CAST(k AS BIGINT) * 86400000 AS VARCHAR(20)) ELSE 'unknown' END",
    "nhl_designation_date": "CASE WHEN k % 5 <> 2 THEN CAST(1200 + k % 1000 AS VARCHAR(20)) || '-01-01' END",
    "full_description": "text",
    "short_description": "substring(text, 1, 500)",
    "source_arcgis": "k % 2 = 1",
    "source_spreadsheet": "k % 4 >= 2",
    "source_nps_parks": "k % 8 >= 4",
    "source_nomination": "k % 16 >= 8",
    "source_shpo": "k % 32 >= 16",
    "source_other": "k % 64 >= 32",
    "review_status": "CASE k % 4 WHEN 0 THEN 'unreviewed' WHEN 1 THEN 'approved' WHEN 2 THEN 'flagged' ELSE 'auto_approved' END",
    "enrichment_status": "CASE k % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'complete' ELSE 'partial' END",
    "primary_source": "CASE WHEN k % 19 = 0 THEN 'manual' WHEN k % 23 <> 0 THEN 'arcgis' END",
    "coordinates_source": "CASE WHEN k % 9 = 0 THEN 'city_level' WHEN k % 11 <> 0 THEN 'arcgis' END",
}

_STATE_ROWS = _LIST(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(zip(CODES, NAMES, strict=True)))
_SITES = f"""
SELECT {_LIST(f"{e} AS {c}" for c, e in _COLUMNS.items())}
FROM (
  SELECT c_custkey AS k, p_name, r_name, short_state, long_state, text,
    CAST(30 AS DOUBLE) + (c_custkey * 37 % 1000) / CAST(100 AS DOUBLE) AS lat0,
    CAST(-100 AS DOUBLE) + (c_custkey * 53 % 1000) / CAST(100 AS DOUBLE) AS lon0
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN part ON p_partkey = c_custkey % 200
  LEFT JOIN documents ON doc_id = c_custkey
  LEFT JOIN (VALUES {_STATE_ROWS}) AS s(nation, short_state, long_state) ON nation = c_nationkey) AS base"""

#: Common table expressions for the oracle's side.
SQL = {
    "sites": _SITES,
    "site_categories": """
SELECT l_orderkey * 10 + l_linenumber AS arrival, l_orderkey % 1500 AS site_id,
  CASE l_linenumber % 4 WHEN 0 THEN 'era' WHEN 1 THEN 'event' WHEN 2 THEN 'type' ELSE 'ownership' END AS kind,
  l_partkey % 12 AS category, 1 + l_linenumber % 4 AS rank, 1 - l_discount * 10 AS confidence
FROM lineitem""",
    "periods": """
SELECT o_orderkey AS period_id, o_custkey AS site_id, CAST(1700 + o_orderkey % 300 AS INT) AS start_year,
  CAST(CASE WHEN o_orderkey % 9 <> 0 THEN 1700 + o_orderkey % 300 + o_custkey % 60 END AS INT) AS end_year
FROM orders""",
    "areas": "SELECT l_orderkey * 10 + l_linenumber AS area_id, l_orderkey % 1500 AS site_id, l_partkey % 30 AS area_no FROM lineitem",
}


def with_tables(*names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + body


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run shared SQL over the tables it names, bound as DataFrames and not as global views."""
    import re

    names = sorted({n for n in ("customer", "nation", "region", "part", "documents", "lineitem", "orders", "supplier") if re.search(rf"\b{n}\b", sql)})
    bound = {n: table(spark, sf_dir, n) for n in names}
    if "customer" in bound:
        bound["customer"] = spread(bound["customer"], "c_custkey")
    text = sql
    for n in names:
        text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **bound)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SQL["sites"])


def site_categories(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Line items as categories; ``placed`` adds where a row is stored (file, row)."""
    items = table(spark, sf_dir, "lineitem")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("era", "event", "type", "ownership")]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return items.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("arrival"), (F.col("l_orderkey") % 1500).alias("site_id"), kind.alias("kind"),
        (F.col("l_partkey") % 12).alias("category"), (1 + F.col("l_linenumber") % 4).alias("rank"), (1 - F.col("l_discount") * 10).alias("confidence"),
        *([F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")] if placed else []),
    )


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SQL["periods"])


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area_id, site_id, area): line items as areas of significance."""
    rows = _view(spark, sf_dir, SQL["areas"])
    names = F.array(*[F.lit(a) for a in AREAS])
    return rows.select("area_id", "site_id", F.element_at(names, (F.col("area_no") + 1).cast("int")).alias("area"))


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sites as new records: words reversed, moved by 0.001 degrees, and some with
    another number, another city or without their number in the register; and the
    suppliers, far from any site and under names of their own."""
    k = F.col("site_id")
    words = F.array_join(F.reverse(F.split("name", " ")), " ")
    renumbered = F.regexp_replace("name", r"\d+", (k % 90 + 900).cast("string"))
    disturbed = sites(spark, sf_dir).select(
        (k + 1_000_000).alias("record_id"), k.alias("arrival"),
        F.when(k % 9 == 1, F.col("nris_refnum")).alias("nris_refnum"),
        F.when(k % 5 == 1, renumbered).otherwise(words).alias("name"), "state",
        F.when(k % 7 == 1, F.lit("ELSEWHERE")).otherwise(F.col("city")).alias("city"), "address",
        (F.col("latitude") + 0.001).alias("latitude"), (F.col("longitude") + 0.001).alias("longitude"),
        "date_constructed", "nhl_designation_date", "full_description",
    )
    state = F.element_at(F.array(*[F.lit(c) for c in CODES]), F.col("s_nationkey") + 1)
    strangers = spread(table(spark, sf_dir, "supplier"), "s_suppkey").select(
        (F.col("s_suppkey") + 900_000_000).alias("record_id"), (F.col("s_suppkey") + 900_000_000).alias("arrival"), F.lit(None).cast("string").alias("nris_refnum"),
        F.concat_ws(" ", F.lit("Works of"), "s_name").alias("name"), state.alias("state"), F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("address"),
        F.lit(60.0).alias("latitude"), (F.lit(-150.0) + F.col("s_suppkey") % 100 / 100).alias("longitude"),
    )
    return disturbed.unionByName(strangers, allowMissingColumns=True)
