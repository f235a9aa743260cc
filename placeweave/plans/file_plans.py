"""Registered queries of files, replies and categories: written from the given tables, read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions import names as N
from placeweave.operators import enrich, tables
from placeweave.plans import views
from placeweave.plans.registry import query
from placeweave.plans.views import with_tables
from placeweave.session import shared_folder
from placeweave.sinks import exports
from placeweave.sources import documents, features


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _csv(spark, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


_TEXTS = "site_id name state city county address".split()


@query(
    with_tables(
        "sites",
        body=""" SELECT nullif(trim(name), '') AS name, 'R' || site_id AS nris_refnum, nullif(trim(city), '') AS city, nullif(trim(state), '') AS state, CASE WHEN site_id % 3 = 0 THEN '19' || (10 + site_id % 80) END AS nhl_designation_date,
  concat_ws(',', CASE WHEN site_id % 2 = 0 THEN 'A' END, CASE WHEN site_id % 3 = 0 THEN 'C' END) AS criteria,
  CASE WHEN site_id % 5 = 0 THEN 'architecture' WHEN site_id % 4 = 0 THEN 'art,law' WHEN site_id % 4 = 1 THEN 'industry' ELSE '' END AS areas, 'Federal NHL' AS designation_type FROM sites""",
    )
)
def listed_file(spark, sf_dir):
    """All sites as a delimited list under other headers, read by alias: fields, criteria, areas."""
    k, folder = F.col("site_id"), _folder(spark)
    rows = views.sites(spark, sf_dir).select(
        F.concat(F.lit("R"), k.cast("string"), F.lit(".0")).alias("Reference Number"), F.col("name").alias("Property Name"), F.concat(F.lit(" "), "city").alias("City"), F.col("state").alias("ST"),
        F.when(k % 3 == 0, F.concat(F.lit("19"), (10 + k % 80).cast("string"))).otherwise("nan").alias("NHL Date"), F.when(k % 2 == 0, "x").otherwise("no").alias("CritA"), F.when(k % 3 == 0, " Yes ").alias("Criteria C"),
        F.when(k % 5 == 0, "TRUE").alias("Architecture"), F.when(k % 4 == 0, "Art; LAW,unheard of").when(k % 4 == 1, "industry").alias("Areas of Significance"),
    )
    rows.write.option("header", True).option("escape", '"').csv(folder)
    found = documents.read_list(spark, folder, landmark=True)
    return found.select("name", "nris_refnum", "city", "state", "nhl_designation_date", F.array_join("criteria", ",").alias("criteria"), F.array_join("areas", ",").alias("areas"), "designation_type")


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, CASE WHEN site_id % 2 = 0 THEN round(latitude + 0.7 / 8, 6) ELSE round(latitude + 0.3 / 4, 6) END AS latitude, CASE WHEN site_id % 2 = 0 THEN round(longitude + 2.6 / 8, 6) ELSE round(longitude + 0.5 / 4, 6) END AS longitude, 'VA' AS state
FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    )
)
def battlefield_sites(spark, sf_dir):
    """Battlefields as GeoJSON of one or two polygons: the mean of the vertices of all outer rings."""
    rows = views.sites(spark, sf_dir).where("latitude is not null and longitude is not null")
    ring = lambda *ps: F.array(*[F.array(F.col("longitude") + x, F.col("latitude") + y) for x, y in ps])
    one, two = ring((0.0, 0.0), (0.2, 0.1), (0.3, 0.2), (0.0, 0.0)), ring((0.5, 0.1), (0.6, 0.1), (0.5, 0.1), (0.5, 0.1))
    hole = ring((9.0, 9.0), (9.1, 9.0), (9.0, 9.1), (9.0, 9.0))
    several = F.col("site_id") % 2 == 0
    geometry = F.struct(F.when(several, "MultiPolygon").otherwise("Polygon").alias("type"), F.when(several, F.to_json(F.array(F.array(one, hole), F.array(two)))).otherwise(F.to_json(F.array(one, hole))).alias("coordinates"))
    properties = F.create_map(F.lit("NAME"), F.concat(F.lit("FIELD "), F.col("site_id").cast("string")), F.lit("STATE"), F.lit("VA/WV"))
    text = rows.select(F.to_json(F.struct(F.array(F.struct(properties.alias("properties"), geometry.alias("geometry"))).alias("features"))).alias("value"))
    found = documents.parse_battlefields(text.select(F.from_json("value", documents.GEOJSON).alias("c")).select("c.*"), "War")
    return found.select(F.split("name", " ")[1].cast("long").alias("site_id"), "latitude", "longitude", "state")


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, round(longitude + (CASE WHEN site_id % 2 = 0 THEN (3.0 * 2 - 1.0 / 2 * 1.5) / (3 - 0.5) ELSE 1 END), 5) AS lon, round(latitude + (CASE WHEN site_id % 2 = 0 THEN (3.0 * 1 - 1.0 / 2 * 4 / 3) / (3 - 0.5) ELSE 1 END), 5) AS lat
FROM (SELECT site_id, latitude, longitude FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL)""",
    )
)
def area_centroids(spark, sf_dir):
    """Centroids by area of a triangle with a hole, or of a triangle alone."""
    rows = views.sites(spark, sf_dir).where("latitude is not null and longitude is not null")
    ring = lambda *ps: F.array(*[F.array(F.col("longitude") + x, F.col("latitude") + y) for x, y in ps])
    # areas 3 and 1/2, centroids (2, 1) and (1.5, 4/3); the hole turns the other way
    outer, hole = ring((1.0, 0.0), (3.0, 0.0), (2.0, 3.0), (1.0, 0.0)), ring((1.0, 1.0), (1.5, 2.0), (2.0, 1.0), (1.0, 1.0))
    alone = ring((0.0, 0.0), (3.0, 0.0), (0.0, 3.0), (0.0, 0.0))
    at = features.polygon_centroid(F.when(F.col("site_id") % 2 == 0, F.array(outer, hole)).otherwise(F.array(alone)))
    return rows.select("site_id", F.round(at["lon"], 5).alias("lon"), F.round(at["lat"], 5).alias("lat"))


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, site_id % 4 IN (0, 1) AS generic, CASE WHEN site_id % 4 = 3 THEN 'Old Mill ' || site_id ELSE CASE site_id % 4 WHEN 0 THEN ' House ' WHEN 1 THEN 'site - ' || site_id ELSE 'A House' END END AS title FROM sites""",
    )
)
def generic_names(spark, sf_dir):
    """Generic names and names in capitals among all sites."""
    k = F.col("site_id")
    name = F.when(k % 4 == 0, " House ").when(k % 4 == 1, F.concat(F.lit("site - "), k.cast("string"))).when(k % 4 == 2, "A House").otherwise(F.concat(F.lit("OLD MILL "), k.cast("string")))
    rows = views.sites(spark, sf_dir).select("site_id", name.alias("name"))
    return rows.select("site_id", N.is_generic(F.col("name"), ["site", "house"]).alias("generic"), N.unshout(F.col("name")).alias("title"))


_SCORED = "site_id % 7 / 10.0"


@query(
    with_tables(
        "sites",
        body=f""", f AS (SELECT *, row_number() OVER (ORDER BY CAST(site_id % 100 AS INTEGER), {_SCORED}, site_id) - 1 AS place FROM sites WHERE review_status = 'flagged')
SELECT CAST(place AS BIGINT) AS place, CAST(site_id AS VARCHAR) AS id, name, state, nris_refnum, CAST({_SCORED} AS DOUBLE) AS confidence_score, CAST(site_id % 100 AS VARCHAR) AS review_priority, review_status, 'note ' || site_id AS reviewer_notes,
  round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, short_description FROM f""",
    )
)
def review_tool_file(spark, sf_dir):
    """The review tool's file, written and read back: all columns, and the place of each row in it."""
    k, folder = F.col("site_id"), _folder(spark)
    rows = views.sites(spark, sf_dir).withColumns({"confidence_score": k % 7 / 10.0, "review_priority": (k % 100).cast("int"), "reviewer_notes": F.concat(F.lit("note "), k.cast("string"))})
    exports.write_csv(exports.review_rows(rows, exports.TOOL_COLUMNS), folder)
    read = _csv(spark, folder).select("*", F.col("_metadata.file_name").alias("__f"), F.monotonically_increasing_id().alias("__m"))
    # part files are in the order of their names, rows in that of their lines: ranked inside files, with what comes before
    ranked = tables.numbered(read, [], ["__f", "__m"], F.col("__f"), "place")
    number = lambda c: F.col(c).cast("double")
    return ranked.drop("__f", "__m").withColumns({"confidence_score": number("confidence_score"), "latitude": F.round(number("latitude"), 6), "longitude": F.round(number("longitude"), 6)})


@query(with_tables("sites", body=" SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _TEXTS) + " FROM sites"))
def full_file(spark, sf_dir):
    """The whole table as CSV, written and read back."""
    folder = _folder(spark)
    exports.write_csv(exports.full_rows(views.sites(spark, sf_dir).select(*_TEXTS)), folder)
    return _csv(spark, folder)


@query("SELECT event_type AS source_key, event_id, 'v' || event_id AS body FROM events")
def raw_features(spark, sf_dir):
    """Raw features landed for each source, appended twice, read back."""
    folder, rows = _folder(spark), views.table(spark, sf_dir, "events").select(F.col("event_type").alias("source_key"), "event_id", F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("body"))
    exports.land_raw(rows.where("event_id % 2 = 0"), folder)
    exports.land_raw(rows.where("event_id % 2 = 1"), folder)
    return spark.read.parquet(folder).select("source_key", "event_id", "body")


@query(with_tables("sites", "areas", body=" SELECT 'completeness' AS section, 'name' AS key, count(*) FILTER (WHERE name <> '') AS n FROM sites UNION ALL SELECT 'states', state, count(*) FROM sites WHERE state IS NOT NULL GROUP BY 2"))
def profile_report(spark, sf_dir):
    """A report of two sections, written as JSON and read back."""
    from placeweave.operators import profile

    rows, folder = views.sites(spark, sf_dir), _folder(spark)
    exports.write_report({"completeness": profile.completeness(rows, ["name"]), "states": profile.value_counts(rows, "state")}, folder)
    first = spark.read.schema("field string, non_null long").json(f"{folder}/completeness").select(F.lit("completeness").alias("section"), F.col("field").alias("key"), F.col("non_null").alias("n"))
    return first.unionByName(spark.read.schema("state string, n long").json(f"{folder}/states").select(F.lit("states").alias("section"), F.col("state").alias("key"), "n"))


@query(
    with_tables(
        "sites",
        "site_categories",
        body=""", p AS (SELECT *, (row_number() OVER (PARTITION BY state ORDER BY site_id) - 1) // 10 AS batch FROM sites WHERE state IS NOT NULL),
c AS (SELECT site_id, string_agg(DISTINCT CAST(category AS VARCHAR), ',' ORDER BY CAST(category AS VARCHAR)) AS derived FROM site_categories WHERE kind = 'era' GROUP BY 1)
SELECT state, CAST(batch AS BIGINT) AS batch, count(*) OVER (PARTITION BY state, batch) AS n, p.site_id, name, coalesce(derived, '') AS derived FROM p LEFT JOIN c ON c.site_id = p.site_id""",
    )
)
def request_bodies(spark, sf_dir):
    """Batches of sites with their derived categories as a classifier is asked, read back from the text."""
    derived = views.site_categories(spark, sf_dir).where("kind = 'era'").groupBy("site_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("category").cast("string"))), ",").alias("derived"))  # of 12 at most
    rows = views.sites(spark, sf_dir).where("state is not null").select("site_id", "state", "name").join(derived, "site_id", "left").fillna("", ["derived"])
    asked = enrich.request_batches(rows, 10, ["state"])
    return asked.select("state", "batch", "n", F.explode(F.from_json("request", "array<struct<site_id:long,name:string,derived:string>>")).alias("r")).select("state", "batch", "n", "r.*")


@query(
    with_tables(
        "sites",
        body=" SELECT site_id, CAST(1800 + site_id % 200 AS INTEGER) AS start_year, CAST(site_id % 10 / 10.0 AS DOUBLE) AS confidence, CASE WHEN site_id % 10 < 3 THEN 'extraction_low_confidence' ELSE 'extraction' END AS method FROM sites WHERE site_id % 3 > 0",
    )
)
def extracted_objects(spark, sf_dir):
    """Objects inside the text of replies; texts without one give nothing."""
    k = F.col("site_id")
    body = F.to_json(F.struct((1800 + k % 200).alias("start_year"), (k % 10 / 10.0).alias("confidence")))
    replies = views.sites(spark, sf_dir).select("site_id", F.when(k % 3 == 0, "no answer [1]").otherwise(F.concat(F.lit("Here it is:\n"), body, F.lit("\nDone."))).alias("text"))
    return documents.object_replies(replies, "start_year int, confidence double").select("site_id", "start_year", "confidence", "method")


_SLUGS = "CASE l_partkey % 5 WHEN 0 THEN 'nowhere' ELSE 's' || l_partkey % 12 END"


def _said(spark, sf_dir):
    items, p = views.table(spark, sf_dir, "lineitem"), F.col("l_partkey")
    slug = F.when(p % 5 == 0, "nowhere").otherwise(F.concat(F.lit("s"), (p % 12).cast("string")))
    arrival = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = items.select(
        (F.col("l_orderkey") % 1500).cast("long").alias("site_id"), F.lit("era").alias("kind"), slug.alias("slug"), F.when(F.col("l_linenumber") % 4 > 0, (F.col("l_linenumber") % 4).cast("int")).alias("rank"),
        F.when(p % 3 > 0, p % 3 * 0.5).alias("confidence"), F.when(p % 2 == 0, "derived").alias("source"), arrival.alias("arrival"), (F.col("l_suppkey") % 4 == 0).alias("own"),
    )
    dimension = spark.createDataFrame([("era", f"s{k}", k) for k in range(12)], "kind string, slug string, category int")
    return rows.where("own").drop("own"), rows.where("not own").drop("own"), dimension


@query(
    f"""WITH r AS (SELECT l_orderkey % 1500 AS site_id, {_SLUGS} AS slug, l_partkey % 12 AS category, coalesce(nullif(l_linenumber % 4, 0), 1) AS rank, coalesce(CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 3 * 0.5::DOUBLE END, 0.5) AS confidence,
  CASE WHEN l_partkey % 2 = 0 THEN 'derived' ELSE 'ai' END AS source, l_suppkey % 4 <> 0 AS later, l_orderkey * 10 + l_linenumber AS arrival FROM lineitem)
SELECT site_id, 'era' AS kind, category, count(DISTINCT site_id) AS n FROM r WHERE slug <> 'nowhere' AND rank BETWEEN 1 AND 3 GROUP BY 1, 2, 3"""
)
def classified_categories(spark, sf_dir):
    """Derived categories first, then replied ones, each once."""
    derived, replies, dimension = _said(spark, sf_dir)
    none = spark.createDataFrame([], "site_id long, kind string, category int, rank int, confidence double, source string")
    found = enrich.apply_classifications(none, derived, replies, dimension)
    return found.groupBy("site_id", "kind", "category").agg(F.count("*").alias("n"))


@query(f"SELECT 'era' AS kind, {_SLUGS} AS slug, count(*) AS n FROM lineitem WHERE l_suppkey % 4 <> 0 AND {_SLUGS} = 'nowhere' GROUP BY 2")
def unknown_slugs(spark, sf_dir):
    """What replies name and the dimension does not have."""
    _, replies, dimension = _said(spark, sf_dir)
    return enrich.unknown_slugs(replies, dimension)


@query(
    "WITH a AS (SELECT o_custkey AS site_id, o_orderkey AS id, 'order' AS kind FROM orders UNION ALL SELECT s_suppkey + 100000000, s_suppkey, 'supply' FROM supplier) "
    "SELECT a.*, c_custkey IS NULL AS orphan FROM a LEFT JOIN customer ON c_custkey = site_id"
)
def appended_children(spark, sf_dir):
    """Child rows of two tables appended, those without a site marked."""
    sites = views.sites(spark, sf_dir)
    own = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("site_id"), F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"))
    more = views.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100_000_000).alias("site_id"), F.col("s_suppkey").alias("id"), F.lit("supply").alias("kind"))
    rows = tables.append_rows(own, more)
    lost = tables.orphans(rows, sites).withColumn("orphan", F.lit(True))
    return rows.join(sites.select("site_id"), "site_id", "left_semi").withColumn("orphan", F.lit(False)).unionByName(lost)
