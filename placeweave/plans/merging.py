"""Registered queries of merges, queues, sources and exports, each with the SQL that checks it.

Features, lists, park documents, replies and pages are made from the given tables as text
first and then parsed, so the parsers see every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave import constants as C
from placeweave.functions import names as N
from placeweave.functions import normalize as Z
from placeweave.operators import batches, merges, profile, resolve, scoring, tables
from placeweave.plans import views
from placeweave.plans.registry import _TITLE, _WORDS, SQL_STATE, _sides, query
from placeweave.plans.views import with_tables
from placeweave.session import staged
from placeweave.sinks import exports
from placeweave.sources import documents, features

# --- merges ------------------------------------------------------------------------

#: The stored registry: the first site of each number, and those without a number.
_CURRENT = """, cur AS (SELECT site_id, nris_refnum, name, state, city, address, source_arcgis FROM sites WHERE nris_refnum IS NULL
  UNION ALL SELECT site_id, nris_refnum, name, state, city, address, source_arcgis FROM sites WHERE nris_refnum IS NOT NULL QUALIFY row_number() OVER (PARTITION BY nris_refnum ORDER BY site_id) = 1)"""
_INC = (
    _CURRENT
    + f""", inc AS (SELECT site_id + 1000000 AS arrival, CASE WHEN site_id % 4 <> 0 THEN lpad(CAST(site_id % 1500 AS VARCHAR), 8, '6') END AS nris_refnum,
  'New ' || name AS name, {SQL_STATE} AS state, {_TITLE.format("trim(city)")} AS city, trim(address) AS address, true AS source_arcgis FROM sites),
placed AS (SELECT inc.*, coalesce(cur.site_id, min(arrival) OVER (PARTITION BY inc.nris_refnum, inc.nris_refnum IS NULL AND arrival > 0, CASE WHEN inc.nris_refnum IS NULL THEN arrival END), arrival) AS site_id,
  CASE WHEN cur.site_id IS NOT NULL OR (inc.nris_refnum IS NOT NULL AND arrival > min(arrival) OVER (PARTITION BY inc.nris_refnum)) THEN 'updated' ELSE 'inserted' END AS outcome
  FROM inc LEFT JOIN cur ON inc.nris_refnum = cur.nris_refnum)
"""
)
_FIELDS = ["site_id", "nris_refnum", "name", "state", "city", "address", "source_arcgis"]


def _stored(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    return tables.keep_first(rows.where("nris_refnum is not null"), ["nris_refnum"], "site_id").unionByName(rows.where("nris_refnum is null")).select(*_FIELDS)


def _arriving(spark, sf_dir):
    k = F.col("site_id")
    return views.sites(spark, sf_dir).select(
        (k + 1_000_000).alias("arrival"), F.when(k % 4 != 0, F.lpad((k % 1500).cast("string"), 8, "6")).alias("nris_refnum"), F.concat(F.lit("New "), "name").alias("name"),
        "state", "city", "address", "latitude", "longitude", F.lit(True).alias("source_arcgis"),
    )


def _merged(spark, sf_dir):
    return merges.merge_points(_stored(spark, sf_dir), _arriving(spark, sf_dir), "arcgis", ["source_arcgis"])


@query(with_tables("sites", body=_INC + "SELECT arrival, site_id, outcome FROM placed"))
def merge_outcomes(spark, sf_dir):
    return _merged(spark, sf_dir)["outcomes"]


@query(with_tables("sites", body=_INC + "SELECT outcome, count(*) AS n FROM placed GROUP BY outcome"))
def merge_stats(spark, sf_dir):
    return merges.merge_stats(_merged(spark, sf_dir)["outcomes"], [])


@query(
    with_tables(
        "sites",
        body=_INC
        + """, f AS (SELECT nris_refnum, min(site_id) AS id, arg_min(name, arrival) AS name, arg_min(state, arrival) FILTER (WHERE state <> '') AS state, arg_min(city, arrival) FILTER (WHERE city <> '') AS city,
  arg_min(address, arrival) FILTER (WHERE address <> '') AS address FROM placed WHERE nris_refnum IS NOT NULL GROUP BY 1)
SELECT coalesce(c.site_id, f.id) AS site_id, coalesce(c.nris_refnum, f.nris_refnum) AS nris_refnum, coalesce(nullif(c.name, ''), f.name, c.name) AS name, coalesce(nullif(c.state, ''), f.state, c.state) AS state,
  coalesce(nullif(c.city, ''), f.city, c.city) AS city, coalesce(nullif(c.address, ''), f.address, c.address) AS address, coalesce(c.source_arcgis, false) OR f.id IS NOT NULL AS source_arcgis
FROM (SELECT * FROM cur WHERE nris_refnum IS NOT NULL) c FULL JOIN f ON c.nris_refnum = f.nris_refnum
UNION ALL SELECT * FROM cur WHERE nris_refnum IS NULL
UNION ALL SELECT site_id, nris_refnum, name, state, city, address, source_arcgis FROM placed WHERE nris_refnum IS NULL""",
    )
)
def merge_sites(spark, sf_dir):
    return _merged(spark, sf_dir)["sites"]


@query(with_tables("sites", body=_INC + "SELECT site_id, 'arcgis' AS source_name, nris_refnum AS source_record_id, name, state FROM placed"))
def merge_provenance(spark, sf_dir):
    rows = _merged(spark, sf_dir)["sources"]
    return rows.select("site_id", "source_name", "source_record_id", F.get_json_object("raw_data_json", "$.name").alias("name"), F.get_json_object("raw_data_json", "$.state").alias("state"))


def _list_merge(spark, sf_dir):
    k = F.col("arrival")
    letters = F.filter(F.array(*[F.lit(x) for x in "ABCD"]), lambda x, i: (k + i) % 3 == 0)
    slugs = F.slice(F.array(*[F.lit(a) for a in views.AREAS]), (k % 28 + 1).cast("int"), 2)
    told = _arriving(spark, sf_dir).withColumns({"criteria": letters, "areas": slugs, "designation_type": F.when(k % 3 == 0, "Federal NHL").otherwise("Federal NRHP")})
    first = views.sites(spark, sf_dir).select("site_id", F.lit("Federal NRHP").alias("designation_type"), F.lit(None).cast("string").alias("designation_date"), F.lit("stored").alias("designating_authority"), F.lit("arcgis").alias("source"))
    return merges.merge_list(_stored(spark, sf_dir), told, "nhl_spreadsheet", ["source_arcgis"], first)


@query(with_tables("sites", body=_INC + "SELECT site_id, letter AS criterion, 'nhl_spreadsheet' AS source FROM placed, (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3)) AS l(letter, i) WHERE (arrival + i) % 3 = 0"))
def merge_list_criteria(spark, sf_dir):
    return _list_merge(spark, sf_dir)["criteria"]


_AREA_ROWS = ", ".join(f"({i}, '{a}')" for i, a in enumerate(views.AREAS))


@query(with_tables("sites", body=_INC + f"SELECT site_id, area, 'nhl_spreadsheet' AS source FROM placed JOIN (VALUES {_AREA_ROWS}) AS a(no, area) ON no - arrival % 28 IN (0, 1)"))
def merge_list_areas(spark, sf_dir):
    return _list_merge(spark, sf_dir)["areas"]


@query(
    with_tables(
        "sites",
        body=_INC
        + """, old AS (SELECT site_id, 'Federal NRHP' AS designation_type, 'stored' AS designating_authority, 'arcgis' AS source FROM sites),
new AS (SELECT DISTINCT site_id, CASE WHEN arrival % 3 = 0 THEN 'Federal NHL' ELSE 'Federal NRHP' END AS designation_type, CAST(NULL AS VARCHAR) AS designating_authority, 'nhl_spreadsheet' AS source FROM placed)
SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (site_id, designation_type)""",
    )
)
def merge_list_designations(spark, sf_dir):
    return _list_merge(spark, sf_dir)["designations"].drop("designation_date")


@query(
    with_tables(
        "sites",
        body=_CURRENT
        + """, old AS (SELECT *, CASE WHEN nris_refnum IS NOT NULL AND site_id % 2 = 0 THEN 'same' ELSE 'other' END AS mark FROM cur)
SELECT site_id, CASE WHEN nris_refnum IS NULL OR mark = 'same' THEN city ELSE coalesce(nullif(city, ''), 'filled') END AS city, nris_refnum IS NOT NULL AND mark <> 'same' AS touched FROM old""",
    )
)
def upsert_changed(spark, sf_dir):
    """Half of the sites get what was last written: nothing of them changes."""
    new = _stored(spark, sf_dir).where("nris_refnum is not null").select(F.col("site_id").alias("arrival"), "nris_refnum", F.coalesce(F.nullif("city", F.lit("")), F.lit("filled")).alias("city"), F.lit(True).alias("source_arcgis"))
    told = new.select("nris_refnum", "arrival", tables.checksum(["nris_refnum", "city", "source_arcgis"]).alias("__sum"))
    stored = _stored(spark, sf_dir).join(told.drop("arrival"), "nris_refnum", "left")
    stored = stored.withColumns({"data_checksum": F.when(F.col("site_id") % 2 == 0, F.col("__sum")).otherwise("old"), "updated_at": F.lit("before")}).drop("__sum")
    out = merges.upsert_changed(stored, new, ["source_arcgis"], F.lit("now"))
    return out.select("site_id", "city", (F.col("updated_at") == "now").alias("touched"))


# --- replies -----------------------------------------------------------------------


@query(
    with_tables(
        "sites",
        body=f""", r AS (SELECT site_id, CASE WHEN site_id % 5 = 0 THEN -100.0 + site_id % 7 WHEN site_id % 5 <> 4 THEN 30.0 + site_id % 7 END AS lat, CASE WHEN site_id % 5 = 0 THEN 30.0 + site_id % 7 WHEN site_id % 5 = 3 THEN 10.0 ELSE -100.0 + site_id % 7 END AS lon FROM sites),
p AS (SELECT site_id, CASE WHEN lat BETWEEN {C.LON_RANGE[0]} AND {C.LON_RANGE[1]} AND lon BETWEEN {C.LAT_RANGE[0]} AND {C.LAT_RANGE[1]} THEN lon ELSE lat END AS lat,
  CASE WHEN lat BETWEEN {C.LON_RANGE[0]} AND {C.LON_RANGE[1]} AND lon BETWEEN {C.LAT_RANGE[0]} AND {C.LAT_RANGE[1]} THEN lat ELSE lon END AS lon FROM r WHERE lat IS NOT NULL),
ok AS (SELECT * FROM p WHERE lat BETWEEN {C.LAT_RANGE[0]} AND {C.LAT_RANGE[1]} AND lon BETWEEN {C.LON_RANGE[0]} AND {C.LON_RANGE[1]})
SELECT s.site_id, coalesce(ok.lat, latitude) AS latitude, coalesce(ok.lon, longitude) AS longitude, CASE WHEN ok.site_id IS NOT NULL THEN 'ai_lookup' ELSE coordinates_source END AS coordinates_source,
  CASE WHEN ok.site_id IS NOT NULL AND s.site_id % 2 = 1 THEN 'Found ' || s.site_id ELSE address END AS address FROM sites s LEFT JOIN ok ON s.site_id = ok.site_id""",
    )
)
def lookup_sites(spark, sf_dir):
    return _lookups(spark, sf_dir)["sites"].select("site_id", "latitude", "longitude", "coordinates_source", "address")


def _lookups(spark, sf_dir):
    """Replies as a model gives them: text around a JSON array, parsed first."""
    rows = views.sites(spark, sf_dir).withColumn("geocode_quality", F.lit(None).cast("string"))
    k = F.col("site_id")
    lat = F.when(k % 5 == 0, -100.0 + k % 7).when(k % 5 != 4, 30.0 + k % 7)
    lon = F.when(k % 5 == 0, 30.0 + k % 7).when(k % 5 == 3, F.lit(10.0)).otherwise(-100.0 + k % 7)
    said = F.to_json(F.array(F.struct(
        "site_id", lat.alias("latitude"), lon.alias("longitude"), F.when(k % 2 == 1, F.concat(F.lit(" Found "), k.cast("string"))).alias("address"),
        F.when(k % 3 == 0, F.concat(F.lit("https://x/"), k.cast("string"))).alias("source_url"), F.lit("high").alias("confidence"))))
    texts = rows.select(F.concat(F.lit("Here it is:\n```json\n"), said, F.lit("\n```")).alias("text"))
    schema = "site_id:bigint,latitude:double,longitude:double,address:string,source_url:string,confidence:string"
    return merges.apply_lookups(rows, documents.array_replies(texts, schema))


@query(with_tables("sites", body=" SELECT site_id, 'ai_geocode' AS source_name, 'https://x/' || site_id AS source_url FROM sites WHERE site_id % 3 = 0 AND site_id % 5 NOT IN (3, 4)"))
def lookup_provenance(spark, sf_dir):
    return _lookups(spark, sf_dir)["sources"].select("site_id", "source_name", "source_url")


@query(
    with_tables(
        "sites",
        body=""", b AS (SELECT *, site_id // 10 AS batch FROM sites)
SELECT site_id, CASE WHEN batch % 3 = 0 THEN 'partial' WHEN site_id % 10 < 8 THEN 'complete' ELSE enrichment_status END AS enrichment_status, batch % 3 <> 0 AND site_id % 10 < 8 AS has_raw FROM b""",
    )
)
def batch_statuses(spark, sf_dir):
    """Every third batch had no reply; in the others two of ten sites were left out."""
    rows = views.sites(spark, sf_dir).withColumn("enrichment_raw_json", F.lit(None).cast("string"))
    k = F.col("site_id")
    asked = rows.select(F.floor(k / 10).alias("batch"), "site_id")
    replies = asked.where((F.col("batch") % 3 != 0) & (k % 10 < 8)).withColumn("era", F.lit("modern"))
    out = merges.apply_batches(rows, asked, replies)
    return out.select("site_id", "enrichment_status", F.col("enrichment_raw_json").isNotNull().alias("has_raw"))


def _nominations(spark, sf_dir):
    """A nomination for each order's site: every fourth extraction failed."""
    orders = views.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    read = k % 4 != 0
    first = tables.keep_first(orders.select(F.col("o_custkey").alias("site_id"), "o_orderkey"), ["site_id"], "o_orderkey")
    rows = first.select(
        "site_id", F.when(read & (k % 5 != 0), (1700 + k % 200).cast("int")).alias("start_year"), F.when(read & (k % 3 == 0), (1900 + k % 50).cast("int")).alias("end_year"),
        F.when(read, F.slice(F.array(*[F.lit(a) for a in views.AREAS]), (k % 28 + 1).cast("int"), 2)).alias("areas"), F.when(read, F.array(F.lit("A"), F.lit("E"), F.lit("C"))).alias("criteria"),
        F.when(read & (k % 7 != 0), F.concat(F.lit("Of note "), k.cast("string"))).alias("statement"), F.when(read, F.lit("good")).alias("condition"),
    )
    sites = views.sites(spark, sf_dir).withColumns({"condition": F.lit(None).cast("string"), "enrichment_raw_json": F.lit(None).cast("string")})
    return merges.apply_nominations(sites, rows)


_NOMINATED = ", n AS (SELECT o_custkey AS site_id, min(o_orderkey) AS k FROM orders GROUP BY 1)"


@query(
    with_tables(
        "sites",
        body=_NOMINATED
        + """ SELECT s.site_id, CASE WHEN k % 4 <> 0 AND k % 7 <> 0 THEN 'Of note ' || k ELSE full_description END AS full_description, CASE WHEN k % 4 <> 0 THEN 'good' END AS condition,
  source_nomination OR k IS NOT NULL AS source_nomination FROM sites s LEFT JOIN n ON n.site_id = s.site_id""",
    )
)
def nomination_sites(spark, sf_dir):
    return _nominations(spark, sf_dir)["sites"].select("site_id", "full_description", "condition", "source_nomination")


@query(
    with_tables(
        "sites",
        body=_NOMINATED
        + f""" SELECT site_id, 'period' AS kind, coalesce(CAST(CASE WHEN k % 5 <> 0 THEN 1700 + k % 200 END AS VARCHAR), '') || '-' || coalesce(CAST(CASE WHEN k % 3 = 0 THEN 1900 + k % 50 END AS VARCHAR), '') AS value FROM n WHERE k % 4 <> 0 AND (k % 5 <> 0 OR k % 3 = 0)
UNION ALL SELECT site_id, 'criterion', x FROM n, (VALUES ('A'), ('C')) AS c(x) WHERE k % 4 <> 0
UNION ALL SELECT site_id, 'area', area FROM n JOIN (VALUES {_AREA_ROWS}) AS a(no, area) ON no - k % 28 IN (0, 1) WHERE k % 4 <> 0""",
    )
)
def nomination_children(spark, sf_dir):
    out = _nominations(spark, sf_dir)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    periods = out["periods"].select("site_id", F.lit("period").alias("kind"), F.concat(text("start_year"), F.lit("-"), text("end_year")).alias("value"))
    criteria = out["criteria"].select("site_id", F.lit("criterion").alias("kind"), F.col("criterion").alias("value"))
    return periods.unionByName(criteria).unionByName(out["areas"].select("site_id", F.lit("area").alias("kind"), F.col("area").alias("value")))


# --- runs, queues and counts ---------------------------------------------------------


@query("SELECT CAST(user_id % 20 AS BIGINT) AS run_id, 'enrich' AS stage, 'completed' AS status, count(*) AS records_processed FROM events GROUP BY 1")
def current_runs(spark, sf_dir):
    counts = views.table(spark, sf_dir, "events").groupBy((F.col("user_id") % 20).alias("run_id")).agg(F.count("*").alias("n"))
    log = merges.run_events(counts, F.lit("enrich"), F.lit(1)).withColumn("at", F.col("step"))
    return tables.latest_runs(log).select("run_id", "stage", "status", "records_processed")


@query("SELECT event_type AS source_name, arg_max(user_id, event_id) AS record_count FROM events GROUP BY 1")
def source_metadata(spark, sf_dir):
    told = views.table(spark, sf_dir, "events").select(F.col("event_type").alias("source_name"), F.col("user_id").alias("record_count"), "event_id")
    return merges.source_metadata(told, "event_id").drop("event_id")


@query("WITH b AS (SELECT o_custkey AS run_id, o_orderkey AS batch, 1 + o_orderkey % 10 AS enriched FROM orders) SELECT *, CAST(sum(enriched) OVER (PARTITION BY run_id ORDER BY batch) AS BIGINT) AS so_far FROM b")
def run_progress(spark, sf_dir):
    batches = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), F.col("o_orderkey").alias("batch"), (1 + F.col("o_orderkey") % 10).alias("enriched"))
    return merges.cumulative(batches, ["run_id"], "batch", "enriched")


@query(
    """SELECT event_type AS source_key, CAST(count(*) FILTER (WHERE event_id % 7 <> 0) AS BIGINT) AS n_good, CAST(count(*) FILTER (WHERE event_id % 7 = 0) AS BIGINT) AS n_bad,
  CASE WHEN count(*) FILTER (WHERE event_id % 7 <> 0) = 0 THEN 'failed' WHEN count(*) FILTER (WHERE event_id % 7 = 0) > 0 THEN 'partial' ELSE 'complete' END AS status FROM events GROUP BY 1"""
)
def source_statuses(spark, sf_dir):
    """Properties as JSON, every seventh line broken: the rest is read all the same."""
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    lines = views.table(spark, sf_dir, "events").select(F.col("event_type").alias("source_key"), text.alias("value"))
    good, bad = merges.quarantined(lines, "k int")
    return merges.source_statuses(good, bad, "source_key")


_HITS = ", hits AS (SELECT DISTINCT o_custkey AS site_id FROM orders)"


@query(
    with_tables(
        "sites",
        body=_HITS
        + """ SELECT site_id, address IS NOT NULL AS addressed FROM sites WHERE latitude IS NULL AND address IS NOT NULL AND site_id NOT IN (SELECT site_id FROM hits)
UNION ALL SELECT site_id, false FROM sites WHERE latitude IS NULL AND address IS NULL AND city IS NOT NULL""",
    )
)
def fallback_requests(spark, sf_dir):
    hits = views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("site_id")).distinct()
    return merges.fallback_requests(views.sites(spark, sf_dir), hits).select("site_id", F.col("address").isNotNull().alias("addressed"))


@query(
    with_tables(
        "sites",
        body=""" SELECT 'enrich' AS purpose, site_id FROM sites WHERE enrichment_status = 'pending'
UNION ALL SELECT 'geocode', site_id FROM sites WHERE latitude IS NULL AND (address IS NOT NULL OR city IS NOT NULL)
UNION ALL SELECT 'lookup', site_id FROM sites WHERE (latitude IS NULL OR coordinates_source = 'city_level') AND name IS NOT NULL AND city IS NOT NULL
UNION ALL SELECT 'all', site_id FROM sites""",
    )
)
def work_queues(spark, sf_dir):
    rows = views.sites(spark, sf_dir).withColumn("geocode_quality", F.col("coordinates_source"))
    parts = [merges.eligible(rows, p).select(F.lit(p).alias("purpose"), "site_id") for p in ("enrich", "geocode", "lookup", "all")]
    return features.union_sources(parts)


@query(with_tables("sites", "areas", body=" SELECT 'total_sites' AS what, count(*) AS n FROM sites UNION ALL SELECT 'total_sources', (SELECT count(*) FROM orders) UNION ALL SELECT 'total_designations', (SELECT count(*) FROM areas)"))
def profile_summary(spark, sf_dir):
    return profile.summary(views.sites(spark, sf_dir), views.table(spark, sf_dir, "orders"), views.areas(spark, sf_dir))


@query(with_tables("sites", body=" SELECT DISTINCT state FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND state IS NOT NULL"))
def states_with_coordinates(spark, sf_dir):
    return profile.states_with_coordinates(views.sites(spark, sf_dir))


@query(with_tables("sites", body=f", w AS (SELECT site_id, {_WORDS} AS n FROM sites) SELECT site_id, CASE WHEN n >= 50 THEN 'data_rich' WHEN n >= 5 THEN 'data_moderate' ELSE 'data_poor' END AS richness FROM w"))
def site_richness(spark, sf_dir):
    return profile.site_richness(views.sites(spark, sf_dir))


@query(
    with_tables(
        "sites",
        body=""", o AS (SELECT site_id, 'zero_coordinate' AS kind, 'latitude or longitude' AS detail FROM sites WHERE latitude = 0 OR longitude = 0
  UNION ALL SELECT site_id, 'implausible_year', 'nhl_designation_date: ' || nhl_designation_date FROM sites WHERE try_cast(substr(nhl_designation_date, 1, 4) AS INTEGER) NOT BETWEEN 1400 AND 2026)
SELECT * FROM o ORDER BY site_id, kind, detail LIMIT 50""",
    )
)
def outlier_report(spark, sf_dir):
    """The report's list of outliers, which the reference caps at 50."""
    return profile.report_outliers(profile.outliers(views.sites(spark, sf_dir), ["nhl_designation_date"]))


@query()
def cascade_outcomes(spark, sf_dir):
    """(state, outcome, n) of all incoming records."""
    inc, sites = _sides(spark, sf_dir)
    return merges.merge_stats(merges.cascade_outcomes(inc.select("id", "state"), batches.assignments(inc, sites)), ["state"])


@query()
def audit_file(spark, sf_dir):
    inc, sites = _sides(spark, sf_dir)
    plain = lambda df, id: df.select(F.col(id).alias("id"), "name", "state", "city", "address", "nris_refnum")
    found = resolve.match_audit(inc, sites)
    return merges.audit_rows(found, plain(views.incoming(spark, sf_dir), "record_id"), plain(views.sites(spark, sf_dir), "site_id"), "arcgis")


@query("SELECT event_type AS source_key, count(*) AS records, count(*) FILTER (WHERE value > 50) AS flagged FROM events GROUP BY 1")
def audit_summary(spark, sf_dir):
    told = views.table(spark, sf_dir, "events").withColumn("source_key", F.col("event_type"))
    return merges.audit_summary(told, told.where("value > 50"), "source_key")


# --- exports ------------------------------------------------------------------------


@query(with_tables("sites", body=" SELECT site_id AS id, name, state, city, nris_refnum, latitude, longitude, short_description, review_status FROM sites WHERE review_status = 'flagged'"))
def review_file(spark, sf_dir):
    rows = views.sites(spark, sf_dir).withColumns({"confidence_score": F.lit(0.4), "review_priority": (F.col("site_id") % 100).cast("int")})
    return exports.review_rows(rows).select("id", "name", "state", "city", "nris_refnum", "latitude", "longitude", "short_description", "review_status")


@query(with_tables("sites", body=" SELECT site_id, state, '<p><b>Address:</b> ' || address || '</p>' AS address FROM sites WHERE address IS NOT NULL"))
def description_parts(spark, sf_dir):
    rows = views.sites(spark, sf_dir).where("address is not null")
    html = exports.description_html(rows)
    return rows.select("site_id", "state", F.regexp_extract(html, "(<p><b>Address:</b> .*?</p>)", 1).alias("address"))


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, latitude, longitude, CASE WHEN site_id % 5 = 0 THEN 'red' WHEN site_id % 5 = 1 THEN 'green' ELSE 'gray' END AS colour, CASE WHEN site_id % 5 = 0 THEN 'Federal NHL' ELSE 'Other' END AS layer,
  '<h4>' || name || '</h4>' AS head FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    )
)
def map_markers(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    k = F.col("site_id") % 5
    kinds = rows.select("site_id", F.when(k == 0, "Federal NHL").when(k == 1, "NPS Unit").alias("designation_type")).where("designation_type is not null")
    return exports.map_markers(rows, kinds).select("site_id", "latitude", "longitude", "colour", "layer", F.substring_index("popup", "\n", 1).alias("head"))


@query(with_tables("sites", body=" SELECT site_id, CAST(site_id AS VARCHAR) || ',' || address || ',' || coalesce(city, '') || ',' || coalesce(state, '') || ',' AS line FROM sites WHERE latitude IS NULL AND address IS NOT NULL"))
def geocoder_lines(spark, sf_dir):
    lines = exports.geocoder_requests(views.sites(spark, sf_dir))
    # empty cells are written as "" and read back as nothing
    return lines.select("site_id", F.replace("line", F.lit('""'), F.lit("")).alias("line"))


@query(
    with_tables(
        "sites",
        body=""" SELECT s.site_id, s.name FROM sites s WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND site_id % 5 = 0""",
    )
)
def landmark_features(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    kinds = rows.select("site_id", F.when(F.col("site_id") % 5 == 0, "Federal NHL").otherwise("Tribal").alias("designation_type"))
    return exports.landmark_features(rows, kinds).select("site_id", F.get_json_object("feature", "$.properties.name").alias("name"))


# --- sources ------------------------------------------------------------------------


def _federal_text(spark, sf_dir):
    """Sites as features in the layer's JSON, some names blank, some geometries empty."""
    rows = views.sites(spark, sf_dir)
    k = F.col("site_id")
    attributes = F.struct(
        F.when(k % 13 == 0, " ").otherwise(F.col("name")).alias("ResName"), F.col("nris_refnum").alias("NRIS_Refnum"), F.col("address").alias("Address"), F.col("city").alias("City"),
        F.col("county").alias("County"), F.col("state").alias("State"), (F.lit(-1_000_000_000_000) + k * 86_400_000).cast("string").alias("CertDate"), F.when(k % 2 == 0, "L").alias("STATUS"),
    )
    geometry = F.struct(F.col("longitude").alias("x"), F.col("latitude").alias("y"))
    return rows.select("site_id", F.to_json(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("value"))


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, trim(name) AS name, nris_refnum, latitude, longitude, strftime(make_timestamp((-1000000000000 + CAST(site_id AS BIGINT) * 86400000) * 1000), '%Y-%m-%d') AS nrhp_cert_date,
  CASE WHEN site_id % 2 = 0 THEN 'L' END AS nrhp_status FROM sites WHERE site_id % 13 <> 0 AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    )
)
def federal_sites(spark, sf_dir):
    read = _federal_text(spark, sf_dir).select("site_id", F.from_json("value", features.FEATURE).alias("f")).select("site_id", "f.*")
    rows = features.parse_federal(read.withColumn("attributes", F.map_concat("attributes", F.create_map(F.lit("Status"), F.coalesce(F.col("attributes")["STATUS"], F.lit(""))))))
    # features carry no number of ours: it comes back from the date they were given
    first = F.datediff(F.to_date("nrhp_cert_date"), F.to_date(F.from_unixtime(F.lit(-1_000_000_000)))).cast("long")
    return rows.select(first.alias("site_id"), "name", "nris_refnum", "latitude", "longitude", "nrhp_cert_date", "nrhp_status")


_SHPO = {
    "key": "xx", "state_code": "XX", "name_strip_patterns": ["(ruins)"], "name_upper_to_title": True, "address_parts": ["NUM", "STREET"], "state_name_field": "STNAME",
    "field_map": {"name": ["HIST", "NAME"], "city": ["TOWN"], "county": ["CNTY"], "state_record_id": ["OID"], "date_listed": ["LISTED"]},
}


@query(
    with_tables(
        "sites",
        body=f""", n AS (SELECT *, trim(regexp_replace(replace(name, '(ruins)', ''), '\\s+', ' ', 'g')) AS clean FROM sites)
SELECT CAST(site_id AS VARCHAR) AS state_record_id, clean AS name, CASE WHEN site_id % 5 = 0 AND upper(state) IN ({", ".join(f"'{n.upper()}'" for n in views.NAMES)}) THEN CASE upper(state) {" ".join(f"WHEN '{n.upper()}' THEN '{c}'" for n, c in zip(views.NAMES, views.CODES, strict=True))} END ELSE 'XX' END AS state,
  city, nullif(concat_ws(' ', CASE WHEN site_id % 3 <> 0 THEN CAST(site_id % 300 AS VARCHAR) END, CASE WHEN site_id % 2 = 0 THEN 'Main St' END), '') AS address,
  CASE WHEN site_id % 3 = 0 THEN 'c. 1900' ELSE strftime(make_timestamp(CAST(site_id AS BIGINT) * 86400000000), '%Y-%m-%d') END AS state_designation_date, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude
FROM n WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    )
)
def survey_sites(spark, sf_dir):
    """A state survey's features through a declared source: points, several points or rings in turn."""
    rows = views.sites(spark, sf_dir)
    k = F.col("site_id")
    attributes = F.struct(
        F.when(k % 2 == 0, " ").otherwise(F.col("name")).alias("HIST"), F.col("name").alias("NAME"), F.col("city").alias("TOWN"), F.col("county").alias("CNTY"), k.cast("string").alias("OID"),
        F.when(k % 3 == 0, "c. 1900").otherwise((k * 86_400_000).cast("string")).alias("LISTED"), F.when(k % 3 != 0, (k % 300).cast("string")).alias("NUM"),
        F.when(k % 2 == 0, "Main St").alias("STREET"), F.col("state").alias("STNAME"),
    )
    lon, lat = F.col("longitude"), F.col("latitude")
    shift = lambda dx, dy: F.array(lon + dx, lat + dy)
    ring = F.array(shift(-1.0, -1.0), shift(1.0, -1.0), shift(1.0, 1.0), shift(-1.0, 1.0))
    geometry = F.struct(
        F.when(k % 3 == 0, lon).alias("x"), F.when(k % 3 == 0, lat).alias("y"), F.when((k % 3 == 1) & lon.isNotNull(), F.array(F.array(lon, lat), F.array(lon + 1, lat))).alias("points"),
        F.when((k % 3 == 2) & lon.isNotNull(), F.array(ring)).alias("rings"),
    )
    text = rows.select(F.to_json(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("value"))
    read = text.select(F.from_json("value", features.FEATURE).alias("f")).select("f.*")
    out = features.parse_source(read, _SHPO)
    return out.select("state_record_id", "name", "state", "city", "address", "state_designation_date", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query(
    """SELECT s_suppkey AS id, 30.0 + s_suppkey % 40 AS lat, -100.0 - s_suppkey % 20 AS lon, CASE WHEN s_suppkey % 5 = 1 THEN 'interpolated' ELSE 'exact' END AS quality FROM supplier WHERE s_suppkey % 5 IN (0, 1, 2)
UNION ALL SELECT c_custkey + 1000000000, 30.0 + c_custkey % 40, -100.0 - c_custkey % 20, CASE WHEN c_custkey % 5 = 1 THEN 'interpolated' ELSE 'exact' END FROM customer WHERE c_custkey % 5 IN (0, 1, 2)"""
)
def geocoder_hits(spark, sf_dir):
    """Reply lines of suppliers and customers: matches, near matches, none, ties, short lines."""
    both = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    both = both.unionByName(views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") + 1_000_000_000).alias("id"), F.col("c_name").alias("name")))
    k = F.col("k")
    hit = F.when(k % 5 == 1, "Non_Exact").when(k % 5 == 3, "No_Match").when(k % 5 == 4, "Tie").otherwise("Match")
    spot = F.concat(F.lit('"'), (-100 - k % 20).cast("string"), F.lit(","), (30 + k % 40).cast("string"), F.lit('"'))
    line = F.when(k % 5 >= 3, F.concat_ws(",", F.col("id").cast("string"), F.col("name"), hit)).otherwise(F.concat_ws(",", F.col("id").cast("string"), F.col("name"), hit, F.lit("Exact"), F.lit("there"), spot))
    return documents.geocoder_replies(both.select(line.alias("value"))).withColumn("id", F.col("id").cast("long"))


@query(
    with_tables(
        "sites",
        body=""" SELECT site_id, name, 'PA' AS state, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude, 'Monday: 9-5' AS visiting_hours, CASE WHEN site_id % 2 = 0 THEN 'Entry: Free' ELSE 'Entry: $' || (site_id % 50) || '.50' END AS admission_info,
  CASE WHEN length(full_description) > 500 THEN length(full_description) END AS n_full FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND site_id % 4 >= 0""",
    )
)
def park_sites(spark, sf_dir):
    """Park documents as JSON text, parsed."""
    rows = views.sites(spark, sf_dir).where("latitude is not null and longitude is not null")
    k = F.col("site_id")
    spot = F.concat(F.lit("lat:"), F.format_string("%.4f", "latitude"), F.lit(", long:"), F.format_string("%.4f", "longitude"))
    hours = F.array(F.struct(F.create_map(F.lit("monday"), F.lit("9-5"), F.lit("sunday"), F.lit("Closed")).alias("standardHours")))
    cost = F.when(k % 2 == 0, "0.00").otherwise(F.concat((k % 50).cast("string"), F.lit(".50")))
    text = rows.select(
        F.to_json(F.struct(
            k.cast("string").alias("id"), k.cast("string").alias("parkCode"), F.lit(" ").alias("fullName"), "name", F.col("full_description").alias("description"), F.lit("u").alias("url"),
            F.lit("PA,NJ").alias("states"), spot.alias("latLong"), hours.alias("operatingHours"), F.array(F.struct(cost.alias("cost"), F.lit("Entry").alias("title"))).alias("entranceFees"))).alias("value"))
    parks = documents.parse_parks(text.select(F.from_json("value", documents.PARK).alias("p")).select("p.*"))
    return parks.select(
        F.col("nps_park_code").cast("long").alias("site_id"), "name", "state", F.round("latitude", 4).alias("latitude"), F.round("longitude", 4).alias("longitude"), "visiting_hours", "admission_info",
        F.length("full_description").alias("n_full"),
    )


@query(
    with_tables(
        "sites",
        body=""" SELECT upper(name[1]) || '' AS first, count(*) AS n FROM (SELECT name FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL) GROUP BY 1""",
    )
)
def battlefield_initials(spark, sf_dir):
    """Battlefields as GeoJSON of one or two polygons, parsed; counted by their first letter."""
    rows = views.sites(spark, sf_dir).where("latitude is not null and longitude is not null")
    corner = lambda d: F.array(F.col("longitude") + d, F.col("latitude") + d)
    ring = F.array(corner(0.0), corner(0.1), corner(0.2), corner(0.0))
    polygon, several = F.to_json(F.array(ring)), F.to_json(F.array(F.array(ring), F.array(ring)))
    several_of = F.col("site_id") % 2 == 0
    geometry = F.struct(F.when(several_of, "MultiPolygon").otherwise("Polygon").alias("type"), F.when(several_of, several).otherwise(polygon).alias("coordinates"))
    properties = F.create_map(F.lit("NAME"), F.upper("name"), F.lit("STATE"), F.lit("VA/WV"))
    collections = rows.select(F.array(F.struct(properties.alias("properties"), geometry.alias("geometry"))).alias("features"))
    out = documents.parse_battlefields(collections, "civil").where("state = 'VA'")
    return out.groupBy(F.substring("name", 1, 1).alias("first")).agg(F.count("*").alias("n"))


@query(
    """SELECT page_id, 'R' || page_id AS refnum, 'Name ' || page_id AS name, '0' || (1 + page_id % 9) || '/15/1980' AS date, CASE WHEN page_id % 2 = 0 THEN 'Town' ELSE 'Place ' || page_id END AS city,
  CASE WHEN page_id % 2 = 0 THEN 'Kern' ELSE 'Napa' END AS county, '12 Oak Ave' AS address, CASE WHEN page_id % 3 <> 0 THEN '1912' END AS date_constructed FROM pages"""
)
def listed_sites(spark, sf_dir):
    """A listing row and a detail page for each page: town and county from the one, else from the other."""
    pages = views.table(spark, sf_dir, "pages").select("page_id")
    k = F.col("page_id").cast("string")
    even = F.col("page_id") % 2 == 0
    row = F.concat(F.lit('<table><tr><td><a href="/Detail/R'), k, F.lit('">Name '), k, F.lit("</a></td><td>0"), (1 + F.col("page_id") % 9).cast("string"), F.lit("/15/1980</td>"), F.when(even, "<td>Town (Kern)</td>").otherwise(""), F.lit("</tr></table>"))
    listing = documents.listing_rows(pages.withColumn("html", row))
    built = F.when(F.col("page_id") % 3 != 0, "<b>Year Built:</b> 1912").otherwise("")
    detail = F.concat(F.lit("<div>Location:</div><div>Place "), k, F.lit("</div><div>County: Napa</div><div>Directions:</div><div>12 Oak Ave</div>"), built)
    details = documents.detail_fields(pages.withColumn("html", detail)).withColumn("refnum", F.concat(F.lit("R"), F.col("page_id").cast("string")))
    out = documents.listed_sites(listing, details)
    return out.select("page_id", "refnum", "name", "date", "city", "county", "address", "date_constructed")


# --- names --------------------------------------------------------------------------


@query(
    with_tables(
        "sites",
        body=r""" SELECT site_id, trim(regexp_replace(replace(name, '(ruins)', ''), '\s+', ' ', 'g')) AS stripped, name AS visible,
  CASE WHEN site_id % 3 = 0 THEN name ELSE 'B' END AS picked, lower(trim(name)) IN ('site', 'house') AS generic FROM sites""",
    )
)
def cleaned_names(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    several = F.when(F.col("site_id") % 3 == 0, F.col("name")).otherwise("A (State list), B (NRHP 1970)")
    return rows.select(
        "site_id", N.strip_patterns(F.col("name"), ["(ruins)"]).alias("stripped"), N.strip_invisible(F.concat(F.lit("\u200b"), "name", F.lit("\ufeff"))).alias("visible"),
        N.pick_entry(several).alias("picked"), N.is_generic(F.col("name"), ["site", "house"]).alias("generic"),
    )


@query("SELECT o_orderkey, strftime(make_timestamp((CAST(o_orderkey AS BIGINT) * 777777777 - 500000000000) * 1000), '%Y-%m-%d') AS day FROM orders")
def epoch_days(spark, sf_dir):
    k = F.col("o_orderkey")
    return views.table(spark, sf_dir, "orders").select("o_orderkey", Z.epoch_ms_to_iso((k * 777_777_777 - 500_000_000_000).cast("string")).alias("day"))


_SCORE_SQL = """
RECURSIVE pairs AS (SELECT DISTINCT a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON a.p_name[1] = b.p_name[1] AND a.p_size = b.p_size),
sorted AS (SELECT a, b, array_to_string(list_sort(string_split(a, ' ')), ' ') AS x, array_to_string(list_sort(string_split(b, ' ')), ' ') AS y FROM pairs),
lcs(a, b, x, y, i, line) AS (
  SELECT a, b, x, y, 0, list_transform(range(length(y) + 1), lambda j: 0) FROM sorted
  UNION ALL SELECT a, b, x, y, i + 1, list_reduce(range(1, length(y) + 1), lambda acc, j: list_append(acc, CASE WHEN y[j] = x[i + 1] THEN line[j] + 1 ELSE greatest(acc[-1], line[j + 1]) END), [0])
  FROM lcs WHERE i < length(x))
SELECT a, b, round(200.0 * line[-1] / (length(x) + length(y)), 6) AS score FROM lcs WHERE i = length(x)"""


@query("WITH " + _SCORE_SQL)
def name_scores(spark, sf_dir):
    """Scores of the distinct names of parts of one size that begin alike."""
    names = views.table(spark, sf_dir, "part").select("p_name", "p_size", F.substring("p_name", 1, 1).alias("first")).distinct()
    a, b = names.withColumnRenamed("p_name", "a"), names.withColumnRenamed("p_name", "b")
    pairs = a.join(b, ["p_size", "first"]).select("a", "b").distinct()
    return pairs.withColumn("score", F.round(N.name_score(N.sorted_tokens(F.col("a")), N.sorted_tokens(F.col("b"))), 6))


@query(
    with_tables(
        "sites",
        body=""", a AS (SELECT o_custkey AS site_id, max(o_orderkey) FILTER (WHERE o_orderkey % 3 = 2) AS edited, max(o_orderkey) FILTER (WHERE o_orderkey % 3 < 2) AS judged FROM orders GROUP BY 1)
SELECT s.site_id, CASE WHEN edited IS NOT NULL THEN 'Edited ' || edited ELSE name END AS name, CASE judged % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'flagged' ELSE review_status END AS review_status,
  CASE WHEN edited IS NOT NULL THEN 'manual' ELSE primary_source END AS primary_source FROM sites s LEFT JOIN a ON a.site_id = s.site_id""",
    )
)
def reviewed_sites(spark, sf_dir):
    rows = views.sites(spark, sf_dir).withColumn("review_priority", F.lit(50))
    k = F.col("o_orderkey")
    acts = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"), F.when(k % 3 == 0, "approve").when(k % 3 == 1, "flag").otherwise("edit").alias("action"), F.lit(None).cast("string").alias("notes"),
        F.create_map(F.lit("name"), F.concat(F.lit("Edited "), k.cast("string"))).alias("fields"), k.alias("at"),
    )
    return scoring.apply_actions(rows, acts).select("site_id", "name", "review_status", "primary_source")
