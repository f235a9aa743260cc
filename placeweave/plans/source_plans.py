"""Registered queries of whole merges, each with the SQL that checks it where the rules are exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators import scoring, source_merges, tables
from placeweave.plans import views
from placeweave.plans.registry import _TITLE, SQL_STATE, query, sql_address, sql_date
from placeweave.plans.views import with_tables

_TYPES = ["State Register", "Landmark"]

#: The stored sites, one a number, and all records as validation leaves them.
_SIDES = f"""
, cur AS (SELECT site_id, CASE WHEN row_number() OVER (PARTITION BY nris_refnum ORDER BY site_id) = 1 THEN nris_refnum END AS nris_refnum, name, state, city, county, address, date_constructed, primary_source, source_shpo FROM sites),
raw AS (SELECT site_id + 1000000 AS arrival, site_id, CASE WHEN site_id % 9 = 1 THEN nris_refnum END AS nris_refnum, state, CASE WHEN site_id % 7 = 1 THEN 'ELSEWHERE' ELSE city END AS city,
  county, address, date_constructed, CASE WHEN site_id % 4 = 1 THEN CAST(1960 + site_id % 60 AS VARCHAR) || '-01-01' END AS state_designation_date, 'S' || site_id AS state_record_id FROM sites),
inc AS (SELECT arrival, nris_refnum, {SQL_STATE} AS state, {_TITLE.format("trim(city)")} AS city, {_TITLE.format("trim(county)")} AS county, trim(address) AS address,
  {sql_date("date_constructed")} AS date_constructed, state_designation_date, state_record_id FROM raw),
stored AS (SELECT *, nullif(lower(trim(city)), '') AS ck, nullif({sql_address("address")}, '') AS ak FROM cur),
coming AS (SELECT *, nullif(lower(trim(city)), '') AS ck, nullif({sql_address("address")}, '') AS ak FROM inc),
by_number AS (SELECT i.arrival, e.site_id FROM coming i JOIN stored e ON i.nris_refnum = e.nris_refnum),
by_place AS (SELECT i.arrival, min(e.site_id) AS site_id FROM coming i JOIN stored e ON i.state = e.state AND i.ak = e.ak AND i.ck = e.ck GROUP BY 1),
open AS (SELECT c.*, CASE WHEN ak IS NOT NULL AND ck IS NOT NULL AND state IS NOT NULL THEN min(arrival) OVER (PARTITION BY state, ak, ck) ELSE arrival END AS led
  FROM coming c WHERE arrival NOT IN (SELECT arrival FROM by_number) AND arrival NOT IN (SELECT arrival FROM by_place)),
placed AS (SELECT c.*, coalesce(n.site_id, p.site_id, o.led) AS to_id,
  CASE WHEN n.site_id IS NOT NULL THEN 'matched_nris' WHEN p.site_id IS NOT NULL OR o.led < c.arrival THEN 'matched_address' ELSE 'inserted' END AS outcome
  FROM coming c LEFT JOIN by_number n ON n.arrival = c.arrival LEFT JOIN by_place p ON p.arrival = c.arrival LEFT JOIN open o ON o.arrival = c.arrival)
"""


def _state_merge(spark, sf_dir, passes=(1, 2)):
    """A survey of all customers: names of one address agree, so the address decides as in SQL by the least id."""
    rows = views.sites(spark, sf_dir)
    k = F.col("site_id")
    stored = tables.keep_first(rows.where("nris_refnum is not null"), ["nris_refnum"], "site_id").select("site_id", F.col("nris_refnum").alias("__own"))
    current = rows.join(stored, "site_id", "left").select(
        "site_id", F.col("__own").alias("nris_refnum"), *([F.lit("Site").alias("name")] if passes == (1, 2) else ["name"]), "state", "city", "county", "address", "latitude", "longitude",
        "date_constructed", F.lit(None).cast("string").alias("state_designation_date"), "primary_source", "source_shpo",
    )
    records = views.incoming(spark, sf_dir).where("record_id < 900000000") if passes == (1, 2) else views.incoming(spark, sf_dir)
    told = rows.select((k + 1_000_000).alias("record_id"), "county", F.when(k % 4 == 1, F.concat((1960 + k % 60).cast("string"), F.lit("-01-01"))).alias("state_designation_date"), F.concat(F.lit("S"), k.cast("string")).alias("state_record_id"))
    incoming = records.drop("full_description", "nhl_designation_date").join(told, "record_id", "left").withColumn("arrival", F.col("record_id")).drop("record_id")
    if passes == (1, 2):
        incoming = incoming.withColumn("name", F.lit("Site"))
    none = spark.createDataFrame([], "site_id long, designation_type string, designation_date string, designating_authority string, source string")
    return source_merges.merge_state(current, incoming, none, "survey", _TYPES, "Office", passes)


@query(
    with_tables(
        "sites",
        body=_SIDES
        + """, told AS (SELECT to_id, arg_min(nullif(city, ''), arrival) FILTER (WHERE city <> '') AS city, arg_min(county, arrival) FILTER (WHERE county <> '') AS county,
  arg_min(address, arrival) FILTER (WHERE address <> '') AS address, arg_min(date_constructed, arrival) FILTER (WHERE date_constructed <> '') AS date_constructed,
  arg_min(state_designation_date, arrival) FILTER (WHERE state_designation_date <> '') AS state_designation_date FROM placed WHERE outcome <> 'inserted' GROUP BY 1),
base AS (SELECT site_id, nris_refnum, state, city, county, address, date_constructed, NULL AS state_designation_date, primary_source, source_shpo FROM cur
  UNION ALL SELECT arrival, nris_refnum, state, city, county, address, date_constructed, state_designation_date, 'survey', true FROM placed WHERE outcome = 'inserted'),
may AS (SELECT b.*, t.to_id IS NOT NULL AND coalesce(primary_source <> 'manual', false) AS may, t.city AS c, t.county AS co, t.address AS a, t.date_constructed AS d, t.state_designation_date AS s FROM base b LEFT JOIN told t ON t.to_id = b.site_id)
SELECT site_id, nris_refnum, state, CASE WHEN may THEN coalesce(nullif(city, ''), c, city) ELSE city END AS city, CASE WHEN may THEN coalesce(nullif(county, ''), co, county) ELSE county END AS county,
  CASE WHEN may THEN coalesce(nullif(address, ''), a, address) ELSE address END AS address, CASE WHEN may THEN coalesce(nullif(date_constructed, ''), d, date_constructed) ELSE date_constructed END AS date_constructed,
  CASE WHEN may THEN coalesce(nullif(state_designation_date, ''), s, state_designation_date) ELSE state_designation_date END AS state_designation_date, primary_source, may OR coalesce(source_shpo, false) AS source_shpo FROM may""",
    )
)
def state_merge_sites(spark, sf_dir):
    """Sites after a survey matched by number and address: fills, flags and inserts."""
    out = _state_merge(spark, sf_dir)["sites"]
    return out.select("site_id", "nris_refnum", "state", "city", "county", "address", "date_constructed", "state_designation_date", "primary_source", F.coalesce("source_shpo", F.lit(False)).alias("source_shpo"))


@query(
    with_tables(
        "sites",
        body=_SIDES
        + """SELECT to_id AS site_id, designation_type, arg_min(coalesce(state_designation_date, '-'), arrival) AS designation_date, 'Office' AS designating_authority, 'survey' AS source
FROM placed, (VALUES ('State Register'), ('Landmark')) AS t(designation_type) GROUP BY 1, 2""",
    )
)
def state_merge_designations(spark, sf_dir):
    return _state_merge(spark, sf_dir)["designations"].fillna("-", ["designation_date"])


@query(with_tables("sites", body=_SIDES + "SELECT to_id AS site_id, 'survey' AS source_name, state_record_id AS source_record_id FROM placed"))
def state_merge_sources(spark, sf_dir):
    return _state_merge(spark, sf_dir)["sources"].select("site_id", "source_name", "source_record_id")


@query(with_tables("sites", body=_SIDES + "SELECT arrival, to_id AS site_id, outcome FROM placed"))
def state_merge_outcomes(spark, sf_dir):
    return _state_merge(spark, sf_dir)["outcomes"].select("arrival", "site_id", "outcome")


@query()
def state_merge_all_passes(spark, sf_dir):
    """The sites after all passes of the cascade over all incoming records."""
    return _state_merge(spark, sf_dir, None)["sites"]


@query()
def record_assignments(spark, sf_dir):
    """Where each record goes: a stored site, one of the batch, or its own."""
    from placeweave.operators import batches
    from placeweave.plans.registry import _sides

    return batches.assignments(*_sides(spark, sf_dir))


def _parks(spark, sf_dir):
    k = F.col("arrival")
    rows = views.incoming(spark, sf_dir)
    return rows.select(
        "arrival", "name", "state", "latitude", "longitude", F.col("full_description"), F.when(k % 3 > 0, F.concat(F.lit("https://p/"), k.cast("string"))).alias("website_url"),
        F.when(k % 2 == 0, "always").alias("visiting_hours"), F.concat(F.lit("c"), k.cast("string")).alias("nps_park_code"),
    )


@query()
def park_merge(spark, sf_dir):
    """Sites after all incoming records as parks."""
    current = views.sites(spark, sf_dir).withColumns({c: F.lit(None).cast("string") for c in ("website_url", "visiting_hours", "nps_park_code", "reviewer_notes")})
    return source_merges.merge_parks(current.drop("date_constructed"), _parks(spark, sf_dir))["sites"].select("site_id", "name", "website_url", "visiting_hours", "source_nps_parks")


@query()
def battlefield_merge(spark, sf_dir):
    """Sites after all incoming records as battlefields."""
    k = F.col("arrival")
    fields = views.incoming(spark, sf_dir).select("arrival", "name", "state", "latitude", "longitude", F.lit("War").alias("war"), k.cast("string").alias("war_site_id"), F.when(k % 2 == 0, "Battlefield").otherwise("Campaign").alias("designation_type"))
    none = spark.createDataFrame([], "site_id long, designation_type string, designation_date string, designating_authority string, source string")
    return source_merges.merge_battlefields(views.sites(spark, sf_dir).drop("date_constructed"), fields, none, "fields", "Program")["sites"].select("site_id", "name", "latitude", "longitude", "source_other")


# --- several records of a site ---------------------------------------------------------

_NOTES = "CASE WHEN site_id % 4 < 2 THEN 'seen' END"


@query(
    with_tables(
        "sites",
        body=f""", s AS (SELECT *, {_NOTES} AS reviewer_notes FROM sites),
r AS (SELECT o_custkey AS site_id, o_orderkey AS arrival, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'text ' || o_orderkey END AS full_description, CASE WHEN o_orderkey % 7 = 0 THEN 'city ' || o_orderkey END AS city FROM orders),
f AS (SELECT site_id, arg_max(full_description, arrival) FILTER (WHERE full_description <> '') AS d, arg_max(city, arrival) FILTER (WHERE city <> '') AS c FROM r GROUP BY 1),
m AS (SELECT s.*, d, c, (d IS NOT NULL OR c IS NOT NULL) AND coalesce(reviewer_notes IS NULL OR primary_source <> 'manual', false) AS may FROM s LEFT JOIN f ON f.site_id = s.site_id)
SELECT site_id, CASE WHEN may THEN coalesce(d, full_description) ELSE full_description END AS full_description, CASE WHEN may THEN coalesce(c, city) ELSE city END AS city, may OR source_nps_parks AS source_nps_parks FROM m""",
    )
)
def park_updates(spark, sf_dir):
    """All orders of a customer as matched park records: the last value given counts, notes and a manual source guard."""
    rows = views.sites(spark, sf_dir).withColumn("reviewer_notes", F.when(F.col("site_id") % 4 < 2, "seen"))
    k = F.col("o_orderkey")
    records = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"), k.alias("arrival"), F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("text "), k.cast("string"))).alias("full_description"),
        F.when(k % 7 == 0, F.concat(F.lit("city "), k.cast("string"))).alias("city"),
    )
    return tables.overwrite_fields(rows, records, ["full_description", "city"], "source_nps_parks").select("site_id", "full_description", "city", "source_nps_parks")


@query(
    with_tables(
        "sites",
        body=""", r AS (SELECT o_custkey AS site_id, o_orderkey AS arrival, CASE WHEN o_orderkey % 2 = 0 THEN CAST(30 + o_orderkey % 10 AS DOUBLE) END AS latitude, CASE WHEN o_orderkey % 3 = 0 THEN CAST(-90 AS DOUBLE) + o_orderkey % 10 END AS longitude FROM orders),
f AS (SELECT site_id, arg_min(latitude, arrival) FILTER (WHERE latitude IS NOT NULL) AS a, arg_min(longitude, arrival) FILTER (WHERE longitude IS NOT NULL) AS o FROM r GROUP BY 1),
m AS (SELECT s.*, a, o, f.site_id IS NOT NULL AND coalesce(primary_source <> 'manual', false) AS may FROM sites s LEFT JOIN f ON f.site_id = s.site_id)
SELECT site_id, round(CASE WHEN may THEN coalesce(latitude, a) ELSE latitude END, 6) AS latitude, round(CASE WHEN may THEN coalesce(longitude, o) ELSE longitude END, 6) AS longitude, may OR source_other AS source_other FROM m""",
    )
)
def battlefield_fills(spark, sf_dir):
    """All orders of a customer as matched battlefields: the first coordinates fill missing ones."""
    k = F.col("o_orderkey")
    records = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"), k.alias("arrival"), F.when(k % 2 == 0, (30 + k % 10).cast("double")).alias("latitude"), F.when(k % 3 == 0, -90.0 + k % 10).alias("longitude")
    )
    out = tables.fill_empty(views.sites(spark, sf_dir), records, ["latitude", "longitude"], "source_other")
    return out.select("site_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "source_other")


@query(
    with_tables(
        "sites",
        body=""", r AS (SELECT l_orderkey % 15 * 100 + l_partkey % 100 AS site_id, l_orderkey * 10 + l_linenumber AS seen, CAST(20 + l_partkey % 40 AS DOUBLE) AS lat, CASE WHEN l_suppkey % 3 > 0 THEN CAST(-100 AS DOUBLE) + l_partkey % 20 END AS lon FROM lineitem),
ok AS (SELECT * FROM r WHERE lon IS NOT NULL AND lat BETWEEN 17 AND 72 QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY seen DESC, lat DESC) = 1)
SELECT s.site_id, round(coalesce(ok.lat, s.latitude), 6) AS latitude, round(CASE WHEN ok.site_id IS NOT NULL THEN ok.lon ELSE s.longitude END, 6) AS longitude, CASE WHEN ok.site_id IS NOT NULL THEN 'census' ELSE coordinates_source END AS coordinates_source
FROM sites s LEFT JOIN ok ON ok.site_id = s.site_id""",
    )
)
def geocoded_sites(spark, sf_dir):
    """Line items as replies of a geocoder: the last valid one of a site counts."""
    rows = views.sites(spark, sf_dir).withColumn("geocode_quality", F.lit(None).cast("string"))
    p = F.col("l_partkey")
    hits = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 15 * 100 + p % 100).alias("site_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"), (20 + p % 40).cast("double").alias("lat"),
        F.when(F.col("l_suppkey") % 3 > 0, -100.0 + p % 20).alias("lon"), F.lit("exact").alias("quality"), F.lit("census").alias("source"),
    )
    out = tables.apply_geocodes(rows, hits, corrected=False)
    return out.select("site_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "coordinates_source")


@query(
    with_tables(
        "sites",
        body=""", a AS (SELECT o_custkey AS site_id, o_orderkey AS seen, o_orderkey % 4 AS kind, CASE WHEN o_orderkey % 5 > 0 THEN 'note ' || o_orderkey ELSE '' END AS notes FROM orders),
w AS (SELECT site_id, max(seen) FILTER (WHERE kind = 2) AS named, max(seen) FILTER (WHERE kind = 3) AS towned, max(seen) FILTER (WHERE kind < 2) AS judged, arg_max(kind, seen) FILTER (WHERE kind < 2) AS verdict,
  arg_max(notes, seen) FILTER (WHERE kind = 1 OR (kind = 0 AND notes <> '')) AS notes, max(seen) FILTER (WHERE kind = 1) AS urgent FROM a GROUP BY 1)
SELECT s.site_id, CASE WHEN named IS NOT NULL THEN 'Edited ' || named ELSE name END AS name, CASE WHEN towned IS NOT NULL THEN 'Town ' || towned ELSE city END AS city,
  CASE verdict WHEN 0 THEN 'approved' WHEN 1 THEN 'flagged' ELSE review_status END AS review_status, notes AS reviewer_notes, CASE WHEN urgent IS NOT NULL THEN 1 ELSE 9 END AS review_priority,
  CASE WHEN named IS NOT NULL OR towned IS NOT NULL THEN 'manual' ELSE primary_source END AS primary_source FROM sites s LEFT JOIN w ON w.site_id = s.site_id""",
    )
)
def review_log(spark, sf_dir):
    """All orders of a customer as review actions in turn: of each column the last write counts."""
    rows = views.sites(spark, sf_dir).withColumns({"reviewer_notes": F.lit(None).cast("string"), "review_priority": F.lit(9)})
    k = F.col("o_orderkey")
    key = k.cast("string")
    actions = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"), F.when(k % 4 == 0, "approve").when(k % 4 == 1, "flag").otherwise("edit").alias("action"), F.when(k % 5 > 0, F.concat(F.lit("note "), key)).otherwise("").alias("notes"),
        F.when(k % 4 == 2, F.create_map(F.lit("name"), F.concat(F.lit("Edited "), key))).when(k % 4 == 3, F.create_map(F.lit("city"), F.concat(F.lit("Town "), key))).alias("fields"), k.alias("at"),
    )
    return scoring.apply_actions(rows, actions).select("site_id", "name", "city", "review_status", "reviewer_notes", "review_priority", "primary_source")
