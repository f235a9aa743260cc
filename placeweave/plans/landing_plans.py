"""Registered queries of typed landing, marker tiles and totals, each with the SQL that checks it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from placeweave.operators import profile
from placeweave.plans import views
from placeweave.plans.registry import query
from placeweave.plans.source_plans import _SIDES, _state_merge
from placeweave.plans.views import with_tables
from placeweave.session import shared_folder
from placeweave.sinks import tiles
from placeweave.sources import landing

_SURVEY = {
    "key": "xx", "state_code": "XX", "where": "t_KIND = 'A' AND n_AREA >= 20",
    "field_map": {"name": ["HIST", "NAME"], "city": ["TOWN"], "county": ["CNTY"], "state_record_id": ["OID"], "date_listed": ["LISTED"], "date_constructed": ["BUILT"]},
}
_FREQUENT = ["NAME", "TOWN", "OID", "LISTED", "KIND", "AREA"]


@query(
    with_tables(
        "sites",
        body=""" SELECT CAST(site_id AS VARCHAR) AS state_record_id, trim(name) AS name, 'XX' AS state, nullif(trim(city), '') AS city, nullif(trim(county), '') AS county,
  CASE WHEN site_id % 4 = 0 THEN CAST(1800 + site_id % 200 AS VARCHAR) END AS date_constructed,
  CASE WHEN site_id % 3 = 0 THEN '19650101' ELSE strftime(make_timestamp(CAST(site_id AS BIGINT) * 86400000000), '%Y-%m-%d') END AS state_designation_date, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude
FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND site_id % 2 = 0 AND site_id % 50 >= 20""",
    )
)
def landed_sites(spark, sf_dir):
    """All sites as features with numbers and texts, landed as VARIANT and columns, then read by a source's map."""
    k = F.col("site_id")
    common = [
        F.col("name").alias("NAME"), F.lit(" ").alias("HIST"), F.col("city").alias("TOWN"), F.col("county").alias("CNTY"), k.alias("OID"), F.when(k % 2 == 0, "A").otherwise("B").alias("KIND"),
        (k % 50).alias("AREA"), F.when(k % 4 == 0, 1800 + k % 200).alias("BUILT"), F.array(k, k + 1).alias("OTHER"),
    ]
    point = F.struct(F.col("longitude").alias("x"), F.col("latitude").alias("y")).alias("geometry")
    feature = lambda date: F.to_json(F.struct(F.struct(*common, date.alias("LISTED")).alias("attributes"), point))
    lines = views.sites(spark, sf_dir).select(F.when(k % 3 == 0, feature(F.lit("19650101"))).otherwise(feature(k * 86_400_000)).alias("value"))
    landed = landing.land(landing.typed_features(lines, _FREQUENT), f"{shared_folder(spark)}/{uuid.uuid4().hex}")
    rows = landing.parse_landed(landed, _SURVEY)
    return rows.select("state_record_id", "name", "state", "city", "county", "date_constructed", "state_designation_date", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


_DEEPEST = 12


@query(
    with_tables(
        "sites",
        body=f""", z AS (SELECT CAST(z AS INTEGER) AS zoom, CAST(1 AS BIGINT) << z AS n FROM range({_DEEPEST + 1}) AS r(z)),
m AS (SELECT site_id, review_status AS layer, latitude, longitude, least(greatest(CAST(floor((longitude + 180) / 360 * {1 << _DEEPEST}) AS BIGINT), 0), {(1 << _DEEPEST) - 1}) AS x,
  least(greatest(CAST(floor((90 - latitude) / 180 * {1 << _DEEPEST}) AS BIGINT), 0), {(1 << _DEEPEST) - 1}) AS y FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
t AS (SELECT zoom, array_to_string(list_transform(range(zoom), lambda k: CAST(((x >> ({_DEEPEST} - 1 - k)) & 1) + 2 * ((y >> ({_DEEPEST} - 1 - k)) & 1) AS VARCHAR)), '') AS tile, layer, site_id, latitude, longitude FROM m, z)
SELECT zoom, coalesce(tile, '') AS tile, layer, count(*) AS n, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude, CASE WHEN count(*) = 1 THEN min(site_id) END AS site_id FROM t GROUP BY 1, 2, 3""",
    )
)
def marker_tiles(spark, sf_dir):
    """Clusters of all sites by review status at zooms 0 to 12."""
    found = tiles.marker_tiles(views.sites(spark, sf_dir), _DEEPEST, "review_status")
    return found.withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})


@query(
    with_tables(
        "sites",
        body=_SIDES
        + """, o AS (SELECT state, outcome FROM placed),
c AS (SELECT state, outcome, count(*) AS n, 1 AS level FROM o GROUP BY 1, 2 UNION ALL SELECT state, 'total', count(*), 1 FROM o GROUP BY 1 UNION ALL SELECT NULL, outcome, count(*), 0 FROM o GROUP BY 2 UNION ALL SELECT NULL, 'total', count(*), 0 FROM o)
SELECT state, outcome, n, level FROM c UNION ALL SELECT state, 'updated', CAST(sum(n) AS BIGINT), level FROM c WHERE starts_with(outcome, 'matched') GROUP BY state, level""",
    )
)
def state_merge_totals(spark, sf_dir):
    """Records of each outcome by state and over all: inserted, each way of matching, updated, total."""
    out = _state_merge(spark, sf_dir)
    # a record's state is that of validation, which the provenance row keeps
    state = F.get_json_object("raw_data_json", "$.state")
    raw = out["sources"].select(F.get_json_object("raw_data_json", "$.arrival").cast("long").alias("arrival"), state.alias("state"))
    return profile.totals(out["outcomes"].join(raw, "arrival"), ["state"])
