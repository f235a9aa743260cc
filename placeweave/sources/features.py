"""Map-service features to site rows.

A source is described by a plain dictionary; it compiles to one projection and one
filter over ``features`` (attributes: map<string,string>, geometry: struct), so
column pruning and pushdown stay with Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.constants import LAYER_STATES, LAYER_UNUSED, STATE_CODES
from placeweave.functions.names import is_generic, pick_entry, strip_invisible, strip_patterns, unshout
from placeweave.functions.normalize import blank_to_null, epoch_ms_to_iso, literal_map

FEATURE = "attributes map<string,string>, geometry struct<x:double,y:double,points:array<array<double>>,rings:array<array<array<double>>>>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A landed array of features, or one feature a line; no inference."""
    return spark.read.schema(FEATURE).option("multiLine", True).json(path)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """A landed collection with its features under ``features``."""
    return spark.read.schema(f"features array<struct<{FEATURE}>>").option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")


def first_filled(attributes: Column, aliases: list[str]) -> Column:
    """The first alias whose trimmed value is not empty."""
    return F.coalesce(*[blank_to_null(attributes[a]) for a in aliases]) if aliases else F.lit(None).cast("string")


def ring_mean(ring: Column, axis: int) -> Column:
    """Mean over all vertices; a closed ring counts its first vertex twice."""
    return F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[axis]) / F.nullif(F.size(ring), F.lit(0))


def area_centroid(ring: Column) -> Column:
    """struct(lon, lat): area-weighted centroid of a closed ring, null if empty or flat."""
    pairs = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    cross = lambda e: e["p"][0] * e["q"][1] - e["q"][0] * e["p"][1]
    total = F.aggregate(pairs, F.lit(0.0), lambda s, e: s + cross(e))
    moment = lambda k: F.aggregate(pairs, F.lit(0.0), lambda s, e: s + (e["p"][k] + e["q"][k]) * cross(e))
    return F.when(total != 0, F.struct((moment(0) / (3 * total)).alias("lon"), (moment(1) / (3 * total)).alias("lat")))


def polygon_centroid(rings: Column) -> Column:
    """struct(lon, lat): area-weighted centroid of all rings, where outer rings turn one
    way and holes the other, as in map services; null if empty or flat (S17)."""
    parts = F.filter(F.transform(rings, lambda r: F.struct(ring_area(r).alias("area"), area_centroid(r).alias("at"))), lambda p: p["at"].isNotNull())
    total = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["area"])
    mean = lambda n: F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["area"] * p["at"][n]) / total
    return F.when(total != 0, F.struct(mean("lon").alias("lon"), mean("lat").alias("lat")))


def ring_area(ring: Column) -> Column:
    """Twice the signed area of a closed ring."""
    pairs = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda p, q: p[0] * q[1] - q[0] * p[1])
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def place(geometry: Column) -> tuple[Column, Column]:
    """(lon, lat): the point, else the first of several, else the mean of the outer ring."""
    point = F.try_element_at(geometry["points"], F.lit(1))
    ring = F.try_element_at(geometry["rings"], F.lit(1))
    clean = lambda c: F.when(~F.isnan(c), c)
    return tuple(clean(F.coalesce(geometry[n], F.try_element_at(point, F.lit(k + 1)), ring_mean(ring, k))) for k, n in enumerate(("x", "y")))


def listed_date(c: Column) -> Column:
    """A whole number is epoch milliseconds, other text stays."""
    return F.when(c.rlike(r"^-?\d+$"), epoch_ms_to_iso(c)).otherwise(c)


def clean_name(c: Column, config: dict) -> Column:
    """Invisible characters, artefacts, several entries and capitals, as configured.

    Names of an exported geodatabase (``adapter``: gdb) stay as they are (S16)."""
    if config.get("adapter") == "gdb":
        return F.trim(c)
    c = strip_invisible(c)
    if config.get("name_strip_patterns"):
        c = strip_patterns(c, config["name_strip_patterns"])
    if config.get("name_multi_entry"):
        c = pick_entry(c)
    return unshout(c) if config.get("name_upper_to_title") else c


def parse_source(features: DataFrame, config: dict, generic_terms: list[str] | None = None) -> DataFrame:
    """Site rows of one source.

    ``config``: key, state_code, field_map (target: aliases), and optionally where
    (a predicate over attributes as SQL), address_parts, state_name_field, multi_state
    and the name options.  Rows without a name or a place are dropped.
    """
    fields, attributes = config["field_map"], F.col("attributes")
    get = lambda target: first_filled(attributes, fields.get(target, []))
    if config.get("where"):
        features = features.where(config["where"])
    lon, lat = place(F.col("geometry"))
    address = get("address")
    if config.get("address_parts"):
        address = F.nullif(F.concat_ws(" ", *[first_filled(attributes, [p]) for p in config["address_parts"]]), F.lit(""))
    state = F.lit(config.get("state_code"))
    if config.get("state_name_field"):
        codes = {k.upper(): v for k, v in STATE_CODES.items() if k not in LAYER_UNUSED} | LAYER_STATES
        named = F.try_element_at(literal_map(codes), F.upper(F.trim(attributes[config["state_name_field"]])))
        state = F.coalesce(named, state)
    tag = f"shpo_{config['key']}"
    rows = features.select(
        clean_name(get("name"), config).alias("name"), state.alias("state"), get("city").alias("city"), get("county").alias("county"), address.alias("address"),
        lat.alias("latitude"), lon.alias("longitude"), get("nris_refnum").alias("nris_refnum"), get("state_record_id").alias("state_record_id"),
        get("date_constructed").alias("date_constructed"), listed_date(get("date_listed")).alias("state_designation_date"),
        F.lit(True).alias("source_shpo"), F.lit(tag).alias("primary_source"), F.lit(tag).alias("coordinates_source"), F.to_json("attributes").alias("raw_data_json"),
    )
    rows = rows.where("name is not null and name <> '' and latitude is not null and longitude is not null")
    if config.get("skip_generic_names") and generic_terms:
        rows = rows.where(~is_generic(F.col("name"), generic_terms))
    return rows


def parse_federal(features: DataFrame) -> DataFrame:
    """Site rows of the federal point layer."""
    a = F.col("attributes")
    return features.select(
        first_filled(a, ["ResName", "RESNAME"]).alias("name"), first_filled(a, ["RefNum", "NRIS_Refnum", "PROPERTY_ID"]).alias("nris_refnum"),
        first_filled(a, ["Address"]).alias("address"), first_filled(a, ["City"]).alias("city"), first_filled(a, ["County"]).alias("county"),
        first_filled(a, ["State"]).alias("state"), F.col("geometry.y").alias("latitude"), F.col("geometry.x").alias("longitude"),
        epoch_ms_to_iso(F.coalesce(a["CertDate"], a["CERTDATE"])).alias("nrhp_cert_date"), first_filled(a, ["Status", "STATUS"]).alias("nrhp_status"), F.lit("arcgis").alias("coordinates_source"), F.lit(True).alias("source_arcgis"),
        F.lit("arcgis").alias("primary_source"),
    ).where("name is not null and latitude is not null and longitude is not null")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
