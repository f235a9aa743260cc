"""Exports: CSV, GeoJSON lines, placemarks, markers, requests and reports."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeweave.constants import DESIGNATIONS
from placeweave.operators.tables import numbered

PLACEMARKS = 2000
#: in the order of the file (fixed values)
PROPERTIES = [
    "name", "nris_refnum", "state", "city", "county", "address", "date_constructed", "nhl_designation_date", "nrhp_cert_date",
    "condition", "public_access", "website_url", "short_description", "confidence_score", "review_status",
]
#: columns of the review file and of the review tool's (fixed values)
REVIEW_COLUMNS = [
    "site_id", "name", "state", "city", "nris_refnum", "confidence_score", "review_priority", "review_status",
    "reviewer_notes", "latitude", "longitude", "short_description", "condition", "public_access",
]
TOOL_COLUMNS = [
    "site_id", "name", "state", "nris_refnum", "confidence_score", "review_priority", "review_status",
    "reviewer_notes", "latitude", "longitude", "short_description",
]


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; quotes inside texts are doubled, white space at their ends stays."""
    df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def review_rows(sites: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Flagged sites by priority and score, the site's number as ``id`` (K01, with TOOL_COLUMNS K02)."""
    chosen = [_or_null(sites, c).alias("id" if c == "site_id" else c) for c in columns or REVIEW_COLUMNS]
    return sites.where(F.col("review_status") == "flagged").orderBy("review_priority", "confidence_score", "site_id").select(*chosen)


def feature_collection(features: DataFrame, path: str) -> None:
    """Lines of features as one collection a part file (K05): head, features, end."""
    lines = features.select(F.col("feature").alias("value"))

    def wrapped(batches):
        first = True
        for batch in batches:
            values = batch.column(0).to_pylist()
            text = [("" if first and not k else ",") + v for k, v in enumerate(values)]
            first = first and not text
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["value"])

    whole = lines.mapInArrow(lambda b: _enclosed(wrapped(b)), "value string")
    whole.write.mode("overwrite").text(path)


def _enclosed(batches):
    line = lambda x: pa.RecordBatch.from_arrays([pa.array([x], pa.string())], names=["value"])
    yield line('{"type":"FeatureCollection","features":[')
    yield from batches
    yield line("]}")


def full_rows(sites: DataFrame) -> DataFrame:
    """All columns by state and name, nulls first."""
    return sites.orderBy("state", "name")


def geojson_features(sites: DataFrame) -> DataFrame:
    """(site_id, state, feature): a point feature of every site with coordinates, null properties left out."""
    known = [F.col("site_id").alias("id"), *[F.col(p) for p in PROPERTIES if p in sites.columns]]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
        F.struct(*known).alias("properties"),
    )
    return sites.where("latitude is not null and longitude is not null").select("site_id", "state", F.to_json(feature).alias("feature"))


def landmark_features(sites: DataFrame, designations: DataFrame, kind: str = "Federal NHL") -> DataFrame:
    """Features of the sites with a designation."""
    return geojson_features(sites.join(designations.where(F.col("designation_type") == kind).select("site_id"), "site_id", "left_semi"))


def write_by_state(lines: DataFrame, path: str, column: str) -> None:
    """One folder a state of newline-delimited text."""
    lines.select("state", F.col(column).alias("value")).write.mode("overwrite").partitionBy("state").text(path)


def _tag(label: str, c: Column) -> Column:
    body = F.concat(F.lit(f"<p><b>{label}:</b> "), c, F.lit("</p>"))
    return F.when(F.length(c) > 0, body)


def _or_null(sites: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in sites.columns else F.lit(None).cast(kind)


def description_html(sites: DataFrame) -> Column:
    """Paragraphs of what is known of a site, else its name."""
    get = lambda n: _or_null(sites, n)
    town = F.when((F.length(get("city")) > 0) & (F.length(get("state")) > 0), F.concat(get("city"), F.lit(", "), get("state")))
    score = _or_null(sites, "confidence_score", "double")
    parts = [
        F.when(F.length(get("short_description")) > 0, F.concat(F.lit("<p>"), get("short_description"), F.lit("</p>"))),
        _tag("Address", get("address")), _tag("Location", town), _tag("NHL Designated", get("nhl_designation_date")),
        _tag("NRHP Listed", get("nrhp_cert_date")), _tag("Public Access", get("public_access")), _tag("Hours", get("visiting_hours")),
        _tag("Admission", get("admission_info")),
        F.when(F.length(get("website_url")) > 0, F.concat(F.lit('<p><a href="'), get("website_url"), F.lit('">Website</a></p>'))),
        F.when(score.isNotNull(), F.concat(F.lit("<p><b>Confidence:</b> "), F.format_string("%.2f", score), F.lit("</p>"))),
    ]
    return F.coalesce(F.nullif(F.concat_ws("\n", *parts), F.lit("")), F.col("name"))


def kml_placemarks(sites: DataFrame) -> DataFrame:
    """(state, part, site_id, placemark): parts of PLACEMARKS rows by name in each state.

    ``part`` is null where a state needs one file only.
    """
    spots = sites.where("latitude is not null and longitude is not null").withColumn("state", F.coalesce("state", F.lit("Unknown")))
    sizes = spots.groupBy("state").agg(F.count("*").alias("__n"))
    escape = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    mark = F.concat(
        F.lit("<Placemark><name>"), escape(F.col("name")), F.lit("</name><description><![CDATA["), description_html(sites),
        F.lit("]]></description><Point><coordinates>"), F.concat_ws(",", F.col("longitude").cast("string"), F.col("latitude").cast("string")),
        F.lit("</coordinates></Point></Placemark>"),
    )
    placed = numbered(spots, ["state"], ["name", "site_id"], F.substring("name", 1, 3), "__place")
    placed = placed.withColumn("__part", F.floor(F.col("__place") / PLACEMARKS) + 1).join(sizes, "state")
    return placed.select("state", F.when(F.col("__n") > PLACEMARKS, F.col("__part")).alias("part"), "site_id", mark.alias("placemark"))


def best_designation(designations: DataFrame) -> DataFrame:
    """(site_id, designation_type, colour) of the highest designation."""
    names = F.create_map(*[F.lit(x) for k, (r, _) in DESIGNATIONS.items() for x in (k, r)])
    rank = F.coalesce(F.try_element_at(names, F.col("designation_type")), F.lit(6))
    colours = F.create_map(*[F.lit(x) for k, (_, c) in DESIGNATIONS.items() for x in (k, c)])
    best = designations.groupBy("site_id").agg(F.min(F.struct(rank.alias("r"), F.col("designation_type").alias("t"))).alias("b"))
    return best.select("site_id", F.col("b.t").alias("designation_type"), F.coalesce(F.try_element_at(colours, F.col("b.t")), F.lit("gray")).alias("colour"))


def popup_html(sites: DataFrame) -> Column:
    """The marker's text with its truncations."""
    get = lambda n: _or_null(sites, n)
    small = lambda label, c: F.when(F.length(c) > 0, F.concat(F.lit(f"<p><small>{label}"), c, F.lit("</small></p>")))
    town = F.when((F.length(get("city")) > 0) & (F.length(get("state")) > 0), F.concat(get("city"), F.lit(", "), get("state"))).otherwise(get("state"))
    parts = [
        F.concat(F.lit("<h4>"), F.col("name"), F.lit("</h4>")),
        F.when(F.length(town) > 0, F.concat(F.lit("<p><b>"), town, F.lit("</b></p>"))),
        F.when(F.length(get("short_description")) > 0, F.concat(F.lit("<p>"), F.substring(get("short_description"), 1, 300), F.lit("</p>"))),
        small("NHL: ", get("nhl_designation_date")), small("Access: ", get("public_access")),
        small("Hours: ", F.substring(get("visiting_hours"), 1, 100)), small("", F.substring(get("admission_info"), 1, 100)),
        F.when(F.length(get("website_url")) > 0, F.concat(F.lit('<p><a href="'), get("website_url"), F.lit('" target="_blank">Website</a></p>'))),
    ]
    return F.concat_ws("\n", *parts)


def map_markers(sites: DataFrame, designations: DataFrame) -> DataFrame:
    """A marker for every site with coordinates."""
    spots = sites.where("latitude is not null and longitude is not null")
    rows = spots.join(best_designation(designations), "site_id", "left")
    layer = F.when(F.col("designation_type").isin("Federal NHL", "Federal NRHP", "State Register"), F.col("designation_type")).otherwise("Other")
    return rows.select("site_id", "latitude", "longitude", F.coalesce("colour", F.lit("gray")).alias("colour"), layer.alias("layer"), popup_html(spots).alias("popup"), F.col("name").alias("tooltip"))


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines for each section."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def geocoder_requests(sites: DataFrame, size: int = 10_000, groups: int = 64) -> DataFrame:
    """(chunk, line) of request files with at most ``size`` addresses.

    Rows are numbered inside hashed groups, so no single task numbers them all.
    """
    rows = sites.where(F.col("latitude").isNull() & (F.length(F.trim("address")) > 0)).withColumn("__g", F.pmod(F.xxhash64("site_id"), F.lit(groups)))
    place = F.row_number().over(Window.partitionBy("__g").orderBy("site_id"))
    line = F.to_csv(F.struct("site_id", "address", F.coalesce("city", F.lit("")).alias("city"), F.coalesce("state", F.lit("")).alias("state"), F.lit("").alias("zip")))
    chunk = F.concat_ws("-", F.col("__g").cast("string"), F.floor((place - 1) / size).cast("string"))
    return rows.select("site_id", chunk.alias("chunk"), line.alias("line"))


def query_strings(sites: DataFrame) -> DataFrame:
    """(site_id, by_address, by_name, by_city) for a web geocoder, blanks left out."""
    filled = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    path = lambda *cs: F.concat_ws(", ", *[filled(c) for c in cs], F.lit("United States"))
    return sites.select(
        "site_id",
        F.when(filled("address").isNotNull(), path("address", "city", "state")).alias("by_address"),
        path("name", "city", "state").alias("by_name"),
        F.when(filled("city").isNotNull(), path("city", "state")).alias("by_city"),
    )


def land_raw(features: DataFrame, path: str) -> None:
    """Raw features kept verbatim for each source."""
    features.write.mode("append").partitionBy("source_key").parquet(path)
