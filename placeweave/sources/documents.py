"""Lists, parks, battlefields, web pages and replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.constants import AREA_NAMES
from placeweave.functions.normalize import blank_to_null, literal_map, title_case

#: target column: headers it may have (fixed values)
LIST_HEADERS = {
    "nris_refnum": ["RefNum", "Ref#", "Reference Number", "Refnum"],
    "name": ["Resource Name", "ResName", "Property Name", "Historic Name"],
    "address": ["Address"], "city": ["City"], "county": ["County"], "state": ["State", "ST"],
    "nhl_designation_date": ["NHL Date", "NHL_Date"],
    "nrhp_cert_date": ["Cert Date", "CertDate", "Date Listed"],
}
AREA_LISTS = ["Areas of Significance", "AreaOfSignificance", "AreasOfSig"]
YES = ["X", "Y", "YES", "TRUE", "1"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]

PARK = (
    "id string, parkCode string, fullName string, name string, description string, url string, states string, latLong string, "
    "operatingHours array<struct<standardHours:map<string,string>>>, entranceFees array<struct<cost:string,title:string>>"
)


def _text(c: Column) -> Column:
    s = blank_to_null(c)
    return F.when(F.lower(s) != "nan", s)


def criteria_flags(columns: list[str]) -> Column:
    """Letters whose first existing flag column says yes."""
    found = []
    for letter in "ABCD":
        name = next((n for n in (f"Crit{letter}", f"Criteria {letter}", f"Criterion{letter}") if n in columns), None)
        if name:
            found.append(F.when(F.upper(F.trim(F.col(f"`{name}`"))).isin(YES), letter))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def significance_areas(columns: list[str], names: dict[str, str], delimited: list[str]) -> Column:
    """Slugs of the flag columns that say yes, else of a ``;`` or ``,`` separated list."""
    by_lower = {c.lower(): c for c in columns}
    flags = [F.when(F.upper(F.trim(F.col(f"`{by_lower[n.lower()]}`"))).isin(YES), F.lit(slug)) for n, slug in names.items() if n.lower() in by_lower]
    flagged = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    source = next((c for c in delimited if c in columns), None)
    if source is None:
        return flagged
    slugs = literal_map({n.lower(): s for n, s in names.items()})
    parts = F.split(F.translate(F.col(f"`{source}`"), ";", ","), ",")
    listed = F.filter(F.transform(parts, lambda p: F.try_element_at(slugs, F.lower(F.trim(p)))), lambda x: x.isNotNull())
    return F.when(F.size(flagged) > 0, flagged).otherwise(F.coalesce(listed, F.array().cast("array<string>")))


def read_list(spark: SparkSession, path: str, landmark: bool) -> DataFrame:
    """A delimited list, all text, headers by alias (S03); rows without a name are dropped."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    pick = {t: F.coalesce(*[_text(F.col(f"`{h}`")) for h in hs if h in raw.columns]) for t, hs in LIST_HEADERS.items() if any(h in raw.columns for h in hs)}
    absent = [t for t in LIST_HEADERS if t not in pick]
    kind = "Federal NHL" if landmark else "Federal NRHP"
    rows = raw.select(
        *[c.alias(t) for t, c in pick.items()], *[F.lit(None).cast("string").alias(t) for t in absent], criteria_flags(raw.columns).alias("criteria"),
        significance_areas(raw.columns, AREA_NAMES, AREA_LISTS).alias("areas"), F.lit(kind).alias("designation_type"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("raw_data_json"), F.lit(True).alias("source_spreadsheet"),
    )
    return rows.withColumn("nris_refnum", F.substring_index("nris_refnum", ".", 1)).where("name is not null")


def lat_long(text: Column) -> tuple[Column, Column]:
    """(lat, lon) of ``lat:…, long:…``, either may be null."""
    number = lambda key: F.nullif(F.regexp_extract(text, rf"{key}:\s*(-?[\d.]+)", 1), F.lit("")).try_cast("double")
    return number("lat"), number("long")


def parse_parks(parks: DataFrame) -> DataFrame:
    """Site rows of park documents."""
    hours = F.try_element_at("operatingHours", F.lit(1))["standardHours"]
    days = [F.when((F.length(F.trim(hours[d])) > 0) & (F.lower(F.trim(hours[d])) != "closed"), F.concat(F.lit(f"{d.title()}: "), hours[d])) for d in DAYS]
    free = lambda f: F.coalesce(f["cost"].try_cast("double") == 0, F.lit(False))
    fees = F.transform("entranceFees", lambda f: F.concat(f["title"], F.lit(": "), F.when(free(f), "Free").otherwise(F.concat(F.lit("$"), f["cost"]))))
    lat, lon = lat_long(F.col("latLong"))
    return parks.select(
        F.coalesce(blank_to_null(F.col("fullName")), blank_to_null(F.col("name"))).alias("name"), F.substring(F.trim("states"), 1, 2).alias("state"),
        lat.alias("latitude"), lon.alias("longitude"), F.substring("description", 1, 500).alias("short_description"),
        F.when(F.length("description") > 500, F.col("description")).alias("full_description"), F.col("url").alias("website_url"), F.col("parkCode").alias("nps_park_code"),
        F.nullif(F.array_join(F.array_compact(F.array(*days)), "; "), F.lit("")).alias("visiting_hours"), F.nullif(F.array_join(fees, "; "), F.lit("")).alias("admission_info"),
        F.lit(True).alias("source_nps_parks"),
    ).where("name is not null")


_RING = "array<array<double>>"


def parse_battlefields(collections: DataFrame, war: str) -> DataFrame:
    """Site rows of GeoJSON features (S18): vertex mean over all outer rings, six digits."""
    # generators in place of columns, and an outer one: a filter on a column makes it, and the JSON behind it, once more
    f = collections.select(F.explode_outer("features").alias("f")).select("f.properties", "f.geometry")
    polygon = F.from_json("geometry.coordinates", f"array<{_RING}>")
    several = F.from_json("geometry.coordinates", f"array<array<{_RING}>>")
    outer = F.when(F.col("geometry.type") == "Polygon", F.element_at(polygon, 1)).when(
        F.col("geometry.type") == "MultiPolygon", F.flatten(F.transform(several, lambda p: p[0]))
    )
    mean = lambda ps, k: F.round(F.aggregate(ps, F.lit(0.0), lambda s, p: s + p[k]) / F.nullif(F.size(ps), F.lit(0)), 6)
    return (
        f.select("properties", F.inline_outer(F.transform(F.array(outer), lambda ps: F.struct(mean(ps, 1).alias("latitude"), mean(ps, 0).alias("longitude")))))
        .select(
            title_case(F.trim(F.col("properties")["NAME"])).alias("name"), F.trim(F.element_at(F.split(F.col("properties")["STATE"], "/"), 1)).alias("state"),
            "latitude", "longitude", F.lit(war).alias("war"),
        )
        .where("name is not null and name <> '' and latitude is not null")
    )


#: The schema that parse_battlefields reads; coordinates stay text until their type is known.
GEOJSON = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"


def _plain(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]+>", " "), r"\s+", " "))


def page_outline(pages: DataFrame) -> DataFrame:
    """(page_id, n_items, heading): list items and first heading of pages, for pages without tables."""
    heading = F.nullif(F.trim(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
    items = F.size(F.regexp_extract_all("html", F.lit(r"(?s)(<li[^>]*>.*?</li>)"), F.lit(1)))
    return pages.select("page_id", F.coalesce(items, F.lit(0)).cast("long").alias("n_items"), heading.alias("heading"))


def listing_rows(pages: DataFrame) -> DataFrame:
    """(page_id, row_no, name, refnum, date, city, county) of the table rows of listing pages."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?s)(<tr.*?</tr>)"), F.lit(1))).alias("row_no", "row"))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), _plain)
    rows = rows.withColumn("cells", cells).where(F.size("cells") > 0)
    linked = F.nullif(F.regexp_extract("row", r"Detail/([^/?\"'<> ]+)", 1), F.lit(""))
    ending = r"\(([A-Z]?\d+)\)\s*$"
    first = F.element_at("cells", 1)
    ref = F.coalesce(linked, F.nullif(F.regexp_extract(first, ending, 1), F.lit("")))
    name = F.when(linked.isNull(), F.trim(F.regexp_replace(first, ending, ""))).otherwise(first)
    date = F.try_element_at(F.filter("cells", lambda c: c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$")), F.lit(1))
    town = F.try_element_at(F.filter("cells", lambda c: c.rlike(r"^[^()]+ \([^()]+\)$") & ~c.rlike(r"\([A-Z]?\d+\)$")), F.lit(1))
    return rows.select(
        "page_id", "row_no", name.alias("name"), ref.alias("refnum"), date.alias("date"),
        F.trim(F.regexp_extract(town, r"^([^()]+) \(", 1)).alias("city"), F.trim(F.regexp_extract(town, r"\(([^()]+)\)$", 1)).alias("county"),
    )


#: field: label on a detail page (fixed values)
DETAIL_LABELS = {
    "nps_number": "NPS Number", "registration_date": "Registration Date", "location": "Location", "county": "County",
    "directions": "Directions", "criteria": "Criteria", "architect": "Architect", "year_built": "Year Built",
}


def detail_fields(pages: DataFrame) -> DataFrame:
    """Labelled lines of detail pages."""
    text = F.regexp_replace("html", r"<[^>]+>", "\n")
    fields = [F.nullif(F.trim(F.regexp_extract("t", rf"{label}:?[ \t]*\n*[ \t]*([^\n]+)", 1)), F.lit("")).alias(name) for name, label in DETAIL_LABELS.items()]
    return pages.select("page_id", text.alias("t")).select("page_id", *fields)


def listed_sites(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Listing rows with what their detail page adds; the listing is preferred.

    ``details`` carry the refnum of the listing they belong to, or else their own number.
    The detail page's location is the city, its directions are the address.
    """
    d = details.select(
        F.col("refnum" if "refnum" in details.columns else "nps_number").alias("refnum"), F.col("county").alias("__county"), F.col("location").alias("__city"), F.col("directions").alias("address"),
        F.col("year_built").alias("date_constructed"),
    )
    empty = F.lit("")
    filled = {"county": F.coalesce(F.nullif("county", empty), "__county"), "city": F.coalesce(F.nullif("city", empty), "__city")}
    return listing.join(d, "refnum", "left").withColumns(filled).drop("__county", "__city")


def geocoder_replies(lines: DataFrame, column: str = "value") -> DataFrame:
    """(id, lat, lon, quality) of reply lines with six columns and a match."""
    schema = "id string, input string, hit string, kind string, matched string, spot string"
    r = lines.select(F.from_csv(column, schema).alias("r")).select("r.*").where(F.col("hit").isin("Match", "Non_Exact") & F.col("spot").isNotNull())
    part = F.split("spot", ",")
    lon, lat = F.try_element_at(part, F.lit(1)).try_cast("double"), F.try_element_at(part, F.lit(2)).try_cast("double")
    quality = F.when(F.col("hit") == "Non_Exact", "interpolated").otherwise("exact")
    return r.select("id", lat.alias("lat"), lon.alias("lon"), quality.alias("quality")).where("lat is not null and lon is not null")


def array_replies(replies: DataFrame, schema: str, column: str = "text") -> DataFrame:
    """Rows of the JSON array between the first ``[`` and the last ``]`` (S23); broken ones give none."""
    found = F.from_json(F.regexp_extract(column, r"(?s)(\[.*\])", 1), f"array<struct<{schema}>>")
    return replies.select(*[c for c in replies.columns if c != column], F.explode(found).alias("r")).select("*", "r.*").drop("r")


def object_replies(replies: DataFrame, schema: str, column: str = "text") -> DataFrame:
    """The JSON object between the first ``{`` and the last ``}`` with a method tag."""
    found = F.from_json(F.regexp_extract(column, r"(?s)(\{.*\})", 1), f"struct<{schema}>" if not schema.startswith("struct") else schema)
    rows = replies.select(*[c for c in replies.columns if c != column], found.alias("r")).where("r is not null").select("*", "r.*").drop("r")
    return rows.withColumn("method", F.when(F.coalesce("confidence", F.lit(0.0)) < 0.3, "extraction_low_confidence").otherwise("extraction"))
