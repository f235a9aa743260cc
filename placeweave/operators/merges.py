"""Merges put together: validation, upsert, children, provenance, counts and runs
(W02, W03, W09, W10, W13-W15, W18, W19, W22, W23, W-h, A14-A17, J19).

Each function takes tables and gives tables; what a merge writes comes back as a
dictionary of DataFrames by table name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeweave.functions.normalize import validate_coordinates
from placeweave.operators.tables import checksum, folded, insert_or_ignore, keep_last, last_replies, upsert_first_wins
from placeweave.operators.validate import validate_sites

LETTERS = ("A", "B", "C", "D")


def assigned(current: DataFrame, incoming: DataFrame, key: str = "nris_refnum", order: str = "arrival") -> DataFrame:
    """``incoming`` with the site each record goes to and its outcome.

    A record updates the site of its key, or the one an earlier record of its key
    inserted; else it is inserted under the number of its arrival.
    """
    known = current.where(F.col(key).isNotNull()).select(key, F.col("site_id").alias("__now"))
    first = incoming.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("__first"))
    out = incoming.join(first, key, "left").join(known, key, "left")
    later = F.col("__now").isNotNull() | F.coalesce(F.col(order) > F.col("__first"), F.lit(False))
    site = F.coalesce("__now", "__first", order).alias("site_id")
    return out.select(*incoming.columns, site, F.when(later, "updated").otherwise("inserted").alias("outcome"))


def provenance(records: DataFrame, source: str | Column, record_id: Column, raw: list[str], url: Column | None = None) -> DataFrame:
    """(site_id, source_name, source_record_id, source_url, raw_data_json) of records with a site."""
    name = F.lit(source) if isinstance(source, str) else source
    body = F.to_json(F.struct(*raw)) if raw else F.lit(None).cast("string")
    return records.select(
        "site_id", name.alias("source_name"), record_id.cast("string").alias("source_record_id"),
        (F.lit(None).cast("string") if url is None else url).alias("source_url"), body.alias("raw_data_json"),
    )


def merge_points(current: DataFrame, incoming: DataFrame, source: str, flags: list[str]) -> dict[str, DataFrame]:
    """Records of a point layer: validated, upserted by refnum, with provenance and counts.

    ``current`` has site_id, ``incoming`` arrival and site columns.
    """
    checked = validate_sites(incoming).drop("status", "issues")
    placed = assigned(current, checked)
    merged = upsert_first_wins(current, checked, "nris_refnum", "arrival", flags)
    ids = placed.where("outcome = 'inserted' and nris_refnum is not null").select(F.col("nris_refnum").alias("__ref"), F.col("site_id").alias("__id"))
    keyed = merged.where("nris_refnum is not null").join(ids, F.col("nris_refnum") == F.col("__ref"), "left")
    sites = keyed.withColumn("site_id", F.coalesce("site_id", "__id")).select(*current.columns)
    unkeyed = placed.where("nris_refnum is null").select(*[c for c in current.columns if c in placed.columns])
    return {
        "sites": sites.unionByName(current.where("nris_refnum is null")).unionByName(unkeyed, allowMissingColumns=True),
        "sources": provenance(placed, source, F.col("nris_refnum"), checked.columns),
        "outcomes": placed.select("arrival", "site_id", "outcome"),
    }


def merge_list(
    current: DataFrame, incoming: DataFrame, source: str, flags: list[str], designations: DataFrame
) -> dict[str, DataFrame]:
    """Records of a list (with criteria, areas and designation_type): as ``merge_points``,
    with criteria and areas appended and the designation added once (W03)."""
    fields = [c for c in incoming.columns if c not in ("criteria", "areas", "designation_type")]
    out = merge_points(current, incoming.select(*fields), source, flags)
    told = incoming.select("arrival", "criteria", "areas", "designation_type").join(out["outcomes"], "arrival")
    tag = F.lit(source).alias("source")
    out["criteria"] = told.select("site_id", F.explode("criteria").alias("criterion"), tag)
    out["areas"] = told.select("site_id", F.explode("areas").alias("area"), tag)
    out["designations"] = add_designations(designations, told.select("site_id", "arrival", F.array("designation_type").alias("types"), F.lit(None).cast("string").alias("date")), None, source)
    return out


def add_designations(current: DataFrame, records: DataFrame, authority: str | None, source: str) -> DataFrame:
    """Every type of every record, unless its site has it.

    ``records``: site_id, arrival, types, date; ``current``: site_id,
    designation_type, designation_date, designating_authority, source.
    """
    rows = records.select(
        "site_id", "arrival", F.explode("types").alias("designation_type"), F.col("date").alias("designation_date"),
        F.lit(authority).cast("string").alias("designating_authority"), F.lit(source).alias("source"),
    )
    return insert_or_ignore(current, rows, ["site_id", "designation_type"], F.col("designation_type").isNotNull(), "arrival")


def upsert_changed(current: DataFrame, incoming: DataFrame, flags: list[str], at: Column) -> DataFrame:
    """As ``upsert_first_wins`` by refnum, but a record that is what was last written
    changes nothing, and one that is not sets data_checksum and updated_at (W01, W22)."""
    fields = [c for c in incoming.columns if c not in ("arrival", "data_checksum", "updated_at")]
    told = incoming.select(*fields, "arrival").withColumn("data_checksum", checksum(fields))
    stored = current.where("nris_refnum is not null").select("nris_refnum", "data_checksum")
    fresh = told.join(stored, ["nris_refnum", "data_checksum"], "left_anti")
    merged = upsert_first_wins(current, fresh.drop("data_checksum"), "nris_refnum", "arrival", flags)
    last = keep_last(fresh.where("nris_refnum is not null"), ["nris_refnum"], "arrival").select(F.col("nris_refnum").alias("__ref"), F.col("data_checksum").alias("__sum"))
    out = merged.join(last, F.col("nris_refnum") == F.col("__ref"), "left")
    changed = {"data_checksum": F.coalesce("__sum", "data_checksum"), "updated_at": F.when(F.col("__sum").isNotNull(), at).otherwise(F.col("updated_at"))}
    return out.withColumns(changed).select(*current.columns)


def apply_lookups(sites: DataFrame, replies: DataFrame, method: str = "web_search", order: str | None = "at") -> dict[str, DataFrame]:
    """Looked-up addresses (site_id, latitude, longitude, address, source_url, confidence)
    with sound coordinates, exchanged ones put right, take effect; one with a source
    leaves provenance (W13).  The last reply of a site counts, sound or not (J17)."""
    r = last_replies(replies, "site_id", order)
    r = r.select("site_id", F.col("latitude").try_cast("double").alias("__lat"), F.col("longitude").try_cast("double").alias("__lon"), F.col("address").alias("__address"), "source_url", "confidence")
    r = r.withColumn("__p", validate_coordinates(F.col("__lat"), F.col("__lon"))).where("__lat is not null and __lon is not null and __p.valid")
    hit = F.col("__p").isNotNull()
    put = {
        "latitude": F.when(hit, F.col("__p.latitude")).otherwise(F.col("latitude")), "longitude": F.when(hit, F.col("__p.longitude")).otherwise(F.col("longitude")),
        "coordinates_source": F.when(hit, "ai_lookup").otherwise(F.col("coordinates_source")), "geocode_quality": F.when(hit, "ai_lookup").otherwise(F.col("geocode_quality")),
        "address": F.coalesce(F.nullif(F.trim("__address"), F.lit("")), F.col("address")),
    }
    sourced = r.where(F.length("source_url") > 0).select("site_id", "source_url", F.coalesce("confidence", F.lit("low")).alias("confidence"), F.lit(method).alias("method"))
    return {
        "sites": sites.join(r.drop("source_url", "confidence"), "site_id", "left").withColumns(put).select(*sites.columns),
        "sources": provenance(sourced, "ai_geocode", F.lit(None), ["confidence", "method"], F.col("source_url")),
    }


def apply_batches(sites: DataFrame, requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Enrichment status after a classifier's replies (W14): sites with a reply are
    complete and keep it as JSON, sites of a batch without any reply are partial.

    ``requests``: batch, site_id; ``replies``: batch, site_id and what was said.
    """
    answered = replies.select("batch").distinct().withColumn("__any", F.lit(True))
    told = replies.groupBy("site_id").agg(F.max(F.to_json(F.struct(*replies.columns))).alias("__raw"))
    asked = requests.join(answered, "batch", "left").groupBy("site_id").agg(F.max(F.coalesce("__any", F.lit(False))).alias("__answered"))
    status = F.when(F.col("__raw").isNotNull(), "complete").when(~F.col("__answered"), "partial").otherwise(F.col("enrichment_status"))
    out = sites.join(told, "site_id", "left").join(asked, "site_id", "left")
    return out.withColumns({"enrichment_status": status, "enrichment_raw_json": F.coalesce("__raw", "enrichment_raw_json")}).select(*sites.columns)


def apply_nominations(sites: DataFrame, nominations: DataFrame, order: str | None = "at") -> dict[str, DataFrame]:
    """Extracted nominations take effect on their sites.

    ``nominations``: site_id, start_year, end_year, areas, criteria, statement,
    condition; all fields of a failed extraction are null.  The flag is set always.  Of
    several nominations of a site the last text, condition and extraction count, and all
    periods, areas and criteria are added.
    """
    fields = [c for c in nominations.columns if c != order]
    n = nominations
    read = F.greatest(*[F.col(c).isNotNull() for c in fields if c != "site_id"])
    when = [order] if order in n.columns else []
    told = n.select("site_id", *when, F.col("statement").alias("__text"), F.col("condition").alias("__condition"), F.when(read, F.to_json(F.struct(*fields))).alias("__raw"), F.lit(True).alias("__hit"))
    told = folded(told, "site_id", ["__text", "__condition", "__raw", "__hit"], when[0] if when else None, last=True)
    put = {
        "full_description": F.coalesce("__text", "full_description"), "condition": F.coalesce("__condition", "condition"),
        "enrichment_raw_json": F.coalesce("__raw", "enrichment_raw_json"), "source_nomination": F.coalesce("__hit", "source_nomination"),
    }
    years = F.coalesce(F.nullif("start_year", F.lit(0)), F.nullif("end_year", F.lit(0))).isNotNull()
    source = F.lit("nomination").alias("source")
    return {
        "sites": sites.join(told, "site_id", "left").withColumns(put).select(*sites.columns),
        "periods": n.where(years).select("site_id", "start_year", "end_year", source),
        "areas": n.select("site_id", F.explode("areas").alias("area"), source),
        "criteria": n.select("site_id", F.explode("criteria").alias("criterion"), source).where(F.col("criterion").isin(*LETTERS)),
    }


def merge_stats(outcomes: DataFrame, by: list[str], column: str = "outcome") -> DataFrame:
    """Records of each outcome for each value of ``by`` (A14, A15), or over all."""
    return outcomes.groupBy(*by, column).agg(F.count("*").alias("n"))


def cascade_outcomes(records: DataFrame, assigned: DataFrame) -> DataFrame:
    """``records`` (id) with matched_nris, matched_address, matched_fuzzy or inserted.

    ``assigned``: what ``batches.assignments`` gives; a record counts by the pass that it
    matches by, be it a stored site or one inserted before.
    """
    names = F.when(F.col("inserted"), "inserted").when(F.col("pass") == 1, "matched_nris").when(F.col("pass") == 2, "matched_address").otherwise("matched_fuzzy")
    return records.join(assigned.select(F.col("record_id").alias("id"), names.alias("outcome")), "id")


def run_events(counts: DataFrame, stage: Column, at: Column) -> DataFrame:
    """Log rows of the runs in ``counts`` (run_id, n): started, then completed with what was processed."""
    rows = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("running").alias("status"), F.lit(None).cast("long").alias("records_processed")),
        F.struct(F.lit(2).alias("step"), F.lit("completed").alias("status"), F.col("n").cast("long").alias("records_processed")),
    )
    return counts.select("run_id", stage.alias("stage"), at.alias("at"), F.explode(rows).alias("e")).select("run_id", "stage", "at", "e.*")


def source_metadata(events: DataFrame, order: str) -> DataFrame:
    """The last row of each source name."""
    return keep_last(events, ["source_name"], order)


def cumulative(batches: DataFrame, by: list[str], order: str, value: str, name: str = "so_far") -> DataFrame:
    """Running sums inside each run (W-h)."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return batches.withColumn(name, F.sum(value).over(w))


def quarantined(lines: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines) of JSON text: a source's broken records do not stop the rest."""
    corrupt = "_corrupt_record"
    read = lines.withColumn("__r", F.from_json(column, f"{schema}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    bad = F.col(f"__r.{corrupt}").isNotNull() | F.col("__r").isNull()
    others = [c for c in lines.columns if c != column]
    return read.where(~bad).select(*others, "__r.*").drop(corrupt), read.where(bad).select(*others, column)


def source_statuses(good: DataFrame, bad: DataFrame, source: str) -> DataFrame:
    """(source, n_good, n_bad, status): failed if nothing could be read, partial if something could not."""
    both = good.select(source, F.lit(1).alias("g")).unionByName(bad.select(source, F.lit(0).alias("g")))
    sums = both.groupBy(source).agg(F.sum("g").alias("n_good"), F.sum(1 - F.col("g")).alias("n_bad"))
    status = F.when(F.col("n_good") == 0, "failed").when(F.col("n_bad") > 0, "partial").otherwise("complete")
    return sums.withColumn("status", status)


def fallback_requests(sites: DataFrame, hits: DataFrame) -> DataFrame:
    """Sites for the second geocoder: with an address but no hit of the first, or without one."""
    rest = sites.where("latitude is null and (address is not null or city is not null)")
    addressed = F.length(F.trim("address")) > 0
    missed = rest.where(addressed).join(hits.select("site_id"), "site_id", "left_anti")
    return missed.unionByName(rest.where(~F.coalesce(addressed, F.lit(False))))


def eligible(sites: DataFrame, purpose: str, limit: int | None = None) -> DataFrame:
    """The queue of a purpose by site_id (F34, O02, O03): ``enrich``, ``geocode``, ``lookup`` or ``all``."""
    rules = {
        "enrich": F.col("enrichment_status") == "pending",
        "geocode": F.col("latitude").isNull() & (F.col("address").isNotNull() | F.col("city").isNotNull()),
        "lookup": (F.col("latitude").isNull() | (F.col("geocode_quality") == "city_level") if "geocode_quality" in sites.columns else F.col("latitude").isNull())
        & F.col("name").isNotNull() & F.col("city").isNotNull(),
        "all": F.lit(True),
    }
    queue = sites.where(rules[purpose]).orderBy("site_id")
    return queue.limit(limit) if limit else queue


def audit_rows(audit: DataFrame, records: DataFrame, sites: DataFrame, source: str) -> DataFrame:
    """The columns of the audit file, by risk and source.

    ``audit``: what ``match_audit`` gives; ``records`` and ``sites`` have id, name,
    state, city, address and nris_refnum.
    """
    i = records.select(F.col("id").alias("record_id"), "state", F.col("name").alias("incoming_name"), F.col("city").alias("incoming_city"), F.col("address").alias("incoming_address"), F.col("nris_refnum").alias("incoming_refnum"))
    e = sites.select(F.col("id").alias("site_id"), F.col("name").alias("matched_name"), F.col("city").alias("matched_city"), F.col("address").alias("matched_address"))
    sure = (F.col("match_type") == "proximity_match") | (F.col("match_type") == "name_only_match")
    return audit.join(i, "record_id").join(e, "site_id").select(
        "risk", F.lit(source).alias("source_key"), "state", "incoming_name", "incoming_city", "incoming_address", "incoming_refnum",
        "matched_name", "matched_city", "matched_address", F.col("site_id").alias("matched_id"), "score",
        F.coalesce(F.format_string("%.3f", "km"), F.lit("")).alias("distance_km"), "match_type", F.when(sure, "YES").otherwise("CANDIDATE").alias("would_match"),
    )


def audit_summary(records: DataFrame, flagged: DataFrame, source: str) -> DataFrame:
    """(source, records, flagged) for each source."""
    r = records.groupBy(source).agg(F.count("*").alias("records"))
    return r.join(flagged.groupBy(source).agg(F.count("*").alias("flagged")), source, "left").fillna(0, ["flagged"])
