"""Whole merges of one source: state surveys, parks and battlefields
(J08-J10 and J12 with W01, W06-W10, A14).

A merge is a fold over records in order of arrival: each goes to a stored site, to a
site that an earlier record of the batch made, or makes one.  Where records go is found
first (``batches.assignments``), as no rule reads what a merge writes to a matched site;
then each table is written once, with what all records of a site say folded in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.operators import batches, resolve
from placeweave.operators.merges import add_designations, provenance
from placeweave.operators.tables import fill_empty, overwrite_fields
from placeweave.operators.validate import validate_sites
from placeweave.session import staged

#: What each source may fill or overwrite on a site that it matches (fixed values).
STATE_FIELDS = ["address", "city", "county", "date_constructed", "state_designation_date"]
PARK_FIELDS = ["short_description", "full_description", "website_url", "visiting_hours", "admission_info", "nps_park_code"]
#: How passes of the cascade are counted.
MATCHED = {1: "matched_nris", 2: "matched_address", 3: "matched_fuzzy", 4: "matched_fuzzy"}


def _placed(current: DataFrame, incoming: DataFrame, kind: str, passes: tuple[int, ...] | None, new_id: Column) -> tuple[DataFrame, DataFrame]:
    """(validated records with site_id, inserted and outcome; the sites they insert, with the columns of ``current``)."""
    checked = validate_sites(incoming).drop("status", "issues")
    own = "nris_refnum name state city address latitude longitude".split()
    blank = {c: F.lit(None).cast("double" if c.endswith("tude") else "string") for c in own}
    keyed = lambda df, id: resolve.keyed(df.withColumns({c: e for c, e in blank.items() if c not in df.columns}), id)
    checked = staged(checked)
    found = staged(batches.assignments(keyed(checked, "arrival"), keyed(current, "site_id"), kind, passes))
    made = found.where("inserted").select("leader_id").join(checked.select(F.col("arrival").alias("leader_id"), new_id.alias("__made")), "leader_id")
    to = found.join(made, "leader_id", "left").select(F.col("record_id").alias("arrival"), F.coalesce("site_id", "__made").alias("site_id"), "inserted", F.col("pass").alias("match_pass"), "score", "km")
    name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in MATCHED.items() for x in kv]), F.col("match_pass")), F.lit("inserted"))
    placed = staged(checked.join(to.withColumn("outcome", F.when(F.col("inserted"), "inserted").otherwise(name if kind == "state" else F.lit("matched"))), "arrival"))
    fresh = placed.where("inserted").select(*[c for c in current.columns if c in placed.columns])
    return placed, current.unionByName(fresh, allowMissingColumns=True)


def merge_state(
    current: DataFrame, incoming: DataFrame, designations: DataFrame, source: str, types: list[str], authority: str | None = None,
    passes: tuple[int, ...] | None = None, new_id: Column | None = None,
) -> dict[str, DataFrame]:
    """A survey of states: the cascade, fills of empty fields, inserts, designations, provenance and counts.

    ``incoming``: arrival, state_record_id and site columns.  A matched site gets of each of
    STATE_FIELDS the first value that a record has, if it is empty, unless its primary source is manual
    or unknown; an inserted record's primary source is its own or ``source``.  ``designations``
    gets every type once a site, ``sources`` a row a record.  ``new_id`` is the id of a site
    that a record makes, else its arrival.
    """
    told = incoming.withColumn("source_shpo", F.lit(True)).withColumn("primary_source", F.coalesce("primary_source", F.lit(source)) if "primary_source" in incoming.columns else F.lit(source))
    told = told.withColumns({c: F.lit(None).cast("string") for c in STATE_FIELDS if c not in told.columns})
    placed, base = _placed(current, told, "state", passes, F.col("arrival") if new_id is None else new_id)
    dated = placed.select("site_id", "arrival", F.array(*[F.lit(t) for t in types]).alias("types"), F.col("state_designation_date").alias("date"))
    return {
        "sites": fill_empty(base, placed.where("not inserted"), [c for c in STATE_FIELDS if c in current.columns], "source_shpo"),
        "designations": add_designations(designations, dated, authority, source),
        "sources": provenance(placed, source, F.coalesce("state_record_id", "nris_refnum"), told.columns),
        "outcomes": placed.select("arrival", "site_id", "outcome", "score", "km"),
    }


def merge_parks(current: DataFrame, incoming: DataFrame, source: str = "nps_parks", new_id: Column | None = None) -> dict[str, DataFrame]:
    """Parks, matched by name alone: what a record gives of PARK_FIELDS replaces the site's.

    Records write in order of arrival, so the last one that gives a field counts, also on a
    site that the batch made; a site with reviewer notes and a manual source stays as it is.
    """
    told = incoming.withColumn("source_nps_parks", F.lit(True))
    placed, base = _placed(current, told, "parks", None, F.col("arrival") if new_id is None else new_id)
    fields = [c for c in PARK_FIELDS if c in current.columns and c in placed.columns]
    return {
        "sites": overwrite_fields(base, placed.where("not inserted"), fields, "source_nps_parks"),
        "sources": provenance(placed, source, F.col("nps_park_code"), told.columns),
        "outcomes": placed.select("arrival", "site_id", "outcome", "score", "km"),
    }


def merge_battlefields(current: DataFrame, incoming: DataFrame, designations: DataFrame, source: str, authority: str, new_id: Column | None = None) -> dict[str, DataFrame]:
    """Battlefields: coordinates fill missing ones, every record adds its designation.

    ``incoming``: arrival, name, state, latitude, longitude, war, war_site_id, designation_type.
    """
    told = incoming.withColumns({"source_other": F.lit(True), "primary_source": F.lit(source)})
    placed, base = _placed(current, told, "battlefields", None, F.col("arrival") if new_id is None else new_id)
    typed = placed.select("site_id", "arrival", F.array("designation_type").alias("types"), F.lit(None).cast("string").alias("date"))
    raw = placed.select("site_id", "name", "war", F.col("war_site_id").alias("record"), "state")
    return {
        "sites": fill_empty(base, placed.where("not inserted"), ["latitude", "longitude"], "source_other"),
        "designations": add_designations(designations, typed, authority, source),
        "sources": provenance(raw, source, F.col("record"), ["name", "war", "record", "state"]),
        "outcomes": placed.select("arrival", "site_id", "outcome", "score", "km"),
    }
