"""Whole merges against loops over their records."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from placeweave.operators import resolve, scoring, source_merges, tables
from placeweave.operators.validate import validate_sites
from test_batches import field_accepts, park_accepts, sequential, state_accepts

FIELDS = source_merges.STATE_FIELDS
SITE = "site_id long, nris_refnum string, name string, state string, city string, county string, address string, latitude double, longitude double, date_constructed string, state_designation_date string, primary_source string, reviewer_notes string, source_shpo boolean, source_nps_parks boolean, source_other boolean, short_description string, full_description string, website_url string, visiting_hours string, admission_info string, nps_park_code string"
RECORD = "arrival long, state_record_id string, nris_refnum string, name string, state string, city string, county string, address string, latitude double, longitude double, date_constructed string, state_designation_date string"


def batch(spark, n: int, seed: int):
    """Sites and records of few names and addresses, so that several records reach one site."""
    r = random.Random(seed)
    words = ["Oldham", "Mill", "Stone", "Bridge", "Harbor", "Chapel"]
    maybe = lambda x: r.choice([None, "", x])

    def place(k):
        at = (None, None) if r.random() < 0.4 else (40.0 + r.choice([0, 0.003, 0.4]), -75.0)
        return (f"R{k % 23}" if r.random() < 0.2 else None, " ".join(r.sample(words, 2)) + r.choice(["", " House"]), r.choice(["PA", "NJ"]), r.choice(["Town", None]), maybe(f"County {k % 5}"), r.choice([None, f"{k % 7} Main St"]), *at)

    sites = [(k, *place(k), maybe("1900"), maybe("2001-01-01"), r.choice(["manual", "arcgis", None]), r.choice([None, "seen"]), False, None, False, maybe("short"), None, maybe("http://old"), None, None, None) for k in range(1, 1 + n // 4)]
    seen: set = set()
    for k, s in enumerate(sites):  # one site a number
        if s[1] in seen:
            sites[k] = (s[0], None, *s[2:])
        seen.add(s[1])
    records = [(1000 + k, f"S{k}" if k % 3 else None, *place(k), maybe(f"19{10 + k % 80}"), maybe(f"20{10 + k % 10}-05-05")) for k in range(n)]
    return spark.createDataFrame(sites, SITE), spark.createDataFrame(records, RECORD)


def looped(current, checked, assigned, write):
    """The sites after a loop: ``write`` changes the dictionary of a matched site."""
    out = {r.site_id: r.asDict() for r in current}
    rows = {r.arrival: r.asDict() for r in checked}
    for record, site, leader, _, inserted in assigned:
        if inserted:
            out[record] = {c: rows[record].get(c) for c in next(iter(out.values()))} | {"site_id": record}
        else:
            write(out[site if site is not None else leader], rows[record])
    return out


def keyed(df, id):
    return resolve.keyed(df, id).collect()


def same(got, want):
    assert len(got) == len(want) == len({r.site_id for r in got})
    for r in got:
        assert r.asDict() == want[r.site_id]


@pytest.mark.parametrize("seed", [1, 2])
def test_state_merge_equals_a_loop(spark, seed):
    current, incoming = batch(spark, 90, seed)
    designations = spark.createDataFrame([(1, "State Register", "1999-01-01", "Old", "x")], "site_id long, designation_type string, designation_date string, designating_authority string, source string")
    out = source_merges.merge_state(current, incoming, designations, "survey_pa", ["State Register", "Landmark"], "Office")
    told = incoming.withColumn("source_shpo", F.lit(True)).withColumn("primary_source", F.lit("survey_pa"))
    checked = validate_sites(told).drop("status", "issues").cache()
    assigned = sequential(keyed(checked, "arrival"), keyed(current, "site_id"), state_accepts)

    def write(site, record):
        if site["primary_source"] not in (None, "manual"):
            for f in FIELDS:
                site[f] = site[f] if site[f] else (record[f] or site[f])
            site["source_shpo"] = True

    same(out["sites"].collect(), looped(current.collect(), checked.collect(), assigned, write))
    to = {a: s if s is not None else lead for a, s, lead, _, _ in assigned}
    assert len(set(to.values())) < len(to) and sum(1 for x in assigned if not x[4]) > 20
    kinds, dates = {(1, "State Register"): ("1999-01-01", "Old")}, {r.arrival: r.state_designation_date for r in checked.collect()}
    for a in sorted(to):
        for t in ("State Register", "Landmark"):
            kinds.setdefault((to[a], t), (dates[a], "Office"))
    assert {(r.site_id, r.designation_type): (r.designation_date, r.designating_authority) for r in out["designations"].collect()} == kinds
    want = sorted((to[r.arrival], r.state_record_id or r.nris_refnum or "") for r in incoming.collect())
    assert sorted((r.site_id, r.source_record_id or "") for r in out["sources"].collect()) == want
    names = {None: "inserted", 1: "matched_nris", 2: "matched_address", 3: "matched_fuzzy", 4: "matched_fuzzy"}
    assert {(r.arrival, r.site_id, r.outcome) for r in out["outcomes"].collect()} == {(a, to[a], names[p]) for a, _, _, p, _ in assigned}
    again = source_merges.merge_state(out["sites"].cache(), incoming, out["designations"], "survey_pa", ["State Register", "Landmark"], "Office")
    assert again["sites"].count() == out["sites"].count() and again["designations"].count() == out["designations"].count()
    assert again["outcomes"].where("outcome = 'inserted'").count() == 0


def test_parks_merge_equals_a_loop(spark):
    current, incoming = batch(spark, 60, 5)
    r = random.Random(4)
    extra = [(1000 + k, r.choice([None, "", f"text {k}"]), r.choice([None, f"http://{k}"]), r.choice([None, f"hours {k}"]), f"code{k}") for k in range(60)]
    parks = incoming.join(spark.createDataFrame(extra, "arrival long, full_description string, website_url string, visiting_hours string, nps_park_code string"), "arrival").drop("state_record_id")
    parks = parks.withColumn("nps_park_code", F.when(F.col("arrival") % 4 > 0, F.col("nps_park_code")))
    out = source_merges.merge_parks(current, parks)
    checked = validate_sites(parks.withColumn("source_nps_parks", F.lit(True))).drop("status", "issues").cache()
    assigned = sequential(keyed(checked, "arrival"), keyed(current, "site_id"), park_accepts)

    def write(site, record):
        given = {f: record[f] for f in source_merges.PARK_FIELDS if record.get(f)}
        if given and (site["reviewer_notes"] is None or site["primary_source"] not in (None, "manual")):
            site |= given | {"source_nps_parks": True}

    same(out["sites"].collect(), looped(current.collect(), checked.collect(), assigned, write))
    assert out["sources"].count() == 60 and {x.outcome for x in out["outcomes"].collect()} == {"matched", "inserted"}


def test_battlefields_merge_equals_a_loop(spark):
    current, incoming = batch(spark, 60, 6)
    fields = incoming.select("arrival", "name", "state", "latitude", "longitude", F.lit("War").alias("war"), F.concat(F.lit("X"), "arrival").alias("war_site_id"), F.when(F.col("arrival") % 2 == 0, "Battlefield").otherwise("Campaign").alias("designation_type"))
    none = spark.createDataFrame([], "site_id long, designation_type string, designation_date string, designating_authority string, source string")
    out = source_merges.merge_battlefields(current, fields, none, "fields", "Program")
    checked = validate_sites(fields.withColumns({"source_other": F.lit(True), "primary_source": F.lit("fields")})).drop("status", "issues").cache()
    bare = checked.withColumns({c: F.lit(None).cast("string") for c in ("nris_refnum", "city", "address")})
    assigned = sequential(keyed(bare, "arrival"), keyed(current, "site_id"), field_accepts)

    def write(site, record):
        if site["primary_source"] not in (None, "manual"):
            for f in ("latitude", "longitude"):
                site[f] = record[f] if site[f] is None else site[f]
            site["source_other"] = True

    same(out["sites"].collect(), looped(current.collect(), checked.collect(), assigned, write))
    to = {a: s if s is not None else lead for a, s, lead, _, _ in assigned}
    kinds = {(to[r.arrival], r.designation_type) for r in fields.collect()}
    assert {(r.site_id, r.designation_type) for r in out["designations"].collect()} == kinds
    assert {(r.site_id, r.source_record_id) for r in out["sources"].collect()} == {(to[r.arrival], r.war_site_id) for r in fields.collect()}


def test_several_records_and_replies_of_a_site(spark):
    """Fills take the first value, overwrites and replies the last; no site is repeated."""
    sites = spark.createDataFrame([(1, "", "x", None, None, "a", None, None, None, None), (2, "c", "y", 1.0, 2.0, "manual", "n", None, None, None)], "site_id int, city string, url string, latitude double, longitude double, primary_source string, reviewer_notes string, hit boolean, geocode_quality string, coordinates_source string")
    records = spark.createDataFrame([(1, 3, "late", "u3"), (1, 1, None, "u1"), (1, 2, "first", ""), (2, 1, "z", "u"), (2, 2, "z", None)], "site_id int, arrival int, city string, url string")
    filled = {r.site_id: (r.city, r.url, r.hit) for r in tables.fill_empty(sites, records, ["city", "url"], "hit").collect()}
    assert filled == {1: ("first", "x", True), 2: ("c", "y", None)}
    over = {r.site_id: (r.city, r.url, r.hit) for r in tables.overwrite_fields(sites, records, ["city", "url"], "hit").collect()}
    assert over == {1: ("late", "u3", True), 2: ("c", "y", None)}
    blank = tables.overwrite_fields(sites, records.where("site_id = 1").withColumns({"city": F.lit(""), "url": F.lit(None).cast("string")}), ["city", "url"], "hit")
    assert [r.hit for r in blank.where("site_id = 1").collect()] == [None]
    hits = spark.createDataFrame([(1, 40.0, -75.0, "q1", "s", 1), (1, 41.0, -75.0, "q2", "s", 3), (1, 0.0, 0.0, "q3", "s", 4), (1, 42.0, -75.0, "q2", "s", 2)], "site_id int, lat double, lon double, quality string, source string, at int")
    coded = {r.site_id: (r.latitude, r.geocode_quality) for r in tables.apply_geocodes(sites, hits, True).collect()}
    assert coded == {1: (41.0, "q2"), 2: (1.0, None)}
    requests = spark.createDataFrame([(1, "q"), (2, "q"), (3, "q")], "site_id int, body string")
    replies = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "site_id int, said string, at int")
    assert {(r.site_id, r.said) for r in tables.apply_replies(requests, replies, "site_id", "at").collect()} == {(1, "b"), (2, "c"), (3, None)}


def test_actions_equal_a_loop(spark):
    """Five actions a site in turn: an edit survives an approval, notes reach their column."""
    r = random.Random(2)
    cols = "site_id int, name string, city string, review_status string, review_priority int, primary_source string, reviewer_notes string, year int, tags array<string>"
    sites = [(k, f"n{k}", None, "unreviewed", 5, "a", None, 1900, ["t"]) for k in range(60)]
    acts, want = [], {s[0]: dict(zip([c.split()[0] for c in cols.split(", ")], s, strict=True)) for s in sites}
    for k in range(50):
        for at in range(5):
            kind = r.choice(["approve", "flag", "edit", "edit", "other"])
            notes = r.choice([None, "", f"note {k} {at}"])
            fields = r.choice([None, {"name": f"N{at}"}, {"city": f"C{at}", "year": str(2000 + at)}, {"city": None}, {"nothing": "x", "site_id": "9"}]) if kind == "edit" else None
            acts.append((k, kind, notes, fields, at))
            site = want[k]
            if kind == "approve":
                site["review_status"] = "approved"
                site["reviewer_notes"] = notes or site["reviewer_notes"]
            elif kind == "flag":
                site |= {"review_status": "flagged", "reviewer_notes": notes, "review_priority": 1}
            elif kind == "edit":
                for c, v in (fields or {}).items():
                    if c in site and c != "site_id":
                        site[c] = int(v) if c == "year" else v
                site["primary_source"] = "manual"
    r.shuffle(acts)
    log = spark.createDataFrame(acts, "site_id int, action string, notes string, fields map<string,string>, at int")
    got = {x.site_id: x.asDict() for x in scoring.apply_actions(spark.createDataFrame(sites, cols), log).collect()}
    assert got == want
