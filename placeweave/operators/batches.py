"""Records that arrive one after the other, as sets.

In a merge each record meets the stored sites and the records inserted before it.
Which records are inserted is the first maximal independent set in arrival order of
the graph of pairs that a rule accepts.  Pairs by a key, an address or an equal or
similar name would be cliques, so they are no edges: a record belongs to groups and
sees groups, and each round reads of a group only its first leader and its first open
record.  Only nearby pairs of different names are edges.  Records of equal match keys
are one vertex, their first arrival.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.constants import SCORE_ANYWHERE, SCORE_MATCH, SCORE_NAME_ONLY
from placeweave.functions.names import comparable_lengths, differ_only_by_number
from placeweave.operators import resolve
from placeweave.session import discard, staged

#: Places of a record without coordinates and of all records.
_NONE, _ALL = "-", "*"


def leaders(records: DataFrame, edges: DataFrame, taken: DataFrame, belongs: DataFrame | None = None, sees: DataFrame | None = None) -> DataFrame:
    """(id, leader) of records (id) inserted in order of their ids.

    A later record meets an earlier one if ``edges`` (later, earlier) has the pair or if it
    sees a group (``sees``: id, group) that the earlier one belongs to (``belongs``: id,
    group); ``taken`` (id) match a stored site.  A record becomes a leader when all that it
    could meet before it is settled as no leader, and none when one of them leads
    (Blelloch, Fineman, Shun, SPAA 2012).  Each round stages one row a record.
    """
    spark = records.sparkSession
    none = spark.createDataFrame([], "id long, group string")
    state = staged(records.select("id").join(taken.select("id").distinct().withColumn("leader", F.lit(False)), "id", "left"))
    free = staged(state.where("leader is null").select("id"))
    far = edges.where("later > earlier").select("later", "earlier").distinct()
    edges = staged(far.join(free.withColumnRenamed("id", "later"), "later", "left_semi").join(free.withColumnRenamed("id", "earlier"), "earlier", "left_semi"))
    belongs = staged((none if belongs is None else belongs).join(free, "id", "left_semi"))
    sees = staged((none if sees is None else sees).join(free, "id", "left_semi"))
    used = belongs.groupBy("group").agg(F.min("id").alias("lo")).join(sees.groupBy("group").agg(F.max("id").alias("hi")), "group").where("lo < hi").select("group")
    members, views = staged(belongs.join(used, "group", "left_semi")), staged(sees.join(used, "group", "left_semi"))
    discard(belongs, sees)
    while True:
        open_rows = state.where("leader is null").select("id")
        if open_rows.isEmpty():
            discard(free, edges, members, views)
            return state
        groups = members.join(state, "id").groupBy("group").agg(F.min(F.when(F.col("leader"), F.col("id"))).alias("led"), F.min(F.when(F.col("leader").isNull(), F.col("id"))).alias("open"))
        by_group = views.join(open_rows, "id", "left_semi").join(groups, "group").select("id", (F.col("led") < F.col("id")).alias("led"), (F.col("open") < F.col("id")).alias("waits"))
        met = edges.join(open_rows.withColumnRenamed("id", "later"), "later", "left_semi").join(state.withColumnRenamed("id", "earlier"), "earlier")
        by_edge = met.select(F.col("later").alias("id"), F.coalesce("leader", F.lit(False)).alias("led"), F.col("leader").isNull().alias("waits"))
        verdict = by_group.unionByName(by_edge).groupBy("id").agg(F.max(F.coalesce("led", F.lit(False))).alias("led"), F.max(F.coalesce("waits", F.lit(False))).alias("waits"))
        now = F.when(F.col("leader").isNotNull(), F.col("leader")).when(F.coalesce("led", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        last, state = state, staged(state.join(verdict, "id", "left").select("id", now.alias("leader")))
        discard(last)


def _group(kind: str, *parts: Column) -> Column:
    """A group's name: its parts with a mark between, null if a part is null."""
    return F.concat(F.lit(kind), *[x for p in parts for x in (F.lit("\u0001"), p.cast("string"))])


def _place(x: Column, y: Column) -> Column:
    return F.concat_ws(",", x.cast("string"), y.cast("string"))


def _cells_of(records: DataFrame) -> DataFrame:
    """A row for each place that a record belongs to: its cell, or none, and everywhere."""
    own = F.when(F.col("placed"), _place(F.col("cx"), F.col("cy"))).otherwise(F.lit(_NONE))
    return records.withColumn("place", F.explode(F.array(own, F.lit(_ALL))))


def _cells_seen(records: DataFrame) -> DataFrame:
    """A row for each place that a record sees: its nine cells and none, or everywhere."""
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    around = F.array(*[_place(F.col("cx") + a, F.col("cy") + b) for a, b in steps], F.lit(_NONE))
    return records.withColumn("place", F.explode(F.when(F.col("placed"), around).otherwise(F.array(F.lit(_ALL)))))


def _similar_names(records: DataFrame, least: float, by_state: bool, renumbered: bool = True) -> DataFrame:
    """(state, name, other, score) of the names of the batch that score ``least`` or more, equal ones too."""
    block = F.col("state") if by_state else F.lit("")
    names = records.where("name is not null").select(block.alias("block"), "name", "tokens", "plain").distinct()
    pairs = resolve.name_pairs(records, records, least, by_state, renumbered)
    a = names.select("block", F.col("tokens").alias("a"), "name", F.col("plain").alias("x"))
    b = names.select("block", F.col("tokens").alias("b"), F.col("name").alias("other"), F.col("plain").alias("y"))
    return a.join(pairs, ["block", "a"]).join(b, ["block", "b"]).where(comparable_lengths(F.col("x"), F.col("y"))).select("block", "name", "other", "score")


def _rows(records: DataFrame, *groups: Column) -> DataFrame:
    return records.select("id", F.explode(F.array_compact(F.array(*groups))).alias("group")).distinct()


def state_groups(records: DataFrame, passes: tuple[int, ...] = (1, 2, 3, 4)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, belongs, sees) of the rules of the cascade among records of a batch.

    Number and address are groups.  Names of SCORE_NAME_ONLY or more in one city meet at
    any distance among what a record sees, so these are groups as well, and so are
    names of SCORE_ANYWHERE in any city for a record without one; what is left for edges
    are nearby records of a lower score or of another city.
    """
    keys = ([_group("r", F.col("nris_refnum"))] if 1 in passes else []) + ([_group("a", F.col("state"), F.col("address_key"), F.col("city_key"))] if 2 in passes else [])
    none = records.sparkSession.createDataFrame([], "later long, earlier long")
    belongs = sees = _rows(records, *keys) if keys else None
    if 3 not in passes and 4 not in passes:
        return none, belongs, sees
    near = resolve.near_pairs(records, records, apart=SCORE_NAME_ONLY, renumbered=False).where(F.col("i_id") > F.col("e_id"))
    edges = near.select(F.col("i_id").alias("later"), F.col("e_id").alias("earlier"))
    city = F.coalesce("city_key", F.lit("\u0002"))
    named = _cells_of(records.where("name is not null and state is not null"))
    belongs = belongs.unionByName(_rows(named, _group("n", F.col("state"), F.col("name"), city, F.col("place")), _group("m", F.col("state"), F.col("name"), F.col("place"))))
    alike = _similar_names(records, SCORE_NAME_ONLY, True, renumbered=False).where(~differ_only_by_number(F.col("name"), F.col("other")))
    looking = _cells_seen(records.join(alike.withColumnRenamed("block", "state"), ["state", "name"]))
    anywhere = F.when(F.col("city_key").isNull() & (F.col("score") >= SCORE_ANYWHERE), _group("m", F.col("state"), F.col("other"), F.col("place")))
    sees = sees.unionByName(_rows(looking, _group("n", F.col("state"), F.col("other"), city, F.col("place")), anywhere))
    return edges, belongs, sees


def park_groups(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parks meet by name alone, so all pairs are groups."""
    alike = _similar_names(records, SCORE_MATCH, False)
    sees = records.join(alike, "name")
    none = records.sparkSession.createDataFrame([], "later long, earlier long")
    return none, _rows(records, _group("n", F.col("name"))), _rows(sees, _group("n", F.col("other")))


def battlefield_groups(records: DataFrame, least: float = 92.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Battlefields meet nearby, which are edges, or by name among what they see."""
    near = resolve.near_pairs(records.withColumn("city_key", F.lit(None).cast("string")), records.withColumn("city_key", F.lit(None).cast("string")), by_state=False, apart=least)
    near = near.where(F.col("i_id") > F.col("e_id"))
    alike = _similar_names(records, least, False)
    belongs = _rows(_cells_of(records), _group("n", F.col("name"), F.col("place")))
    sees = _rows(_cells_seen(records.join(alike, "name")), _group("n", F.col("other"), F.col("place")))
    return near.select(F.col("i_id").alias("later"), F.col("e_id").alias("earlier")), belongs, sees


def state_alike(passes: tuple[int, ...] = (1, 2, 3, 4)) -> Column:
    """Records that the cascade matches with one of equal match keys."""
    has = lambda *names: reduce(Column.__and__, [F.col(c).isNotNull() for c in names])
    near = F.col("placed") & (F.col("latitude") != 0) & (F.col("longitude") != 0)
    by_pass = {1: has("nris_refnum"), 2: has("state", "address_key", "city_key"), 3: has("state", "tokens") & near, 4: has("state", "tokens")}
    return reduce(Column.__or__, [F.coalesce(by_pass[p], F.lit(False)) for p in passes])


def _named() -> Column:
    return F.col("tokens").isNotNull()


#: Of each kind of merge what it accepts, what groups its rules make, which records meet their equals, and
#: how its names meet: the least score, in a state only, and if by numbers only.
RULES = {
    "state": (resolve.candidates, state_groups, state_alike, (SCORE_NAME_ONLY, True, False)),
    "parks": (resolve.park_candidates, park_groups, _named, (SCORE_MATCH, False, True)),
    "battlefields": (resolve.battlefield_candidates, battlefield_groups, _named, (92.0, False, True)),
}
#: Letter pairs in which the names of one part of a batch meet, about.
PART = 20_000_000


def inserted_ids(rows: DataFrame, taken: DataFrame, kind: str, passes: tuple[int, ...] | None = None) -> DataFrame:
    """(id) of the records that are inserted; ``taken`` (id) match a stored site.

    Where very many names resemble each other, pairs of all of them would be a clique, of
    which few lead.  So the batch is taken in parts in order of arrival: the leaders of a
    part, then what is left after these among the rest (the prefixes of Blelloch, Fineman, Shun).
    """
    accept, groups, _, names = RULES[kind]
    more = {} if passes is None else {"passes": passes}
    none, led = taken.select("id").where("false"), None
    left = staged(rows.join(taken, "id", "left_anti"))
    by_name = passes is None or 3 in passes or 4 in passes
    while True:
        last = resolve.sparse_until(left, *names, most=PART) if by_name else None
        part = left if last is None else left.where(F.col("id") <= last)
        edges, belongs, sees = groups(part, **more)
        leads = leaders(part, edges, none, belongs, sees).where("leader").select("id")
        led = leads if led is None else led.unionByName(leads)
        if last is None:
            return led
        rest = left.where(F.col("id") > last)
        if rest.isEmpty():
            return led
        met = accept(rest, staged(part.join(leads, "id", "left_semi")), **more).select(F.col("i_id").alias("id")).distinct()
        left = staged(rest.join(met, "id", "left_anti"))


def assignments(incoming: DataFrame, existing: DataFrame, kind: str = "state", passes: tuple[int, ...] | None = None) -> DataFrame:
    """(record_id, site_id, leader_id, pass, score, km, inserted) of every record.

    Records arrive in order of their ids.  One goes to a stored site (``site_id``) or to a
    record inserted before it (``leader_id``), the earliest pass first, then the best
    score, then stored before inserted and the smaller id; one that meets none is inserted
    and its own leader.  Ids of sites and of records are of different kinds.
    """
    accept, _, alike, _ = RULES[kind]
    more = {} if passes is None else {"passes": passes}
    incoming, existing = staged(incoming), staged(existing)  # their names and addresses are normalised once
    rows, members = resolve.match_classes(incoming, alike(**more))
    rows, members = staged(rows), staged(members)
    stored = staged(accept(rows, existing, **more))
    leads = inserted_ids(rows, stored.select(F.col("i_id").alias("id")).distinct(), kind, passes)
    led = staged(rows.join(leads, "id", "left_semi"))
    inserted = staged(accept(rows, led, **more))
    found = stored.select(F.col("i_id").alias("class"), F.col("e_id").alias("site_id"), F.lit(None).cast("long").alias("leader_id"), "pass", "score", "km")
    found = found.unionByName(inserted.select(F.col("i_id").alias("class"), F.lit(None).cast("long").alias("site_id"), F.col("e_id").alias("leader_id"), "pass", "score", "km"))
    met = members.join(found, "class").where("leader_id is null or leader_id < id")
    order = [F.col("pass"), -F.coalesce("score", F.lit(-1.0)), F.col("leader_id").isNotNull(), F.coalesce("site_id", "leader_id")]
    best = met.groupBy("id").agg(F.min_by(F.struct("site_id", "leader_id", "pass", "score", "km"), F.struct(*[c.alias(f"k{n}") for n, c in enumerate(order)])).alias("m"))
    fresh = members.where("id = class").join(leads, "id", "left_semi").select("id", F.lit(True).alias("inserted"))
    own = F.when(F.col("inserted"), F.col("id"))
    out = incoming.select("id").join(best, "id", "left").join(fresh, "id", "left")
    return out.select(
        F.col("id").alias("record_id"), F.when(~F.coalesce("inserted", F.lit(False)), F.col("m.site_id")).alias("site_id"), F.coalesce(own, "m.leader_id").alias("leader_id"),
        *[F.when(F.col("inserted").isNull(), F.col(f"m.{c}")).alias(c) for c in ("pass", "score", "km")], F.coalesce("inserted", F.lit(False)).alias("inserted"),
    )


def insert_leaders(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """(id, leader) of records in order of their ids: which of them are inserted."""
    return assignments(incoming, existing).select(F.col("record_id").alias("id"), F.col("inserted").alias("leader"))
