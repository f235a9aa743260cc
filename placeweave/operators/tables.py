"""Writes as functions (current, incoming) -> new (W01-W22, W-f, W-g, J17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def numbered(df: DataFrame, by: list[str], order: list[str], coarse: Column, name: str) -> DataFrame:
    """``df`` with the place of each row in its group from 0 on, in the given order.

    ``coarse`` is a value that the order never decreases, such as the first letters of a
    name: rows are ranked inside its values and what comes before is added, so that a
    group that holds a third of all rows is not ranked by one task.
    """
    rows = df.withColumn("__coarse", coarse)
    before = Window.partitionBy(*by).orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    starts = rows.groupBy(*by, "__coarse").agg(F.count("*").alias("__n"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n").withColumnsRenamed({c: f"__g_{c}" for c in [*by, "__coarse"]})
    inside = F.row_number().over(Window.partitionBy(*by, "__coarse").orderBy(*order))
    met = [same(c, f"__g_{c}") for c in [*by, "__coarse"]]
    return rows.withColumn("__rank", inside).join(starts, met).withColumn(name, (F.col("__start") + F.col("__rank") - 1).cast("long")).select(*df.columns, name)


def checksum(columns: list[str]) -> Column:
    """SHA-256 of the row as JSON, fields by name."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def _filled(c: Column, kind: str) -> Column:
    return F.nullif(c, F.lit("")) if kind == "string" else c


def upsert_first_wins(current: DataFrame, incoming: DataFrame, key: str, order: str, flags: list[str]) -> DataFrame:
    """Existing non-empty values stay, empty ones are filled, flags are or-ed.

    Incoming rows of one key are folded first, in their order.  Rows without a
    key are always added.  Ids of new rows are left to the caller.
    """
    fields = [c for c in incoming.columns if c not in (key, order)]
    kinds = dict(incoming.dtypes)
    keyed = incoming.where(F.col(key).isNotNull())
    folded = keyed.groupBy(key).agg(
        *[
            F.max(F.coalesce(F.col(c), F.lit(False))).alias(c)
            if c in flags
            else F.min(F.when(_filled(F.col(c), kinds[c]).isNotNull(), F.struct(order, F.col(c).alias("v")))).getField("v").alias(c)
            for c in fields
        ]
    )
    now, new = current.where(F.col(key).isNotNull()).alias("n"), folded.alias("i")
    both = now.join(new, F.col(f"n.{key}") == F.col(f"i.{key}"), "full_outer")
    merged = []
    for c in current.columns:
        mine = F.col(f"n.{c}")
        if c == key:
            merged.append(F.coalesce(mine, F.col(f"i.{c}")).alias(c))
        elif c in flags and c in fields:
            merged.append((F.coalesce(mine, F.lit(False)) | F.coalesce(F.col(f"i.{c}"), F.lit(False))).alias(c))
        elif c in fields:
            merged.append(F.coalesce(_filled(mine, kinds[c]), F.col(f"i.{c}"), mine).alias(c))
        else:
            merged.append(mine.alias(c))
    rest = current.where(F.col(key).isNull())
    added = incoming.where(F.col(key).isNull())
    return both.select(*merged).unionByName(rest).unionByName(added.select(*[c for c in current.columns if c in incoming.columns]), allowMissingColumns=True)


def insert_or_ignore(current: DataFrame, incoming: DataFrame, keys: list[str], sound: Column, order: str) -> DataFrame:
    """Rows that satisfy the check, first of each key, unless the key is there."""
    fresh = keep_first(incoming.where(F.coalesce(sound, F.lit(False))), keys, order)
    return current.unionByName(fresh.join(current.select(*keys), keys, "left_anti").select(*current.columns))


def append_rows(current: DataFrame, incoming: DataFrame) -> DataFrame:
    return current.unionByName(incoming, allowMissingColumns=True)


def folded(records: DataFrame, key: str, fields: list[str], order: str | None, last: bool = False) -> DataFrame:
    """One row a key: of each field the first non-empty value in the given order, or the last.

    Records of one key are folded by partial aggregates, however many there are; without
    an order the least value stands for the first.
    """
    kinds, pick = dict(records.dtypes), F.max if last else F.min
    told = [F.col(order).alias("o")] if order else []
    values = [pick(F.when(_filled(F.col(f), kinds[f]).isNotNull(), F.struct(*told, F.col(f).alias("v")))).getField("v").alias(f) for f in fields]
    return records.groupBy(key).agg(*values)


def _order(records: DataFrame, order: str | None) -> str | None:
    return order if order in records.columns else None


def fill_empty(sites: DataFrame, matched: DataFrame, fields: list[str], flag: str, order: str | None = "arrival") -> DataFrame:
    """Fill empty fields from the matched records (site_id, fields) and set the flag.

    Several records may match a site: the first non-empty value by arrival counts for each
    field.  Sites whose primary source is manual or unknown stay as they are.
    """
    kinds = dict(sites.dtypes)
    found = folded(matched, "site_id", fields, _order(matched, order))
    found = found.select("site_id", *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__hit"))
    may = F.col("__hit").isNotNull() & (F.col("primary_source") != "manual")
    out = sites.join(found, "site_id", "left")
    changed = {f: F.when(may, F.coalesce(_filled(F.col(f), kinds[f]), F.col(f"__{f}"), F.col(f))).otherwise(F.col(f)) for f in fields}
    changed[flag] = F.when(may, True).otherwise(F.col(flag))
    return out.withColumns(changed).select(*sites.columns)


def overwrite_fields(sites: DataFrame, matched: DataFrame, fields: list[str], flag: str, order: str | None = "arrival") -> DataFrame:
    """Non-empty fields of the matched records replace the site's.

    Of several records the last non-empty value by arrival counts.  A site with reviewer
    notes changes only if its primary source is known and not manual; the flag is set where
    a record gives any field.
    """
    found = folded(matched, "site_id", fields, _order(matched, order), last=True)
    found = found.select("site_id", *[F.col(f).alias(f"__{f}") for f in fields]).where(" or ".join(f"`__{f}` is not null" for f in fields)).withColumn("__hit", F.lit(True))
    may = F.col("__hit").isNotNull() & (F.col("reviewer_notes").isNull() | (F.col("primary_source") != "manual"))
    changed = {f: F.when(may, F.coalesce(F.col(f"__{f}"), F.col(f))).otherwise(F.col(f)) for f in fields}
    changed[flag] = F.when(may, True).otherwise(F.col(flag))
    return sites.join(found, "site_id", "left").withColumns(changed).select(*sites.columns)


def priority_wins(provenance: DataFrame, ranks: dict[str, int], fields: list[str]) -> DataFrame:
    """For each site and field the non-empty value of the best-ranked source.

    ``provenance``: site_id, source and the fields; unknown sources come last and
    ``manual`` before all; ties go to the smaller value.
    """
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in {"manual": 0, **ranks}.items() for x in kv]), F.col("source")), F.lit(1 << 20))
    return provenance.groupBy("site_id").agg(
        *[F.min(F.when(F.nullif(F.col(f).cast("string"), F.lit("")).isNotNull(), F.struct(rank.alias("r"), F.col(f).alias("v")))).getField("v").alias(f) for f in fields]
    )


def apply_replies(requests: DataFrame, replies: DataFrame, key: str, order: str) -> DataFrame:
    """Requests with their last reply; a request without one keeps nulls."""
    return requests.join(last_replies(replies, key, order), key, "left")


def last_replies(replies: DataFrame, key: str, order: str | None) -> DataFrame:
    """The last reply of each key, equal ones by their values; by partial aggregates."""
    others = [c for c in replies.columns if c != key]
    told = [F.col(_order(replies, order)).alias("o")] if _order(replies, order) else []
    ranked = F.struct(*told, F.to_json(F.struct(*others)).alias("t")) if others else F.lit(0)
    return replies.groupBy(key).agg(F.max_by(F.struct(*replies.columns), ranked).alias("__r")).select("__r.*")


def apply_geocodes(sites: DataFrame, hits: DataFrame, corrected: bool, order: str | None = "at") -> DataFrame:
    """Coordinates from replies (site_id, lat, lon, quality, source) that are valid.

    ``corrected`` stores exchanged coordinates as corrected, else as they came.  Of several
    valid replies of a site the last counts.
    """
    from placeweave.functions.normalize import validate_coordinates

    h = hits.withColumn("__p", validate_coordinates(F.col("lat"), F.col("lon"))).where("lat is not null and __p.valid")
    lat, lon = (F.col("__p.latitude"), F.col("__p.longitude")) if corrected else (F.col("lat"), F.col("lon"))
    when = [order] if _order(hits, order) else []
    h = last_replies(h.select("site_id", lat.alias("__lat"), lon.alias("__lon"), F.col("quality").alias("__q"), F.col("source").alias("__s"), F.lit(True).alias("__hit"), *when), "site_id", order)
    out, ok = sites.join(h, "site_id", "left"), F.col("__hit").isNotNull()
    put = {"latitude": "__lat", "longitude": "__lon", "geocode_quality": "__q", "coordinates_source": "__s"}
    return out.withColumns({c: F.when(ok, F.col(v)).otherwise(F.col(c)) for c, v in put.items()}).select(*sites.columns)


def latest_runs(events: DataFrame) -> DataFrame:
    """The current state of each run from an append-only log."""
    return keep_last(events, ["run_id"], "at")


def orphans(children: DataFrame, sites: DataFrame) -> DataFrame:
    """Child rows without a site (the referential check)."""
    return children.join(sites.select("site_id"), "site_id", "left_anti")
