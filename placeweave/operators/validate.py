"""Validation of site rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions.normalize import known_state, normalize_date, normalize_state, title_case, validate_coordinates

DATE_FIELDS = ("nhl_designation_date", "nrhp_cert_date", "date_constructed", "state_designation_date")


def validate_sites(sites: DataFrame) -> DataFrame:
    """Normalised sites with ``status`` (pass, warning, fail) and ``issues``; no row is rejected."""
    has = set(sites.columns)
    point = validate_coordinates(F.col("latitude"), F.col("longitude"))
    out = sites.withColumn("__p", point).withColumn("state", normalize_state(F.col("state")))
    dates = {c: normalize_date(F.col(c)) for c in DATE_FIELDS if c in has}
    titles = {c: title_case(F.trim(F.col(c))) for c in ("city", "county") if c in has}
    trims = {"address": F.trim("address")} if "address" in has else {}
    odd_state = F.col("state").isNotNull() & ~known_state(F.col("state"))
    issues = F.concat(
        F.array_compact(F.array(F.when(odd_state, F.concat(F.lit("unknown_state: "), F.col("state"))))), F.col("__p.warnings")
    )
    status = F.when(~F.col("__p.valid"), "fail").when(odd_state | F.col("__p.swapped"), "warning").otherwise("pass")
    return out.withColumns(
        {**dates, **titles, **trims, "latitude": F.coalesce("__p.latitude", F.col("latitude").try_cast("double")),
         "longitude": F.coalesce("__p.longitude", F.col("longitude").try_cast("double")), "status": status, "issues": issues}
    ).drop("__p")


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status").agg(F.count("*").alias("n"))


def issue_counts(validated: DataFrame) -> DataFrame:
    """How often each kind of issue occurs; what follows a colon is detail."""
    kinds = validated.select(F.explode("issues").alias("issue"))
    return kinds.groupBy(F.substring_index("issue", ":", 1).alias("issue")).agg(F.count("*").alias("n"))
