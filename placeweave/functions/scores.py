"""Quality factors of a site as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave.constants import AUTO_APPROVE, FLAG_BELOW, GENERIC_NAMES, KEY_FIELDS, OPEN_END, OPEN_START, SCORE_WEIGHTS, SOURCE_FLAGS


def best_description(full: Column, short: Column) -> Column:
    return F.coalesce(F.nullif(full, F.lit("")), F.nullif(short, F.lit("")), F.lit(""))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != ""))


def richness_class(words: Column) -> Column:
    return F.when(words >= 50, "data_rich").when(words >= 5, "data_moderate").otherwise("data_poor")


def richness_score(words: Column) -> Column:
    return F.when(words >= 100, 1.0).when(words >= 50, 0.7).when(words >= 5, 0.4).otherwise(0.1)


def completeness_score() -> Column:
    """Share of the key fields that are not null; an empty string counts as filled."""
    return reduce(add, [F.col(f).isNotNull().cast("int") for f in KEY_FIELDS]) / len(KEY_FIELDS)


def nomination_score(flag: Column, full: Column) -> Column:
    size = F.coalesce(F.length(full), F.lit(0))
    return F.when(~F.coalesce(flag, F.lit(False)), 0.3).when(size > 100, 1.0).when(size > 0, 0.7).otherwise(0.2)


def source_agreement() -> Column:
    n = reduce(add, [F.coalesce(F.col(f), F.lit(False)).cast("int") for f in SOURCE_FLAGS])
    return F.when(n >= 4, 1.0).when(n == 3, 0.8).when(n == 2, 0.6).otherwise(0.3)


def name_specificity(name: Column) -> Column:
    s = F.trim(F.lower(F.coalesce(name, F.lit(""))))
    generic = s.rlike("^(" + "|".join(GENERIC_NAMES) + r")($| #)")
    return F.when(s == "", 0.0).when(generic, 0.2).when(F.length(s) < 10, 0.6).otherwise(1.0)


def composite_score() -> Column:
    return F.round(reduce(add, [F.col(k) * w for k, w in SCORE_WEIGHTS.items()]), 4)


def review_status(score: Column) -> Column:
    return F.when(score >= AUTO_APPROVE, "auto_approved").when(score >= FLAG_BELOW, "unreviewed").otherwise("flagged")


def review_priority(score: Column) -> Column:
    return ((F.lit(1.0) - score) * 100).cast("int")


def era_confidence(start: Column, end: Column, era_start: Column, era_end: Column) -> Column:
    """Confidence that a period belongs to an era, null below a tenth of overlap.

    A missing or zero year is open; a period of one year overlaps by zero years.
    Hundredths are rounded half up, with 1e-9 for what binary fractions lack.
    """
    ps = F.coalesce(F.nullif(start, F.lit(0)), F.lit(OPEN_START))
    pe = F.coalesce(F.nullif(end, F.lit(0)), F.lit(OPEN_END))
    es, ee = F.coalesce(era_start, F.lit(OPEN_START)), F.coalesce(era_end, F.lit(OPEN_END))
    span = F.when(pe > ps, pe - ps).otherwise(1)
    part = F.greatest(F.lit(0), F.least(pe, ee) - F.greatest(ps, es)) / span
    return F.when((ps <= ee) & (pe >= es) & (part > 0.1), F.floor(F.least(F.lit(0.95), 0.6 + part * 0.35) * 100 + 0.5 + 1e-9) / 100)
