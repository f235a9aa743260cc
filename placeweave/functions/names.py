"""Names and similarity as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from placeweave.constants import EARTH_KM, NAME_SUFFIXES
from placeweave.functions.normalize import title_case

#: A number, with an ordinal's ending (a fixed pattern).
NUMBER = r"\d+(?:st|nd|rd|th)?\b"
_INVISIBLE = "\\u200b\\u200c\\u200d\\ufeff"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_lon) * F.sin(half_lon)
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Null where a coordinate is null or zero."""
    zero = F.lit(0.0)
    return haversine_km(*[F.nullif(c, zero) for c in (lat1, lon1, lat2, lon2)])


def matching_name(c: Column) -> Column:
    """Without the longest listed suffix and without remarks in parentheses."""
    endings = "|".join(sorted(NAME_SUFFIXES, key=len, reverse=True))
    s = F.trim(F.regexp_replace(F.trim(c), rf"(?i)(?:{endings})\z", ""))
    return F.trim(F.regexp_replace(s, r"\s*\(.*?\)\s*", " "))


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")), " ")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, one row of the table at a time."""
    left, right = F.split(a, ""), F.split(b, "")
    zeros = F.array_repeat(F.lit(0), F.length(b) + 1)

    def step(row: Column, x: Column) -> Column:
        # the new row grows from the left; place j + 1 needs the old places j, j + 1
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1))),
            F.array(F.lit(0)),
            lambda new, j: F.array_append(
                new,
                F.when(F.element_at(right, j) == x, F.element_at(row, j) + 1).otherwise(F.greatest(F.element_at(new, -1), F.element_at(row, j + 1))),
            ),
        )

    full = F.element_at(F.aggregate(left, zeros, step), -1)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(full)


def indel_ratio(a: Column, b: Column) -> Column:
    """200 LCS / (both lengths), 100 for two empty strings."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).when(a == b, 100.0).otherwise(F.lit(200.0) * lcs_length(a, b) / total)


@F.pandas_udf(DoubleType())
def _scores(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def _score(a: str | None, b: str | None) -> float | None:
    """200 LCS / (both lengths); rows of the subsequence's table are bits of one number
    (Hyyrö, "Bit-parallel LCS-length computation revisited", 2004)."""
    if a is None or b is None:
        return None
    if a == b:
        return 100.0
    at: dict[str, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    free = full
    for y in b:
        hit = free & at.get(y, 0)
        free = ((free + hit) | (free - hit)) & full
    return 200.0 * (len(a) - free.bit_count()) / (len(a) + len(b))


def name_score(a: Column, b: Column) -> Column:
    """``indel_ratio`` in Arrow batches: for many pairs of distinct names."""
    return _scores(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of the sorted words, 0 to 100, case-sensitive."""
    return indel_ratio(sorted_tokens(a), sorted_tokens(b))


def may_reach(a: Column, b: Column, score: float) -> Column:
    """No score of ``score`` or more is possible where this is false (from the lengths)."""
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.lit(200.0) * shorter >= F.lit(float(score)) * (shorter + longer)


def comparable_lengths(a: Column, b: Column) -> Column:
    """The cheap check before scoring: the shorter has 0.4 of the longer."""
    m, n = F.length(a), F.length(b)
    return (m == 0) | (n == 0) | (F.least(m, n) / F.greatest(m, n) >= 0.4)


def differ_only_by_number(a: Column, b: Column) -> Column:
    """The same but for numbers that differ."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    same = F.regexp_replace(x, NUMBER, "\u0001") == F.regexp_replace(y, NUMBER, "\u0001")
    return same & (F.regexp_extract_all(x, F.lit(NUMBER), F.lit(0)) != F.regexp_extract_all(y, F.lit(NUMBER), F.lit(0)))


def comparison_name(c: Column) -> Column:
    """Lower-case letters, digits and single spaces only."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9\s]", ""), r"\s+", " "))


def match_risk(score: Column, km: Column, kind: Column, city: Column, other_city: Column) -> Column:
    """HIGH, MEDIUM or LOW, by the first rule that holds."""
    both = F.coalesce((F.length(city) > 0) & (F.length(other_city) > 0), F.lit(False))
    mismatch = both & (F.lower(F.trim(city)) != F.lower(F.trim(other_city)))
    by_name = kind == "name_only_match"
    return (
        F.when(by_name & mismatch, "HIGH")
        .when(by_name & km.isNull(), F.when(score < 95, "HIGH").otherwise("MEDIUM"))
        .when((kind == "proximity_match") & (score < 80), "MEDIUM")
        .when(mismatch & km.isNotNull() & (km > 0.3), "MEDIUM")
        .when(score < 85, "MEDIUM")
        .otherwise("LOW")
    )


def strip_invisible(c: Column) -> Column:
    """Trimmed, without zero-width characters at the ends."""
    return F.trim(F.regexp_replace(F.trim(c), f"^[{_INVISIBLE}]+|[{_INVISIBLE}]+$", ""))


def strip_patterns(c: Column, patterns: list[str]) -> Column:
    """Without the given literal artefacts, single spaces (F16)."""
    for p in patterns:
        c = F.replace(c, F.lit(p), F.lit(""))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def pick_entry(c: Column) -> Column:
    """Of ``A (x), B (y)`` the first part about the register, else the first."""
    parts = F.split(c, r"\)\s*,\s*")
    listed = F.filter(parts, lambda p: p.contains("NRHP") | p.contains("National Register"))
    chosen = F.when(F.size(listed) > 0, F.element_at(listed, 1)).otherwise(F.element_at(parts, 1))
    return F.when(F.size(parts) > 1, F.trim(F.regexp_replace(chosen, r"\s*\(.*", ""))).otherwise(c)


def unshout(c: Column) -> Column:
    """All capitals become title case."""
    return F.when((c == F.upper(c)) & (F.lower(c) != c) & (F.length(c) > 1), title_case(c)).otherwise(c)


def is_generic(c: Column, terms: list[str]) -> Column:
    """The name, or what stands before its first ``-``, ``,`` or ``(``, is a listed term."""
    s = F.lower(F.trim(c))
    return s.isin(terms) | F.element_at(F.split(s, r"\s*[-,(]\s*"), 1).isin(terms)
