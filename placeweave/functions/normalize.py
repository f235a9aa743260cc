"""States, dates, coordinates, titles and addresses as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave.constants import ADDRESS_WORDS, LAT_RANGE, LON_RANGE, STATE_CODES


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def normalize_state(c: Column) -> Column:
    """A known code upper-cased; a full name's code; else the first two letters upper-cased."""
    s = F.trim(c)
    codes = sorted(set(STATE_CODES.values()))
    return (
        F.when(c.isNull() | (c == ""), F.lit(None))
        .when(F.upper(s).isin(codes) & (F.length(s) == 2), F.upper(s))
        .otherwise(F.coalesce(F.try_element_at(literal_map(STATE_CODES), F.lower(s)), F.substring(F.upper(s), 1, 2)))
    )


def known_state(c: Column) -> Column:
    return c.isin(sorted(set(STATE_CODES.values())))


def normalize_date(c: Column) -> Column:
    """ISO dates and years stay; m/d/yyyy is padded without a range check; large
    numbers are epoch milliseconds or seconds (UTC); four text forms; else unchanged."""
    s = F.trim(c)
    mdy = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    epoch = s.try_cast("double").try_cast("long")
    texts = [F.try_to_timestamp(s, F.lit(f)) for f in ("MMMM d, yyyy", "MMM d, yyyy", "MM-dd-yyyy", "dd-MMM-yyyy")]
    return (
        F.when(s.isNull() | (s == ""), F.lit(None))
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}$") | s.rlike(r"^\d{4}$"), s)
        .when(
            s.rlike(mdy),
            F.concat_ws("-", F.regexp_extract(s, mdy, 3), F.lpad(F.regexp_extract(s, mdy, 1), 2, "0"), F.lpad(F.regexp_extract(s, mdy, 2), 2, "0")),
        )
        .when(epoch > 1_000_000_000_000, F.date_format(F.timestamp_millis(epoch), "yyyy-MM-dd"))
        .when(epoch > 1_000_000_000, F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd"))
        .otherwise(F.coalesce(F.date_format(F.coalesce(*texts), "yyyy-MM-dd"), s))
    )


#: Milliseconds that a timestamp of microseconds holds.
EPOCH_MS = (2**63 - 1) // 1000


def epoch_ms_to_iso(c: Column) -> Column:
    """A number as epoch milliseconds; m/d/yy with years above 25 in the last century; else null."""
    s = F.trim(c.cast("string"))
    mdy = r"^(\d{1,2})/(\d{1,2})/(\d{2,4})$"
    year = F.regexp_extract(s, mdy, 3).try_cast("int")
    full = F.when(year >= 100, year).when(year > 25, year + 1900).otherwise(year + 2000)
    text = F.concat_ws("-", F.lpad(full.cast("string"), 4, "0"), F.lpad(F.regexp_extract(s, mdy, 1), 2, "0"), F.lpad(F.regexp_extract(s, mdy, 2), 2, "0"))
    number = s.try_cast("double").try_cast("long")
    # beyond year 9999 the format puts a sign before the year; what no timestamp holds is null
    held = F.when(number.between(-EPOCH_MS, EPOCH_MS), number)
    day = F.ltrim(F.date_format(F.timestamp_millis(held), "yyyy-MM-dd"), F.lit("+"))
    return F.when(s.rlike(mdy), text).when(number.isNotNull(), day)


def validate_coordinates(lat: Column, lon: Column) -> Column:
    """struct(valid, swapped, latitude, longitude, warnings).

    Coordinates that only fit when exchanged are exchanged; missing, non-numeric
    and NaN ones are invalid, as are those outside the range.
    """
    a, b = lat.try_cast("double"), lon.try_cast("double")
    missing = lat.isNull() | lon.isNull()
    words = ~missing & (a.isNull() | b.isNull())
    nan = F.coalesce(F.isnan(a) | F.isnan(b), F.lit(False)) & ~missing & ~words
    usable = ~missing & ~words & ~nan
    swapped = usable & a.between(*LON_RANGE) & b.between(*LAT_RANGE)
    y, x = F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b)
    low, far = usable & ~y.between(*LAT_RANGE), usable & ~x.between(*LON_RANGE)
    warnings = F.array_compact(
        F.array(
            F.when(missing, F.lit("missing_coordinates")),
            F.when(words, F.concat(F.lit("non_numeric_coordinates: "), lat.cast("string"), F.lit(", "), lon.cast("string"))),
            F.when(nan, F.lit("nan_coordinates")),
            F.when(swapped, F.lit("swapped_lat_lon")),
            F.when(low, F.concat(F.lit("latitude_out_of_bounds: "), y.cast("string"))),
            F.when(far, F.concat(F.lit("longitude_out_of_bounds: "), x.cast("string"))),
        )
    )
    return F.struct(
        (usable & ~low & ~far).alias("valid"), swapped.alias("swapped"), y.alias("latitude"), x.alias("longitude"), warnings.alias("warnings")
    )


def title_case(c: Column) -> Column:
    """A capital after every character that is no letter, not only after spaces."""
    mark = "\u0001 "
    return F.regexp_replace(F.initcap(F.regexp_replace(c, r"([^\p{L}\s])", "$1" + mark)), mark, "")


def normalize_address(c: Column) -> Column:
    """Lower case, no ``.,#``, twelve words abbreviated in their order, single spaces."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[.,#]", "")
    s = reduce(lambda x, w: F.regexp_replace(x, rf"\b{w[0]}\b", w[1]), ADDRESS_WORDS, s)
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def year_of(date: Column) -> Column:
    return F.substring(date, 1, 4).try_cast("int")


def implausible_year(date: Column) -> Column:
    """The first four characters are a year before 1400 or after 2026."""
    return F.coalesce(~year_of(date).between(1400, 2026), F.lit(False))


def zero_coordinate(lat: Column, lon: Column) -> Column:
    return F.coalesce((lat == 0) | (lon == 0), F.lit(False))
