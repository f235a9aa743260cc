"""Registered queries of the place registry, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave import constants as C
from placeweave.functions import names as N
from placeweave.functions import normalize as Z
from placeweave.functions import scores as S
from placeweave.operators import batches, enrich, profile, resolve, scoring, tables, validate
from placeweave.plans import views
from placeweave.plans.views import with_tables
from placeweave.session import LEAST_COUNTED, LEAST_FILE, LEAST_SHARE, staged, with_settings
from placeweave.sinks import exports
from placeweave.sources import documents, features
from placeweave.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        @wraps(run)
        def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(with_settings(spark, LEAST_SHARE, LEAST_FILE, LEAST_COUNTED), sf_dir)

        QUERIES[run.__name__] = spread
        if sql is not None:
            ORACLE_SQL[run.__name__] = sql
        return run

    return register


# --- the oracle's expressions -------------------------------------------------

_CODES = ", ".join(f"'{c}'" for c in sorted(set(C.STATE_CODES.values())))
_LONG = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in C.STATE_CODES.items())
SQL_STATE = (
    f"CASE WHEN state IS NULL OR state = '' THEN NULL WHEN length(trim(state)) = 2 AND upper(trim(state)) IN ({_CODES}) THEN upper(trim(state)) "
    f"ELSE coalesce(CASE lower(trim(state)) {_LONG} END, substr(upper(trim(state)), 1, 2)) END"
)
_MDY = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def sql_date(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') OR regexp_matches({c}, '^\\d{{4}}$') THEN {c} "
        f"WHEN regexp_matches({c}, '{_MDY}') THEN regexp_extract({c}, '{_MDY}', 3) || '-' || lpad(regexp_extract({c}, '{_MDY}', 1), 2, '0') || '-' || lpad(regexp_extract({c}, '{_MDY}', 2), 2, '0') "
        f"WHEN try_cast({c} AS DOUBLE) > 1e12 THEN strftime(make_timestamp(CAST(try_cast({c} AS DOUBLE) AS BIGINT) * 1000), '%Y-%m-%d') "
        f"WHEN try_cast({c} AS DOUBLE) > 1e9 THEN strftime(make_timestamp(CAST(try_cast({c} AS DOUBLE) AS BIGINT) * 1000000), '%Y-%m-%d') "
        f"ELSE coalesce(strftime(try_strptime({c}, ['%B %d, %Y', '%b %d, %Y', '%m-%d-%Y', '%d-%b-%Y']), '%Y-%m-%d'), {c}) END"
    )


_SWAPPED = f"(latitude BETWEEN {C.LON_RANGE[0]} AND {C.LON_RANGE[1]} AND longitude BETWEEN {C.LAT_RANGE[0]} AND {C.LAT_RANGE[1]})"
_VALIDATED = f"""
, v0 AS (SELECT *, {SQL_STATE} AS state2, latitude IS NULL OR longitude IS NULL AS missing, coalesce({_SWAPPED}, false) AS swapped FROM sites),
v1 AS (SELECT *, CASE WHEN swapped THEN longitude ELSE latitude END AS lat2, CASE WHEN swapped THEN latitude ELSE longitude END AS lon2,
  state2 IS NOT NULL AND state2 NOT IN ({_CODES}) AS odd FROM v0),
v2 AS (SELECT *, NOT missing AND lat2 NOT BETWEEN {C.LAT_RANGE[0]} AND {C.LAT_RANGE[1]} AS low, NOT missing AND lon2 NOT BETWEEN {C.LON_RANGE[0]} AND {C.LON_RANGE[1]} AS far FROM v1),
validated AS (SELECT *, CASE WHEN missing OR low OR far THEN 'fail' WHEN odd OR swapped THEN 'warning' ELSE 'pass' END AS status FROM v2)
"""


# --- validation ----------------------------------------------------------------


@query(with_tables("sites", body=_VALIDATED + "SELECT status, count(*) AS n FROM validated GROUP BY status"))
def validate_status(spark, sf_dir):
    return validate.status_counts(validate.validate_sites(views.sites(spark, sf_dir)))


@query(
    with_tables(
        "sites",
        body=_VALIDATED
        + """, kinds AS (
SELECT unnest([CASE WHEN odd THEN 'unknown_state' END, CASE WHEN missing THEN 'missing_coordinates' END, CASE WHEN swapped THEN 'swapped_lat_lon' END,
  CASE WHEN low THEN 'latitude_out_of_bounds' END, CASE WHEN far THEN 'longitude_out_of_bounds' END]) AS issue FROM validated)
SELECT issue, count(*) AS n FROM kinds WHERE issue IS NOT NULL GROUP BY issue""",
    )
)
def validate_issues(spark, sf_dir):
    return validate.issue_counts(validate.validate_sites(views.sites(spark, sf_dir)))


@query(
    with_tables(
        "sites",
        body=_VALIDATED
        + f"SELECT site_id, state2 AS state, {sql_date('date_constructed')} AS date_constructed, round(lat2, 6) AS latitude, round(lon2, 6) AS longitude, status FROM validated",
    )
)
def normalized_sites(spark, sf_dir):
    rows = validate.validate_sites(views.sites(spark, sf_dir))
    return rows.select("site_id", "state", "date_constructed", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "status")


_TITLE = "array_to_string(list_transform(regexp_extract_all(lower({0}), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '')"


@query(with_tables("sites", body=f" SELECT site_id, {_TITLE.format('county')} AS county, {_TITLE.format('city')} AS city FROM sites"))
def title_names(spark, sf_dir):
    return views.sites(spark, sf_dir).select("site_id", Z.title_case(F.col("county")).alias("county"), Z.title_case(F.col("city")).alias("city"))


_SUFFIX = "|".join(sorted(C.NAME_SUFFIXES, key=len, reverse=True))


def sql_plain(c: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace(trim({c}), '(?i)(?:{_SUFFIX})$', '')), '\\s*\\(.*?\\)\\s*', ' ', 'g'))"


def sql_address(c: str) -> str:
    out = f"regexp_replace(lower(trim({c})), '[.,#]', '', 'g')"
    for word, short in C.ADDRESS_WORDS:
        out = f"regexp_replace({out}, '\\b{word}\\b', '{short}', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query(
    with_tables(
        "sites",
        body=f" SELECT site_id, {sql_plain('name')} AS plain, trim(regexp_replace(regexp_replace(lower(trim(name)), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS compared, {sql_address('address')} AS address FROM sites",
    )
)
def matching_names(spark, sf_dir):
    return views.sites(spark, sf_dir).select(
        "site_id", N.matching_name(F.col("name")).alias("plain"), N.comparison_name(F.col("name")).alias("compared"), Z.normalize_address(F.col("address")).alias("address")
    )


# --- profiles --------------------------------------------------------------------

PROFILED = ["nris_refnum", "name", "address", "city", "county", "state", "latitude", "longitude", "date_constructed", "nhl_designation_date", "short_description", "full_description"]


@query(
    with_tables(
        "sites",
        body=" "
        + " UNION ALL ".join(
            f"SELECT '{f}' AS field, count(*) AS total, count(*) FILTER (WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '') AS non_null, "
            f"count(*) - count(*) FILTER (WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '') AS null_count, "
            f"round((count(*) - count(*) FILTER (WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '')) / count(*), 4) AS null_rate FROM sites"
            for f in PROFILED
        ),
    )
)
def profile_completeness(spark, sf_dir):
    return profile.completeness(views.sites(spark, sf_dir), PROFILED)


@query(
    with_tables(
        "sites",
        body=" "
        + " UNION ALL ".join(
            f"SELECT '{f}' AS source, count(*) FILTER (WHERE {f}) AS total, count(*) FILTER (WHERE {f} AND latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates, "
            f"count(*) FILTER (WHERE {f} AND (coalesce(short_description, '') <> '' OR coalesce(full_description, '') <> '')) AS with_description FROM sites"
            for f in C.SOURCE_FLAGS[:4]
        ),
    )
)
def profile_by_source(spark, sf_dir):
    return profile.by_source(views.sites(spark, sf_dir), C.SOURCE_FLAGS[:4])


DISTRIBUTED = ["state", "review_status", "enrichment_status"]


@query(with_tables("sites", body=" " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM sites WHERE {c} IS NOT NULL GROUP BY {c}" for c in DISTRIBUTED)))
def profile_distributions(spark, sf_dir):
    return profile.distributions(views.sites(spark, sf_dir), DISTRIBUTED)


_SPOT = "count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"


@query(
    with_tables(
        "sites",
        body=f" SELECT state, count(*) AS total, {_SPOT} AS with_coordinates, round({_SPOT} / count(*), 4) AS rate FROM sites WHERE state IS NOT NULL GROUP BY state "
        f"UNION ALL SELECT NULL, count(*), {_SPOT}, round({_SPOT} / count(*), 4) FROM sites",
    )
)
def profile_coordinates(spark, sf_dir):
    return profile.coordinate_coverage(views.sites(spark, sf_dir))


_WORDS = "len(list_filter(regexp_split_to_array(coalesce(nullif(full_description, ''), nullif(short_description, ''), ''), '\\s+'), lambda x: x <> ''))"


@query(
    with_tables(
        "sites",
        body=f", w AS (SELECT {_WORDS} AS n FROM sites) SELECT CASE WHEN n >= 50 THEN 'data_rich' WHEN n >= 5 THEN 'data_moderate' ELSE 'data_poor' END AS richness, count(*) AS n FROM w GROUP BY 1",
    )
)
def profile_richness(spark, sf_dir):
    return profile.description_richness(views.sites(spark, sf_dir))


_ODD_YEAR = "try_cast(substr({0}, 1, 4) AS INTEGER) NOT BETWEEN 1400 AND 2026"


@query(
    with_tables(
        "sites",
        body=" "
        + " UNION ALL ".join(
            f"SELECT site_id, 'implausible_year' AS kind, '{f}: ' || {f} AS detail FROM sites WHERE {_ODD_YEAR.format(f)}" for f in ("date_constructed", "nhl_designation_date")
        )
        + " UNION ALL SELECT site_id, 'zero_coordinate', 'latitude or longitude' FROM sites WHERE latitude = 0 OR longitude = 0",
    )
)
def profile_outliers(spark, sf_dir):
    return profile.outliers(views.sites(spark, sf_dir), ["date_constructed", "nhl_designation_date"])


@query(with_tables("sites", body=" SELECT coordinates_source, count(*) AS n FROM sites WHERE coordinates_source IS NOT NULL GROUP BY 1"))
def geocode_sources(spark, sf_dir):
    return profile.value_counts(views.sites(spark, sf_dir), "coordinates_source")


# --- scores ------------------------------------------------------------------------

_GENERIC = "|".join(C.GENERIC_NAMES)
_FACTORS = f"""
, cat AS (SELECT site_id, avg(confidence) AS mean, stddev_samp(confidence) AS dev, count(*) AS n FROM site_categories GROUP BY site_id),
words AS (SELECT *, {_WORDS} AS n_words FROM sites),
factors AS (
SELECT s.site_id, s.name,
  ({" + ".join(f"CAST({f} IS NOT NULL AS INTEGER)" for f in C.KEY_FIELDS)}) / 7 AS data_completeness,
  CASE WHEN n_words >= 100 THEN 1.0::DOUBLE WHEN n_words >= 50 THEN 0.7 WHEN n_words >= 5 THEN 0.4 ELSE 0.1 END AS description_richness,
  CASE WHEN s.site_id IN (SELECT site_id FROM site_categories WHERE kind = 'type') THEN 0.4::DOUBLE ELSE 0 END
  + CASE WHEN s.site_id IN (SELECT site_id FROM areas) THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN s.site_id IN (SELECT site_id FROM periods) THEN 0.25::DOUBLE ELSE 0 END AS official_data,
  CASE WHEN NOT source_nomination THEN 0.3::DOUBLE WHEN length(full_description) > 100 THEN 1.0 WHEN length(full_description) > 0 THEN 0.7 ELSE 0.2 END AS nomination_extraction,
  coalesce(mean, 0) AS ai_confidence,
  CASE WHEN coalesce(n, 0) < 2 THEN 0.5::DOUBLE ELSE 1 - least(1.0, dev) END AS classification_ambiguity,
  CASE WHEN flags >= 4 THEN 1.0::DOUBLE WHEN flags = 3 THEN 0.8 WHEN flags = 2 THEN 0.6 ELSE 0.3 END AS source_agreement,
  CASE WHEN trim(lower(s.name)) = '' THEN 0.0::DOUBLE WHEN regexp_matches(trim(lower(s.name)), '^({_GENERIC})($| #)') THEN 0.2 WHEN length(trim(s.name)) < 10 THEN 0.6 ELSE 1.0 END AS name_specificity
FROM (SELECT *, {" + ".join(f"CAST({f} AS INTEGER)" for f in C.SOURCE_FLAGS)} AS flags FROM words) s LEFT JOIN cat USING (site_id))
"""
_SCORE = "round(" + " + ".join(f"{k} * {w}::DOUBLE" for k, w in C.SCORE_WEIGHTS.items()) + ", 4)"


def _unclassified(spark, sf_dir):
    """Factors of the registry as it is before anything is classified: periods are all it knows."""
    none = spark.createDataFrame([], "site_id long, confidence double")
    return scoring.factor_scores(views.sites(spark, sf_dir), none, none, views.periods(spark, sf_dir), none)


_BEFORE = (
    _FACTORS.replace("FROM site_categories GROUP BY site_id", "FROM site_categories WHERE false GROUP BY site_id")
    .replace("s.site_id IN (SELECT site_id FROM site_categories WHERE kind = 'type')", "false")
    .replace("s.site_id IN (SELECT site_id FROM areas)", "false")
)


def _factors(spark, sf_dir):
    cats = views.site_categories(spark, sf_dir)
    return scoring.factor_scores(views.sites(spark, sf_dir), cats.where("kind = 'type'"), views.areas(spark, sf_dir), views.periods(spark, sf_dir), cats)


@query(with_tables("sites", "site_categories", "areas", "periods", body=_FACTORS + f"SELECT site_id, {', '.join(f'round({k}, 4) AS {k}' for k in C.SCORE_WEIGHTS)} FROM factors"))
def factor_scores(spark, sf_dir):
    return _factors(spark, sf_dir).select("site_id", *[F.round(k, 4).alias(k) for k in C.SCORE_WEIGHTS])


@query(
    with_tables(
        "sites", "site_categories", "areas", "periods",
        body=_FACTORS + f", s AS (SELECT {_SCORE} AS score FROM factors) SELECT CASE WHEN score >= 0.8 THEN 'auto_approved' WHEN score >= 0.5 THEN 'unreviewed' ELSE 'flagged' END AS review_status, count(*) AS n FROM s GROUP BY 1",
    )
)
def score_statuses(spark, sf_dir):
    return profile.value_counts(scoring.scored(_factors(spark, sf_dir)), "review_status")


@query(
    with_tables(
        "sites", "site_categories", "areas", "periods",
        body=_BEFORE + f", s AS (SELECT site_id, name, {_SCORE} AS confidence_score FROM factors) SELECT site_id, name, confidence_score, CAST(trunc((1.0 - confidence_score) * 100) AS INTEGER) AS review_priority FROM s WHERE confidence_score < 0.5",
    )
)
def review_queue(spark, sf_dir):
    return scoring.review_queue(scoring.scored(_unclassified(spark, sf_dir))).select("site_id", "name", "confidence_score", "review_priority")


# --- enrichment ----------------------------------------------------------------------

_ERA_ROWS = ", ".join(f"({i + 1}, '{e}', {s if s is not None else 'NULL'}, {t if t is not None else 'NULL'})" for i, (e, s, t) in enumerate(C.ERAS))
_ERA_SQL = f"""
, eras(era_no, era, era_start, era_end) AS (VALUES {_ERA_ROWS}),
p AS (SELECT *, coalesce(nullif(start_year, 0), 0) AS ps, coalesce(nullif(end_year, 0), 2026) AS pe FROM periods),
o AS (SELECT site_id, period_id, era_no, era, greatest(0, least(pe, coalesce(era_end, 2026)) - greatest(ps, coalesce(era_start, 0))) / CASE WHEN pe > ps THEN pe - ps ELSE 1 END AS part
  FROM p JOIN eras ON ps <= coalesce(era_end, 2026) AND pe >= coalesce(era_start, 0)),
spans AS (SELECT site_id, period_id, era_no, era, floor(least(0.95::DOUBLE, 0.6::DOUBLE + part * 0.35::DOUBLE) * 100 + 0.5 + 1e-9) / 100 AS confidence FROM o WHERE part > 0.1)
"""


@query(with_tables("periods", body=_ERA_SQL + "SELECT site_id, period_id, era, confidence FROM spans"))
def era_overlap(spark, sf_dir):
    return enrich.era_overlaps(views.periods(spark, sf_dir)).drop("era_no")


@query(
    with_tables(
        "periods",
        body=_ERA_SQL
        + """, r AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY confidence DESC, period_id, era_no) AS rank FROM spans)
SELECT site_id, era, CAST(min(rank) AS INTEGER) AS rank, arg_min(confidence, rank) AS confidence FROM r WHERE rank <= 3 GROUP BY site_id, era""",
    )
)
def era_top3(spark, sf_dir):
    return enrich.top_eras(views.periods(spark, sf_dir))


_NATURES = ", ".join(f"({i}, {repr(n) if n else 'NULL'})" for i, (_, n) in enumerate(C.AREA_NATURES))


@query(
    with_tables(
        "areas",
        body=f""", natures(no, nature) AS (VALUES {_NATURES}),
f AS (SELECT site_id, nature, min(area_id) AS first FROM areas JOIN natures ON no = area_no WHERE nature IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY site_id ORDER BY first, nature) AS INTEGER) AS rank FROM f)
SELECT site_id, nature, rank FROM r WHERE rank <= 3""",
    )
)
def events_top3(spark, sf_dir):
    return enrich.top_natures(views.areas(spark, sf_dir))


@query(with_tables("sites", body=" SELECT state, site_id, (row_number() OVER (PARTITION BY state ORDER BY site_id) - 1) // 10 AS chunk FROM sites WHERE address IS NOT NULL"))
def chunk_batches(spark, sf_dir):
    return enrich.chunk_numbers(views.sites(spark, sf_dir).where("address is not null"), ["state"], "site_id", 10).select("state", "site_id", "chunk")


@query(
    """WITH e AS (SELECT user_id, event_id, event_type = 'error' AS failed FROM events),
i AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM e),
s AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY event_id) AS streak FROM i),
stops AS (SELECT user_id, min(event_id) AS stop FROM s WHERE streak = 2 GROUP BY user_id)
SELECT user_id, event_id, failed FROM e LEFT JOIN stops USING (user_id) WHERE stop IS NULL OR event_id <= stop"""
)
def breaker_cutoff(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("failed"))
    return enrich.breaker_cutoff(events, ["user_id"], "event_id", "failed", run=2)


# --- resolution ----------------------------------------------------------------------

_NATION_CODES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(views.CODES))
_KEYED = f"""
, keyed AS (SELECT site_id AS id, *, nullif(lower(trim(city)), '') AS city_key, nullif({sql_address('address')}, '') AS address_key,
  {sql_plain('name')} AS plain, CAST(round_even(latitude / 0.05, 0) AS BIGINT) AS cx, CAST(round_even(longitude / 0.05, 0) AS BIGINT) AS cy FROM sites),
inc AS (SELECT site_id + 1000000 AS id, state, CASE WHEN site_id % 9 = 1 THEN nris_refnum END AS nris_refnum,
  nullif(lower(trim(CASE WHEN site_id % 7 = 1 THEN 'ELSEWHERE' ELSE city END)), '') AS city_key, nullif({sql_address('address')}, '') AS address_key,
  latitude + 0.001 AS latitude, longitude + 0.001 AS longitude, CAST(round_even((latitude + 0.001) / 0.05, 0) AS BIGINT) AS cx, CAST(round_even((longitude + 0.001) / 0.05, 0) AS BIGINT) AS cy
  FROM sites
  UNION ALL SELECT s_suppkey + 900000000, code, NULL, NULL, NULL, 60.0, -150.0 + s_suppkey % 100 / 100, 1200, CAST(round_even((-150.0 + s_suppkey % 100 / 100) / 0.05, 0) AS BIGINT)
  FROM supplier JOIN (VALUES {_NATION_CODES}) AS c(nation, code) ON nation = s_nationkey)
"""


def _sides(spark, sf_dir):
    """Both sides with their keys, staged since a cascade reads them many times."""
    return staged(resolve.keyed(views.incoming(spark, sf_dir), "record_id")), staged(resolve.keyed(views.sites(spark, sf_dir), "site_id"))


@query(with_tables("sites", body=_KEYED + "SELECT i.id AS record_id, e.id AS site_id FROM inc i JOIN keyed e ON i.nris_refnum = e.nris_refnum"))
def refnum_matches(spark, sf_dir):
    only = lambda df, id: df.select(F.col(id).alias("id"), "nris_refnum").where("nris_refnum is not null")
    return resolve.refnum_matches(only(views.incoming(spark, sf_dir), "record_id"), only(views.sites(spark, sf_dir), "site_id")).select(F.col("i_id").alias("record_id"), F.col("e_id").alias("site_id"))


@query(with_tables("sites", body=_KEYED + "SELECT i.id AS record_id, e.id AS site_id FROM inc i JOIN keyed e ON i.state = e.state AND i.address_key = e.address_key AND i.city_key = e.city_key"))
def address_matches(spark, sf_dir):
    return resolve.address_matches(*_sides(spark, sf_dir)).select(F.col("i_id").alias("record_id"), F.col("e_id").alias("site_id"))


_HAVERSINE = (
    "12742.0 * atan2(sqrt({a}), sqrt(1 - {a}))".replace(
        "{a}",
        "(pow(sin(radians(e.latitude - i.latitude) / 2), 2) + cos(radians(i.latitude)) * cos(radians(e.latitude)) * pow(sin(radians(e.longitude - i.longitude) / 2), 2))",
    )
)


@query(with_tables("sites", body=_KEYED + f"SELECT i.id AS record_id, e.id AS site_id, round({_HAVERSINE}, 6) AS km FROM inc i JOIN keyed e ON i.state = e.state AND abs(i.cx - e.cx) <= 1 AND abs(i.cy - e.cy) <= 1"))
def grid_candidates(spark, sf_dir):
    pairs = resolve.neighbours(*_sides(spark, sf_dir))
    km = N.haversine_km(*[F.col(c) for c in ("i_latitude", "i_longitude", "e_latitude", "e_longitude")])
    return pairs.select(F.col("i_id").alias("record_id"), F.col("e_id").alias("site_id"), F.round(km, 6).alias("km"))


@query()
def match_cascade(spark, sf_dir):
    return resolve.cascade(*_sides(spark, sf_dir))


@query()
def match_audit(spark, sf_dir):
    return resolve.match_audit(*_sides(spark, sf_dir))


# --- writes ----------------------------------------------------------------------------


@query(
    with_tables(
        "sites",
        body=""", cur AS (SELECT site_id, nris_refnum, name, city, address, source_shpo FROM sites WHERE nris_refnum IS NOT NULL QUALIFY row_number() OVER (PARTITION BY nris_refnum ORDER BY site_id) = 1),
inc AS (SELECT site_id + 1000000 AS arrival, nris_refnum, 'New ' || name AS name, CASE WHEN site_id % 7 = 1 THEN 'ELSEWHERE' ELSE city END AS city, address, true AS source_shpo FROM sites),
f AS (SELECT nris_refnum, arg_min(name, arrival) AS name, arg_min(city, arrival) FILTER (WHERE city IS NOT NULL AND city <> '') AS city,
  arg_min(address, arrival) FILTER (WHERE address IS NOT NULL AND address <> '') AS address, bool_or(source_shpo) AS source_shpo FROM inc WHERE nris_refnum IS NOT NULL GROUP BY 1)
SELECT coalesce(cur.site_id, -1) AS site_id, coalesce(cur.nris_refnum, f.nris_refnum) AS nris_refnum, coalesce(nullif(cur.name, ''), f.name, cur.name) AS name, coalesce(nullif(cur.city, ''), f.city, cur.city) AS city,
  coalesce(nullif(cur.address, ''), f.address, cur.address) AS address, coalesce(cur.source_shpo, false) OR coalesce(f.source_shpo, false) AS source_shpo
FROM cur FULL JOIN f ON cur.nris_refnum = f.nris_refnum
UNION ALL SELECT -1, nris_refnum, name, city, address, source_shpo FROM inc WHERE nris_refnum IS NULL""",
    )
)
def upsert_first_wins(spark, sf_dir):
    fields = ["site_id", "nris_refnum", "name", "city", "address", "source_shpo"]
    rows = views.sites(spark, sf_dir)
    current = tables.keep_first(rows.where("nris_refnum is not null"), ["nris_refnum"], "site_id").select(*fields)
    k = F.col("site_id")
    new = rows.select(
        (k + 1_000_000).alias("arrival"), "nris_refnum", F.concat(F.lit("New "), "name").alias("name"),
        F.when(k % 7 == 1, "ELSEWHERE").otherwise(F.col("city")).alias("city"), "address", F.lit(True).alias("source_shpo"),
    )
    return tables.upsert_first_wins(current, new, "nris_refnum", "arrival", ["source_shpo"]).fillna(-1, ["site_id"])


@query(
    with_tables(
        "sites",
        body=""", m AS (SELECT o_custkey AS site_id, 'filled ' || o_orderstatus AS city, 'filled road' AS address FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
SELECT s.site_id, CASE WHEN m.site_id IS NOT NULL AND primary_source <> 'manual' THEN coalesce(nullif(s.city, ''), m.city) ELSE s.city END AS city,
  CASE WHEN m.site_id IS NOT NULL AND primary_source <> 'manual' THEN coalesce(nullif(s.address, ''), m.address) ELSE s.address END AS address,
  CASE WHEN m.site_id IS NOT NULL AND primary_source <> 'manual' THEN true ELSE source_shpo END AS source_shpo FROM sites s LEFT JOIN m ON s.site_id = m.site_id""",
    )
)
def fill_empty(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    first = tables.keep_first(views.table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey")
    matched = first.select(F.col("o_custkey").alias("site_id"), F.concat(F.lit("filled "), "o_orderstatus").alias("city"), F.lit("filled road").alias("address"))
    return tables.fill_empty(rows, matched, ["city", "address"], "source_shpo").select("site_id", "city", "address", "source_shpo")


@query(
    with_tables(
        "site_categories",
        body=" SELECT site_id, kind, category, CAST(rank AS INTEGER) AS rank, confidence FROM site_categories WHERE rank BETWEEN 1 AND 3 AND confidence BETWEEN 0 AND 1 QUALIFY row_number() OVER (PARTITION BY site_id, kind, category ORDER BY arrival) = 1",
    )
)
def keep_first_categories(spark, sf_dir):
    new = views.site_categories(spark, sf_dir, placed=True).withColumn("rank", F.col("rank").cast("int"))
    new = new.withColumn("arrival", F.struct("arrival", "file", "row")).drop("file", "row")  # rows of one arrival come as they are stored
    empty = new.drop("arrival").where("false")
    return tables.insert_or_ignore(empty, new, ["site_id", "kind", "category"], F.col("rank").between(1, 3) & F.col("confidence").between(0, 1), "arrival")


@query(
    with_tables(
        "sites",
        body=""", p AS (SELECT site_id % 100 AS site_id, CASE site_id % 4 WHEN 0 THEN 'arcgis' WHEN 1 THEN 'shpo' WHEN 2 THEN 'nps_parks' ELSE 'other' END AS source, name, city FROM sites),
r AS (SELECT *, CASE source WHEN 'arcgis' THEN 1 WHEN 'nps_parks' THEN 2 WHEN 'shpo' THEN 3 ELSE 1048576 END AS r FROM p)
SELECT site_id, min((r, name)) FILTER (WHERE name <> '')[2] AS name, min((r, city)) FILTER (WHERE city <> '')[2] AS city FROM r GROUP BY site_id""".replace(
            "min((r, name)) FILTER (WHERE name <> '')[2]", "struct_extract(min({'r': r, 'v': name}) FILTER (WHERE name <> ''), 'v')"
        ).replace("min((r, city)) FILTER (WHERE city <> '')[2]", "struct_extract(min({'r': r, 'v': city}) FILTER (WHERE city <> ''), 'v')"),
    )
)
def priority_merge(spark, sf_dir):
    k = F.col("site_id") % 4
    source = F.when(k == 0, "arcgis").when(k == 1, "shpo").when(k == 2, "nps_parks").otherwise("other")
    rows = views.sites(spark, sf_dir).select((F.col("site_id") % 100).alias("site_id"), source.alias("source"), "name", "city")
    return tables.priority_wins(rows, {"arcgis": 1, "nps_parks": 2, "shpo": 3}, ["name", "city"])


# --- sources, exports and streams ----------------------------------------------------------


@query("SELECT page_id, coalesce(len(regexp_extract_all(html, '(?s)<li[^>]*>.*?</li>')), 0) AS n_items, nullif(trim(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)), '') AS heading FROM pages")
def page_fields(spark, sf_dir):
    return documents.page_outline(views.table(spark, sf_dir, "pages"))


@query()
def page_rows(spark, sf_dir):
    """Listing rows of all pages; list items stand for table rows."""
    pages = views.table(spark, sf_dir, "pages")
    cells = F.regexp_replace(F.regexp_replace("html", r"<li[^>]*>", "<tr><td>"), "</li>", "</td></tr>")
    return documents.listing_rows(pages.withColumn("html", cells))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    attributes = F.from_json("props", "map<string,string>")
    return events.select("event_id", features.first_filled(attributes, ["missing", "k"]).alias("k"))


@query(with_tables("sites", body=" SELECT site_id, state, name, nris_refnum, city, county, address, date_constructed, review_status, round(longitude, 6) AS lon, round(latitude, 6) AS lat FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))
def geojson_features(spark, sf_dir):
    lines = exports.geojson_features(views.sites(spark, sf_dir))
    read = F.from_json("feature", "struct<geometry:struct<coordinates:array<double>>,properties:map<string,string>>")
    return lines.select("site_id", "state", read.alias("f")).select(
        "site_id", "state", *[F.col("f.properties")[c].alias(c) for c in ("name", "nris_refnum", "city", "county", "address", "date_constructed", "review_status")], F.round(F.col("f.geometry.coordinates")[0], 6).alias("lon"), F.round(F.col("f.geometry.coordinates")[1], 6).alias("lat")
    )


@query(
    with_tables(
        "sites",
        body=""", k AS (SELECT coalesce(state, 'Unknown') AS state, name, site_id FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY name, site_id) AS rn, count(*) OVER (PARTITION BY state) AS m FROM k)
SELECT state, coalesce(CASE WHEN m > 2000 THEN (rn - 1) // 2000 + 1 END, 0) AS part, count(*) AS n FROM n GROUP BY 1, 2""",
    )
)
def kml_parts(spark, sf_dir):
    marks = exports.kml_placemarks(views.sites(spark, sf_dir))
    return marks.groupBy("state", F.coalesce("part", F.lit(0)).alias("part")).agg(F.count("*").alias("n"))


@query(with_tables("sites", body=" SELECT site_id, coalesce(state, 'Unknown') AS state, name, round(longitude, 6) AS lon, round(latitude, 6) AS lat FROM sites WHERE latitude IS NOT NULL AND longitude IS NOT NULL"))
def kml_marks(spark, sf_dir):
    marks = exports.kml_placemarks(views.sites(spark, sf_dir))
    spot = F.split(F.regexp_extract("placemark", "<coordinates>([^<]*)<", 1), ",")
    name = F.replace(F.regexp_extract("placemark", "<name>([^<]*)<", 1), F.lit("&amp;"), F.lit("&"))
    return marks.select("site_id", "state", name.alias("name"), F.round(spot[0].cast("double"), 6).alias("lon"), F.round(spot[1].cast("double"), 6).alias("lat"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS started, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def run_progress_windows(spark, sf_dir):
    return incremental.progress_windows(views.table(spark, sf_dir, "events"), "event_type")


@query(with_tables("sites", body=""", d AS (SELECT site_id, CASE site_id % 8 WHEN 0 THEN 'Federal NRHP' WHEN 1 THEN 'Tribal' WHEN 2 THEN 'NPS Unit' WHEN 3 THEN 'Local Landmark' ELSE 'State Register' END AS t FROM sites
  UNION ALL SELECT site_id, 'Federal NHL' FROM sites WHERE site_id % 5 = 0),
r AS (SELECT site_id, t, CASE t WHEN 'Federal NHL' THEN 1 WHEN 'Federal NRHP' THEN 2 WHEN 'NPS Unit' THEN 3 WHEN 'State Register' THEN 4 WHEN 'Local Landmark' THEN 5 ELSE 6 END AS k FROM d)
SELECT site_id, arg_min(t, k) AS designation_type, CASE arg_min(t, k) WHEN 'Federal NHL' THEN 'red' WHEN 'Federal NRHP' THEN 'blue' WHEN 'NPS Unit' THEN 'green' WHEN 'State Register' THEN 'orange' WHEN 'Local Landmark' THEN 'purple' ELSE 'darkred' END AS colour FROM r GROUP BY site_id"""))
def best_designation(spark, sf_dir):
    rows = views.sites(spark, sf_dir)
    k = F.col("site_id") % 8
    kind = F.when(k == 0, "Federal NRHP").when(k == 1, "Tribal").when(k == 2, "NPS Unit").when(k == 3, "Local Landmark").otherwise("State Register")
    both = rows.select("site_id", kind.alias("designation_type")).unionByName(rows.where(F.col("site_id") % 5 == 0).select("site_id", F.lit("Federal NHL").alias("designation_type")))
    return exports.best_designation(both)


@query(
    with_tables(
        "sites",
        body=" SELECT site_id, CASE WHEN address IS NOT NULL THEN concat_ws(', ', nullif(trim(address), ''), nullif(trim(city), ''), nullif(trim(state), ''), 'United States') END AS by_address, "
        "concat_ws(', ', nullif(trim(name), ''), nullif(trim(city), ''), nullif(trim(state), ''), 'United States') AS by_name, "
        "CASE WHEN city IS NOT NULL THEN concat_ws(', ', nullif(trim(city), ''), nullif(trim(state), ''), 'United States') END AS by_city FROM sites",
    )
)
def geocode_queries(spark, sf_dir):
    return exports.query_strings(views.sites(spark, sf_dir))


@query()
def park_matches(spark, sf_dir):
    inc, sites = _sides(spark, sf_dir)
    return resolve.park_matches(inc, sites)


@query()
def battlefield_matches(spark, sf_dir):
    inc, sites = _sides(spark, sf_dir)
    return resolve.battlefield_matches(inc, sites)


@query()
def near_misses(spark, sf_dir):
    inc, sites = _sides(spark, sf_dir)
    return resolve.near_misses(inc, sites, resolve.cascade(inc, sites))


@query()
def insert_leaders(spark, sf_dir):
    """Records that are inserted when they arrive one after the other."""
    return batches.insert_leaders(*_sides(spark, sf_dir))


from placeweave.plans import merging  # noqa: E402, F401  (registers its queries)
from placeweave.plans import file_plans, landing_plans, source_plans, stream_plans  # noqa: E402, F401
