"""Data-quality profiles: one pass over the sites for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions.normalize import implausible_year, zero_coordinate
from placeweave.functions.scores import best_description, richness_class, word_count


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


def _rows(df: DataFrame, key: str, cells: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """One row for each entry of ``cells``, from a frame of one row."""
    structs = [F.struct(F.lit(k).alias(key), *[c.alias(n) for c, n in zip(v, names, strict=True)]) for k, v in cells.items()]
    return df.select(F.inline(F.array(*structs)))


def completeness(sites: DataFrame, fields: list[str]) -> DataFrame:
    """(field, total, non_null, null_count, null_rate), all fields in one aggregate; no rows of no sites."""
    sums = sites.agg(F.count("*").alias("total"), *[F.count_if(_filled(f)).alias(f) for f in fields]).where("total > 0")
    total = F.col("total")
    cells = {f: [total, F.col(f), total - F.col(f), F.round((total - F.col(f)) / total, 4)] for f in fields}
    return _rows(sums, "field", cells, ["total", "non_null", "null_count", "null_rate"])


def by_source(sites: DataFrame, flags: list[str]) -> DataFrame:
    """(source, total, with_coordinates, with_description) for each source flag."""
    spot = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    told = _filled("short_description") | _filled("full_description")
    sums = sites.agg(
        *[F.count_if(F.col(f) & x).alias(f"{f}_{n}") for f in flags for n, x in (("n", F.lit(True)), ("c", spot), ("d", F.coalesce(told, F.lit(False))))]
    )
    cells = {f: [F.col(f"{f}_n"), F.col(f"{f}_c"), F.col(f"{f}_d")] for f in flags}
    return _rows(sums, "source", cells, ["total", "with_coordinates", "with_description"])


def distributions(sites: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) of the non-null values of several columns, by one grouping-sets pass."""
    texts = sites.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = texts.groupingSets([[c] for c in columns], *columns).agg(F.count("*").alias("n"), F.grouping_id().alias("__g"))
    # a column's bit is 0 in its own set, the first column's is the highest
    own = {c: (1 << len(columns)) - 1 - (1 << (len(columns) - 1 - k)) for k, c in enumerate(columns)}
    name = F.coalesce(*[F.when(F.col("__g") == g, F.lit(c)) for c, g in own.items()])
    return counts.select(name.alias("column"), F.coalesce(*columns).alias("value"), "n").where("value is not null")


def coordinate_coverage(sites: DataFrame) -> DataFrame:
    """(state, total, with_coordinates, rate) by state, and under a null state of all sites, in one rollup."""
    spot = F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    sums = sites.rollup("state").agg(F.count("*").alias("total"), spot.alias("with_coordinates"), F.grouping("state").alias("__all"))
    rows = sums.where("state is not null or __all = 1").drop("__all")
    none = rows.sparkSession.createDataFrame([(None, 0, 0)], rows.schema)  # a rollup of no rows has no total
    both = rows.unionByName(none).groupBy("state").agg(F.max("total").alias("total"), F.max("with_coordinates").alias("with_coordinates"))
    return both.withColumn("rate", F.round(F.when(F.col("total") > 0, F.col("with_coordinates") / F.col("total")).otherwise(0.0), 4))


def totals(outcomes: DataFrame, by: list[str], outcome: str = "outcome") -> DataFrame:
    """(by, outcome, n): records of each outcome and of all, for each value of ``by`` and over all.

    One cube-like pass of grouping sets; the outcome ``total`` is of all records, and
    ``updated`` of those that matched a stored site or one of the batch.  ``level`` is the
    number of columns of ``by`` that a row keeps.
    """
    sets = [s for k in range(len(by), -1, -1) for s in ([*by[:k], outcome], by[:k])]
    counts = outcomes.groupingSets(sets, *by, outcome).agg(F.count("*").alias("n"), F.grouping(outcome).alias("__t"), sum((1 - F.grouping(c) for c in by), F.lit(0)).cast("int").alias("level"))
    each = counts.withColumn(outcome, F.when(F.col("__t") == 1, "total").otherwise(F.col(outcome))).drop("__t")
    matched = each.where(F.col(outcome).startswith("matched")).groupBy(*by, "level").agg(F.sum("n").alias("n")).withColumn(outcome, F.lit("updated"))
    return each.unionByName(matched)


def description_richness(sites: DataFrame) -> DataFrame:
    words = word_count(best_description(F.col("full_description"), F.col("short_description")))
    return sites.groupBy(richness_class(words).alias("richness")).agg(F.count("*").alias("n"))


def outliers(sites: DataFrame, date_fields: list[str]) -> DataFrame:
    """(site_id, kind, detail) of implausible years and of coordinates that are zero."""
    checks = [
        F.when(implausible_year(F.col(f)), F.struct(F.lit("implausible_year").alias("kind"), F.concat(F.lit(f"{f}: "), F.col(f)).alias("detail")))
        for f in date_fields
    ]
    zero = zero_coordinate(F.col("latitude"), F.col("longitude"))
    checks.append(F.when(zero, F.struct(F.lit("zero_coordinate").alias("kind"), F.lit("latitude or longitude").alias("detail"))))
    return sites.select("site_id", F.explode(F.array_compact(F.array(*checks))).alias("x")).select("site_id", "x.*")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the non-null values of a column."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def summary(sites: DataFrame, sources: DataFrame, designations: DataFrame) -> DataFrame:
    """(what, n): the rows of the three tables."""
    count = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return count(sites, "total_sites").unionByName(count(sources, "total_sources")).unionByName(count(designations, "total_designations"))


def states_with_coordinates(sites: DataFrame) -> DataFrame:
    """States that have a site with coordinates."""
    return sites.where("latitude is not null and longitude is not null and state is not null").select("state").distinct()


def report_outliers(found: DataFrame, most: int = 50) -> DataFrame:
    """What the report lists of the outliers: the first by site."""
    return found.orderBy("site_id", "kind", "detail").limit(most)


def site_richness(sites: DataFrame) -> DataFrame:
    """(site_id, richness) of each site."""
    words = word_count(best_description(F.col("full_description"), F.col("short_description")))
    return sites.select("site_id", richness_class(words).alias("richness"))
