"""Typed landing of features (S01, S10, S14, S15, K18): VARIANT for all, columns for what is asked often.

A feature is landed as it came.  Numbers and texts stay apart: each frequent attribute
has a column of its texts and one of its numbers, all others stay in one VARIANT.
Source predicates name these columns, so they reach the Parquet scan and a source reads the
columns of its map only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions.normalize import blank_to_null, epoch_ms_to_iso
from placeweave.sources.features import clean_name, place

#: Types of numbers in a VARIANT.
_NUMBERS = ("BIGINT", "DOUBLE", "DECIMAL")
_GEOMETRY = "struct<x:double,y:double,points:array<array<double>>,rings:array<array<array<double>>>>"


def _path(name: str) -> str:
    return "$['" + name + "']"


def text_of(attributes: Column, name: str) -> Column:
    """The attribute if it is a text, else null."""
    kind = F.schema_of_variant(F.try_variant_get(attributes, _path(name), "variant"))
    return F.when(kind == "STRING", F.try_variant_get(attributes, _path(name), "string"))


def number_of(attributes: Column, name: str) -> Column:
    """The attribute if it is a number, else null."""
    kind = F.substring_index(F.schema_of_variant(F.try_variant_get(attributes, _path(name), "variant")), "(", 1)
    return F.when(kind.isin(*_NUMBERS), F.try_variant_get(attributes, _path(name), "double"))


def typed_features(lines: DataFrame, frequent: list[str], column: str = "value") -> DataFrame:
    """Features of JSON lines with t_NAME and n_NAME for each frequent attribute, attributes and geometry.

    A line that is no JSON has null attributes and comes out all the same, with its text
    under ``broken``; further columns pass through.
    """
    read = lines.withColumn("__v", F.try_parse_json(column))
    read = read.withColumn("attributes", F.try_variant_get("__v", "$.attributes", "variant"))
    columns = {f"{p}_{n}": f(F.col("attributes"), n) for n in frequent for p, f in (("t", text_of), ("n", number_of))}
    told = {"geometry": F.try_variant_get("__v", "$.geometry", _GEOMETRY), "broken": F.when(F.col("__v").isNull(), F.col(column))}
    return read.withColumns(columns | told).drop("__v", column)


def land(features: DataFrame, path: str) -> DataFrame:
    """Write typed features once and read them back; columns and predicates of a source act on the scan."""
    features.write.mode("errorifexists").parquet(path)
    return read_landed(features.sparkSession, path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _whole(n: Column) -> Column:
    return F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string"))


def filled(aliases: list[str], known: list[str]) -> Column:
    """The first alias that has a text that is not blank or a number."""
    found = []
    for name in aliases:
        if f"t_{name}" in known:
            found += [blank_to_null(F.col(f"t_{name}")), _whole(F.col(f"n_{name}"))]
        else:
            found += [blank_to_null(text_of(F.col("attributes"), name)), _whole(number_of(F.col("attributes"), name))]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def listed(aliases: list[str], known: list[str]) -> Column:
    """A number is epoch milliseconds, a text stays, digits too."""
    found = []
    for name in aliases:
        text, number = (F.col(f"t_{name}"), F.col(f"n_{name}")) if f"t_{name}" in known else (text_of(F.col("attributes"), name), number_of(F.col("attributes"), name))
        found += [blank_to_null(text), epoch_ms_to_iso(F.floor(number).cast("string"))]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def parse_landed(landed: DataFrame, config: dict) -> DataFrame:
    """Site rows of one source from landed features.

    ``config`` as for ``parse_source``; its ``where`` is SQL over t_ and n_ columns and acts
    before anything is read of other columns.  Rows without a name or a place are dropped.
    """
    known, fields = landed.columns, config["field_map"]
    rows = landed.where(config["where"]) if config.get("where") else landed
    lon, lat = place(F.col("geometry"))
    get = lambda target: filled(fields.get(target, []), known)
    tag = f"shpo_{config['key']}"
    found = rows.select(
        clean_name(get("name"), config).alias("name"), F.lit(config.get("state_code")).alias("state"), get("city").alias("city"), get("county").alias("county"), get("address").alias("address"),
        lat.alias("latitude"), lon.alias("longitude"), get("nris_refnum").alias("nris_refnum"), get("state_record_id").alias("state_record_id"), get("date_constructed").alias("date_constructed"),
        listed(fields.get("date_listed", []), known).alias("state_designation_date"), F.lit(True).alias("source_shpo"), F.lit(tag).alias("primary_source"),
    )
    return found.where("name is not null and name <> '' and latitude is not null and longitude is not null")
