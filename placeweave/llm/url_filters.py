"""URL filters (operator 3), built from DataFrame functions only.

A URL is expanded into expressions, one for each suffix of its host (whole labels)
and each prefix of its path that is as long as some rule's path.  Expressions meet
rules in an equi-join on a short prefix of their digest; the full digest then
confirms the hit and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the equi-join compares.
SHORT = 8
#: Most rules that are broadcast; larger rule tables are shuffled.
BROADCAST_RULES = 100_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: then up to ``?``, ``#`` or the end.  Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: F.Column, path: F.Column) -> F.Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with the columns host, path, rule and verdict added.

    ``rules`` (host, path, verdict): a rule fits its host and all subdomains, if
    the URL's path starts with the rule's; the longest host and path win, among
    equal rules the smaller verdict by name but ``block`` before all.  ``rule``
    is null and ``verdict`` the default where none fits.  Null URLs and URLs
    without ``://`` have empty host and path.  Each distinct URL is judged once,
    so repeated rows and a URL that fills a third of the table cost a join, whose
    skewed side adaptive execution splits; all rows are returned.  Columns of
    ``pages`` named like an added one are replaced.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in added]
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        _digest(F.col("host"), F.col("path")).alias("__digest"),
        F.concat("host", "path").alias("__rule"),
        F.struct(
            F.length(F.concat("host", "path")).alias("length"),
            (F.col("verdict") == "block").alias("block"),
            F.col("verdict").alias("verdict"),
            F.concat("host", "path").alias("rule"),
        ).alias("__found"),
        F.length("path").alias("__length"),
    )
    lengths = sorted(r[0] for r in rules.select("__length").distinct().collect())  # as many as paths have lengths
    host, path = host_and_path(F.col("__url"))
    urls = pages.select(F.coalesce(F.col(url), F.lit("")).alias("__url")).distinct().select("__url", host.alias("host"), path.alias("path"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_compact(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>")
    )
    expressions = (
        urls.select("__url", F.explode(F.array_distinct(suffixes)).alias("__host"), prefixes.alias("__paths"))
        .select("__url", "__host", F.explode("__paths").alias("__path"))
        .select("__url", _digest(F.col("__host"), F.col("__path")).alias("__full"))
    )
    small = rules.withColumn("__short", F.substring("__digest", 1, SHORT)).drop("__rule", "__length")
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        small = F.broadcast(small)
    hits = (
        expressions.withColumn("__short", F.substring("__full", 1, SHORT))
        .join(small, "__short")
        .where(F.col("__full") == F.col("__digest"))
        .groupBy("__url")
        .agg(F.max("__found").alias("__found"))
    )
    judged = urls.join(hits, "__url", "left").select(
        "__url", "host", "path",
        F.col("__found.rule").alias("rule"),
        F.coalesce("__found.verdict", F.lit(default)).alias("verdict"),
    )
    return (
        pages.select(*kept, F.coalesce(F.col(url), F.lit("")).alias("__url"))
        .join(judged, "__url", "left")
        .select(*kept, *added)
    )
