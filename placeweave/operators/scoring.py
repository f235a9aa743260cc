"""Confidence scores and the review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.functions.scores import (
    best_description, completeness_score, composite_score, name_specificity, nomination_score, review_priority,
    review_status, richness_score, source_agreement, word_count,
)


def factor_scores(sites: DataFrame, criteria: DataFrame, areas: DataFrame, periods: DataFrame, categories: DataFrame) -> DataFrame:
    """``sites`` with the eight factors.

    What the side tables say of a site is aggregated before the joins, so each
    join adds one small row a site.
    """
    said = None
    for name, df, weight in (("criteria", criteria, 0.4), ("areas", areas, 0.35), ("periods", periods, 0.25)):
        part = df.select("site_id", F.lit(weight).alias("w"), F.lit(name).alias("part"))
        said = part if said is None else said.unionByName(part)
    official = said.groupBy("site_id").agg(
        *[F.max(F.when(F.col("part") == p, F.col("w"))).alias(f"__{p}") for p in ("criteria", "areas", "periods")]
    )
    spread = categories.groupBy("site_id").agg(
        F.avg("confidence").alias("__mean"), F.stddev_samp("confidence").alias("__dev"), F.count("confidence").alias("__n")
    )
    zero = F.lit(0.0)
    words = word_count(best_description(F.col("full_description"), F.col("short_description")))
    return (
        sites.join(official, "site_id", "left")
        .join(spread, "site_id", "left")
        .withColumns(
            {
                "data_completeness": completeness_score(),
                "description_richness": richness_score(words),
                "official_data": F.coalesce("__criteria", zero) + F.coalesce("__areas", zero) + F.coalesce("__periods", zero),
                "nomination_extraction": nomination_score(F.col("source_nomination"), F.col("full_description")),
                "ai_confidence": F.coalesce("__mean", zero),
                "classification_ambiguity": F.when(F.coalesce("__n", F.lit(0)) < 2, 0.5).otherwise(1 - F.least(F.lit(1.0), F.col("__dev"))),
                "source_agreement": source_agreement(),
                "name_specificity": name_specificity(F.col("name")),
            }
        )
        .drop("__criteria", "__areas", "__periods", "__mean", "__dev", "__n")
    )


def scored(factors: DataFrame, preserve_manual: bool = False) -> DataFrame:
    """Composite score, status and priority; approved and flagged sites are judged anew
    unless ``preserve_manual``."""
    out = factors.withColumn("confidence_score", composite_score())
    status = review_status(F.col("confidence_score"))
    if preserve_manual:
        status = F.when(F.col("review_status").isin("approved", "flagged"), F.col("review_status")).otherwise(status)
    return out.withColumns({"review_status": status, "review_priority": review_priority(F.col("confidence_score"))})


def review_queue(sites: DataFrame, limit: int | None = None) -> DataFrame:
    """Flagged sites, the most urgent first."""
    queue = sites.where(F.col("review_status") == "flagged").orderBy("review_priority", "confidence_score", "site_id")
    return queue.limit(limit) if limit else queue


def apply_actions(sites: DataFrame, actions: DataFrame) -> DataFrame:
    """Review actions (site_id, action, notes, fields, priority, at) take effect in order.

    ``approve`` sets the status and notes, ``flag`` status, notes and priority (1 if none
    is given), ``edit`` puts the given fields (a map of column names to text) and marks the
    site manual.  Each action is a map of the columns that it writes; of each column the
    last write counts, so an edit before an approval stays.  Empty notes of an approval
    write nothing, those of a flag and a null value of an edited field write a null.
    Actions of one time count in the order of their content; unknown ones and fields
    that are no column of ``sites`` do nothing.
    """
    kinds = dict(sites.dtypes)
    act, text = F.col("action"), lambda c: c.cast("string")
    notes = F.col("notes")
    priority = F.coalesce(text(F.col("priority")), F.lit("1")) if "priority" in actions.columns else F.lit("1")
    none = F.lit(None).cast("map<string,string>")
    approve = F.map_concat(F.create_map(F.lit("review_status"), F.lit("approved")), F.when(F.length(notes) > 0, F.create_map(F.lit("reviewer_notes"), notes)).otherwise(F.from_json(F.lit("{}"), "map<string,string>")))
    flag = F.create_map(F.lit("review_status"), F.lit("flagged"), F.lit("reviewer_notes"), notes, F.lit("review_priority"), priority)
    edited = F.map_filter(F.coalesce("fields", F.from_json(F.lit("{}"), "map<string,string>")), lambda k, v: k != "primary_source")
    writes = F.when(act == "approve", approve).when(act == "flag", flag).when(act == "edit", F.map_concat(edited, F.create_map(F.lit("primary_source"), F.lit("manual")))).otherwise(none)
    log = actions.select("site_id", F.struct("at", "action", F.coalesce(notes, F.lit("")).alias("n")).alias("order"), F.explode(writes).alias("column", "value"))
    written = log.where(F.col("column").isin(*[c for c in sites.columns if c != "site_id"])).groupBy("site_id", "column").agg(F.max(F.struct("order", "value")).getField("value").alias("value"))
    puts = written.groupBy("site_id").agg(F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("__put"))  # at most one entry a column
    put = lambda c: F.try_element_at("__put", F.lit(c)).try_cast(kinds[c])
    told = lambda c: F.coalesce(F.map_contains_key("__put", F.lit(c)), F.lit(False))
    out = sites.join(puts, "site_id", "left")
    simple = [c for c in sites.columns if c != "site_id" and not kinds[c].startswith(("array", "map", "struct"))]
    return out.withColumns({c: F.when(told(c), put(c)).otherwise(F.col(c)) for c in simple}).select(*sites.columns)
