"""Mixing sources to target weights (operator 10), built from DataFrame functions only.

Documents are counted into cells (source, language, topic) of tokens.  Iterative
proportional fitting rakes the cells' token weights until each marginal has its
target shares.  ``calibrated_sample`` then keeps each document once or not, with a
probability in proportion to its cell's weight: the largest ones that stay at one
or below, so nothing that the raking asked for is cut off.  ``mix_sources`` takes a
document as often, in the mean, as its cell's weight asks for: whole copies, and one
more with the probability of the rest.  Draws are hashes of ids.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.llm.shared import discard, staged

DIMENSIONS = ("source", "lang", "topic")
#: Without targets a dimension's shares are in proportion to its observed tokens to this
#: power: sources and languages are evened out, topics are held at what they are.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 1.0}
#: Raking ends when no factor of a round is further from one, or after so many rounds.
TOLERANCE, ROUNDS = 1e-10, 60
#: What a null dimension counts as.
MISSING = "(none)"


def topic(text: F.Column) -> F.Column:
    """A coarse kind of content: table rows, web references, prose or nothing."""
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit("empty"))
        .when(F.contains(text, F.lit(" | ")), F.lit("table"))
        .when(F.contains(text, F.lit("://")) | F.contains(text, F.lit("@")), F.lit("web"))
        .otherwise(F.lit("prose"))
    )


def token_estimate(text: F.Column) -> F.Column:
    """A quarter of the UTF-8 bytes, rounded up, and one for the end of the text."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("long") + 1


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares (value, share) in proportion to the observed tokens ** power."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("t"))
    whole = sums.agg(F.sum("t")).first()[0] or 1.0  # one number
    return sums.select("value", (F.col("t") / whole).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``weight``: tokens raked to the targets.

    Targets are DataFrames (value, share) for each dimension; values without a
    target get no weight.  A round is one pass over each dimension, a window over the
    cells, which are a summary of the corpus.  After each two rounds they are staged,
    so plans stay small, and the largest change is read.  Where no weights meet all
    targets, the last dimension's are met; raking that has not settled after ``rounds`` warns.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)  # one number
    shares = {d: f"__share_{k}" for k, d in enumerate(targets)}
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dimension, target in targets.items():
        now = now.join(target.select(F.col("value").alias(dimension), F.col("share").alias(shares[dimension])), dimension, "left")
    now = staged(now.fillna(0.0, list(shares.values())))
    done, change = 0, 0.0
    while done < rounds:
        step, last = now.withColumn("__moved", F.lit(0.0)), now
        for _ in range(min(2, rounds - done)):
            for dimension, share in shares.items():
                whole = F.sum("weight").over(Window.partitionBy(dimension))
                factor = F.when(whole > 0, F.col(share) * total / whole).otherwise(0.0)
                moved = F.greatest("__moved", F.when(F.col("weight") > 0, F.abs(F.col("__factor") - 1)).otherwise(0.0))
                step = step.withColumn("__factor", factor).withColumns({"__moved": moved, "weight": F.col("weight") * F.col("__factor")})
            done += 1
        step = staged(step.drop("__factor"))
        discard(last)
        now = step.drop("__moved")
        now.staged_path = step.staged_path
        change = step.agg(F.max("__moved")).first()[0] or 0.0  # one number
        if change <= tolerance:
            break
    else:
        warnings.warn(f"raking ended after {rounds} rounds while weights still changed by a factor of {1 + change:.6g}", stacklevel=2)
    return now.drop(*shares.values())


def _placed(docs: DataFrame, kept: list[str], text: str, topic_of: F.Column | None, tokens_of: F.Column | None) -> tuple[DataFrame, list[str]]:
    """``kept`` columns, topic and n_tokens, and the three dimensions under names of their own."""
    keys = [f"__{d}" for d in DIMENSIONS]
    found = docs.select(
        *kept,
        (topic(F.col(text)) if topic_of is None else topic_of).alias("topic"),
        (token_estimate(F.col(text)) if tokens_of is None else tokens_of).alias("n_tokens"),
        *[F.coalesce(F.col(d).cast("string"), F.lit(MISSING)).alias(k) for d, k in zip(DIMENSIONS[:2], keys[:2], strict=True)],
    )
    return found.withColumn(keys[2], F.coalesce(F.col("topic").cast("string"), F.lit(MISSING))), keys


def _draw(id: str, seed: int) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0


def calibrated_sample(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    targets: dict[str, DataFrame] | None = None,
    keep: float = 0.8,
    seed: int = 17,
    topic_of: F.Column | None = None,
    tokens_of: F.Column | None = None,
) -> DataFrame:
    """All rows of ``docs`` with topic, n_tokens, weight, probability and kept added.

    ``weight`` is the raked over the observed token mass of the document's cell,
    ``probability`` = weight * min(keep, 1 / the largest weight of a cell): expected
    tokens of each value of each dimension are in proportion to its target.  A
    document is kept where the hash of seed and id is below it.  ``targets`` has
    DataFrames (value, share) for each of DIMENSIONS; a value without one is never
    kept; without ``targets`` shares follow POWERS.  ``topic_of`` and ``tokens_of``
    are columns that replace the estimates.  A null source, language or topic is the
    value MISSING, an empty or null text has the topic ``empty`` and one token; rows
    of one id of one cell are kept together; columns of ``docs`` named like an added
    one are replaced.  An empty table gives no rows.
    """
    added = ("topic", "n_tokens", "weight", "probability", "kept")
    kept = [c for c in docs.columns if c not in added]
    placed, keys = _placed(docs, kept, text, topic_of, tokens_of)
    cells = staged(placed.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")))
    goals = _goals(cells, keys, targets)
    raked = staged(rake(cells, goals).select(*keys, (F.col("weight") / F.col("tokens")).alias("weight")))
    largest = raked.agg(F.max("weight")).first()[0] or 0.0  # one number
    scale = min(keep, 1 / largest) if largest > 0 else keep
    return (
        placed.join(raked, keys, "left")
        .withColumn("probability", F.least(F.lit(1.0), scale * F.col("weight")))  # a rounding error above one
        .withColumn("kept", _draw(id, seed) < F.col("probability"))
        .select(*kept, *added)
    )


def _goals(cells: DataFrame, keys: list[str], targets: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    if targets:
        return {k: targets[d] for d, k in zip(DIMENSIONS, keys, strict=True)}
    return {k: staged(tempered(cells, k, POWERS[d])) for d, k in zip(DIMENSIONS, keys, strict=True)}


def shares(mixed: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(dimension, value, target, expected, achieved): shares of tokens in the result of
    ``calibrated_sample``, from its probabilities and from what it kept."""
    tokens = F.col("n_tokens")
    names = [F.coalesce(F.col(d).cast("string"), F.lit(MISSING)).alias(d) for d in DIMENSIONS]
    cells = staged(
        mixed.groupBy(*names).agg(
            F.sum(tokens).alias("tokens"), F.sum(tokens * F.col("probability")).alias("expected"), F.sum(F.when(F.col("kept"), tokens).otherwise(0)).alias("achieved")
        )
    )
    goals = _goals(cells, list(DIMENSIONS), targets)
    whole = cells.agg(F.sum("expected"), F.sum("achieved")).first()  # two numbers
    parts = [
        cells.groupBy(F.col(d).alias("value")).agg(F.sum("expected").alias("e"), F.sum("achieved").alias("a"))
        .join(goals[d], "value", "left")
        .select(F.lit(d).alias("dimension"), "value", F.coalesce("share", F.lit(0.0)).alias("target"), (F.col("e") / (whole[0] or 1.0)).alias("expected"), (F.col("a") / (whole[1] or 1)).alias("achieved"))
        for d in DIMENSIONS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def mix_sources(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.7,
    keep: float = 0.8,
    rounds: int = ROUNDS,
    seed: int = 17,
) -> DataFrame:
    """All rows of ``docs`` with topic, n_tokens, weight, probability, kept and copies added.

    ``weight`` is the raked over the observed token mass of the document's cell;
    ``copies`` is keep * weight rounded up or down, up where the hash of seed and id
    falls below its fraction, so that each cell's expected tokens are keep times its
    raked ones.  ``probability`` = min(1, keep * weight) is that of a copy or more,
    ``kept`` whether there is one: where weights exceed 1 / keep, rows that are kept
    reach the targets only when taken ``copies`` times (see ``sampled``).  Rows of
    one id of one cell have the same number of copies.  Without
    ``targets`` the marginals are tempered by ``power``.  A null source or
    language is a value of its own, an empty or null text has the topic
    ``empty`` and one token; columns of ``docs`` named like an added one are
    replaced.  An empty table gives no rows.
    """
    added = ("topic", "n_tokens", "weight", "probability", "kept", "copies")
    kept = [c for c in docs.columns if c not in added]
    placed, keys = _placed(docs, kept, text, None, None)
    cells = staged(placed.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")))
    goals = {k: targets[d] if targets else staged(tempered(cells, k, power)) for d, k in zip(DIMENSIONS, keys, strict=True)}
    raked = rake(cells, goals, rounds).select(*keys, (F.col("weight") / F.col("tokens")).alias("weight"))
    draw = _draw(id, seed)
    whole = F.floor(keep * F.col("weight"))
    return (
        placed.join(raked, keys, "left")
        .withColumn("probability", F.least(F.lit(1.0), keep * F.col("weight")))
        .withColumn("kept", draw < F.col("probability"))
        .withColumn("copies", whole + (draw < keep * F.col("weight") - whole).cast("long"))
        .select(*kept, *added)
    )


def sampled(mixed: DataFrame) -> DataFrame:
    """A row, numbered by ``copy`` from 1 on, for each copy of the rows of ``mix_sources``."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
