"""K-d tree sharding (operator 6).

The tree is grown level by level.  A node that holds k shards is cut along its
widest metadata dimension at the weighted quantile that gives its left part
floor(k/2) of k shares of the bytes; nodes of one shard have reached the target
bytes.  A value's place in a dimension is the share of all bytes that lie before it,
so that widths of dimensions can be compared.  Quantiles are found by refining
histograms: the driver sees at most ``BINS`` sums a node and round, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeweave.llm.shared import staged

BITS = 10
BINS = 1 << BITS
#: A key is 18 bits of the dimension, 32 of the text's checksum, 10 of the id's hash.
DIM_BITS, ID_BITS, KEY_BITS = 18, 10, 60
ROWS_PER_SLOT_GROUP = 20_000


DIMENSIONS = ("source", "lang", "length")
#: Values of a dimension that are told apart: names by a hash, lengths by a fine logarithm.
VALUES = 1 << 12


def _values(docs: DataFrame, text_bytes: F.Column) -> dict[str, F.Column]:
    """The number, from 0 to VALUES - 1, of a row's value in each dimension; a column that is absent counts as null."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    return {
        "source": F.pmod(F.xxhash64(name("source")), F.lit(VALUES)),
        "lang": F.pmod(F.xxhash64(name("lang")), F.lit(VALUES)),
        "length": F.least(F.lit(VALUES - 1), F.floor(F.log2(text_bytes + 1) * (VALUES / 32))).cast("long"),
    }


def _ranks(meta: DataFrame) -> DataFrame:
    """(value, source, lang, length): the place of each value in each dimension, 18 bits of
    the share of the bytes before it.  VALUES sums a dimension reach the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("d"), F.col(d).alias("value")) for k, d in enumerate(DIMENSIONS)]))
    sums = meta.select("size", pairs.alias("p")).groupBy("p.d", "p.value").agg(F.sum("size").alias("mass")).collect()
    places = [[0] * VALUES for _ in DIMENSIONS]
    for k in range(len(DIMENSIONS)):
        mass = {r["value"]: r["mass"] for r in sums if r["d"] == k}
        whole, before = max(1, sum(mass.values())), 0
        for value in range(VALUES):
            places[k][value] = before * ((1 << DIM_BITS) - 1) // whole
            before += mass.get(value, 0)
    rows = [(v, *(p[v] for p in places)) for v in range(VALUES)]
    return meta.sparkSession.createDataFrame(rows, "value long, " + ", ".join(f"{d} long" for d in DIMENSIONS))


def _pick(values: dict[int, int], node: F.Column) -> F.Column:
    """The literal that belongs to a row's node (shard numbers, 0 and up)."""
    return F.element_at(F.array(*[F.lit(values.get(k, 0)).cast("long") for k in range(max(values) + 1)]), (node + 1).cast("int"))


def _cut_points(rows: DataFrame, targets: dict[int, float]) -> dict[int, int]:
    """For each node the key from which on rows go right; ``rows``: node, key, size."""
    low, below = dict.fromkeys(targets, 0), dict.fromkeys(targets, 0.0)
    open_nodes = set(targets)
    for shift in range(KEY_BITS - BITS, -1, -BITS):
        nodes = [int(n) for n in open_nodes]
        base = _pick(low, F.col("node"))
        span = 1 << (shift + BITS)
        bins = (
            rows.where(F.col("node").isin(nodes) & (F.col("key") >= base) & (F.col("key") < base + F.lit(span)))
            .groupBy("node", F.shiftright(F.col("key") - base, shift).alias("bin"))
            .agg(F.sum("size").alias("mass"), F.count("*").alias("n"))
            .collect()
        )
        for node in nodes:
            own = sorted((r["bin"], r["mass"], r["n"]) for r in bins if r["node"] == node)
            sums, at = below[node], None
            for place, mass, count in own:
                if sums + mass >= targets[node]:
                    at = (place, mass, count)
                    break
                sums += mass
            if at is None:  # no rows left: everything goes left
                low[node] += span
                open_nodes.discard(node)
                continue
            low[node] += at[0] << shift
            below[node] = sums
            if at[2] == 1 or shift == 0:  # the nearer side
                if targets[node] - sums > sums + at[1] - targets[node]:
                    low[node] += 1 << shift
                open_nodes.discard(node)
        if not open_nodes:
            break
    return low


def kd_shards(docs: DataFrame, shards: int = 24, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, size, text_crc32, law, shard, slot, grown_shard), law ``bytes``.

    Size is the UTF-8 bytes of the text plus 8; a null text has none.  Sizes of
    shards are as near as whole documents allow.  Equal texts lie next to each
    other inside a node and are parted only where a quantile falls among them, so
    a group of copies that holds a third of all bytes is split, not one shard.
    For that, copies count with the source and language of their smallest id.  At
    most one group at each cut, so at most shards - 1, is parted, whatever its size.
    ``source`` and ``lang`` may be absent or null.  Slots are gapless in each shard, also with repeated rows and null ids.  An
    empty table gives no rows; further columns are ignored.
    """
    bytes_of = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    meta = staged(
        docs.select(
            F.col(id).cast("long").alias("id"),
            (bytes_of + 8).alias("size"),
            crc.alias("text_crc32"),
            *[c.alias(d) for d, c in _values(docs, bytes_of).items()],
        )
    )
    ranks = _ranks(meta)
    place = lambda d: F.broadcast(ranks.select(F.col("value").alias(d), F.col(d).alias(f"__{d}")))
    tie = F.shiftleft(F.col("text_crc32"), ID_BITS) + F.pmod(F.xxhash64("id"), F.lit(1 << ID_BITS))
    first = meta.groupBy("text_crc32", "size").agg(F.min(F.struct("id", "source", "lang")).alias("first"))
    rows = meta.drop("source", "lang").join(first, ["text_crc32", "size"]).select("id", "size", "text_crc32", "first.source", "first.lang", "length", tie.alias("tie"))
    for d in DIMENSIONS:
        rows = rows.join(place(d), d).drop(d).withColumnRenamed(f"__{d}", d)
    rows = staged(rows.select("id", "size", "text_crc32", *DIMENSIONS, "tie", F.lit(0).cast("long").alias("node")))
    nodes = {0: shards}
    while any(k > 1 for k in nodes.values()):
        spread = rows.groupBy("node").agg(
            F.sum("size").alias("mass"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
        )
        seen = {r["node"]: r for r in spread.collect()}  # one row for each shard at most
        widest = {n: max(range(len(DIMENSIONS)), key=lambda j: seen[n][DIMENSIONS[j]]) if n in seen else 0 for n in nodes}
        key = F.shiftleft(F.element_at(F.array(*DIMENSIONS), (_pick(widest, F.col("node")) + 1).cast("int")), KEY_BITS - DIM_BITS) + F.col("tie")
        rows = rows.withColumn("key", key)
        goals = {n: seen[n]["mass"] * (k // 2) / k for n, k in nodes.items() if k > 1 and n in seen}
        cuts = _cut_points(rows, goals) if goals else {}
        step = {n: k // 2 for n, k in nodes.items() if k > 1}
        right = F.lit(False)
        if cuts:
            right = F.col("node").isin(list(cuts)) & (F.col("key") >= _pick(cuts, F.col("node")))
        rows = rows.withColumn("node", F.when(right, F.col("node") + _pick(step, F.col("node"))).otherwise(F.col("node")))
        rows = staged(rows.drop("key"))  # a level's cuts read the nodes many times
        nodes = {m: s for n, k in nodes.items() for m, s in ([(n, k // 2), (n + k // 2, k - k // 2)] if k > 1 else [(n, k)])}
    return _slots(rows).select(
        F.col("id").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("node").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _slots(rows: DataFrame) -> DataFrame:
    """Gapless numbers in each node: rank in a hashed group plus the groups before."""
    groups = 16 + rows.count() // ROWS_PER_SLOT_GROUP
    rows = staged(rows.withColumn("part", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(groups))))
    before = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("node", "part").agg(F.count("*").alias("n")).select("node", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("node", "part").orderBy("id", "text_crc32", "size"))
    return rows.withColumn("rank", inside).join(starts, ["node", "part"]).withColumn("slot", (F.col("start") + F.col("rank") - 1).cast("long"))
