"""Markers as a tile pyramid (K12): counts of each tile of each zoom, one shuffle a zoom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.session import staged


def tile_of(latitude: Column, longitude: Column, zoom: int) -> tuple[Column, Column]:
    """(x, y) of an equal-degree tile at ``zoom``: 2**zoom columns by 2**zoom rows from west and north."""
    n = 1 << zoom
    cut = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(n - 1)).cast("long")
    return cut((longitude + 180) / 360 * n), cut((90 - latitude) / 180 * n)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """The tile's path from the top: a digit of two bits for each zoom."""
    bit = lambda c, k: F.shiftright(c, zoom - 1 - k).bitwiseAND(F.lit(1))
    return F.concat(*[(bit(x, k) + 2 * bit(y, k)).cast("string") for k in range(zoom)]) if zoom else F.lit("")


def marker_tiles(markers: DataFrame, deepest: int, layer: str = "layer") -> DataFrame:
    """(zoom, tile, layer, n, latitude, longitude, site_id) of the tiles with markers.

    ``markers``: site_id, latitude, longitude and a layer.  Each zoom is made from the one
    below, so all but the first shuffle move tiles instead of markers; the place of a cluster is the mean of
    its markers, ``site_id`` that of its only marker.  Markers without coordinates are left out; a
    null layer is one of its own.
    """
    x, y = tile_of(F.col("latitude"), F.col("longitude"), deepest)
    rows = markers.where("latitude is not null and longitude is not null").select(quadkey(x, y, deepest).alias("tile"), F.col(layer).alias("layer"), F.lit(1).cast("long").alias("n"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "site_id")
    sums = [F.sum("n").alias("n"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"), F.min("site_id").alias("site_id")]
    now, levels = staged(rows.groupBy("tile", "layer").agg(*sums)), []
    for zoom in range(deepest, -1, -1):
        levels.append(now.withColumn("zoom", F.lit(zoom)))
        if zoom:
            now = staged(now.withColumn("tile", F.substring("tile", 1, zoom - 1)).groupBy("tile", "layer").agg(*sums))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("zoom", "tile", "layer", "n", (F.col("lat") / F.col("n")).alias("latitude"), (F.col("lon") / F.col("n")).alias("longitude"), F.when(F.col("n") == 1, F.col("site_id")).alias("site_id"))
