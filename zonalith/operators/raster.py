"""Raster tiles as rows: windowed reads, block subsets, regridding, images.

A tile row holds (scene_id, band, row0, col0, h, w, data): float32 values row by row. Parcels meet tiles by an equi-join on
the tile's place in a fixed grid, so one scan of a scene serves every parcel.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from zonalith.functions.geo import ramp_color
from zonalith.session import reach_workers

TILE = "scene_id string, band string, row0 long, col0 long, h int, w int, data binary"


def cells_of(tiles: DataFrame) -> DataFrame:
    """SRC8: (scene_id, band, row, col, value) of every finite cell; bounds on row0 and col0 reach the scan as filters."""
    reach_workers(tiles.sparkSession)

    def run(batches):
        for batch in batches:
            for t in batch.to_pylist():
                v = np.frombuffer(t["data"], "<f4").reshape(t["h"], t["w"])
                i, j = np.nonzero(np.isfinite(v))
                yield pa.RecordBatch.from_pydict({"scene_id": [t["scene_id"]] * len(i), "band": [t["band"]] * len(i), "row": i + t["row0"], "col": j + t["col0"], "value": v[i, j]})

    return tiles.mapInArrow(run, "scene_id string, band string, row long, col long, value float")


def window(tiles: DataFrame, row0: int, col0: int, row1: int, col1: int) -> DataFrame:
    """SRC9: the cells of a block, tiles that miss it pruned before they are decoded."""
    near = (F.col("row0") < row1) & (F.col("row0") + F.col("h") > row0) & (F.col("col0") < col1) & (F.col("col0") + F.col("w") > col0)
    return cells_of(tiles.where(near)).where(F.col("row").between(row0, row1 - 1) & F.col("col").between(col0, col1 - 1))


def block_subset(cells: DataFrame, parcels: DataFrame, tile: int) -> DataFrame:
    """SRC10: each parcel's cells of a block. parcels: land_id, r0, c0, r1, c1 (ends open); matched by tile of `tile` cells a side."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / tile), F.floor((F.col(b) - 1) / tile))
    p = parcels.withColumn("tr", F.explode(span("r0", "r1"))).withColumn("tc", F.explode(span("c0", "c1")))
    c = cells.withColumn("tr", F.floor(F.col("row") / tile)).withColumn("tc", F.floor(F.col("col") / tile))
    inside = (F.col("row") >= F.col("r0")) & (F.col("row") < F.col("r1")) & (F.col("col") >= F.col("c0")) & (F.col("col") < F.col("c1"))
    return c.join(p, ["tr", "tc"]).where(inside).drop("tr", "tc", "r0", "c0", "r1", "c1")


def regrid_nearest(cells: DataFrame, factor: int = 2) -> DataFrame:
    """GE6 for classes: every coarse cell becomes factor x factor fine ones."""
    step = F.explode(F.sequence(F.lit(0), F.lit(factor * factor - 1)))
    d = cells.withColumn("s", step)
    return d.withColumn("row", F.col("row") * factor + F.floor(F.col("s") / factor)).withColumn("col", F.col("col") * factor + F.col("s") % factor).drop("s")


def regrid_bilinear(cells: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """GE6 for bands, 2:1: weights of the four nearest coarse centres, over those that are there."""
    offsets = [(dr, dc) for dr in (-1, 0, 1, 2) for dc in (-1, 0, 1, 2)]
    weight = {-1: 0.25, 0: 0.75, 1: 0.75, 2: 0.25}
    items = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(weight[dr] * weight[dc]).alias("share")) for dr, dc in offsets])
    d = cells.where(F.col(value).isNotNull()).withColumn("_o", F.explode(items))
    own = F.col("_o.dr").between(0, 1) & F.col("_o.dc").between(0, 1)
    d = d.select(*keys, (F.col("row") * 2 + F.col("_o.dr")).alias("row"), (F.col("col") * 2 + F.col("_o.dc")).alias("col"), F.col(value).alias("_v"), F.col("_o.share").alias("_share"), own.alias("_own"))
    out = d.groupBy(*keys, "row", "col").agg((F.sum(F.col("_v") * F.col("_share")) / F.sum("_share")).alias(value), F.max("_own").alias("_own"))
    return out.where("_own").drop("_own")


def png(rgba: np.ndarray) -> bytes:
    """An RGBA array as PNG."""
    h, w = rgba.shape[:2]
    raw = b"".join(b"\0" + rgba[i].astype(np.uint8).tobytes() for i in range(h))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def render(cells: DataFrame, keys: list[str], color: Column | None = None, value: str = "value") -> DataFrame:
    """GE14, SNK8: an image of each group's cells, transparent where none stands; colours are made in SQL, the file in Python."""
    reach_workers(cells.sparkSession)
    c = color if color is not None else ramp_color(F.col(value))
    own = cells.where(F.col(value).isNotNull()).select(*keys, "row", "col", c.alias("c")).select(*keys, "row", "col", "c.*")

    def run(table: pa.Table) -> pa.Table:
        r, k = table.column("row").to_numpy(), table.column("col").to_numpy()
        img = np.zeros((int(r.max() - r.min()) + 1, int(k.max() - k.min()) + 1, 4), np.uint8)
        for n, name in enumerate("rgb"):
            img[r - r.min(), k - k.min(), n] = table.column(name).to_numpy()
        img[r - r.min(), k - k.min(), 3] = 255
        return pa.table({**{x: table.column(x).slice(0, 1) for x in keys}, "width": pa.array([img.shape[1]], pa.int32()), "height": pa.array([img.shape[0]], pa.int32()), "png": pa.array([png(img)], pa.binary())})

    from pyspark.sql.types import BinaryType, IntegerType, StructType

    schema = StructType([own.schema[x] for x in keys]).add("width", IntegerType()).add("height", IntegerType()).add("png", BinaryType())
    return own.groupBy(*keys).applyInArrow(run, schema)
