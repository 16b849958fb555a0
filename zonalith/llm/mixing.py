"""Mixing sources to target weights by systematic sampling.

Each source's target is its share by weight of all sizes, held to `most` times its own size; what is above is reshared by
weight until none is above (the water level is found in closed form with windows over the sources). A document's expected
copies are its source's rate, target / size. Within a source, documents stand in order of size class and seeded hash;
their expected copies are summed along that order, one offset in [0, 1) is added, and a copy is emitted at each integer
crossed. Standing by size makes the words taken come near the target as well as the copies.

Defined results: a null text has size 0; the null source is a source, last; repeated rows each have their own place, ties
falling on rows that cannot be told apart; an empty table gives an empty result; other columns pass through.

Scale: no source is gathered. The prefix sum is in three levels - size class, hash bucket, row - over counts that are
pre-aggregated before they move, and the number of hash buckets follows the rows, so the largest window has about
`cell_rows` rows however hot a source or a size is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from zonalith.llm import words as W
from zonalith.session import reach_workers

WEIGHTS = (5, 2, 1)
CELL_ROWS, LEAST_BUCKETS = 50_000, 64


def with_size(df: DataFrame, text_col: str, keep: list[str], out_col: str) -> DataFrame:
    """The columns `keep` and the number of words of a text, 0 where null. Counted on the bytes, once for each row: as an
    expression the count would be made again wherever the plan refers to it."""
    reach_workers(df.sparkSession)
    own = df.select(F.col(text_col).alias("_text"), *[F.col(c) for c in keep if c != text_col])
    names = [text_col if c == "_text" else c for c in own.columns]
    given = [c for c in names if c in keep]

    def run(batches):
        for batch in batches:
            n = [np.zeros(0, np.int64)]
            for _, _, data, docs in W.slices(batch.column(0)):
                n.append(np.diff(W.find(data, docs, W.SPACED_MASK, hashed=False).of))
            columns = [batch.column(k) for k, c in enumerate(names) if c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(n).astype(np.int64))], names=[*given, out_col])

    fields = [own.schema["_text" if c == text_col else c] for c in given]
    schema = StructType([StructField(c, f.dataType, f.nullable) for c, f in zip(given, fields, strict=True)]).add(out_col, LongType())
    return own.mapInArrow(run, schema).select(*keep, out_col)


def size_class(size: Column) -> Column:
    """Eighths of an octave; sizes below 16 stand alone."""
    bits = F.length(F.bin(size))
    eighth = F.call_function("shiftright", size, (bits - 4).cast("int")) % 8
    return F.when(size < 16, size).otherwise(bits * 8 + eighth).cast("int")


def source_targets(sizes: DataFrame, source: str, size: str, weights: tuple = WEIGHTS, most: int = 3) -> DataFrame:
    """source, source_size, target, rate: one row for each source."""
    by_rank = Window.orderBy(F.col(source).asc_nulls_last())
    whole = Window.partitionBy()
    src = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    src = src.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_rank) - 1) % len(weights) + 1).cast("int")))
    src = src.withColumn("total", F.sum("source_size").over(whole)).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col(source).asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    src = src.withColumn("level", (F.col("total") - below).cast("double") / left)
    src = src.withColumn("level", F.max("level").over(whole))
    src = src.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return src.select(source, "source_size", "target", rate.alias("rate"))


def seeded(text: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text, F.lit("\\N"))).cast("binary"))


def hex_int(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def plan_copies(df: DataFrame, rows: int, id_col: str = "doc_id", source_col: str = "source", size_col: str | None = None, text_col: str = "text", seed: int = 29, most: int = 3, weights: tuple = WEIGHTS) -> DataFrame:
    """df with a struct last, `mix` or the next free name: size, source_size, target, copies. rows: how many df has, which sets the
    hash buckets."""
    inner = [f"c{k}" for k in range(len(df.columns))]
    name = dict(zip(df.columns, inner, strict=True))
    own = df.toDF(*inner)
    source, ident = name[source_col], name[id_col]
    if size_col:
        own, narrow = own.withColumn("size", F.col(name[size_col])), own.select(F.col(name[size_col]).alias("size"), source, ident)
    else:
        own, narrow = with_size(own, name[text_col], inner, "size"), with_size(own, name[text_col], [source, ident], "size")
    buckets = max(LEAST_BUCKETS, -(-rows // CELL_ROWS))
    hashed = seeded(F.col(ident).cast("string"), seed)
    narrow = narrow.select(F.col(source).alias("src"), "size", hashed.alias("h"))
    cell = lambda d: d.withColumn("class", size_class(F.col("size"))).withColumn("bucket", hex_int(F.col("h"), 8) % buckets)
    # A source is matched by (is null, value), so that null is a key like any other.
    keyed = lambda d: d.withColumn("none", F.col("src").isNull()).withColumn("src", F.coalesce("src", F.lit("")))
    targets = keyed(source_targets(narrow, "src", "size", weights, most))
    cells = keyed(cell(narrow)).groupBy("none", "src", "class", "bucket").agg(F.count("*").alias("n"))
    classes = cells.groupBy("none", "src", "class").agg(F.sum("n").alias("m"))
    up_to = Window.partitionBy("none", "src").orderBy("class")
    classes = classes.select("none", "src", "class", (F.sum("m").over(up_to) - F.col("m")).alias("class_at"))
    inside = Window.partitionBy("none", "src", "class").orderBy("bucket")
    cells = cells.withColumn("bucket_at", F.sum("n").over(inside) - F.col("n"))
    cells = cells.join(classes, ["none", "src", "class"]).join(targets, ["none", "src"])
    offset = hex_int(seeded(F.when(~F.col("none"), F.col("src")), seed + 1), 4) / 65536.0
    cells = cells.select("none", "src", "class", "bucket", "source_size", "target", "rate", (F.col("class_at") + F.col("bucket_at")).alias("at"), offset.alias("u"))
    full = keyed(cell(own.withColumn("src", F.col(source)).withColumn("h", hashed)))
    row = F.row_number().over(Window.partitionBy("none", "src", "class", "bucket").orderBy("size", "h", *([F.col(name[text_col]).asc_nulls_first()] if text_col in name else [])))
    full = full.withColumn("row", row).join(cells, ["none", "src", "class", "bucket"])
    place = F.col("at") + F.col("row")
    reach = lambda p: F.floor(p * F.col("rate") + F.col("u"))
    copies = F.least(reach(place) - reach(place - 1), F.lit(most)).cast("long")
    mix = F.struct(F.col("size"), F.col("source_size"), F.col("target"), copies.alias("copies")).alias(W.free("mix", df.columns))
    return full.select(*[F.col(c).alias(n) for n, c in name.items()], mix)


def emit(planned: DataFrame) -> DataFrame:
    """Each row as often as planned."""
    mix = planned.columns[-1]
    copies = F.col(f"`{mix}`.copies")
    return planned.where(copies > 0).withColumn(mix, F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop(mix)
