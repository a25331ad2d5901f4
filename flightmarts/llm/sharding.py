"""Sharding along a Hilbert curve over several metadata dimensions.

Each row's metadata is quantised to a cell of a cube of 2**BITS per side: language,
source and the logarithm of the text size. Rows are ordered by the cell's
index on the Hilbert curve, then by text checksum and id, and the order is cut into
shards whose row counts differ by one at most (law ``rows``). Neighbours on the
curve are neighbours in every dimension, so a shard spans a small box of the cube
and ``shard_bounds`` lets a reader skip shards by any of the dimensions.

Categories are quantised in the order of a hash, which needs no dictionary; the
size is quantised by its logarithm, so no statistic has to be collected.

At scale: one range exchange on (curve index, checksum, id), which splits a cell
that holds a third of all rows as the id is part of the key; the counts of
the partitions (a few rows) give each row its place, so nothing is ranked in one task.

Defined results: null text counts as empty (size 8, checksum 0); null language or
source are cells of their own; repeated rows keep all copies; an empty table gives
no rows; a result column replaces an input column of its name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

BITS = 7


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of points (rows) with integer coordinates below 2**bits.

    The transposed index is built from the top bit down: at each bit the lower bits
    of the axes are reflected or exchanged with the first axis, then Gray-decoded.
    """
    x = [coords[:, i].astype(np.int64) for i in range(coords.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << 1) | (((axis ^ flip) >> b) & 1)
    return out


def _category(col: str) -> Column:
    """Cell of a category: 0 for null, otherwise 1 .. 2**BITS - 1 by its hash."""
    cells = (1 << BITS) - 1
    return F.when(F.col(col).isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(F.col(col).cast("string")), F.lit(cells))).cast("int")


def _log_size(size: Column) -> Column:
    """Four cells per doubling of the size, so 2**BITS cells reach 2**32 bytes."""
    return F.least(F.floor(F.log2(size) * 4), F.lit((1 << BITS) - 1)).cast("int")


def hilbert_shards(df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text",
                   categories: tuple[str, ...] = ("lang", "source"), carry: bool = False) -> DataFrame:
    """doc_id, the dimensions, size, text_crc32, curve, shard, slot; with ``carry`` also
    ``row``, the whole input row."""
    ship(df.sparkSession)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8

    @F.pandas_udf("long")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), BITS))

    rows = df.select(
        F.col(doc_id).alias("doc_id"), *[F.col(c).alias(f"dim_{i}") for i, c in enumerate(categories)],
        size.alias("size"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        *([F.struct(*[df[c] for c in df.columns]).alias("row")] if carry else []),
    )
    cells = F.struct(*[_category(f"dim_{i}").alias(f"c{i}") for i in range(len(categories))], _log_size(F.col("size")).alias("size"))
    rows = materialize(rows.withColumn("curve", curve(cells)), "hilbert-rows")  # the range exchange samples it again
    order = ["curve", "text_crc32", "doc_id"]
    # place = partition << 33 | row in the partition, fixed by writing it once
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()),
        "hilbert-order",
    ).withColumn("part", F.shiftright("place", 33))
    # one row per partition: the rank at which each partition starts
    starts, total = [], 0
    for row in placed.groupBy("part").count().orderBy("part").collect():
        starts.append((row["part"], total))
        total += row["count"]
    starts = df.sparkSession.createDataFrame(starts, "part long, start long")
    n = max(total, 1)
    return (
        placed.join(F.broadcast(starts), "part")
        .withColumn("rank", F.expr(f"start + (place & {(1 << 33) - 1})"))
        .withColumn("shard", F.expr(f"cast(rank * {shards}L div {n}L as int)"))
        # the shard's first rank is the smallest r with r * shards >= shard * n
        .withColumn("slot", F.expr(f"rank - (shard * {n}L + {shards - 1}L) div {shards}L"))
        .drop("part", "place", "start", "rank")
    )


def shard_bounds(sharded: DataFrame) -> DataFrame:
    """Smallest and largest value of every dimension in each shard, for file pruning."""
    dims = [c for c in sharded.columns if c.startswith("dim_")] + ["size"]
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"),
        *[f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))],
    )


def write_shards(df: DataFrame, shards: int, path: str, doc_id: str = "doc_id", text: str = "text",
                 categories: tuple[str, ...] = ("lang", "source")) -> None:
    """Write every row of ``df`` once, as one folder per shard, in slot order.

    The row itself travels with its place, so repeated and null ids lose nothing; ``shard``
    and ``slot`` replace columns of those names."""
    placed = hilbert_shards(df, shards, doc_id, text, categories, carry=True)
    rows = placed.select(*[F.col("row")[c].alias(c) for c in df.columns if c not in ("shard", "slot")], "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
