"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly, equal texts together.

Groups of equal texts are the items. Groups above ``1 / FINE`` of a shard in any dimension are listed singly:
their number is at most ``3 * shards * FINE``, whatever the table holds. All others fall by hash into
``shards * CELLS`` cells, which bounds what the driver packs. A group larger than a shard is split by its keys.
Items go, largest first, to the shard whose residual capacity has the highest dot product with them.

A null text counts as empty. Rows with equal keys get slots of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.session import pin

FINE = 32
CELLS = 512
SLOT_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item; a row of ``items`` holds its bytes, tokens and rows."""
    total = np.maximum(items.sum(axis=0), 1)
    share = items / total * shards
    free = np.ones((shards, items.shape[1]))
    out = np.empty(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.sum(axis=1))):
        out[i] = best = int(np.argmax(free @ share[i]))
        free[best] -= share[i]
    return out


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = pin(
        docs.select(
            F.col(key).alias("key"), (F.octet_length(body) + 8).cast("long").alias("size"),
            F.regexp_count(body, F.lit(WORD)).cast("long").alias("tokens"), F.crc32(body).alias("text_crc32"),
            F.md5(body).alias("g"),
        ),
        "shard-rows",
    )
    cell = F.pmod(F.xxhash64("g"), F.lit(shards * CELLS))
    vector = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n")]
    groups = pin(rows.groupBy("g").agg(*vector), "shard-groups")
    total = groups.agg(F.sum("b").alias("b"), F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    capacity = {d: (total[d] or 0) / shards for d in "btn"}
    load = F.greatest(*[F.col(d) / max(capacity[d], 1e-9) for d in "btn"])
    large = groups.withColumn("load", load).where(F.col("load") > 1 / FINE)
    # at most 3 * shards * FINE rows: each takes 1 / FINE of a shard in one of three dimensions
    parts = large.select("g", F.when(F.col("load") > 1, F.ceil(F.col("load") * 8)).otherwise(1).cast("long").alias("parts"))
    tagged = rows.join(F.broadcast(parts), "g", "left").withColumn(
        "unit",
        F.when(F.col("parts").isNull(), F.concat(F.lit("cell "), cell.cast("string")))
        .otherwise(F.concat_ws(" ", "g", F.pmod(F.xxhash64("key"), F.col("parts")).cast("string"))),
    )
    units = tagged.groupBy("unit").agg(*vector).orderBy("unit").collect()  # bounded by cells and large groups
    packed = place(np.array([[u.b, u.t, u.n] for u in units], float).reshape(-1, 3), shards)
    spark = docs.sparkSession
    table = spark.createDataFrame([(u.unit, int(s)) for u, s in zip(units, packed, strict=True)], "unit string, shard int")
    subs = max(8, -(-(total["n"] or 0) // (shards * SLOT_ROWS)))
    placed = tagged.join(F.broadcast(table), "unit").withColumn("sub", F.pmod(F.xxhash64("key"), F.lit(subs)))
    # slots: a running total over the few (shard, sub) counts, then the rank within each of them
    counts = placed.groupBy("shard", "sub").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "sub", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("key", "text_crc32", "size"))
    return placed.withColumn("rank", rank).join(offsets, ["shard", "sub"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
