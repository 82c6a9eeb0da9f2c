"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows with equal texts form a group and stay together. Groups are placed in
decreasing order, each on the shard where the dot product of its size vector
with the shard's residual capacity is highest. To place billions of groups,
only the heavy ones (more than ``1 / heavy_share`` of a shard in some
dimension, a number bounded by the parameters) are placed one by one; the
rest meet in a fixed number of hashed bundles, each placed as one item. A
group larger than a whole shard is cut into pieces by a hash of the number
that each of its rows got when the sizes were written: it cannot be whole in
balanced shards, and neither null nor repeated ids keep it together.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from huddlekit.llm.common import cut

DIMS = ("size", "tokens", "rows")


def place(items: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item (row: bytes, tokens, rows), by highest dot product
    with the residual capacity among shards the item fits in (all shards,
    when it fits in none). Ties go to the lower shard."""
    total = items.sum(axis=0)
    share = items / np.where(total > 0, total / n_shards, 1.0)
    order = np.lexsort((np.arange(len(items)), -share.max(axis=1)))
    residual = np.ones((n_shards, items.shape[1]))
    out = np.zeros(len(items), np.int32)
    for k in order:
        score = residual @ share[k]
        fits = (residual >= share[k] - 1e-12).all(axis=1)
        if fits.any():
            score = np.where(fits, score, -np.inf)
        else:  # over capacity somewhere: keep the fullest dimension as low as possible
            score = (residual - share[k]).min(axis=1)
        best = int(np.argmax(score))
        out[k] = best
        residual[best] -= share[k]
    return out


def text_sizes(text: Column) -> list[Column]:
    words = F.size(F.split(F.trim(text), r"[ \t-\r]+")).cast("long")
    return [(F.octet_length(text) + 1).cast("long").alias("size"), words.alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("group_key")]


def pack_shards(docs: DataFrame, n_shards: int = 16, *, heavy_share: int = 200, n_bundles: int = 8192,
                slot_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, tokens, shard, slot`` of every row.

    A null text counts as empty (size 1) and groups with empty texts. Rows
    with null ids and repeated rows are placed like any other; slots are
    gapless from 0 per shard, in order of (hash bucket, id, checksum). A text
    is never cut: one that is larger than a shard's worth makes its shard that
    much larger. An empty table gives an empty result. Other columns are not
    read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the row number is written, so every later use sees the same one
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_sizes(text),
                           F.monotonically_increasing_id().alias("row")), "sizes")
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"),
                                           F.count(F.lit(1)).alias("rows"))
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS]).first()
    capacity = {d: max(total[d], 1) / n_shards for d in DIMS}
    largest = F.greatest(*[F.col(d) / F.lit(capacity[d]) for d in DIMS])
    heavy = groups.withColumn("share", largest).filter(F.col("share") > 1.0 / heavy_share)
    # at most 3 * n_shards * heavy_share groups can be heavy
    heavy_rows = heavy.select(F.hex("group_key").alias("key"), *DIMS, "share").collect()
    bundle = F.pmod(F.xxhash64("group_key"), F.lit(n_bundles)).cast("int")
    bundles = (groups.filter(largest <= 1.0 / heavy_share).groupBy(bundle.alias("bundle"))
               .agg(*[F.sum(d).alias(d) for d in DIMS]).collect())

    names: list[tuple[str | None, int, int]] = []
    sizes: list[list[float]] = []
    pieces_of: dict[str, int] = {}
    for r in sorted(heavy_rows, key=lambda r: r["key"]):
        # rows are whole: a group that is one row cannot be cut
        pieces_of[r["key"]] = min(int(r["rows"]), 8 * int(np.ceil(r["share"]))) if r["share"] > 1 else 1
        if pieces_of[r["key"]] == 1:
            names.append((r["key"], 0, 0))
            sizes.append([float(r[d]) for d in DIMS])
    many = spark.createDataFrame([(bytearray.fromhex(k), n) for k, n in pieces_of.items()],
                                 "group_key binary, pieces int")
    piece = F.pmod(F.xxhash64("row", F.lit(7)), F.coalesce("pieces", F.lit(1))).cast("int").alias("piece")
    if max(pieces_of.values(), default=1) > 1:      # at most 8 pieces for each shard's worth
        cut_groups = (rows.join(F.broadcast(many.filter("pieces > 1")), "group_key")
                      .groupBy(F.hex("group_key").alias("key"), piece)
                      .agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")))
        for r in sorted(cut_groups.collect(), key=lambda r: (r["key"], r["piece"])):
            names.append((r["key"], r["piece"], 0))
            sizes.append([float(r[d]) for d in DIMS])
    for r in sorted(bundles, key=lambda r: r["bundle"]):
        names.append((None, 0, r["bundle"]))
        sizes.append([float(r[d]) for d in DIMS])
    shards = place(np.array(sizes, float).reshape(-1, len(DIMS)), n_shards)

    heavy_to = spark.createDataFrame([(bytearray.fromhex(k), p, int(s))
                                      for (k, p, _), s in zip(names, shards) if k is not None],
                                     "group_key binary, piece int, heavy_shard int")
    bundle_to = spark.createDataFrame([(b, int(s)) for (k, _, b), s in zip(names, shards) if k is None],
                                      "bundle int, bundle_shard int")
    placed = (rows.join(F.broadcast(many), "group_key", "left").withColumn("piece", piece)   # bounded: see above
              .join(F.broadcast(heavy_to), ["group_key", "piece"], "left")
              .withColumn("bundle", bundle).join(F.broadcast(bundle_to), "bundle", "left")
              .select("doc_id", "size", "text_crc32", "tokens", "row",
                      F.coalesce("heavy_shard", "bundle_shard").alias("shard")))
    return number_slots(placed, max(1, -(-int(total["rows"]) // (n_shards * slot_rows))))


def number_slots(placed: DataFrame, buckets: int) -> DataFrame:
    """Gapless slot numbers per shard without sorting a shard in one task:
    rows are numbered within (shard, hash bucket) and shifted by the counts
    of the buckets before."""
    bucket = F.pmod(F.xxhash64("row", F.lit(11)), F.lit(buckets))
    rows = placed.withColumn("bucket", bucket)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size", "row")
    return (rows.withColumn("n", F.row_number().over(inside)).join(starts, ["shard", "bucket"])
            .withColumn("slot", (F.col("start") + F.col("n") - 1).cast("long"))
            .drop("bucket", "n", "start", "row"))
