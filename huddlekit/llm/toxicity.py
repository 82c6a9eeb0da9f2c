"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

Features are the presence of hashed words, word stems, adjacent word pairs
and pairs that skip one word. Training keeps, per coordinate, the FTRL state
(z, n): each coordinate has its own learning rate and L1 sets most weights to
exactly zero, so the model that is sent to the scoring tasks is a short list
of (index, weight).

The classifier is fitted on all labelled rows (one row per id), dealt into
shards whose number grows with theirs; in each round every shard runs FTRL
passes from the common state, and the changes are averaged per coordinate by a
Spark aggregation. Rows of the
smaller class take several turns in a pass, so that both classes have about as
many whatever their numbers; a weight in the gradient would also
slow the per-coordinate rates. Every text is scored whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import WordHash, batch_bytes, blobs, cut, map_batches, mix

BITS = 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.1
LEAST_ROWS = 3      # features of fewer rows of a shard are not learned
SHARD_ROWS = 2500   # labelled rows of a shard, about
TASK_SHARDS = 4     # shards that a task runs one after another, about
PACK_ROWS = 500     # rows whose features are handed over at a time
LEARN_BYTES = 8 << 20   # of features handed to a learning task at a time
ID_BUCKETS = 1 << 20    # of the filter that keeps unlabelled texts from being shuffled
# bytes that are letters or digits, lower-cased; the rest become blanks
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


class Features:
    """Hashed feature indices of a text."""

    def __init__(self) -> None:
        self.words, self.stems = WordHash(), StemHash()

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(_CLEAN).split()
        if not words:
            return np.empty(0, np.int64)
        h = self.words.array(words)
        parts = [h, self.stems.array(words), mix(h[:-1], h[1:]), mix(h[:-2], h[2:] + np.uint64(1))]
        x = np.concatenate(parts) * np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(64 - BITS)).astype(np.int64)


class StemHash(WordHash):
    """Hash of a word's first five bytes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        import xxhash
        h = self[word] = xxhash.xxh3_64_intdigest(word[:5], 5)
        return h


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def ftrl_passes(texts: list[bytes], labels: np.ndarray, z: np.ndarray, n: np.ndarray, passes: int,
                turns: np.ndarray | None = None) -> None:
    """Passes over the rows, updating the state in place; ``turns`` gives the
    rows of a pass in order (default: each once)."""
    features = Features()
    ftrl_rows([np.unique(features(t)).astype(np.int32) for t in texts], labels, z, n, passes, turns)


def ftrl_rows(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, passes: int,
              turns: np.ndarray | None = None) -> None:
    """``ftrl_passes`` over rows of distinct feature indices. Only the learned
    coordinates are held while it runs, with the roots of ``n``."""
    bias = 1 << BITS
    held = np.zeros(bias + 1, np.int32)
    for r in rows:
        held[r] += 1
    learned = held >= LEAST_ROWS
    learned[bias] = True
    used = np.flatnonzero(learned)
    place = np.zeros(bias + 1, np.int32)
    place[used] = np.arange(len(used))
    rows = [place[np.append(r[learned[r]], bias)] for r in rows]
    z_used, n_used = z[used], n[used]
    root = np.sqrt(n_used)
    for _ in range(passes):
        for k in range(len(rows)) if turns is None else turns:
            idx = rows[k]
            z0, r0 = z_used[idx], root[idx]
            w = (np.minimum(np.maximum(z0, -L1), L1) - z0) / ((BETA + r0) / ALPHA + L2)
            g = sigmoid(w.sum()) - labels[k]
            n1 = n_used[idx] + g * g
            r1 = np.sqrt(n1)
            z_used[idx] = z0 + (g - (r1 - r0) / ALPHA * w)
            n_used[idx], root[idx] = n1, r1
    z[used], n[used] = z_used, n_used


def turns_of(labels: np.ndarray, times: tuple[int, int], order: np.ndarray) -> np.ndarray:
    """Every row as often as its class says, mixed by a hash of the row's
    order and the number of its turn."""
    rows = np.repeat(np.arange(len(labels)), np.where(labels == 1, times[1], times[0]))
    again = np.arange(len(rows)) - np.searchsorted(rows, rows)
    key = mix(order.astype(np.uint64)[rows], again.astype(np.uint64) + np.uint64(1))
    return rows[np.argsort(key, kind="stable")]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shard, y, orders, gaps`` for ``shard, y, order, text``: the gaps between
    a row's sorted features, as bytes. Batches stay small on the way out."""
    features = Features()
    for whole in batches:
        for start in range(0, whole.num_rows, PACK_ROWS):
            b = whole.slice(start, PACK_ROWS)
            y, orders = (c.to_numpy(zero_copy_only=False) for c in b.columns[1:3])
            gaps = [np.diff(np.unique(features(t)), prepend=0).astype(np.int32).tobytes() for t in blobs(b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([v.tobytes() for v in y.astype(np.float64)], pa.binary()),
                 pa.array([v.tobytes() for v in orders.astype(np.int64)], pa.binary()), pa.array(gaps, pa.binary())],
                names=["shard", "y", "orders", "gaps"])


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Labels, orders and feature indices of a shard at a time. A shard's rows
    stand together; only in files of more than a row group it may come in parts."""
    shard, y, orders, rows = None, [], [], []
    for b in batches:
        column = b.column(3)
        for k, (s, label, order) in enumerate(zip(*[c.to_pylist() for c in b.columns[:3]])):
            if s != shard and rows:
                yield np.frombuffer(b"".join(y), np.float64), np.frombuffer(b"".join(orders), np.int64), rows
                y, orders, rows = [], [], []
            shard = s
            y.append(label)
            orders.append(order)
            rows.append(np.cumsum(np.frombuffer(column[k].as_buffer(), np.int32), dtype=np.int32))
    if rows:
        yield np.frombuffer(b"".join(y), np.float64), np.frombuffer(b"".join(orders), np.int64), rows


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, *, max_rows: int | None = None,
                 shards: int = 4, rounds: int = 3, passes: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) of the fitted model; the last index is the bias.

    ``usable`` is a condition on ``doc_id`` that says which labelled rows may
    be learned from. All of them are used (with ``max_rows``, at most so many
    of each class), one per id (that of least text hash), of ids that stand in
    ``docs`` with a text. There are at least ``shards`` shards.
    Rows of the class with fewer take more turns, so the fit has a class ratio
    of about 1 to 1 at every size. Labels of a repeated id count as toxic if
    any of them does; rows with a null id, label or text are not learned from.
    Without rows of both classes the model is empty and scores 0.5."""
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
             .filter("y in (0, 1)").filter(usable).withColumn("order", F.xxhash64("doc_id")))
    src = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
           .filter("doc_id is not null and text is not null"))
    known = known.join(src.select("doc_id").distinct(), "doc_id", "left_semi")
    if max_rows is not None:
        picked = [known.filter(F.col("y") == c).orderBy("order", "doc_id").limit(max_rows) for c in (0, 1)]
        known = picked[0].unionByName(picked[1])
    known = cut(known, "toxic-ids")
    n_of = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n_of) < 2:
        return np.empty(0, np.int64), np.empty(0)
    shards = max(shards, -(-sum(n_of.values()) // SHARD_ROWS))
    # 64 bits a row, at most ID_BUCKETS rows; it only saves work, the rows are matched exactly after it
    bucket = F.expr(f"pmod(shiftright(xxhash64(doc_id), 6), {ID_BUCKETS})").alias("bucket")
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))")
    used = F.broadcast(known.groupBy(bucket).agg(F.bit_or(bit).alias("bits")))
    some = src.withColumn("bucket", bucket).join(used, "bucket").filter(F.col("bits").bitwiseAND(bit) != 0)
    # labels and texts meet in their shard: texts are shuffled once
    row = F.struct(F.xxhash64("text").alias("hash"), "text")
    both = some.select("doc_id", F.lit(None).cast("int").alias("y"), row.alias("row")).unionByName(
        known.select("doc_id", "y", F.lit(None).cast("struct<hash: bigint, text: string>").alias("row")))
    one = (both.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")).repartition(shards, "shard")
           .groupBy("shard", "doc_id").agg(F.max("y").alias("y"), F.min("row").alias("row"))
           .filter("y is not null and row is not null").sortWithinPartitions("shard", "doc_id")
           .select("shard", "y", F.xxhash64("doc_id").alias("order"), "row.text"))
    # features are written once: no round shuffles or reads texts again
    sample = cut(map_batches(one, packed, "shard int, y binary, orders binary, gaps binary"), "toxic-rows")
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    most = max(n_of.values())
    times = (round(most / n_of[0]), round(most / n_of[1]))
    for _ in range(rounds):
        used = np.flatnonzero(n)
        state = spark.sparkContext.broadcast((used, z[used], n[used]))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dz, dn, held = np.zeros(size), np.zeros(size), np.zeros(size, np.int64)
            for y, orders, rows in unpacked(batches):
                idx, z1, n1 = changes(y, orders, rows)
                dz[idx] += z1
                dn[idx] += n1
                held[idx] += 1
            idx = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (idx, dz[idx], dn[idx], held[idx])],
                                             names=["idx", "dz", "dn", "held"])

        def changes(y: np.ndarray, orders: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
            z1, n1 = np.zeros(size), np.zeros(size)
            at, z_at, n_at = state.value
            z1[at], n1[at] = z_at, n_at
            ftrl_rows(rows, y, z1, n1, passes, turns_of(y, times, orders))
            z1[at] -= z_at
            n1[at] -= n_at
            idx = np.flatnonzero(n1)
            return idx, z1[idx], n1[idx]

        # a task adds up the changes of a few shards before they are shuffled
        with batch_bytes(spark, LEARN_BYTES):
            merged = (map_batches(sample.coalesce(max(4, shards // TASK_SHARDS)), learn,
                                  "idx long, dz double, dn double, held long")
                      .groupBy("idx").agg((F.sum("dz") / F.sum("held")).alias("dz"),
                                          (F.sum("dn") / F.sum("held")).alias("dn"))
                      .toArrow())    # at most 2**BITS + 1 rows
        idx = merged["idx"].to_numpy()
        z[idx] += merged["dz"].to_numpy()
        n[idx] += merged["dn"].to_numpy()
        state.destroy()
    w = ftrl_weights(z, n)
    idx = np.flatnonzero(w)
    return idx, w[idx]


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, score`` per row. Null and empty texts get the bias score.
    Rows are neither dropped nor shuffled; repeated rows score alike."""
    index, weights = model

    def scorer():
        table = np.zeros((1 << BITS) + 1)
        table[index] = weights
        features, bias = Features(), table[1 << BITS]

        def score(text: bytes | None) -> float:
            idx = features(text or b"")
            idx = np.unique(idx[table[idx] != 0])
            return float(sigmoid(bias + table[idx].sum()))
        return score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for b in batches:
            s = pa.array([score(t) for t in blobs(b.column(1))], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), s], names=["doc_id", "score"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(src, run, "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, usable: Column, *, threshold: float = 0.5,
                  text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. Only texts
    go to Python and only scores come back; rows are named by a hash of the
    text, which alone decides the score, so null and repeated ids do not
    matter. A null text is scored as an empty one."""
    model = fit_toxicity(docs, labels, usable, text_col=text_col, **options)
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    scored = score_toxicity(docs.select(key.alias("text_key"), text_col), model, id_col="text_key", text_col=text_col)
    lost = cut(scored.filter(F.col("score") >= threshold).select(F.col("doc_id").alias("lost_key")).distinct(), "lost")
    return docs.join(lost, key == F.col("lost_key"), "left_anti")
