"""Quality: a factorisation machine over hashed words, structure statistics
and metadata.

A text is a sparse vector x: one entry per distinct hashed word, scaled so
that all words together have length 1, and one entry of value 1 per structure
statistic (shares of letter kinds, repetition, line shape, sizes) and per
metadata column, each cut into levels. Besides a weight w_i, every feature has
a short vector v_i, and each pair of features adds <v_i, v_j> x_i x_j. The sum
over all pairs is never formed: it is half of the square of the sum of
v_i x_i less the sum of the squares, so a text is scored in time linear in its
features.

The machine is fitted on at most ``max_rows`` labelled rows (one row per id,
ids of least hash first), dealt into a fixed number of shards. In each round
every shard runs AdaGrad passes from the common state and a Spark aggregation
averages the changes of each feature over the shards that changed it. Every
text is scored whole.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import WordHash, blobs, cut

BITS = 16                   # words are hashed into 2**BITS features
LEVELS = 16                 # levels of each statistic
RANK = 8                    # length of the feature vectors
RATE_W, RATE_V = 0.3, 0.1   # AdaGrad rates
DECAY = 1e-4
START = 0.05                # spread of the first feature vectors

_UPPER, _LOWER, _DIGIT, _HIGH, _STOP, _SYMBOL, _BLANK, _LINE = range(8)


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return _HIGH
    if c == "\n":
        return _LINE
    if c in " \t\r\x0b\x0c":
        return _BLANK
    if c.isalpha():
        return _UPPER if c.isupper() else _LOWER
    if c.isdigit():
        return _DIGIT
    return _STOP if c in ".,;:!?'\"-()" else _SYMBOL


KIND = np.array([_kind(b) for b in range(256)], np.uint8)
# bytes of words, lower-cased; the rest become blanks
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
STATISTICS = ("upper", "digits", "high", "stops", "symbols", "mark_runs", "line_ends", "distinct_words",
              "same_as_last", "commonest_word", "distinct_lines", "bytes", "words", "lines", "word_length",
              "longest_word")


def share(part: float, whole: float) -> int:
    """Level of a share; the square root spreads out the small ones."""
    return min(LEVELS - 1, int(LEVELS * (part / whole) ** 0.5)) if whole else 0


def magnitude(n: float) -> int:
    return min(LEVELS - 1, int(np.log2(n + 1)))


class Encoder:
    """Feature indices and values of a text and its metadata."""

    def __init__(self) -> None:
        self.hashes = WordHash()

    def statistics(self, text: bytes, words: list[bytes], ids: np.ndarray, counts: np.ndarray,
                   h: np.ndarray) -> list[int]:
        kinds = KIND[np.frombuffer(text, np.uint8)]
        n = np.bincount(kinds, minlength=8)
        marks = (kinds == _STOP) | (kinds == _SYMBOL)
        letters = n[_UPPER] + n[_LOWER]
        lines = text.split(b"\n")
        size, many = len(text), len(words)
        return [share(n[_UPPER], letters), share(n[_DIGIT], size), share(n[_HIGH], size), share(n[_STOP], size),
                share(n[_SYMBOL], size), share(np.count_nonzero(marks[1:] & marks[:-1]), size),
                share(len(lines) - 1, size), share(len(ids), many), share(np.count_nonzero(h[1:] == h[:-1]), many),
                share(counts.max(), many) if many else 0, share(len(set(lines)), len(lines)),
                magnitude(size), magnitude(many), magnitude(len(lines)),
                magnitude(sum(map(len, words)) / many * 4) if many else 0,
                magnitude(max(map(len, words))) if many else 0]

    def __call__(self, text: bytes, metadata: list[float | None]) -> tuple[np.ndarray, np.ndarray]:
        words = text.translate(_CLEAN).split()
        h = self.hashes.array(words) * np.uint64(0xD6E8FEB86659FD93)
        ids, counts = np.unique((h >> np.uint64(64 - BITS)).astype(np.int32), return_counts=True)
        levels = self.statistics(text, words, ids, counts, h)
        levels += [0 if m is None or not np.isfinite(m) else 1 + min(LEVELS - 2, magnitude(abs(m))) for m in metadata]
        idx = np.append(ids, (1 << BITS) + LEVELS * np.arange(len(levels)) + np.array(levels)).astype(np.int32)
        value = np.ones(len(idx))
        value[:len(ids)] = 1.0 / np.sqrt(max(1, len(ids)))
        return idx, value


class Machine(NamedTuple):
    """bias, and for each learned feature its index, weight and vector."""
    bias: float
    index: np.ndarray
    weight: np.ndarray
    vector: np.ndarray


def size_of(columns: int) -> int:
    return (1 << BITS) + LEVELS * (len(STATISTICS) + columns)


def first_vectors(columns: int) -> np.ndarray:
    return np.random.default_rng(11).normal(0.0, START, (size_of(columns), RANK))


def raw_score(bias: float, w: np.ndarray, v: np.ndarray, x: np.ndarray) -> float:
    """Machine value of features with weights ``w``, vectors ``v`` and values
    ``x``, by the sum of squares."""
    vx = v * x[:, None]
    total = vx.sum(axis=0)
    return float(bias + w @ x + 0.5 * (total @ total - (vx * vx).sum()))


def logistic(z: float) -> float:
    return float(1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, z)))))


def fit_passes(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bias: np.ndarray, w: np.ndarray,
               v: np.ndarray, gw: np.ndarray, gv: np.ndarray, passes: int) -> None:
    """AdaGrad passes over the rows in the given order, in place. ``bias``
    holds the bias and its squared gradients; ``gw`` and ``gv`` those of the
    weights and (one for each) vectors."""
    for _ in range(passes):
        for (idx, x), y in zip(rows, labels):
            vi, wi = v[idx], w[idx]
            vx = vi * x[:, None]
            total = vx.sum(axis=0)
            g = logistic(bias[0] + wi @ x + 0.5 * (total @ total - (vx * vx).sum())) - y
            bias[1] += g * g
            bias[0] -= RATE_W * g / np.sqrt(bias[1])
            dw = g * x + DECAY * wi
            gw[idx] += dw * dw
            w[idx] = wi - RATE_W * dw / np.sqrt(gw[idx])
            dv = g * (x[:, None] * total - vx * x[:, None]) + DECAY * vi
            gv[idx] += (dv * dv).mean(axis=1)
            v[idx] = vi - RATE_V * dv / np.sqrt(gv[idx] + 1e-12)[:, None]


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int, shards: int,
                    metadata: tuple[str, ...], id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Encoded rows to learn from: ``y, shard, order, idx, value``; at most
    one per id and ``max_rows`` in all."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("y"))
             .filter(usable).withColumn("order", F.xxhash64("doc_id")))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      *[F.col(c).cast("double").alias(f"m{k}") for k, c in enumerate(metadata)])
    src = src.filter("doc_id is not null and text is not null")
    ids = (known.join(src.select("doc_id").distinct(), "doc_id", "left_semi")
           .orderBy("order", "doc_id").limit(max_rows))
    # ids: at most max_rows rows
    one = (src.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y", "order")
           .agg(F.min(F.struct(F.xxhash64("text"), "text", *[f"m{k}" for k in range(len(metadata))])).alias("row")))
    flat = one.select("y", F.pmod("order", F.lit(shards)).cast("int").alias("shard"), "order", F.col("row.text"),
                      *[F.col(f"row.m{k}") for k in range(len(metadata))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for b in batches:
            extra = [b.column(4 + k).to_pylist() for k in range(len(metadata))]
            coded = [encoder(t, list(m)) for t, *m in zip(blobs(b.column(3)), *extra)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([c[0] for c in coded], pa.list_(pa.int32())),
                 pa.array([c[1] for c in coded], pa.list_(pa.float64()))], names=["y", "shard", "order", "idx", "value"])
    return cut(flat.mapInArrow(encode, "y int, shard int, order long, idx array<int>, value array<double>"),
               "quality-sample")


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column, *, max_rows: int = 8000, shards: int = 4,
                rounds: int = 4, passes: int = 2, metadata: tuple[str, ...] = ("n_chars",), id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality") -> Machine:
    """The fitted machine.

    ``usable`` is a condition on ``doc_id`` that says which labelled rows may
    be learned from. Of those whose id stands in ``docs`` with a text, at most
    ``max_rows`` ids are used, one row each (that of least text hash). A
    repeated label counts as 0 if any of its rows does; null ids, labels and
    texts are not learned from. ``metadata`` names numeric columns of
    ``docs``; a null or non-finite value is a level of its own. Without rows
    of both classes the machine is empty and scores the share of label 1
    (0.5 without any row)."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, usable, max_rows, shards, metadata, id_col, text_col, label_col)
    n_of = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    size, first = size_of(len(metadata)), first_vectors(len(metadata))
    if not (n_of.get(0) and n_of.get(1)):
        odds = (n_of.get(1, 0) + 0.5) / (n_of.get(0, 0) + 0.5)
        return Machine(float(np.log(odds)), np.empty(0, np.int64), np.empty(0), np.empty((0, RANK)))
    bias = np.array([np.log(n_of[1] / n_of[0]), 1.0])
    w, v, gw, gv = np.zeros(size), first.copy(), np.ones(size), np.ones(size)
    names = ["dw", "dgw", "dgv", *[f"d{f}" for f in range(RANK)]]
    for _ in range(rounds):
        used = np.flatnonzero(gw > 1.0)
        state = spark.sparkContext.broadcast((bias, used, w[used], v[used], gw[used], gv[used]))

        def learn(part: pd.DataFrame) -> pd.DataFrame:
            b0, at, *values = state.value
            w0, v0, gw0, gv0 = np.zeros(size), first_vectors(len(metadata)), np.ones(size), np.ones(size)
            for whole, some in zip((w0, v0, gw0, gv0), values):
                whole[at] = some
            b1, w1, v1, gw1, gv1 = b0.copy(), w0.copy(), v0.copy(), gw0.copy(), gv0.copy()
            part = part.sort_values("order")
            rows = [(np.asarray(i), np.asarray(x)) for i, x in zip(part["idx"], part["value"])]
            fit_passes(rows, part["y"].to_numpy(float), b1, w1, v1, gw1, gv1, passes)
            idx = np.flatnonzero(gw1 != gw0)
            out = np.column_stack([(w1 - w0)[idx], (gw1 - gw0)[idx], (gv1 - gv0)[idx], (v1 - v0)[idx]])
            frame = pd.DataFrame(out, columns=names)
            frame.insert(0, "idx", idx)
            frame.loc[len(frame)] = [-1, b1[0] - b0[0], b1[1] - b0[1], 0.0, *[0.0] * RANK]
            return frame.astype({"idx": "int64"})

        # at most size + 1 rows: a bound set by BITS
        merged = (sample.groupBy("shard").applyInPandas(learn, "idx long, " + ", ".join(f"{c} double" for c in names))
                  .groupBy("idx").agg(*[F.avg(c).alias(c) for c in names]).toArrow().to_pandas().sort_values("idx"))
        own = merged[merged["idx"] < 0]
        bias += own[["dw", "dgw"]].to_numpy()[0]
        merged = merged[merged["idx"] >= 0]
        idx = merged["idx"].to_numpy()
        w[idx] += merged["dw"].to_numpy()
        gw[idx] += merged["dgw"].to_numpy()
        gv[idx] += merged["dgv"].to_numpy()
        v[idx] += merged[names[3:]].to_numpy()
        state.destroy()
    idx = np.flatnonzero(gw > 1.0)
    return Machine(float(bias[0]), idx, w[idx], v[idx])


def score_quality(docs: DataFrame, machine: Machine, *, metadata: tuple[str, ...] = ("n_chars",),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` per row, score from 0 to 1. Null and empty texts are
    scored from their statistics and metadata; features never learned count
    nothing. Rows are neither dropped nor shuffled, and repeated rows score
    alike; texts of any length are scored whole, one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = size_of(len(metadata))
        w, v = np.zeros(size), np.zeros((size, RANK))
        w[machine.index], v[machine.index] = machine.weight, machine.vector
        encoder = Encoder()
        for b in batches:
            extra = [b.column(2 + k).to_pylist() for k in range(len(metadata))]
            scores = []
            for text, *m in zip(blobs(b.column(1)), *extra):
                idx, x = encoder(text or b"", list(m))
                scores.append(logistic(raw_score(machine.bias, w[idx], v[idx], x)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      *[F.col(c).cast("double").alias(f"m{k}") for k, c in enumerate(metadata)])
    return src.mapInArrow(run, "doc_id long, score double")
