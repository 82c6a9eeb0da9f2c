"""Benchmark decontamination: rare word-pair seeds and Smith-Waterman alignment.

A test item's grams are its pairs of neighbouring words and of words with one
word between. An alignment that reaches ``threshold`` of the score of a whole
exact copy holds the pairs of a known number of the item's positions, so all
positions but that many (the ones that most documents hold), plus one, are
seeds: no such alignment misses them all, whatever other copies are there.
Seeds join training passages to items (an ordinary shuffle join on the pair's
hash, both sides of any size), and each joined passage is aligned with the
item by local alignment over words. An item counts as found when its best
alignment reaches ``threshold``, so edited, cut or interrupted copies are
found as well.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huddlekit.llm.common import WordHash, blobs, cut, map_batches, mix, shingle_hashes

FILTER_BITS = 23        # fixed-size filter over n-gram hashes
MATCH, MISMATCH, GAP = 2, -1, -1
BATCH_CELLS = 1 << 22   # cells of one row of a batch of alignments
# letters and digits in lower case, all other ASCII as blanks
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_CLEAN).split()


def pair_hashes(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words and of words with one word between; a
    pair hashes alike in both."""
    salt = np.uint64(0x94D049BB133111EB)
    return mix(w[:-1], w[1:]) * salt, mix(w[:-2], w[2:]) * salt


def item_grams(w: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Grams of an item, their positions, the number of positions that must
    be seeds, and the width of its grams (0: pairs).

    An alignment that reaches ``threshold`` of the ``2 * L`` points of a copy
    has ``m`` matches and at most ``2 * m - 2 * threshold * L`` errors. So at
    least ``threshold * L - 1`` of the gaps between matches hold at most one
    error, and such a gap is a pair of the text: any choice of all but that
    many positions, plus one, meets each such alignment."""
    size = len(w)
    if 0 < size < n:
        return shingle_hashes(w, size), np.zeros(1, np.int64), 1, size
    needed = math.ceil(threshold * size - 1e-9)
    if needed < 2:          # single words: an alignment has at least ``needed`` matches
        return shingle_hashes(w, 1), np.arange(size), size - max(needed, 1) + 1, 1
    near, far = pair_hashes(w)
    return (np.concatenate([near, far]), np.concatenate([np.arange(len(near)), np.arange(len(far))]),
            (size - 1) - (needed - 1) + 1, 0)


def item_table(bench: DataFrame, n: int, threshold: float) -> DataFrame:
    """``item, item_id, length, words, width, picks, grams, places``: word
    hashes and ``item_grams`` of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            w = [hashes.array(plain_words(t)) for t in blobs(b.column(2))]
            grams = [item_grams(x, n, threshold) for x in w]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in w], pa.int64()),
                 pa.array([x.astype(np.uint32).tobytes() for x in w], pa.binary()),
                 pa.array([g[3] for g in grams], pa.int32()), pa.array([g[2] for g in grams], pa.int64()),
                 pa.array([g[0].astype(np.int64) for g in grams], pa.list_(pa.int64())),
                 pa.array([g[1].astype(np.int64) for g in grams], pa.list_(pa.int64()))],
                names=["item", "item_id", "length", "words", "width", "picks", "grams", "places"])

    rows = bench.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return cut(map_batches(rows, run, "item long, item_id long, length long, words binary, width int, picks long, "
                                    "grams array<long>, places array<long>"), "items")


class Hits:
    """Positions and hashes of a text's grams that may be in the filter."""

    def __init__(self, packed: np.ndarray, widths: list[int]):
        self.hashes, self.hit, self.widths = WordHash(), np.unpackbits(packed).astype(bool), widths

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = self.hashes.array(plain_words(text))
        at, grams = [], []
        for width in self.widths:
            for g in pair_hashes(w) if width == 0 else (shingle_hashes(w, width),):
                k = np.flatnonzero(self.hit[(g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
                at.append(k)
                grams.append(g[k])
        at, grams = np.concatenate(at), np.concatenate(grams)
        order = np.argsort(at, kind="stable")
        return w, at[order], grams[order]


def gram_filter(grams: DataFrame) -> np.ndarray:
    """Bits of the buckets that column ``g`` uses: at most 2**FILTER_BITS."""
    bucket = F.shiftrightunsigned("g", 64 - FILTER_BITS)
    table = np.zeros(1 << FILTER_BITS, bool)
    table[grams.select(bucket.alias("k")).distinct().toArrow()["k"].to_numpy()] = True
    return np.packbits(table)


def gram_hits(docs: DataFrame, items: DataFrame, widths: list[int]) -> DataFrame:
    """``doc, doc_id, words, at, grams``: of every text with grams that may be
    an item's, its word hashes and those grams with their positions. The
    filter has a fixed size; it only saves work, the joins are exact."""
    shared = docs.sparkSession.sparkContext.broadcast(gram_filter(items.select(F.explode("grams").alias("g"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Hits(shared.value, widths)
        for b in batches:
            rows = []
            for doc, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), blobs(b.column(2))):
                w, at, grams = find(text)
                if len(at):
                    rows.append((doc, doc_id, w.astype(np.uint32).tobytes(), at.astype(np.int32), grams.astype(np.int64)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()),
                                                       pa.list_(pa.int64())))],
                names=["doc", "doc_id", "words", "at", "grams"])

    rows = docs.select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text")
    return cut(map_batches(rows, run, "doc long, doc_id long, words binary, at array<int>, grams array<long>"), "hits")


def seeds(hits: DataFrame, items: DataFrame) -> DataFrame:
    """``g, item, first, last``: grams of the ``picks`` positions of each
    item that the fewest texts hold, with the first and last such position.
    Any choice finds the same copies, so the counts, of all texts and by
    filter bucket, only save work."""
    grams = items.select("item", "picks", F.explode(F.arrays_zip("grams", "places")).alias("h")) \
                 .select("item", "picks", F.col("h.grams").alias("g"), F.col("h.places").alias("place"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << FILTER_BITS, np.int64)      # of the benchmark's buckets only
        for b in batches:
            column = b.column(0)
            row = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
            bucket = (column.flatten().to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            once = np.unique((row << FILTER_BITS) + bucket)
            np.add.at(held, once & ((1 << FILTER_BITS) - 1), 1)
        k = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(held[k])], names=["k", "n"])

    held = map_batches(hits.select("grams"), count, "k long, n long").groupBy("k").agg(F.sum("n").alias("texts"))
    counted = (grams.withColumn("k", F.shiftrightunsigned("g", 64 - FILTER_BITS)).join(held, "k", "left")
               .groupBy("item", "picks", "place").agg(F.sum(F.coalesce("texts", F.lit(0))).alias("texts"),
                                                      F.collect_set("g").alias("gs")))
    rarest = Window.partitionBy("item").orderBy("texts", "place")
    return cut(counted.withColumn("r", F.row_number().over(rarest)).filter(F.col("r") <= F.col("picks"))
               .select("item", "place", F.explode("gs").alias("g")).groupBy("g", "item")
               .agg(F.min("place").alias("first"), F.max("place").alias("last")), "seeds")


def passages(hits: DataFrame, items: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc, doc_id, passage, start, words, grams, lows, highs``: the
    stretches of each text around grams that may be seeds, with those grams
    and the first and last position of each.

    A stretch reaches as far around a gram as an alignment with the longest
    item can: its words, and as many inserted ones."""
    reach = 2 * int(items.agg(F.max("length")).first()[0] or 0) + 2
    shared = hits.sparkSession.sparkContext.broadcast(gram_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            rows = []
            ends = b.column(3).offsets.to_numpy()
            ends = ends - ends[0]
            places = b.column(3).flatten().to_numpy()
            found = b.column(4).flatten().to_numpy()
            seed = hit[(found.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            for doc, doc_id, words, lo, hi in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                  b.column(2).to_pylist(), ends[:-1], ends[1:]):
                at, grams = places[lo:hi][seed[lo:hi]], found[lo:hi][seed[lo:hi]]
                if not len(at):
                    continue
                w = np.frombuffer(words, np.uint32)
                # hits closer than two reaches share a stretch
                for k, part in enumerate(np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * reach) + 1)):
                    lo, hi = max(0, int(at[part[0]]) - reach), min(len(w), int(at[part[-1]]) + reach)
                    own, low = np.unique(grams[part], return_index=True)
                    high = len(part) - 1 - np.unique(grams[part][::-1], return_index=True)[1]
                    rows.append((doc, doc_id, k, lo, w[lo:hi].tobytes(), own,
                                 (at[part[low]] - lo).astype(np.int32), (at[part[high]] - lo).astype(np.int32)))
            cols = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(),
                                                       pa.list_(pa.int64()), pa.list_(pa.int32()),
                                                       pa.list_(pa.int32())))],
                names=["doc", "doc_id", "passage", "start", "words", "grams", "lows", "highs"])

    return cut(map_batches(hits, run, "doc long, doc_id long, passage int, start long, words binary, "
                                      "grams array<long>, lows array<int>, highs array<int>"), "passages")


def local_alignment(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each pair and the text position after its
    last aligned word, for a batch padded to common lengths."""
    rows, cols = max(map(len, items)), max(map(len, texts))
    a = np.full((len(items), rows), -1, np.int64)
    b = np.full((len(items), cols), -2, np.int64)
    for k, (x, y) in enumerate(zip(items, texts)):
        a[k, :len(x)], b[k, :len(y)] = x, y
    shift = np.arange(cols, dtype=np.int32) * -GAP
    h, diagonal = np.zeros((len(items), cols), np.int32), np.empty((len(items), cols), np.int32)
    same = np.empty((len(items), cols), bool)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        np.equal(b, a[:, i:i + 1], out=same)
        np.multiply(same, np.int32(MATCH - MISMATCH), out=diagonal)
        diagonal += np.int32(MISMATCH)
        diagonal[:, 1:] += h[:, :-1]
        h += np.int32(GAP)
        np.maximum(diagonal, h, out=h)
        np.maximum(h, 0, out=h)
        # gaps along the text: running maximum of h[k] - gap * (j - k)
        h += shift
        np.maximum.accumulate(h, axis=1, out=h)
        h -= shift
        top = h.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], h[better].argmax(axis=1) + 1
    return best, end


def align(pairs: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Scores of joined pairs; texts are cut to the seeds' diagonals first.
    Pairs that cannot reach ``threshold`` are left out: an alignment has no
    more matches than the item has words that the text holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            xs, ys, cuts, kept = [], [], [], []
            for k, (v, u, lo, hi) in enumerate(zip(c["words"].to_pylist(), c["item_words"].to_pylist(),
                                                   c["lo"].to_pylist(), c["hi"].to_pylist())):
                x, y = np.frombuffer(u, np.uint32), np.frombuffer(v, np.uint32)
                slack = len(x) + 2      # as many words as can be inserted
                first, last = max(0, lo - slack), min(len(y), hi + len(x) + slack)
                y = y[first:last]
                if sum(map(set(y.tolist()).__contains__, x.tolist())) / max(1, len(x)) < threshold:
                    continue
                xs.append(x)
                ys.append(y)
                cuts.append(first)
                kept.append(k)
            c = {name: column.take(pa.array(kept, pa.int64())) for name, column in c.items()
                 if name not in ("words", "item_words")}
            best, end = np.zeros(len(xs), np.int64), np.zeros(len(xs), np.int64)
            order = sorted(range(len(xs)), key=lambda k: (len(xs[k]), len(ys[k])))
            start = 0
            while start < len(order):       # batches of similar size, bounded in cells
                stop, width = start, 0
                while stop < len(order) and (stop == start or (stop - start + 1) * max(width, len(ys[order[stop]]))
                                             <= BATCH_CELLS) and stop - start < 2048:
                    width = max(width, len(ys[order[stop]]))
                    stop += 1
                part = order[start:stop]
                best[part], end[part] = local_alignment([xs[k] for k in part], [ys[k] for k in part])
                start = stop
            score = best / np.array([MATCH * max(1, len(x)) for x in xs], float)
            yield pa.RecordBatch.from_arrays(
                [c["doc"], c["doc_id"], c["item"], c["item_id"], c["seeds"], pa.array(score),
                 pa.array(np.array(c["start"].to_pylist(), np.int64) + np.array(cuts, np.int64) + end)],
                names=["doc", "doc_id", "item", "item_id", "seeds", "similarity", "doc_end"])

    return map_batches(pairs, run, "doc long, doc_id long, item long, item_id long, seeds long, similarity double, "
                                 "doc_end long")


def contaminated(docs: DataFrame, bench: DataFrame, *, n: int = 3, threshold: float = 0.5,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, similarity, seeds, doc_end``: per document row and
    test item the best alignment, where it reaches ``threshold``.
    ``similarity`` is the alignment score over that of a whole copy,
    ``doc_end`` the number of the word after it, and ``seeds`` the number of
    the item's seed grams met. ``threshold`` must be above 0.

    Null and empty texts and items take part in nothing; an item shorter than
    ``n`` words is one n-gram, found where all its words stand in a row. Repeated rows, on either side, are found each
    on their own; null ids are carried. Empty tables give an empty result.
    Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bench = bench.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = item_table(bench, n, threshold)
    widths = sorted(r["width"] for r in items.filter("length > 0").select("width").distinct().collect())   # below n
    if not widths:
        widths = [0]
    held = gram_hits(docs, items, widths)
    wanted = seeds(held, items)
    found = passages(held, items, wanted)
    hits = found.select("doc", "passage", F.explode(F.arrays_zip("grams", "lows", "highs")).alias("h")) \
                .select("doc", "passage", F.col("h.grams").alias("g"), F.col("h.lows").alias("low"),
                        F.col("h.highs").alias("high"))
    joined = (hits.join(wanted, "g").groupBy("doc", "passage", "item")
              .agg(F.count(F.lit(1)).alias("seeds"), F.min(F.col("low") - F.col("last")).alias("lo"),
                   F.max(F.col("high") - F.col("first")).alias("hi")))
    pairs = (joined.join(found.drop("grams", "lows", "highs"), ["doc", "passage"])
             .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item"))
    best = Window.partitionBy("doc", "item").orderBy(F.desc("similarity"), "doc_end")
    return (align(pairs, threshold).filter(F.col("similarity") >= threshold)
            .withColumn("r", F.row_number().over(best)).filter("r = 1")
            .select("doc_id", "item_id", "similarity", "seeds", "doc_end"))


def without_contaminated(docs: DataFrame, bench: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in whose text an item was found; null texts
    stay. Rows are named by a hash of the text, so null and repeated ids do
    not matter."""
    keyed = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    found = contaminated(keyed, bench, id_col="text_key", **options)
    lost = cut(found.select(F.col("doc_id").alias("lost_key")).distinct(), "lost")
    return docs.join(lost, F.xxhash64(text_col) == F.col("lost_key"), "left_anti")
