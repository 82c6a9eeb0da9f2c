"""N-gram Jaccard join with set-relation skipping, and its components.

Every document is its set of distinct word shingles (64-bit hashes). Two
documents link when ``100 * |A & B| >= percent * |A | B|``. Equal sets are
one class; the join runs over classes and is exact up to hash collisions:

1. A prefix index: shingles are ordered rarest first (by a fixed-size count
   sketch of the whole corpus; any fixed order is exact), and only a set's
   first ``n - ceil(percent * n / 100) + 1`` shingles are indexed. Linked
   sets share one of them.
2. Index-level skipping: each index list is sorted by position in the prefix
   and cut into blocks; two blocks meet only if their positions and lengths
   leave room for a link. A long list is thereby spread over many tasks.
   Inside a meeting, entries pass a length, a position and a difference
   filter (a 256-bit parity map whose Hamming distance never exceeds the
   size of the symmetric difference; survivors pass a wider one).
3. Answer-level skipping: a first round verifies only each entry's nearest
   partner. Sets it connects share a component, so no pair inside one is
   looked at again. Entries that still pass the filters with another
   component are connected to families by a spanning forest of each meeting.
   The sets of a family then meet in blocks, and every pair is decided inside
   the task: not at all once its components are joined, by the distances to a
   component's first set ("host") where the triangle inequality of the
   symmetric difference decides, and else by its own difference. Rows are
   made for links that join two components, so their number follows the
   entries, not the pairs.

No pairs within a group of similar documents are enumerated into rows, no
list is held by one task, and nothing is dropped.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import (WordHash, batch_bytes, blobs, cut, map_batches, shingle_hashes, whole_groups,
                                  words_of)
from huddlekit.llm.components import components

SKETCH_BITS, SKETCH_BLOCK = 20, 1 << 14   # count sketch: cells and cells per row
BLOCK = 1024                              # index entries per block
FILTER_BITS = 20                          # buckets of the reread filter
SMALL = 24                                # group size up to which pairs are made by offsets
SET_BLOCK = 1 << 20                       # shingles of a block of sets, 8 MB


class ShingleSet:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, k: int):
        self.k, self.words = k, WordHash()

    def __call__(self, text: bytes | None) -> np.ndarray:
        return np.unique(shingle_hashes(self.words.array(words_of(text or b"")), self.k))


def signature(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def parity_map(s: np.ndarray) -> bytes:
    return np.packbits(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) & 1).tobytes()


def wide_map(s: np.ndarray) -> bytes:
    """A parity map whose width grows with the set (256 bits, 2048 beyond 400
    shingles, 16384 beyond 4000)."""
    bits = 8 if len(s) <= 400 else 11 if len(s) <= 4000 else 14
    return np.packbits(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).tobytes()


def map_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two wide maps, the wider folded by exclusive or."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) == len(b):
        return int(np.bitwise_count(a ^ b).sum())
    if len(a) < len(b):
        a, b = b, a
    folded = np.packbits(np.bitwise_xor.reduce(np.unpackbits(a).reshape(8 * len(b), -1), axis=1))
    return int(np.bitwise_count(folded ^ b).sum())


def may_link(n1, n2, delta, percent: int):
    """Whether a symmetric difference of ``delta`` still allows a link; with
    the exact difference, whether the sets link."""
    return delta * (100 + percent) <= (n1 + n2) * (100 - percent)


# ---- pass 1: signatures and the count sketch ---------------------------------------------------

def signatures_and_sketch(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = ShingleSet(k)
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen = False
        for b in batches:
            sig, n = [], []
            for t in blobs(b.column(1)):
                s = make(t)
                np.add.at(cells, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                sig.append(signature(s) if len(s) else None)
                n.append(len(s))
            seen = True
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sig, pa.binary()), pa.array(n, pa.int64()), pa.nulls(size, pa.int32()),
                 pa.nulls(size, pa.binary())], names=["doc_id", "sig", "n", "part", "cells"])
        if seen:
            parts = cells.reshape(-1, SKETCH_BLOCK)
            size = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64()),
                 pa.array(range(size), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["doc_id", "sig", "n", "part", "cells"])

    return map_batches(docs, run, "doc_id long, sig binary, n long, part int, cells binary")


def sketch_classes(sketch: DataFrame) -> np.ndarray:
    """Frequency class (two per doubling) of each cell: 2**SKETCH_BITS bytes,
    whatever the corpus. Arrays are added within partitions, then per part."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a = np.frombuffer(cells, np.uint64 if len(cells) == 8 * SKETCH_BLOCK else np.uint32)
                if part in sums:
                    sums[part] += a
                else:
                    sums[part] = a.astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([a.tobytes() for a in sums.values()], pa.binary())],
                                         names=["part", "cells"])

    schema = "part int, cells binary"
    summed = map_batches(map_batches(sketch, add, schema).repartition("part"), add, schema).toArrow()
    out = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint8).reshape(-1, SKETCH_BLOCK)
    for part, cells in zip(summed["part"].to_pylist(), summed["cells"].to_pylist()):
        out[part] = (2 * np.log2(np.frombuffer(cells, np.uint64) + 1.0)).astype(np.uint8)
    return out.reshape(-1)


# ---- pass 2: classes and their prefixes --------------------------------------------------------

def classes_with_prefixes(docs: DataFrame, rank: np.ndarray, k: int, percent: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rank)   # 2**SKETCH_BITS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, order = ShingleSet(k), shared.value
        for b in batches:
            rows = []
            for doc_id, key, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), blobs(b.column(1))):
                s = make(t)
                if not len(s):
                    continue
                size = len(s) - -(-percent * len(s) // 100) + 1
                first = np.lexsort((s, order[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))[:size]
                rows.append((doc_id, signature(s), len(s), key, s[first].tobytes(), parity_map(s), wide_map(s)))
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(),
                                                       pa.binary(), pa.binary()))],
                names=["doc_id", "sig", "n", "text_key", "prefix", "parity", "wide"])

    rows = map_batches(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), run,
        "doc_id long, sig binary, n long, text_key long, prefix binary, parity binary, wide binary")
    # all rows of a class agree on n, prefix and parity; text_key is that of one of them
    merged = rows.groupBy("sig").agg(F.min("doc_id").alias("min_doc"), F.min("n").alias("n"),
                                     F.min("text_key").alias("text_key"), F.first("prefix").alias("prefix"),
                                     F.first("parity").alias("parity"), F.first("wide").alias("wide"))
    return cut(merged.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")


# ---- the index ---------------------------------------------------------------------------------

def postings(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes = [np.frombuffer(p, np.int64) for p in b.column(2).to_pylist()]
            if not prefixes:
                continue
            sizes = np.array([len(p) for p in prefixes])
            pos = np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(prefixes)), pa.array(np.repeat(b.column(0).to_numpy(), sizes)),
                 pa.array(np.repeat(b.column(1).to_numpy(), sizes)), pa.array(pos)], names=["token", "cid", "n", "pos"])

    return map_batches(classes.select("cid", "n", "prefix"), run, "token long, cid long, n long, pos int")


def shared_lists(entries: DataFrame) -> DataFrame:
    """Entries of index lists with at least two entries, with their place
    ``seq`` in the list (by position, length, class). Lists are streamed: a
    task holds one batch and one row, however long a list is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None      # the last row, not yet known to be shared
        last, count = None, 0                   # its token and its number of list entries so far
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            token = b.column(0).to_numpy()
            new = np.append(True, token[1:] != token[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            seq = np.arange(len(token)) - first
            if last is not None and token[0] == last:
                seq[first == 0] += count - 1    # the held row was entry count - 1
            shared = (seq > 0) | np.append(~new[1:], False)
            shared[-1] = False
            if shared.any():
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(seq)],
                                                 names=["token", "cid", "n", "pos", "seq"]).filter(pa.array(shared))
            held, last, count = b.slice(len(token) - 1), token[-1], int(seq[-1]) + 1
        if held is not None and count > 1:
            yield pa.RecordBatch.from_arrays([*held.columns[:4], pa.array([count - 1])],
                                             names=["token", "cid", "n", "pos", "seq"])

    ordered = entries.repartition("token").sortWithinPartitions("token", "pos", "n", "cid")
    return map_batches(ordered, run, "token long, cid long, n long, pos int, seq long")


def meetings(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of blocks of one list that may hold a link, as entries tagged
    with the meeting ``gid`` and the side they stand on."""
    lists = lists.withColumn("block", F.floor(F.col("seq") / BLOCK))
    blocks = lists.groupBy("token", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                                                 F.min("pos").alias("at"), F.count(F.lit(1)).alias("entries"))
    left = blocks.select("token", F.col("block").alias("b1"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"),
                         F.col("at").alias("at1"), F.col("entries").alias("entries1"))
    right = blocks.select("token", F.col("block").alias("b2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                          F.col("at").alias("at2"))
    meet = (left.join(right, "token").filter("b1 <= b2 and (b1 < b2 or entries1 > 1)")
            .filter((F.col("lo1") * percent <= F.col("hi2") * 100) & (F.col("lo2") * percent <= F.col("hi1") * 100)
                    & ((F.col("at1") + F.col("at2")) * (100 + percent)
                       <= (F.col("hi1") + F.col("hi2")) * (100 - percent))))
    meet = meet.select(F.xxhash64("token", "b1", "b2").alias("gid"), "token", "b1", "b2")
    sides = meet.select("token", F.explode(F.when(F.col("b1") == F.col("b2"), F.array(F.struct(
        F.col("b1").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(
            F.struct(F.col("b1").alias("block"), F.lit(1).alias("side")),
            F.struct(F.col("b2").alias("block"), F.lit(2).alias("side"))))).alias("s"), "gid", "b1", "b2")
    sides = sides.select("token", "gid", F.col("s.block").alias("block"), F.col("s.side").alias("side"))
    return lists.join(sides, ["token", "block"]).select("gid", "side", "token", "cid", "n", "pos")


def passing(i: np.ndarray, j: np.ndarray, c: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, ...]:
    """Of the pairs of rows, those of different components that pass the
    length, the position and the difference filter, and their parity distance."""
    n1, n2 = c["n"][i], c["n"][j]
    ok = (c["comp"][i] != c["comp"][j]) & ((c["side"][i] == 0) | (c["side"][i] != c["side"][j]))
    ok &= (np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * percent)
    ok &= may_link(n1, n2, c["pos"][i] + c["pos"][j], percent)
    i, j, n1, n2 = i[ok], j[ok], n1[ok], n2[ok]
    far = np.bitwise_count(c["parity"][i] ^ c["parity"][j]).sum(axis=1).astype(np.int64)
    ok = may_link(n1, n2, far, percent)
    return i[ok], j[ok], far[ok]


def passing_pairs(c: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``i, j, far`` (rows, i < j) of all passing pairs within groups: those of
    small groups by the distance of their rows, those of larger ones by ``j``."""
    gid = c["gid"]
    starts = np.flatnonzero(np.append(True, gid[1:] != gid[:-1]))
    sizes = np.diff(np.append(starts, len(gid)))
    size_of = np.repeat(sizes, sizes)
    place = np.arange(len(size_of)) - np.repeat(starts, sizes)
    small = size_of <= SMALL
    for d in range(1, SMALL):       # rows d apart in a small group
        j = np.flatnonzero(small & (place >= d))
        if not len(j):
            break
        yield passing(j - d, j, c, percent)
    for s, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        for r in range(s + 1, s + size):
            yield passing(np.arange(s, r), np.full(r - s, r), c, percent)


def arrays_of(t: pa.Table, *names: str) -> dict[str, np.ndarray]:
    c = {x: t.column(x).to_numpy().astype(np.int64) for x in names}
    c["parity"] = np.frombuffer(b"".join(t.column("parity").to_pylist()), np.uint64).reshape(-1, 4)
    return c


MEETING = ("gid", "side", "cid", "n", "pos", "comp")


def by_meeting(entries: DataFrame) -> DataFrame:
    return entries.repartition("gid").sortWithinPartitions("gid", "pos", "n", "cid")


def nearest_pairs(tagged: DataFrame, percent: int) -> DataFrame:
    """``a, b`` (a < b): each entry with its closest earlier partner within
    the meeting, of those that pass the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "gid"):
            t = t.combine_chunks()
            c = arrays_of(t, *MEETING)
            best, least = np.full(t.num_rows, -1), np.full(t.num_rows, np.iinfo(np.int64).max)
            for i, j, far in passing_pairs(c, percent):
                o = np.lexsort((i, far, j))
                o = o[np.append(True, j[o][1:] != j[o][:-1])] if len(o) else o
                o = o[far[o] <= least[j[o]]]
                best[j[o]], least[j[o]] = i[o], far[o]
            j = np.flatnonzero(best >= 0)
            a, b = c["cid"][best[j]], c["cid"][j]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return map_batches(by_meeting(tagged.withColumn("comp", F.col("cid"))), run, "a long, b long").distinct()


def with_partners(tagged: DataFrame, percent: int) -> DataFrame:
    """The entries that pass the filters with any entry of their meeting that
    is of another component. Pairs stay inside the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "gid"):
            t = t.combine_chunks()
            kept = np.zeros(t.num_rows, bool)
            for i, j, _ in passing_pairs(arrays_of(t, *MEETING), percent):
                kept[i] = kept[j] = True
            yield from t.filter(pa.array(kept)).to_batches()

    return map_batches(by_meeting(tagged), run, tagged.schema)


def family_edges(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs that also pass by their wide maps, as many as connect
    the entries of a meeting like all such pairs do (a spanning forest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "gid"):
            t = t.combine_chunks()
            c, wide = arrays_of(t, *MEETING), t.column("wide").to_pylist()
            label, edges = np.arange(t.num_rows), []
            for i, j, _ in passing_pairs(c, percent):
                apart = label[i] != label[j]
                for x, y in zip(i[apart].tolist(), j[apart].tolist()):
                    if label[x] != label[y] and may_link(c["n"][x], c["n"][y], map_distance(wide[x], wide[y]), percent):
                        label[label == label[x]] = label[y]
                        edges.append((c["cid"][x], c["cid"][y]))
            a, b = np.array(edges, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return map_batches(by_meeting(entries), run, "a long, b long")


def still_possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide maps still allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = [map_distance(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            ok = may_link(b.column(2).to_numpy(), b.column(3).to_numpy(), np.array(far, np.int64), percent)
            yield b.select([0, 1]).filter(pa.array(np.asarray(ok, bool)))

    def side(x: str) -> DataFrame:
        return classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "wide_a", "wide_b")
    return map_batches(both, run, "a long, b long")


# ---- verification ------------------------------------------------------------------------------

def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``sig, items`` of the wanted classes, from one more pass over the
    texts. A fixed-size filter over hashed text keys keeps other texts from
    being hashed and shuffled; the join on signatures is exact."""
    bucket = F.pmod("text_key", F.lit(1 << FILTER_BITS))
    used = wanted.select(bucket.alias("k")).distinct().toArrow()["k"].to_numpy()    # at most 2**FILTER_BITS
    table = np.zeros(1 << FILTER_BITS, bool)
    table[used] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, hit = ShingleSet(k), np.unpackbits(shared.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(hit[b.column(1).to_numpy()]))
            sets = [make(t) for t in blobs(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["sig", "items"])

    reread = docs.select("text", F.pmod(F.xxhash64("text"), F.lit(1 << FILTER_BITS)).alias("k"))
    rows = map_batches(reread, run, "sig binary, items binary")
    return rows.join(wanted.select("sig"), "sig", "left_semi").dropDuplicates(["sig"])


def difference(s: np.ndarray, t: np.ndarray) -> int:
    """Size of the symmetric difference of two sorted sets."""
    if len(s) > len(t):
        s, t = t, s
    at = np.searchsorted(t, s)
    at[at == len(t)] = 0
    return len(s) + len(t) - 2 * int((t[at] == s).sum())


def differences(pairs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """``a, b, na, nb, delta``: exact symmetric differences of pairs. Pairs
    meet the sets by signature, the key the sets are already dealt by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            delta = []
            for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                delta.append(difference(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(delta, pa.int64())],
                                             names=["a", "b", "na", "nb", "delta"])

    def named(x: str) -> DataFrame:
        return wanted.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"sig_{x}"))

    keyed = pairs.join(named("a"), "a").join(named("b"), "b")
    both = keyed.join(sets.select(F.col("sig").alias("sig_a"), F.col("items").alias("sa")), "sig_a") \
                .join(sets.select(F.col("sig").alias("sig_b"), F.col("items").alias("sb")), "sig_b") \
                .select("a", "b", "na", "nb", "sa", "sb")
    return map_batches(both, run, "a long, b long, na long, nb long, delta long")


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, k: int, name: str) -> DataFrame:
    ends = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    wanted = cut(classes.select("cid", "sig", "n", "text_key").join(ends, "cid"), "wanted")
    return cut(differences(pairs, sets_of(docs, wanted, k), wanted), name)


def class_links(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b``: links that connect the classes exactly as all links do."""
    lists = cut(shared_lists(postings(classes)), "lists")
    # an entry only needs its class's parity map from here on
    tagged = cut(meetings(lists, percent).join(classes.select("cid", "parity"), "cid"), "meetings")
    linked = may_link(F.col("na"), F.col("nb"), F.col("delta"), percent)

    near = cut(still_possible(nearest_pairs(tagged, percent), classes, percent), "near")
    first = verified(docs, near, classes, k, "differences")
    links = first.filter(linked).select("a", "b")
    labels = components(links).withColumnRenamed("v", "cid")

    named = (tagged.join(labels, "cid", "left").withColumn("comp", F.coalesce("root", "cid"))
             .select("gid", "side", "cid", "n", "pos", "comp", "parity"))
    left = cut(with_partners(named, percent), "partners")
    if left.isEmpty():
        return links
    families = components(family_edges(left.join(classes.select("cid", "wide"), "cid"), percent))
    if families.isEmpty():
        return links
    return links.unionByName(family_links(docs, families, labels, classes, k, percent))


def family_links(docs: DataFrame, families: DataFrame, labels: DataFrame, classes: DataFrame, k: int,
                 percent: int) -> DataFrame:
    """Links between the components within families (``v, root``), as many as
    connect them like all such links do. The sets of a family meet in blocks
    of about ``SET_BLOCK`` shingles, and every pair is decided where it meets:
    a row is made for a link that joins two components, for no other pair."""
    comps = labels.select("cid", F.col("root").alias("comp"))
    wanted = (classes.select("cid", "sig", "n", "text_key", "parity")
              .join(families.select(F.col("v").alias("cid"), F.col("root").alias("family")), "cid")
              .join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")))
    wanted = cut(wanted, "wanted")
    blocks = wanted.groupBy("family").agg(F.ceil(F.sum("n") / SET_BLOCK).alias("blocks"))
    placed = (wanted.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("cid"), "blocks"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    gid = F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other"))
    placed = placed.select("sig", gid.alias("gid"), side.alias("side"), "cid", "n", "comp", "parity")
    dealt = (placed.join(sets_of(docs, wanted, k), "sig").drop("sig")
             .repartition("gid").sortWithinPartitions("gid", "n", "cid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "gid"):
            t = t.combine_chunks()
            c = arrays_of(t, "gid", "side", "cid", "n", "comp")
            c["pos"] = np.zeros(t.num_rows, np.int64)       # whole sets meet, not places in a list
            links = joining_links(c, [np.frombuffer(x, np.uint64) for x in t.column("items").to_pylist()], percent)
            a, b = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    with batch_bytes(docs.sparkSession, 8 << 20):       # a row holds a set
        return cut(map_batches(dealt, run, "a long, b long"), "family-links")


def joining_links(c: dict[str, np.ndarray], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets of different components, without those whose
    components are already joined by others. A component's first set is the
    host of the others: where its distances to both sides decide a pair by
    the triangle inequality, the pair's own difference is not computed."""
    _, first, member = np.unique(c["comp"], return_index=True, return_inverse=True)
    host = first[member].tolist()
    label, links = c["comp"].copy(), []
    off: dict[int, int] = {}        # distance of a set to its host
    to_host: dict[int, int] = {}    # distance of the current set to the hosts it was compared with
    current = -1
    for i, j, _ in passing_pairs(c, percent):
        apart = label[i] != label[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist()):
            if label[x] == label[y]:
                continue
            if y != current:
                current, to_host = y, {}
            n1, n2, via = c["n"][x], c["n"][y], to_host.get(host[x])
            if via is not None:
                if x not in off:
                    off[x] = difference(sets[x], sets[host[x]])
                if not may_link(n1, n2, abs(via - off[x]), percent):
                    continue
            if via is None or not may_link(n1, n2, via + off[x], percent):
                delta = difference(sets[x], sets[y])
                if x == host[x]:
                    to_host[x] = delta
                if not may_link(n1, n2, delta, percent):
                    continue
            label[label == label[x]] = label[y]
            links.append((c["cid"][x], c["cid"][y]))
    return links


def jaccard_components(docs: DataFrame, *, k: int = 3, percent: int = 90, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, class_size`` of every row.

    ``component_id`` is the smallest id reachable by links, itself included;
    ``class_size`` counts the rows with exactly this shingle set. Null and
    empty texts have no shingles and link with nothing (``component_id`` is
    their own id). Repeated rows and rows with repeated or null ids are rows
    of their own; null ids are passed over when the smallest id is chosen.
    An empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    both = cut(signatures_and_sketch(docs, k), "signatures")
    members = both.filter("part is null").select("doc_id", "sig", F.col("n").alias("n_shingles"))
    rank = sketch_classes(both.filter("part is not null").select("part", "cells"))
    classes = classes_with_prefixes(docs, rank, k, percent)
    labels = components(class_links(docs, classes, k, percent))

    named = classes.select("cid", "sig", "min_doc").join(labels.withColumnRenamed("v", "cid"), "cid", "left") \
                   .withColumn("root", F.coalesce("root", "cid"))
    smallest = named.groupBy("root").agg(F.min("min_doc").alias("component_id"))
    size = members.filter("sig is not null").groupBy("sig").agg(F.count(F.lit(1)).alias("class_size"))
    # written first, so that both sides of the next join are plain and a hot class can be split
    by_sig = cut(named.join(smallest, "root").join(size, "sig").select("sig", "component_id", "class_size"), "named")
    found = members.filter("sig is not null").join(by_sig, "sig").drop("sig")
    alone = members.filter("sig is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
                                                 F.lit(1).cast("long").alias("class_size"))
    return found.select(*alone.columns).unionByName(alone)


def one_per_component(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose component holds a smaller id: of each
    group of near copies the row with the smallest id stays. Rows without
    shingles or with a null id stay, and rows repeating a kept id stay with
    it."""
    found = jaccard_components(docs, k=k, percent=percent, id_col=id_col, text_col=text_col)
    # an id can be repeated: it is lost only if no row of it is kept
    lost = cut(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("lost_id"))
               .agg(F.min((F.col("doc_id") != F.col("component_id")).cast("int")).alias("lost"))
               .filter("lost = 1").select("lost_id"), "lost")
    return docs.join(lost, docs[id_col].cast("long") == F.col("lost_id"), "left_anti")
