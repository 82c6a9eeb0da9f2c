"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is sent down to a leaf.
A query visits leaves best-bin-first: a priority queue over nodes, ordered by
the inner product with the node's centre plus a share of its radius. The
number of leaves to visit is widened until sampled queries, whose exact
neighbours are found by a full scan, reach the wanted recall, all together
and nine in ten of them each by itself. A query goes on beyond that number
until its leaves hold ``k`` candidates. Candidates of the visited leaves are
sifted in single precision, with room for its rounding, and what is left is
scored exactly, in double precision.

Large leaves (many equal vectors, say) are cut into chunks by a hash, and
neighbouring chunks are held together by a task up to ``held_bytes``. A query
goes once to each such group of which it visits a leaf, not once to each leaf,
and comes back as one row with its ``k`` best there.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from huddlekit.llm.common import cut, drop_folder, map_batches, new_folder, whole_groups

QUERIES_AT_ONCE, ROWS_AT_ONCE = 256, 4096     # scored together
STRIPES = 16                                  # rows of which only the best is looked at first


@dataclass
class Tree:
    centres: list        # per node (dim,)
    radii: list          # per node, over the sample
    children: list       # per node a list of node numbers, empty for a leaf

    def plain(self):
        return np.array(self.centres), np.array(self.radii), [list(c) for c in self.children]

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """The leaves, and the nodes on the way to each below the root, the
        leaf itself repeated to the length of the longest way."""
        ways, todo = {}, [(0, [])]
        while todo:
            node, way = todo.pop()
            if not self.children[node]:
                ways[node] = way
            todo += [(c, [*way, c]) for c in self.children[node]]
        leaves, longest = sorted(ways), max(map(len, ways.values()))
        return np.array(leaves), np.array([ways[n] + [n] * (longest - len(ways[n])) for n in leaves]).reshape(len(leaves), -1)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Cluster of each row; seeds are far-apart rows."""
    seeds = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(seeds) < k and near.max() > 0:
        seeds.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[seeds[-1]]) ** 2).sum(axis=1))
    centres = x[seeds]
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        centres = np.stack([x[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
    return own


def fit_tree(x: np.ndarray, branch: int, leaf_rows: int) -> Tree:
    tree = Tree([], [], [])

    def add(rows: np.ndarray) -> int:
        node = len(tree.centres)
        centre = rows.mean(axis=0)
        tree.centres.append(centre)
        tree.radii.append(float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max())))
        tree.children.append([])
        if len(rows) > leaf_rows and tree.radii[node] > 1e-9:
            own = kmeans(rows, branch)
            parts = [rows[own == c] for c in np.unique(own)]
            if len(parts) > 1:
                tree.children[node] = [add(p) for p in parts]
        return node

    add(x)
    return tree


def assign(x: np.ndarray, centres: np.ndarray, children: list[list[int]]) -> np.ndarray:
    """The leaf each row reaches by the nearest centre of every level."""
    node, inner = np.zeros(len(x), np.int64), np.array([bool(c) for c in children])
    open_rows = np.arange(len(x)) if children[0] else np.empty(0, np.int64)
    while len(open_rows):
        for n in np.unique(node[open_rows]):
            rows = open_rows[node[open_rows] == n]
            kids = np.array(children[n])
            c = centres[kids]
            node[rows] = kids[((c ** 2).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)]
        open_rows = open_rows[inner[node[open_rows]]]
    return node


def visit_order(q: np.ndarray, centres: np.ndarray, radii: np.ndarray, paths: np.ndarray,
                share: float = 0.3) -> np.ndarray:
    """Per query the numbers of all leaves in the order in which a best-bin-first
    traversal meets them. That queue hands out a leaf when the least value on
    the way to it is the largest of those left, among leaves behind the same
    least value by the least value after it, and so on."""
    if not paths.shape[1]:
        return np.zeros((len(q), 1), np.int64)
    norm = np.sqrt((q * q).sum(axis=1))
    value = (q @ centres.T + share * norm[:, None] * radii)[:, paths]
    least = np.minimum.accumulate(value[:, :, ::-1], axis=2)[:, :, ::-1]
    return np.lexsort([-least[:, :, d] for d in reversed(range(paths.shape[1]))], axis=1)


def visits_to_hold(order: np.ndarray, rows: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Leaves of each query's order until they hold ``least`` rows (``rows``: by leaf)."""
    return np.minimum((np.cumsum(rows[order], axis=1) < least[:, None]).sum(axis=1) + 1, len(rows))


def matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.empty((0, 0))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.float64).reshape(len(column), -1)


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values of ``counts`` numbers each."""
    ends = np.append(0, np.cumsum(counts * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def exact_top(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """(query row, id, score) of each query's k best rows, own id left out.
    Rows within rounding of the k-th best are scored again by a fixed order
    of additions, so equal vectors get equal scores."""
    out = []
    s = q @ x.T
    s[query_ids[:, None] == ids[None, :]] = -np.inf
    for r in range(len(q)):
        row = s[r]
        if len(row) > k:
            low = np.partition(row, len(row) - k)[len(row) - k]
            at = np.flatnonzero((row >= low - 1e-9 * max(1.0, abs(low))) & np.isfinite(row))
        else:
            at = np.flatnonzero(np.isfinite(row))
        score = np.ascontiguousarray(x[at] * q[r]).sum(axis=1)
        best = np.lexsort((ids[at], -score))[:k]
        out.append((np.full(len(best), r), ids[at][best], score[best]))
    return [np.concatenate(c) if out else np.empty(0) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def usable_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v`` (doubles as bytes) of vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite.cast("boolean") & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    rows = rows.filter(F.size("v") == (sizes["d"] if sizes else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, dim = b.column(1).flatten().to_numpy(), len(b.column(1)[0]) if b.num_rows else 0
            x = flat.reshape(b.num_rows, dim) if dim else flat.reshape(0, 0)
            yield pa.RecordBatch.from_arrays([b.column(0), packed(x, np.full(len(x), dim))], names=["vec_id", "v"])
    return rows.mapInArrow(run, "vec_id long, v binary")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows by their largest number, so that no square leaves the range, and by their length."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def answers(ids: np.ndarray, x: np.ndarray, chunk: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be an answer to any query. Of equal vectors in a chunk only
    those of the ``k + 1`` smallest ids can: one id may be the query's own, and
    the others come before all that are left out."""
    key = x.view(np.uint64) @ (np.random.default_rng(1).integers(0, 1 << 63, x.shape[1], np.uint64) * 2 + 1)
    order = np.lexsort((ids, key, chunk))
    equal = (key[order[1:]] == key[order[:-1]]) & (chunk[order[1:]] == chunk[order[:-1]])
    pairs = np.flatnonzero(equal)
    for a in range(0, len(pairs), ROWS_AT_ONCE):
        p = pairs[a:a + ROWS_AT_ONCE]
        equal[p] = (x[order[p + 1]] == x[order[p]]).all(axis=1)
    fresh = np.append(True, ~equal)
    nth = np.cumsum(fresh | np.append(True, ids[order[1:]] != ids[order[:-1]]))
    nth -= nth[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]
    return np.sort(order[nth <= k])


class Held:
    """Vectors that a task holds, sorted by chunk, and the search in them for
    up to ``k`` answers."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, chunk: np.ndarray, chunks: int, k: int):
        rows = answers(ids, x, chunk, k)
        if len(rows) < len(ids):
            ids, x, chunk = ids[rows], x[rows], chunk[rows]
        self.ids, self.x = ids, x
        self.ends = np.searchsorted(chunk, np.arange(chunks), "right")
        self.by_id = np.argsort(ids, kind="stable")
        most = np.abs(x).max()
        longest = np.sqrt(max(((y / most) ** 2).sum(axis=1).max() for y in self._parts(x)))
        self.tiles = []                       # at most 1 long, filled up to whole stripes
        for y in self._parts(x):
            tile = np.zeros((-(-len(y) // STRIPES) * STRIPES, x.shape[1]), np.float32)
            tile[:len(y)] = y / most / longest
            self.tiles.append(tile)
        self.size = np.log2(most) + np.log2(longest)

    @staticmethod
    def _parts(x: np.ndarray) -> Iterator[np.ndarray]:
        return (x[lo:lo + ROWS_AT_ONCE] for lo in range(0, len(x), ROWS_AT_ONCE))

    def own(self, query_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of one id, by row."""
        ids = self.ids[self.by_id]
        lo, hi = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
        query = np.repeat(np.arange(len(query_ids)), hi - lo)
        row = self.by_id[np.arange(len(query)) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)]
        order = np.argsort(row, kind="stable")
        return query[order], row[order]

    def top(self, query_ids: np.ndarray, q: np.ndarray, want: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query, row, score) of each query's ``k`` best rows in the chunks it
        wants, best first, ties to the smaller id; rows of its own id left out."""
        small, floor = unit(q).astype(np.float32), np.full(len(q), -2, np.float32)
        # single sums are off by no more; scores beyond the range of doubles are all looked at
        size = self.size + np.log2(np.abs(q).max(axis=1))
        room = np.where((size > -960) & (size < 1000), 2.1 * (q.shape[1] + 8) * 2.0 ** -24, np.inf).astype(np.float32)
        own_query, own_row = self.own(query_ids)
        pool = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)]
        more: list[tuple[np.ndarray, ...]] = []
        waiting, space = 0, np.empty(len(q) * ROWS_AT_ONCE, np.float32)
        for t, tile in enumerate(self.tiles):
            lo, hi = t * ROWS_AT_ONCE, min((t + 1) * ROWS_AT_ONCE, len(self.x))
            first, last = np.searchsorted(self.ends, [lo, hi - 1], "right")
            here = want[:, first:last + 1]
            at = np.flatnonzero(here.any(axis=1))
            if not len(at):
                continue
            s = np.matmul(small[at], tile.T, out=space[:len(at) * len(tile)].reshape(len(at), -1))
            s[:, hi - lo:] = -np.inf
            low = floor[at]
            if (low == -2).any():             # else what is found in other chunks is dropped below
                for c in np.flatnonzero(~here[at].all(axis=0)):
                    start = self.ends[first + c - 1] if first + c else 0
                    s[~here[at, c], max(start - lo, 0):self.ends[first + c] - lo] = -np.inf
            a, z = np.searchsorted(own_row, [lo, hi])
            if z > a:
                place = np.full(len(q), -1)
                place[at] = np.arange(len(at))
                asks = place[own_query[a:z]]
                s[asks[asks >= 0], own_row[a:z][asks >= 0] - lo] = -np.inf
            striped = s.reshape(len(at), STRIPES, -1)
            best = striped.max(axis=1)
            if best.shape[1] >= k and (low == -2).any():       # k stripes have a row that good
                low = floor[at] = np.maximum(low, np.partition(best, best.shape[1] - k, axis=1)[:, -k] - room[at])
            r, stripe = np.divmod(np.flatnonzero(best >= low[:, None]), best.shape[1])
            found = striped[r, :, stripe]
            h, c = np.nonzero(found >= low[r][:, None])
            query, row = at[r[h]], lo + c * best.shape[1] + stripe[h]
            asked = want[query, np.searchsorted(self.ends, row, "right")]
            more.append((query[asked], row[asked], found[h, c][asked]))
            waiting += np.count_nonzero(asked)
            if waiting > 4 * k * len(q):
                pool, more, waiting = self._cut(pool, more, q, floor, room, k), [], 0
        query, row, _ = self._cut(pool, more, q, floor, room, k)
        return self._exact(query, row, q, k)

    def _cut(self, pool, more, q: np.ndarray, floor: np.ndarray, room: np.ndarray, k: int) -> list[np.ndarray]:
        """Drops what cannot be among the k best and raises each query's floor."""
        query, row, s = (np.concatenate(c) for c in zip(pool, *more))
        order = np.lexsort((-s, query))
        query, row, s = query[order], row[order], s[order]
        starts = np.searchsorted(query, np.arange(len(q)))
        kth = starts + k - 1
        full = np.flatnonzero(kth < np.append(starts[1:], len(query)))
        floor[full] = np.maximum(floor[full], s[kth[full]] - room[full])
        keep = s >= floor[query]
        query, row, s = query[keep], row[keep], s[keep]
        if len(query) > 2 * k * len(q):                        # many as good as the k-th
            exact_query, exact_row, _ = self._exact(query, row, q, k)
            mark = np.isin(query * len(self.x) + row, exact_query * len(self.x) + exact_row)
            query, row, s = query[mark], row[mark], s[mark]
        return [query, row, s]

    def _exact(self, query: np.ndarray, row: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        score = np.empty(len(query))
        for a in range(0, len(query), 16384):
            z = a + 16384
            score[a:z] = np.ascontiguousarray(self.x[row[a:z]] * q[query[a:z]]).sum(axis=1)
        order = np.lexsort((self.ids[row], -score, query))
        order = order[np.isfinite(score[order])]
        query, row, score = query[order], row[order], score[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[keep], row[keep], score[keep]


def layout(held: dict[int, int], chunk: int, most: int) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """(leaf, its first chunk, its chunks); the leaf of each chunk; the first
    chunk of each group, a group being neighbouring chunks of about ``most`` rows."""
    leaves, leaf_of, starts, rows = [], [], [], math.inf
    for leaf, n in sorted(held.items()):
        chunks = math.ceil(n / chunk)
        leaves.append((leaf, len(leaf_of), chunks))
        for c in range(chunks):
            if rows + n / chunks > most:
                starts.append(len(leaf_of))
                rows = 0
            leaf_of.append(leaf)
            rows += n / chunks
    return leaves, np.array(leaf_of), np.array(starts)


def top_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def least_hashes(vectors: DataFrame, order: Column, sample: int) -> pa.Table:
    """The ``sample`` rows of least hash. A task would hand on that many, so the
    larger part is left out before, unless repeated ids leave too few."""
    total = vectors.count()
    for share in (2 * sample / total if total else 1, 1):
        few = vectors.filter(order < F.lit(int(share * 2 ** 64) - 2 ** 63)) if share < 0.5 else vectors
        taken = few.orderBy(order, "vec_id").limit(sample).toArrow()
        if share >= 0.5 or taken.num_rows == sample:
            break
    return taken


def nearest_neighbours(table: DataFrame, is_query: Column, *, k: int = 20, sample: int = 20_000, branch: int = 8,
                       leaf_rows: int = 64, recall: float = 0.97, calibrate: int = 100, chunk: int = 4096,
                       held_bytes: int = 64 << 20, least_groups: int = 12, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (a
    condition on ``vec_id``) holds, the ``k`` rows of largest inner product
    found, nearest first, ties to the smaller id; fewer only where the table
    holds fewer candidates.

    Vectors that are null, zero, or hold nulls or non-finite numbers take no
    part, nor do rows with a null id or of another length than most. Rows
    that share the query's id are left out; a repeated query id is asked
    once (with the least of its vectors' bytes), repeated candidate rows are candidates each. Empty tables give an
    empty result. ``sample`` bounds the vectors the tree is fitted on and
    ``calibrate`` the queries its recall is measured with; every vector is
    indexed. A task holds about ``held_bytes`` of vectors, fewer where the table
    would make less than ``least_groups`` of them, but a chunk at least.
    """
    spark = table.sparkSession
    folder, usable = new_folder(spark, "vectors"), usable_vectors(table, id_col, vec_col)
    usable.write.option("compression", "zstd").parquet(folder)
    vectors = spark.read.schema(usable.schema).parquet(folder)
    order = F.xxhash64("vec_id")
    schema = "query_id long, rank int, vec_id long, score double"
    taken = least_hashes(vectors, order, sample)
    if not taken.num_rows:
        return spark.createDataFrame([], schema)
    fitted = fit_tree(matrix(taken["v"].combine_chunks()), branch, leaf_rows)
    tree = (*fitted.plain(), *fitted.paths())
    shared = spark.sparkContext.broadcast(tree)      # about 2 * sample / leaf_rows nodes

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, _, children = shared.value[:3]
        done = 0
        for b in batches:
            leaf = assign(matrix(b.column(1)), centres, children)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf), pa.array(np.arange(done, done + b.num_rows))],
                                             names=["vec_id", "v", "leaf", "nth"])
            done += b.num_rows

    placed = cut(vectors.mapInArrow(to_leaf, "vec_id long, v binary, leaf long, nth long"), "leaves")
    drop_folder(spark, folder)
    # rows of the query's own id are no candidates
    queries = cut(placed.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own")),
                  "queries")
    held = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    visits = calibrated_visits(placed, queries.orderBy(order).limit(calibrate).toArrow(), tree, held, k, recall)

    # at most one leaf per sampled vector
    most = min(held_bytes // (8 * tree[0].shape[1]), max(chunk, math.ceil(sum(held.values()) / least_groups)))
    leaves, leaf_of, starts = layout(held, chunk, most)
    parts = spark.sparkContext.broadcast((np.array([held.get(n, 0) for n in tree[3]]), np.searchsorted(tree[3], leaf_of),
                                          np.append(starts, len(leaf_of))))

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, _, _, paths = shared.value
        rows, leaf_at, ends = parts.value
        for b in (b.slice(a, QUERIES_AT_ONCE) for b in batches for a in range(0, b.num_rows, QUERIES_AT_ONCE)):
            met = visit_order(matrix(b.column(1)), centres, radii, paths)
            last = np.maximum(visits, visits_to_hold(met, rows, k + b.column(2).to_numpy()))
            seen = np.zeros(met.shape, bool)
            np.put_along_axis(seen, met, np.arange(met.shape[1]) < last[:, None], axis=1)
            for g, (lo, hi) in enumerate(zip(ends, ends[1:])):
                want = seen[:, leaf_at[lo:hi]]
                asks = np.flatnonzero(want.any(axis=1))
                if len(asks):
                    bits = np.packbits(want[asks], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(asks)), b.column(1).take(pa.array(asks)),
                         pa.array(np.full(len(asks), g)), packed(bits, np.full(len(asks), bits.shape[1]))],
                        names=["vec_id", "v", "group", "want"])

    asked = map_batches(queries, to_groups, "vec_id long, v binary, group long, want binary")
    group_of = np.searchsorted(starts, np.arange(len(leaf_of)), "right") - 1
    groups = spark.createDataFrame([(leaf, first, group_of[first:first + n].tolist()) for leaf, first, n in leaves],
                                   "leaf long, first long, groups array<long>")
    part = F.pmod(F.xxhash64("vec_id", "nth"), F.size("groups")).cast("int")
    stored = placed.join(F.broadcast(groups), "leaf").select(
        F.get("groups", part).alias("group"), (F.col("first") + part).alias("chunk"), "vec_id", "v")
    rows = stored.withColumn("want", F.lit(None).cast("binary")).unionByName(
        asked.select("group", F.lit(None).cast("long").alias("chunk"), "vec_id", "v", "want"))
    dealt = rows.repartition("group").sortWithinPartitions("group", F.asc_nulls_last("chunk"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, at, kept, own = parts.value[2], None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            group, is_asked = b.column(0).to_numpy(), np.asarray(b.column(1).is_null())
            changes = np.append(True, (group[1:] != group[:-1]) | (is_asked[1:] != is_asked[:-1]))
            for lo, hi in zip(np.flatnonzero(changes), np.append(np.flatnonzero(changes)[1:], len(group))):
                part, g = b.slice(lo, hi - lo), int(group[lo])
                if g != at:
                    at, kept, own = g, [], None
                ids, x = part.column(2).to_numpy(), matrix(part.column(3))
                if not is_asked[lo]:
                    kept.append((ids, x, part.column(1).to_numpy()))
                    continue
                first, chunks_here = int(ends[g]), int(ends[g + 1] - ends[g])
                if own is None and kept:
                    own_ids, own_x, own_chunk = (np.concatenate(c) for c in zip(*kept))
                    own, kept = Held(own_ids, own_x, own_chunk - first, chunks_here, k), []
                bits = np.frombuffer(b"".join(part.column(4).to_pylist()), np.uint8).reshape(len(ids), -1)
                for a in range(0, len(ids) if own else 0, QUERIES_AT_ONCE):
                    z = min(a + QUERIES_AT_ONCE, len(ids))
                    want = np.unpackbits(bits[a:z], axis=1, count=chunks_here).astype(bool)
                    query, row, score = own.top(ids[a:z], x[a:z], want, k)
                    counts = np.bincount(query, minlength=z - a)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a:z]), packed(own.ids[row], counts), packed(score, counts)],
                                                     names=["query_id", "ids", "scores"])

    found = map_batches(dealt, search, "query_id long, ids binary, scores binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "query_id"):
            t = t.combine_chunks()
            ids = np.frombuffer(b"".join(t["ids"].to_pylist()), np.int64)
            scores = np.frombuffer(b"".join(t["scores"].to_pylist()), np.float64)
            query = np.repeat(t["query_id"].to_numpy(), np.array([len(v) // 8 for v in t["ids"].to_pylist()], np.int64))
            order = np.lexsort((ids, -scores, query))
            query, ids, scores = query[order], ids[order], scores[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query) + 1
            keep = rank <= k
            yield pa.RecordBatch.from_arrays([pa.array(query[keep]), pa.array(rank[keep].astype(np.int32)), pa.array(ids[keep]),
                                              pa.array(scores[keep])], names=["query_id", "rank", "vec_id", "score"])

    return map_batches(found.repartition("query_id").sortWithinPartitions("query_id"), merge, schema)


def calibrated_visits(placed: DataFrame, asked: pa.Table, tree, held: dict[int, int], k: int, recall: float,
                      most_queries: float = 0.9) -> int:
    """Leaves to visit so that the sampled queries find at least ``recall``
    of their exact neighbours, all together and ``most_queries`` of them each
    by itself; all leaves when there is no sample."""
    centres, radii, _, leaf_nodes, paths = tree
    leaves = len(leaf_nodes)
    if not asked.num_rows:
        return leaves
    query_ids = asked["vec_id"].to_numpy()
    q = matrix(asked["v"].combine_chunks())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, leaf = b.column(0).to_numpy(), b.column(2).to_numpy()
            r, found, score = exact_top(ids, matrix(b.column(1)), query_ids, q, k)
            row = {}
            for i, n in zip(ids, leaf):
                row.setdefault(i, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[r.astype(np.int64)]), pa.array(found, pa.int64()), pa.array(score, pa.float64()),
                 pa.array([row[i] for i in found], pa.int64())], names=["query_id", "vec_id", "score", "leaf"])

    truth = top_rows(placed.mapInArrow(scan, "query_id long, vec_id long, score double, leaf long"), k) \
        .select("query_id", "leaf").toArrow()          # at most calibrate * k rows
    order = visit_order(q, centres, radii, paths)
    place = {int(i): dict(zip(leaf_nodes[met].tolist(), range(leaves))) for i, met in zip(query_ids, order)}
    # a query goes on until it has k candidates, so places up to there are reached by any number of visits
    rows = np.array([held.get(n, 0) for n in leaf_nodes.tolist()])
    first = dict(zip(query_ids.tolist(), visits_to_hold(order, rows, k + asked["own"].to_numpy()).tolist()))
    at: dict[int, list[int]] = {}
    for i, n in zip(truth["query_id"].to_pylist(), truth["leaf"].to_pylist()):
        p = place[i][n]
        at.setdefault(i, []).append(p + 1 if p >= first[i] else 1)
    if not at:
        return leaves

    def visits_for(visited: list[int], share: float) -> int:
        return sorted(visited)[max(0, math.ceil(share * len(visited) - 1e-9) - 1)]

    each = [visits_for(p, recall) for p in at.values()]
    return max(visits_for(sum(at.values(), []), recall), visits_for(each, most_queries))
