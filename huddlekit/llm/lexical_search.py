"""Ranked lexical search: a document FP-tree walked by branch and bound.

Every document is cut down to the terms that some item asks for, ordered from
the term held by most documents to the rarest. Documents whose ordered lists
begin alike share a path of a prefix tree. A node of the tree knows, over all
documents below it, the largest tf of each term and the least m (the length
part of the score), so that no document below can score more for an item than
those maxima give. The tree is walked depth first, for all items that are
still open at a node at once: an item leaves a subtree whose bound cannot beat
its k-th best document so far.

1. Items are dealt into blocks of about ``BLOCK_TERMS`` terms; the term table
   of a block is what every task holds.
2. One pass over the texts writes the restricted vectors and the lengths, from
   which Spark counts N, L and the document frequencies.
3. The vectors are range-partitioned by the first terms of their paths (a hot
   beginning is cut by id), so a task holds neighbouring branches of one tree; it builds and walks the tree
   in runs of ``BLOCK_DOCS`` documents and keeps k documents per item.
4. A small hashed part of the documents is searched first. Its k-th best
   document is a lower bound of the k-th best of all, with which the tasks
   start. It saves work and changes no result.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huddlekit.llm.common import blobs, cut

BLOCK_TERMS = 50_000    # (item, term) pairs of a block of items
BLOCK_DOCS = 8192       # documents of one tree
LEAF = 32               # documents of a leaf bucket
HEAD_TERMS = 6          # first terms of a path that decide its partition
FIRST_PART = 32         # one document in so many is searched first
NO_ID = 2**63 - 1       # stands for a null id: last of equal scores
# bytes of terms, A-Z lower-cased; the rest become blanks
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


class Query(NamedTuple):
    """Items of a block: item k asks for ``terms[start[k]:start[k + 1]]``, and
    term t weighs ``weight[t]``. Terms are numbered by falling document
    frequency."""
    terms: np.ndarray
    start: np.ndarray
    weight: np.ndarray

    def parts(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the given items, one after the other, and where each
        item's begin."""
        size = self.start[items + 1] - self.start[items]
        begin = np.cumsum(size) - size
        at = np.repeat(self.start[items] - begin, size) + np.arange(size.sum())
        return self.terms[at], begin


def gains(weight: np.ndarray, tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """What a term adds to a score, in whole numbers."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


class Node(NamedTuple):
    low: int                # documents low to high of the sorted run
    high: int
    children: list["Node"]  # empty: a leaf bucket
    terms: np.ndarray       # terms held below, each with its largest tf
    most: np.ndarray
    least_m: int
    least_id: int


class Documents(NamedTuple):
    """A run of documents sorted by path."""
    paths: list[bytes]      # four bytes, big-endian, per term
    terms: np.ndarray       # all documents' terms and tfs, one after the other
    tfs: np.ndarray
    start: np.ndarray
    m: np.ndarray
    ids: np.ndarray


def documents_of(batch: pa.Table) -> Documents:
    paths = batch.column("path").to_pylist()
    order = sorted(range(len(paths)), key=paths.__getitem__)
    paths = [paths[k] for k in order]
    tfs = batch.column("tfs").to_pylist()
    start = np.zeros(len(paths) + 1, np.int64)
    np.cumsum([len(p) // 4 for p in paths], out=start[1:])
    return Documents(paths, np.frombuffer(b"".join(paths), ">u4").astype(np.int64),
                     np.frombuffer(b"".join(tfs[k] for k in order), ">u4").astype(np.int64), start,
                     batch.column("m").to_numpy()[order], batch.column("doc_id").to_numpy()[order])


def shared(a: bytes, b: bytes) -> int:
    """Number of leading terms two paths share."""
    n = min(len(a), len(b)) // 4
    if a[:4 * n] == b[:4 * n]:
        return n
    x, y = np.frombuffer(a, ">u4", n), np.frombuffer(b, ">u4", n)
    return int(np.argmax(x != y))


def maxima(terms: list[np.ndarray], tfs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms with the largest tf of each."""
    t, f = np.concatenate(terms), np.concatenate(tfs)
    order = np.lexsort((f, t))
    t, f = t[order], f[order]
    last = np.append(t[1:] != t[:-1], True) if len(t) else np.empty(0, bool)
    return t[last], f[last]


def leaf(docs: Documents, low: int, high: int) -> Node:
    a, b = docs.start[low], docs.start[high]
    terms, most = maxima([docs.terms[a:b]], [docs.tfs[a:b]])
    return Node(low, high, [], terms, most, int(docs.m[low:high].min()), int(docs.ids[low:high].min()))


def branches(docs: Documents, low: int, high: int) -> list[tuple[int, int]]:
    """Runs of documents that go on alike after the path all of them share;
    neighbouring small runs are taken together."""
    depth = 4 * shared(docs.paths[low], docs.paths[high - 1])
    runs, begin = [], low
    for k in range(low + 1, high + 1):
        if k == high or docs.paths[k][depth:depth + 4] != docs.paths[begin][depth:depth + 4]:
            if runs and k - runs[-1][0] <= LEAF:
                runs[-1] = (runs[-1][0], k)
            else:
                runs.append((begin, k))
            begin = k
    return runs


def tree(docs: Documents) -> Node:
    """The prefix tree of a sorted run, with the maxima and minima below each
    node; built from the leaves up without recursion."""
    done: dict[tuple[int, int], Node] = {}
    todo = [(0, len(docs.paths), False)]
    split: dict[tuple[int, int], list[tuple[int, int]]] = {}
    while todo:
        low, high, ready = todo.pop()
        if ready:
            below = [done.pop(run) for run in split.pop((low, high))]
            terms, most = maxima([n.terms for n in below], [n.most for n in below])
            done[low, high] = Node(low, high, below, terms, most, min(n.least_m for n in below),
                                   min(n.least_id for n in below))
        elif high - low <= LEAF or docs.paths[low] == docs.paths[high - 1]:
            for a in range(low, high, 8 * LEAF):    # equal paths: cut into even buckets
                done[a, min(high, a + 8 * LEAF)] = leaf(docs, a, min(high, a + 8 * LEAF))
            if high - low > 8 * LEAF:
                split[low, high] = [(a, min(high, a + 8 * LEAF)) for a in range(low, high, 8 * LEAF)]
                todo.append((low, high, True))
        else:
            split[low, high] = branches(docs, low, high)
            todo.append((low, high, True))
            todo.extend((a, b, False) for a, b in split[low, high])
    return done[0, len(docs.paths)]


class Best:
    """The k best documents of each item so far, and the floor a further one
    has to beat: a score, and the largest id that still wins at that score."""

    def __init__(self, query: Query, k: int, score: np.ndarray, doc_id: np.ndarray):
        self.k, self.floor, self.floor_id = k, score.copy(), doc_id.copy()
        self.rows = [np.empty((0, 3), np.int64)]
        self.waiting, self.limit = 0, max(4096, (len(query.start) - 1) * k)

    def beaten_by(self, items: np.ndarray, score: np.ndarray, doc_id: np.ndarray | int) -> np.ndarray:
        floor = self.floor[items]
        return (score > floor) | ((score == floor) & (doc_id <= self.floor_id[items]))

    def add(self, items: np.ndarray, score: np.ndarray, doc_id: np.ndarray) -> None:
        self.rows.append(np.column_stack([items, score, doc_id]))
        self.waiting += len(items)
        if self.waiting > self.limit:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate(self.rows)
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])) if len(rows) else np.empty(0, np.int64)
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        last = rows[place == self.k - 1]
        self.floor[last[:, 0]], self.floor_id[last[:, 0]] = last[:, 1], last[:, 2]
        self.rows, self.waiting = [rows[place < self.k]], 0
        return self.rows[0]


def walk(docs: Documents, query: Query, best: Best) -> int:
    """Walks the tree of a run depth first; returns how many (document, item)
    pairs were scored."""
    bound = np.zeros(len(query.weight), np.int64)
    scored = 0

    def reach(node: Node, items: np.ndarray) -> np.ndarray:
        """Most that a document below can score for each item."""
        bound[node.terms] = gains(query.weight[node.terms], node.most, node.least_m)
        wanted, begin = query.parts(items)
        out = np.add.reduceat(bound[wanted], begin) if len(wanted) else np.empty(0, np.int64)
        bound[node.terms] = 0
        return out

    stack = [(tree(docs), np.arange(len(query.start) - 1), None)]
    while stack:
        node, items, most = stack.pop()
        if most is None:
            most = reach(node, items)
        items = items[best.beaten_by(items, most, node.least_id)]
        if not len(items):
            continue
        if node.children:
            below = [(child, items, reach(child, items)) for child in node.children]
            below.sort(key=lambda entry: int((entry[2] - best.floor[items]).max()))
            stack.extend(below)
            continue
        wanted, begin = query.parts(items)
        for k in range(node.low, node.high):
            a, b = docs.start[k], docs.start[k + 1]
            own = docs.terms[a:b]
            bound[own] = gains(query.weight[own], docs.tfs[a:b], docs.m[k])
            score = np.add.reduceat(bound[wanted], begin)
            bound[own] = 0
            won = best.beaten_by(items, score, docs.ids[k])
            if won.any():
                best.add(items[won], score[won], np.full(np.count_nonzero(won), docs.ids[k]))
        scored += len(items) * (node.high - node.low)
    return scored


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: n counts all
    its terms, the lists hold those of the vocabulary."""
    table = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = table.value
        for b in batches:
            ids, ns, terms, tfs = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), blobs(b.column(1))):
                words = terms_of(text or b"")
                if words:
                    held = Counter(filter(number.__contains__, words))
                    ids.append(i)
                    ns.append(len(words))
                    terms.append([number[t] for t in held])
                    tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut(src.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "restricted")


def paths(vectors: DataFrame, rank: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``path, tfs, m, doc_id`` of the documents that hold a term of the
    vocabulary: its terms in order of ``rank``, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [NO_ID if i is None else i for i in b.column(0).to_pylist()]
            path, tfs, m, kept = [], [], [], []
            held, times = b.column(2), b.column(3)
            at = held.offsets.to_numpy()
            flat, counts = rank[held.values.to_numpy()], times.values.to_numpy()
            for k, n in enumerate(b.column(1).to_pylist()):
                terms = flat[at[k]:at[k + 1]]
                if len(terms):
                    order = np.argsort(terms)
                    path.append(terms[order].astype(">u4").tobytes())
                    tfs.append(counts[at[k]:at[k + 1]][order].astype(">u4").tobytes())
                    m.append(50 + 50 * n * n_docs // n_terms)
                    kept.append(ids[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(path, pa.binary()), pa.array(tfs, pa.binary()), pa.array(m, pa.int64()),
                 pa.array(kept, pa.int64())], names=["path", "tfs", "m", "doc_id"])
    return vectors.filter("size(terms) > 0").mapInArrow(run, "path binary, tfs binary, m long, doc_id long")


def best_of(documents: DataFrame, query: Query, k: int, floor: np.ndarray, floor_id: np.ndarray) -> DataFrame:
    """``item, score, doc_id``: the k best documents of each item, from the
    trees of every partition."""
    state = documents.sparkSession.sparkContext.broadcast((*query, floor, floor_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, score, doc_id = state.value
        asked = Query(*parts)
        best = Best(asked, k, score, doc_id)

        def search(part: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(part)
            for a in range(0, table.num_rows, BLOCK_DOCS):
                walk(documents_of(table.slice(a, BLOCK_DOCS).combine_chunks()), asked, best)

        waiting: list[pa.RecordBatch] = []
        for b in batches:
            waiting.append(b)
            if sum(w.num_rows for w in waiting) >= BLOCK_DOCS:
                search(waiting)
                waiting = []
        if any(w.num_rows for w in waiting):
            search(waiting)
        rows = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, c], pa.int64()) for c in range(3)],
                                         names=["item", "score", "doc_id"])
    found = documents.mapInArrow(run, "item long, score long, doc_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, pairs: list[tuple], k: int, id_col: str, text_col: str) -> DataFrame | None:
    """Results of one block of items, given as (item, term) pairs."""
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, t in pairs}))}
    items = sorted({i for i, _ in pairs})
    place = {i: n for n, i in enumerate(items)}
    vectors = restricted_vectors(docs, vocabulary, id_col, text_col)
    totals = vectors.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    if not totals["n"]:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    # at most one row per term of the block
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow().to_pylist():
        df[row["t"]] = row["count"]
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weight = np.zeros(len(df), np.int64)
    weight[rank] = [math.floor(1000 * math.log((2 * totals["n"] + 2) / (2 * int(d) + 1))) for d in df]
    asked = np.array(sorted((place[i], rank[vocabulary[t]]) for i, t in pairs), np.int64)
    start = np.searchsorted(asked[:, 0], np.arange(len(items) + 1))
    query = Query(asked[:, 1].copy(), start, weight)
    documents = paths(vectors, rank, int(totals["n"]), int(totals["l"]))
    floor, floor_id = np.ones(len(items), np.int64), np.full(len(items), NO_ID)
    part = documents.filter(F.pmod(F.xxhash64("doc_id", "path"), F.lit(FIRST_PART)) == 0)
    # one row per item of the block
    for row in best_of(part, query, k, floor, floor_id).filter(F.col("rank") == k).collect():
        floor[row["item"]], floor_id[row["item"]] = row["score"], row["doc_id"]
    # the bounds are drawn from the first terms of sampled paths, not from whole paths
    placed = (documents.withColumn("salt", F.monotonically_increasing_id())
              .withColumn("head", F.substring("path", 1, 4 * HEAD_TERMS))
              .repartitionByRange("head", "doc_id", "salt").drop("head", "salt").sortWithinPartitions("path"))
    best = best_of(placed, query, k, floor, floor_id)
    names = docs.sparkSession.createDataFrame(list(enumerate(items)), "item long, item_id long")
    return best.join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"),
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of highest score
    above 0 for each item, equal scores by smaller ``doc_id``.

    Rows of ``items`` with one id are one item that asks for the terms of all
    of them; items without id, text or terms get no rows. Every row of
    ``docs`` is a document of its own, also with a repeated id; a null id
    comes last among equal scores, and null or empty texts count nowhere.
    Texts of any length are counted whole. An empty table gives no rows.

    A task holds the terms of a block of items (about ``BLOCK_TERMS``, or one
    item that is longer), one tree of ``BLOCK_DOCS`` documents, and k
    documents per item."""
    spark = docs.sparkSession

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t) for i, text in zip(b.column(0).to_pylist(), blobs(b.column(1)))
                    for t in set(terms_of(text or b""))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["item", "term"])
    pairs = cut(items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
                .filter("item is not null").mapInArrow(ask, "item long, term binary").distinct(), "item-terms")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    found = []
    for block in range(blocks):
        mine = pairs if blocks == 1 else pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        table = mine.toArrow()      # about BLOCK_TERMS rows
        own = list(zip(table["item"].to_pylist(), table["term"].to_pylist()))
        if own:
            best = search_block(docs, own, k, id_col, text_col)
            found += [] if best is None else [best if blocks == 1 else cut(best, "found")]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


#: DuckDB SQL of ``ranked_search(documents, benchmark)``.
SEARCH_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
held AS (SELECT doc_id, row_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM held),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
tf AS (
  SELECT row_id, term, count(*)::BIGINT AS tf FROM (SELECT row_id, unnest(w) AS term FROM held)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, totals GROUP BY term, n_docs),
size AS (SELECT row_id, doc_id, 50 + (50 * n * n_docs) // n_terms AS m FROM held, totals),
scores AS (
  SELECT item_id, doc_id, row_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (row_id)
  GROUP BY item_id, doc_id, row_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
           AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
