"""Ranked search against a plain version over all documents."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from huddlekit.llm import lexical_search

from . import plain

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = plain.SCHEMA + ", item_id long, score string, rank int, term string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        df = {t: sum(t in c for _, c in held) for t in wanted}
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in wanted}
        found = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r + 1, f[2], -f[0]) for r, f in enumerate(found[:k])]
    return sorted(out, key=lambda r: r[:2])


def run(spark, docs, items, k):
    table = spark.createDataFrame([(i, t, "en", "s", 1, 5, "x", 2, "y") for i, t in docs], SCHEMA)
    asked = spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, doc_id int, term string")
    return sorted((tuple(r) for r in lexical_search.ranked_search(table, asked, k=k).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocab = [f"w{j}" for j in range(60)] + ["Ünder", "ÉTÉ", "k2", "don't", "X_Y"]
    weights = [1 / (j + 1) for j in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.randrange(1, 80)))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]                       # a hot group of copies
    docs += [(3, docs[3][1]), (None, docs[4][1]), (None, docs[4][1]), (2000, None), (2001, ""), (2002, " -- \n"),
             (2003, "w5 " * 30000 + "w59")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "!!"), (33, "nowhere"), (None, "w1"), (34, "w1 w2"), (34, "w2 w3 W3")]
    return docs, items


def test_matches_a_plain_search(spark, tables):
    docs, items = tables
    assert run(spark, docs, items, 10) == plain_search(docs, items, 10)


def test_small_trees_many_blocks_of_items(spark, tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 37)
    monkeypatch.setattr(lexical_search, "LEAF", 3)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical_search, "FIRST_PART", 2)
    assert run(spark, docs, items, 50) == plain_search(docs, items, 50)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert run(spark, [], items, 5) == []
    assert run(spark, docs, [], 5) == []
    assert run(spark, [(1, None)], items, 5) == []


def documents_of(rows):
    import pyarrow as pa
    return lexical_search.documents_of(pa.table({
        "path": pa.array([np.array(t, ">u4").tobytes() for t, _, _ in rows], pa.binary()),
        "tfs": pa.array([np.array([f] * len(t), ">u4").tobytes() for t, f, _ in rows], pa.binary()),
        "m": pa.array([m for _, _, m in rows], pa.int64()), "doc_id": pa.array(range(len(rows)), pa.int64())}))


def test_nodes_hold_maxima_and_minima_of_what_lies_below():
    rng = random.Random(1)
    rows = [(sorted(rng.sample(range(30), rng.randrange(1, 12))), rng.randrange(1, 9), rng.randrange(50, 900))
            for _ in range(500)] + [([1, 2, 3], 4, 60)] * 400
    docs = documents_of(rows)
    seen, stack = 0, [lexical_search.tree(docs)]
    while stack:
        node = stack.pop()
        below = range(node.low, node.high)
        most = Counter()
        for k in below:
            a, b = docs.start[k], docs.start[k + 1]
            for t, f in zip(docs.terms[a:b], docs.tfs[a:b]):
                most[t] = max(most[t], f)
        assert dict(zip(node.terms, node.most)) == most
        assert node.least_m == min(docs.m[k] for k in below) and node.least_id == min(docs.ids[k] for k in below)
        if node.children:
            assert [c.low for c in node.children] + [node.high] == [node.low] + [c.high for c in node.children]
            stack.extend(node.children)
        else:
            seen += len(below)
    assert seen == len(rows)


def test_branches_are_left_out():
    """Documents of a branch that cannot win are not scored."""
    rows = [([0, 1, 5], 1, 500)] * 2000 + [([0, 2, 9], 3, 60)] * 50
    query = lexical_search.Query(np.array([1, 9]), np.array([0, 2]), np.full(10, 700))
    best = lexical_search.Best(query, 10, np.ones(1, np.int64), np.full(1, lexical_search.NO_ID))
    best.limit = 10
    scored = lexical_search.walk(documents_of(rows), query, best)
    assert scored < 300 and len(best.settle()) == 10
