"""Operators against plain versions on small tables, with nulls, empty and
long texts, repeated rows, empty tables and clashing column names."""
import base64
import hashlib
import heapq
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddlekit.llm import (decontamination, hmm, jaccard_join, license_scan, mixing, sharding, token_counts, toxicity,
                           vector_tree, warc)

from . import plain

RNG = random.Random(5)
VOCAB = [a + b for a in ("ka", "lo", "mi", "ne", "tu", "ra") for b in ("bel", "dor", "fin", "gus", "hal", "jem")]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(9)
    rows, i = [], 0
    for n in (1, 2, 3, 30, 60, 120, 400):
        base = [rng.choice(VOCAB) for _ in range(n)]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, n // 15) + 1)):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            rows.append((i, " ".join(w), f"s{i % 2}"))
            i += 1
    rows += [(900, None, "s0"), (901, "", None), (902, " \t\n ", "s1"), (903, rows[20][1].upper(), "s0"),
             (20, rows[20][1], "s0"), (904, " ".join(["ka"] * 3000), "s1")]
    return rows


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, near_rows, k, percent):
    docs = plain.documents(spark, near_rows).withColumn("sig", F.lit(1)).withColumn("cid", F.lit(2))
    got = sorted(tuple(r)[:3] for r in jaccard_join.jaccard_components(docs, k=k, percent=percent).collect())
    assert got == plain.component_ids([(i, t) for i, t, _ in near_rows], k, percent)


def test_jaccard_long_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rng = random.Random(3)
    base = [rng.choice(VOCAB) + str(j) for j in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w), "s"))
    got = sorted(tuple(r)[:3] for r in jaccard_join.jaccard_components(plain.documents(spark, rows)).collect())
    assert got == plain.component_ids([(i, t) for i, t, _ in rows], 3, 90)


def test_jaccard_rows_follow_the_entries_not_the_pairs(spark, monkeypatch):
    """A large group of texts just too unlike to link, with a few links in it."""
    made = {}

    def counted(df, name, write=jaccard_join.cut):
        out = write(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out
    monkeypatch.setattr(jaccard_join, "cut", counted)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", 10_000, raising=False)      # families meet in several blocks
    rng = random.Random(12)
    base = [f"{rng.choice(VOCAB)}{j}" for j in range(300)]
    rows = []
    for i in range(200):
        w = list(base)
        for j in rng.sample(range(5, 290, 6), 5):
            w[j] = f"x{i}y{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(t.split()[:-1])) for i, t in rows[:90:9]]
    got = sorted(tuple(r)[:3] for r in
                 jaccard_join.jaccard_components(plain.documents(spark, [(*r, "s") for r in rows]), k=5, percent=80).collect())
    assert got == plain.component_ids(rows, 5, 80)
    assert len({c for _, _, c in got}) > 150                    # it stays many components
    read = {"signatures", "classes", "lists", "meetings", "partners"}
    assert max(n for name, n in made.items() if name not in read) <= 5 * len(rows), made
    assert made["family-links"] < len(rows)


def test_jaccard_links_within_a_block():
    """Hosts decide as the differences do, and only joining links come back."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 400, np.uint64)
    sets = []
    for _ in range(60):
        s = base.copy()
        s[rng.integers(0, 400, rng.integers(5, 30))] = rng.integers(0, 2**64, 1, np.uint64)
        sets.append(np.unique(s))
    sets.sort(key=len)
    links = {(a, b) for a in range(60) for b in range(a + 1, 60)
             if jaccard_join.may_link(len(sets[a]), len(sets[b]), len(np.setxor1d(sets[a], sets[b])), 90)}
    for comp in (np.arange(60), np.arange(60) // 3 * 3):
        c = {"gid": np.zeros(60, np.int64), "side": np.zeros(60, np.int64), "cid": np.arange(60), "comp": comp,
             "n": np.array([len(s) for s in sets]), "pos": np.zeros(60, np.int64),
             "parity": np.frombuffer(b"".join(map(jaccard_join.parity_map, sets)), np.uint64).reshape(-1, 4)}
        got = jaccard_join.joining_links(c, sets, 90)

        def labels(pairs):
            label = comp.copy()
            for a, b in pairs:
                label[label == label[a]] = label[b]
            return {frozenset(np.flatnonzero(label == x).tolist()) for x in label}
        assert set(got) <= links and len(got) < len(set(comp.tolist()))
        assert labels(got) == labels(links)


def test_parity_maps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 380, 420, 3900, 4100):
        s = np.unique(rng.integers(0, 2**64, n, np.uint64))
        t = np.unique(np.append(s[: int(n * 0.95)], rng.integers(0, 2**64, n // 10, np.uint64)))
        delta = len(np.setxor1d(s, t))
        assert jaccard_join.map_distance(jaccard_join.wide_map(s), jaccard_join.wide_map(t)) <= delta


def test_empty_tables(spark):
    docs = plain.documents(spark, [])
    assert jaccard_join.jaccard_components(docs).count() == 0
    assert mixing.mix_sources(docs).count() == 0
    assert sharding.pack_shards(docs).count() == 0
    assert license_scan.license_labels(docs).count() == 0
    assert hmm.hmm_scores(docs, F.col("doc_id") % 5 == 1, rounds=1).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, bench).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(docs, labels, F.lit(True))[0].size == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_tree.nearest_neighbours(vectors, F.col("vec_id") == 0).count() == 0
    assert warc.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_poisson_inverse(spark):
    rows = [(u, r) for u in (0.0, 0.2, 0.5, 0.9, 0.999, 0.9999999) for r in (0.0, 0.01, 0.7, 1.0, 3.5, 40.0, 900.0)]
    got = spark.createDataFrame(rows, "u double, r double").select(
        "u", "r", mixing.poisson_inverse(F.col("u"), F.col("r")).alias("k")).collect()
    for u, r, k in got:
        total, want = 0.0, 0
        while r > 0:
            total += math.exp(want * math.log(r) - r - math.lgamma(want + 1))
            if total > u:
                break
            want += 1
        assert k == want, (u, r)


def test_mix_repeats_documents_by_rate(spark):
    rows = [(i, prose(5), "big" if i < 900 else None) for i in range(1000)] + [(None, "x", "big"), (5, None, "big")]
    docs = plain.documents(spark, rows).withColumn("mix_copy", F.lit("clash"))
    weights = spark.createDataFrame([("big", 1.0), (None, 1.0)], "source string, weight double")
    out = mixing.mix_sources(docs, weights).collect()
    copies = Counter((r["doc_id"], r["source"]) for r in out)
    by = Counter("big" if r["source"] else "small" for r in out)
    assert 300 < by["big"] < 700 and 300 < by["small"] < 700
    for r in out:
        assert 0 <= r["mix_copy"] < r["mix_copies"] and 0 <= r["mix_order"] < 1
        assert copies[(r["doc_id"], r["source"])] % r["mix_copies"] == 0
    again = mixing.mix_sources(docs, weights).collect()
    assert Counter((r["doc_id"], r["mix_copy"]) for r in out) == Counter((r["doc_id"], r["mix_copy"]) for r in again)


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 200_000
    rows = [(7, "http://B.example.com/x?q=1#f", "same"), (3, "http://b.example.com/x?q=1", "same"), (9, None, None),
            (4, "not a url", ""), (5, "https://u@b.example.com:8080/a b\r\n", big), (3, "http://b.example.com/x?q=1", "same"),
            (None, "http://b.example.com/", "alone")] + [(100 + i, "http://hot.example.com/", f"p{i % 300}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    out = warc.archive_round_trip(pages.repartition(5), payloads=True).collect()
    assert len(out) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = i is not None and first[h or ""] != i
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
              first[h or ""] if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in out) == want
    assert {r["payload"].decode() for r in out if r["page_id"] == 5} == {big}
    assert warc.url_key("http://B.example.com/x?q=1#f") == "com,example,b)/x?q=1"


def all_paths(seq, start, trans, emit):
    total = 0.0
    for path in itertools.product(range(len(start)), repeat=len(seq)):
        p = start[path[0]] * emit[path[0], seq[0]]
        for a, b, c in zip(path, path[1:], seq[1:]):
            p *= trans[a, b] * emit[b, c]
        total += p
    return math.log(total)


def test_forward_is_exact(monkeypatch):
    monkeypatch.setattr(hmm, "STRETCH", 3)      # longer texts are chained from stretches
    rng = np.random.default_rng(2)
    start, trans, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3)
    seqs = [rng.integers(0, 5, n).astype(np.int16) for n in (1, 2, 3, 4, 7, 8, 1)]
    got = hmm.forward_log(seqs, start, trans, emit)
    assert np.allclose(got, [all_paths(s, start, trans, emit) for s in seqs], rtol=1e-10)


def test_expected_counts_do_not_depend_on_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    start, trans, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3)
    seqs = [rng.integers(0, 5, n).astype(np.int16) for n in (1, 2, 9, 30, 31, 4)]
    found = []
    for stretch in (4, 1000):
        monkeypatch.setattr(hmm, "STRETCH", stretch)
        first, moves, shown = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
        hmm.expected_counts(seqs, start, trans, emit, first, moves, shown)
        found.append((first, moves, shown))
        assert np.isclose(shown.sum(), sum(map(len, seqs))) and np.isclose(moves.sum(), sum(len(s) - 1 for s in seqs))
    assert all(np.allclose(a, b) for a, b in zip(*found))


def test_hmm_transitions_take_states_first():
    rng = np.random.default_rng(2)
    here, ahead, trans = rng.random((3, 50)), rng.random((3, 50)), rng.random((3, 3))
    want = np.zeros((3, 3))
    for n in range(50):
        joint = here[:, n, None] * trans * ahead[:, n]
        want += joint / joint.sum()
    assert np.allclose(hmm.transitions(here, ahead, trans), want, rtol=1e-12)


def test_hmm_scores(spark):
    rng = random.Random(8)
    langs = [[w for w in VOCAB if w[0] in "kl"], [w for w in VOCAB if w[0] in "nt"]]
    rows = [(i, " ".join(rng.choice(langs[i % 2]) for _ in range(40)), "s") for i in range(120)]
    rows += [(500, None, "s"), (501, "", "s"), (502, "never seen before", "s"), (None, rows[0][1], "s"), (3, rows[3][1], "s")]
    out = hmm.hmm_scores(plain.documents(spark, rows), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1,
                         table=10).collect()     # a small table, so that most counts come by the join
    train = [t for i, t, _ in rows if i is not None and plain.crc(i) % 5 != 1]
    counts = Counter(w for t in train for w in [*plain.words(t), b"\n"])
    n, v = sum(counts.values()), len(counts)
    texts = Counter()
    for r in out:
        assert r["train_tokens"] == n
        texts[(r["doc_id"], r["n_tokens"])] += 1
    assert texts == Counter((i, len(plain.words(t)) + 1) for i, t, _ in rows)
    by_id = {i: t for i, t, _ in rows}
    for r in out:
        w = [*plain.words(by_id[r["doc_id"]]), b"\n"]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["n_known"] == sum(counts[x] > 0 for x in w)
        assert r["score"] < 0
    held = [r for r in out if r["held_out"] and r["n_tokens"] > 10]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_local_alignment():
    rng = np.random.default_rng(6)
    items = [rng.integers(0, 4, n).astype(np.uint32) for n in (1, 5, 9, 12)]
    texts = [rng.integers(0, 4, n).astype(np.uint32) for n in (3, 20, 7, 30)]
    best, end = decontamination.local_alignment(items, texts)
    assert list(best) == [plain_alignment(list(a), list(b)) for a, b in zip(items, texts)]
    assert all(1 <= e <= len(t) for e, t, b in zip(end, texts, best) if b)


def test_contaminated(spark):
    rng = random.Random(4)
    item = [f"q{rng.randrange(10**6)}" for _ in range(30)]
    edited = [w for k, w in enumerate(item) if k % 9]
    edited[4] = "other"
    rows = [(1, prose(200, rng) + ". " + " ".join(item).upper() + "! " + prose(5000, rng), "s"),
            (2, prose(20, rng) + " " + " ".join(edited), "s"), (3, prose(300, rng), "s"), (4, None, "s"), (5, "", "s"),
            (6, " ".join(item[:6]) + " " + prose(40, rng), "s"), (None, " ".join(item), "s"), (1, " ".join(item), "s")]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, None), (12, ""), (None, "one two"), (10, " ".join(item))],
                                  "item_id long, text string").withColumn("doc_id", F.lit(1))
    docs = plain.documents(spark, rows).withColumn("item", F.lit(0))
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect())
    assert got == Counter({(1, 10): 4, (2, 10): 2, (None, 10): 2})
    left = decontamination.without_contaminated(docs, bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6] and left.columns == docs.columns


def test_contaminated_edited_copies_beside_an_exact_one(spark):
    rng = random.Random(12)
    items = [[f"q{rng.randrange(10**6)}" for _ in range(n)] for n in (3, 4, 5, 8, 20, 20, 20, 40)]
    items.append(["q1", "q2"] * 8)
    texts = [" ".join(w) for w in items] * 2       # exact copies, which hold every gram
    for w in items:
        for share in (0.1, 0.15, 0.2, 0.25, 0.33):
            for _ in range(6):
                edited = []
                for x in w:
                    kind = rng.choice("sid") if rng.random() < share else "k"
                    edited += {"k": [x], "s": ["other"], "i": [x, "new"], "d": []}[kind]
                texts.append(prose(rng.randrange(30), rng) + " " + " ".join(edited) + " " + prose(rng.randrange(30), rng))
        texts.append(" ".join(x if k % 3 else "other" for k, x in enumerate(w)))       # no three words in a row
        texts.append(" new ".join(w))                                                  # no two
        half = len(w) // 2
        texts.append(" ".join(w[:half] + ["new"] * max(0, half - 1) + w[half:]))        # one long interruption
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    docs = plain.documents(spark, [(k, t, "s") for k, t in enumerate(texts)])
    want = {}
    for d, t in enumerate(texts):
        for k, w in enumerate(items):
            score = plain_alignment(w, t.split()) / (2 * len(w))
            if score >= 0.5:
                want[(d, k)] = score
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(docs, bench).collect()}
    assert got == pytest.approx(want) and len(want) > 200


def test_seeds_are_counted_in_all_texts(spark):
    """The place that most texts hold is no seed, whichever texts hold it."""
    common = spark.range(200).select(F.concat(F.lit("q1 q2 other"), "id").alias("t")).where("pmod(xxhash64(t), 8) <> 0")
    rows = [(1, "q1 q2 q3 q4 q5 q6", "s")] + [(k, r["t"], "s") for k, r in enumerate(common.collect(), 2)]
    bench = spark.createDataFrame([(10, "q1 q2 q3 q4 q5 q6")], "item_id long, text string")
    got = decontamination.contaminated(plain.documents(spark, rows), bench).collect()
    assert [(r["doc_id"], r["similarity"], r["seeds"]) for r in got] == [(1, 1.0, 7)]


def test_vector_tree_finds_exact_neighbours_of_small_tables(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [float("nan")] * 8, 0), (1003, [None] + [1.0] * 7, 0),
             (1004, [1.0], 0), (1005, [float("inf")] + [1.0] * 7, 0), (None, [1.0] * 8, 0), (20, [float(v) for v in x[20]], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int")
    out = vector_tree.nearest_neighbours(table, F.col("vec_id") % 20 == 0, k=20, leaf_rows=16, recall=1.0, calibrate=50,
                                         chunk=10).collect()
    ids = np.append(np.arange(400), 20)
    full = np.concatenate([x, x[20:21]]).astype(float)
    for q in range(0, 400, 20):
        s = np.ascontiguousarray(full * full[q]).sum(axis=1)
        keep = ids != q
        best = np.lexsort((ids[keep], -s[keep]))[:20]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q)
        assert [g[1] for g in got] == list(ids[keep][best])
        assert np.allclose([g[2] for g in got], s[keep][best])


def test_vector_tree_fills_every_answer_beside_a_hot_group(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1050, 8))
    x[:400] = x[0]                              # a hot group
    for g in range(20):
        x[400 + 25 * g:425 + 25 * g] = x[400 + 25 * g]
    x[900:] *= 4                                # far apart: leaves of few rows
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(905, [1.0] * 8)],
                                  "vec_id long, embedding array<double>")
    for recall in (0.5, 0.97):                  # 0.5: a single leaf is enough for most
        out = vector_tree.nearest_neighbours(table, F.col("vec_id") % 5 == 0, k=20, leaf_rows=16, recall=recall).collect()
        assert Counter(r["query_id"] for r in out) == Counter({q: 20 for q in range(0, 1050, 5)})
    ids, full, share = np.append(np.arange(1050), 905), np.concatenate([x, np.ones((1, 8))]), []
    for q in range(0, 1050, 5):
        if q == 905:                            # asked by one of its two vectors
            continue
        s = np.where(ids == q, -np.inf, full @ x[q])
        low = np.sort(s)[-20] - 1e-9
        share.append(sum(r["score"] >= low for r in out if r["query_id"] == q) / 20)
    assert np.quantile(share, 0.15) >= 0.97 and np.mean(share) >= 0.95


def shuffled_rows(plan) -> int:
    """Rows written by all shuffles of a plan that has run."""
    rows = plan.metrics().get("shuffleRecordsWritten").get().value() if "ShuffleExchange" in plan.getClass().getName() else 0
    if hasattr(plan, "plan") and "QueryStage" in plan.getClass().getName():
        return rows + shuffled_rows(plan.plan())
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        return rows + shuffled_rows(plan.executedPlan())
    kids = plan.children()
    return rows + sum(shuffled_rows(kids.apply(i)) for i in range(kids.size()))


def test_vector_tree_moves_no_row_for_each_query_and_leaf(spark):
    """No leaf can be left out of vectors without any grouping; a query's copies
    and answers must not grow with the leaves all the same."""
    x = np.random.default_rng(5).normal(size=(2000, 24))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = vector_tree.nearest_neighbours(table, F.col("vec_id") % 10 == 0, k=10, leaf_rows=16, recall=1.0)
    got = out.collect()
    s = x[::10] @ x.T
    s[np.arange(200), np.arange(0, 2000, 10)] = -np.inf
    best = np.argsort(-s, axis=1)[:, :10]
    share = np.mean([len({r["vec_id"] for r in got if r["query_id"] == 10 * q} & set(best[q].tolist())) / 10 for q in range(200)])
    assert len(got) == 2000 and share >= 0.95
    # vectors, queries to at most 12 groups and back; over 100 leaves would be 20,000 rows and more
    assert 2000 < shuffled_rows(out._jdf.queryExecution().executedPlan()) <= 2000 + 2 * 12 * 200


def test_vector_tree_visits_leaves_as_a_queue_of_nodes_does():
    rng = np.random.default_rng(7)
    for dim, rows in ((2, 30), (6, 3000), (40, 4000)):
        x = rng.normal(size=(rows, dim))
        x[:rows // 5] *= 3
        fitted = vector_tree.fit_tree(x, 8, 32)
        (centres, radii, children), (leaves, paths) = fitted.plain(), fitted.paths()
        held = np.bincount(vector_tree.assign(x, centres, children), minlength=len(centres))[leaves]
        q = rng.normal(size=(40, dim))
        order = vector_tree.visit_order(q, centres, radii, paths)
        counts = vector_tree.visits_to_hold(order, held, np.full(40, 50))
        for i in range(40):
            heap, met = [(0.0, 0)], []
            while heap:
                node = heapq.heappop(heap)[1]
                if not children[node]:
                    met.append(node)
                for c in children[node]:
                    heapq.heappush(heap, (-float(centres[c] @ q[i] + 0.3 * np.sqrt(q[i] @ q[i]) * radii[c]), c))
            rows_met = np.cumsum(held[order[i]])
            assert leaves[order[i]].tolist() == met
            assert counts[i] == min(len(leaves), int((rows_met < 50).sum()) + 1)


def test_vector_tree_scores_numbers_of_any_size_and_equal_rows_exactly():
    """Single precision only sifts: ranges it does not have and rows it cannot tell apart."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(9000, 12))
    x[:3000] = x[0]                             # equal
    x[3000:6000] = x[0] * (1 + 1e-12 * rng.integers(0, 50, 3000))[:, None]
    for scale, most in ((1.0, 9000), (1.0, 40), (1e-200, 9000), (1e-150, 2000), (1e150, 9000), (4e153, 9000)):
        y, ids = x * scale, rng.permutation(9000) % most       # ids repeat below 9000
        held = vector_tree.Held(ids, y, np.arange(9000) // 1000, 9, 20)
        q, query_ids = y[[0, 100, 4000, 7000]], ids[[0, 100, 4000, 7000]]
        want = np.ones((4, 9), bool)
        want[1, 3:] = want[3, :2] = False
        query, row, score = held.top(query_ids, q, want, 20)
        for i in range(4):
            full = np.ascontiguousarray(y * q[i]).sum(axis=1)
            may = np.flatnonzero((ids != query_ids[i]) & np.repeat(want[i], 1000) & np.isfinite(full))
            best = may[np.lexsort((ids[may], -full[may]))][:20]
            assert held.ids[row[query == i]].tolist() == ids[best].tolist() and (score[query == i] == full[best]).all()
    assert len(held.x) <= 9000 - 3 * (1000 - 21)       # of 1000 equal ones in a chunk, 21 ids can be answers


def test_vector_tree_sample_is_that_of_least_hashes(spark):
    order = F.xxhash64("vec_id")
    for ids in ("id", "case when id % 2 = 0 then 7 else id end"):
        table = spark.range(4000).selectExpr(f"{ids} as vec_id", "cast('v' as binary) as v")
        rows = sorted(r["vec_id"] for r in table.orderBy(order, "vec_id").limit(50).collect())
        assert sorted(vector_tree.least_hashes(table, order, 50)["vec_id"].to_pylist()) == rows


def test_toxicity_learns_marked_words(spark):
    rng = random.Random(1)
    rows = [(i, prose(30, rng) + (" vilething " if i % 3 == 0 else " ") + prose(30, rng), "s") for i in range(900)]
    rows += [(2000, None, "s"), (2001, "", "s"), (None, prose(9), "s"), (2002, prose(40_000, rng), "s")]
    docs = plain.documents(spark, rows).withColumn("toxic_score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)] + [(None, 1), (5, None), (6, 1)],
                                   "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit_toxicity(docs, labels, ~held)
    assert len(model[0]) < 2000
    out = toxicity.score_toxicity(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    wrong = sum((r["score"] >= 0.5) != (r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 3 == 0) for r in out)
    assert wrong <= 5
    clean = docs.drop("toxic_score")
    kept = toxicity.without_toxic(clean, labels, ~held)
    assert kept.columns == clean.columns and abs(kept.count() - 604) <= 5


def test_toxicity_classes_weigh_alike_at_every_size(spark):
    docs = plain.documents(spark, [(i, ".", "s") for i in range(900)])
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(900)], "doc_id long, toxic int")
    for most in (5000, 100):        # one toxic row in nine, or in two
        model = toxicity.fit_toxicity(docs, labels, F.lit(True), max_rows=most)
        assert 0.3 < toxicity.score_toxicity(docs.limit(1), model).first()["score"] < 0.7


def test_toxicity_takes_one_row_per_id(spark):
    rows = [(7, f"vilething {i}", "s") for i in range(400)] + [(i, prose(20), "s") for i in range(100, 140)]
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 140)] + [(9000, 1)], "doc_id long, toxic int")
    seen = []
    cut = toxicity.cut
    toxicity.cut = lambda df, name: seen.append(cut(df, name)) or seen[-1]
    try:
        toxicity.fit_toxicity(plain.documents(spark, rows), labels, F.lit(True), max_rows=10, rounds=1)
    finally:
        toxicity.cut = cut
    assert {r["y"]: r["count"] for r in seen[0].groupBy("y").count().collect()} == {0: 10, 1: 1}


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    docs = plain.documents(spark, [(i, ".", "s") for i in range(5300)])
    labels = spark.createDataFrame([(i, int(i >= 5200)) for i in range(5300)] + [(5299, 2)], "doc_id long, toxic int")
    seen, cut = [], toxicity.cut
    monkeypatch.setattr(toxicity, "cut", lambda df, name: seen.append(cut(df, name)) or seen[-1])
    toxicity.fit_toxicity(docs, labels, F.lit(True), rounds=1)
    y = np.concatenate([np.frombuffer(r["y"], float) for r in seen[-1].collect()])
    assert Counter(y.tolist()) == {0: 5200, 1: 99}


def test_toxicity_turns_and_updates_as_a_plain_ftrl():
    order = np.arange(7) * 1000
    turns = toxicity.turns_of(np.array([0, 0, 1, 0, 0, 0, 1.0]), (1, 3), order)
    assert Counter(turns.tolist()) == {0: 1, 1: 1, 2: 3, 3: 1, 4: 1, 5: 1, 6: 3}
    texts = [b"aa bb cc", b"aa bb dd", b"aa bb ee", b"ff gg", b"aa bb"] * 3
    y = np.array([0, 1, 1, 0, 1.0] * 3)
    turns = toxicity.turns_of(y, (2, 1), np.arange(15))
    size = (1 << toxicity.BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    toxicity.ftrl_passes(texts, y, z, n, 2, turns)
    features = [set(toxicity.Features()(t).tolist()) for t in texts]
    held = Counter(f for fs in features for f in fs)
    pz, pn = Counter(), Counter()

    def weight(f):
        if abs(pz[f]) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(pn[f])) / toxicity.ALPHA + toxicity.L2
        return -(pz[f] - math.copysign(toxicity.L1, pz[f])) / rate
    for _ in range(2):
        for k in turns:
            fs = [f for f in features[k] if held[f] >= toxicity.LEAST_ROWS] + [size - 1]
            w = {f: weight(f) for f in fs}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y[k]
            for f in fs:
                pz[f] += g - (math.sqrt(pn[f] + g * g) - math.sqrt(pn[f])) / toxicity.ALPHA * w[f]
                pn[f] += g * g
    assert set(np.flatnonzero(n)) == {f for f in pn if pn[f]}
    assert all(z[f] == pytest.approx(pz[f]) and n[f] == pytest.approx(pn[f]) for f in pn)


def test_licenses_lower_only_ascii_letters(spark):
    docs = plain.documents(spark, [(1, "MIT License", "s"), (2, "M\u0130T L\u0131cense wor\u212a \u212a", "s")])
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["labels"]) for r in license_scan.license_labels(docs).collect()}
    assert got[1][:2] == (2, 1) and got[2] == (4, 0, "")


@pytest.mark.parametrize("ids", ["null", "one", "distinct"])
def test_a_hot_group_is_cut_whatever_its_ids(spark, ids):
    rng = random.Random(2)
    hot = prose(40, rng)
    rows = [(i, prose(40, rng), "s") for i in range(3000)]
    rows += [({"null": None, "one": 5, "distinct": 10_000 + i}[ids], hot, "s") for i in range(1500)]
    out = sharding.pack_shards(plain.documents(spark, rows)).withColumn("row", F.lit(1)).toPandas()
    assert len(out) == 4500 and out["shard"].between(0, 15).all()
    per = out.groupby("shard").agg(size=("size", "sum"), n=("doc_id", "size"), top=("slot", "max"))
    assert len(per) == 16 and per["size"].max() < 1.1 * per["size"].mean() and per["n"].max() < 1.1 * per["n"].mean()
    assert (per["top"] + 1 == per["n"]).all() and not out.duplicated(["shard", "slot"]).any()


def test_a_text_larger_than_a_shard(spark):
    rows = [(i, "ab cd", "s") for i in range(50)] + [(99, "x" * 20_000, "s")]
    out = sharding.pack_shards(plain.documents(spark, rows), n_shards=4).toPandas()
    big = out[out["doc_id"] == 99].iloc[0]
    assert big["size"] == 20_001 and len(out) == 51


def test_scratch_folders_name_their_file_system(spark):
    from huddlekit.llm.common import new_folder
    assert new_folder(spark, "x").startswith("file:/")
    with pytest.raises(ValueError):
        warc.opened("/checkpoints/x")


def test_token_counts(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    texts = [None, "", "  ", "it's 3'll <|endoftext|> A<|startoftext|>b", "é ́x \x1cy z 　", "x" * 5000,
             prose(3000), "Ünï 漢字テスト 12 345"]
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = plain.documents(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, "a", "s"), (3, texts[3], "s")])
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in token_counts.token_counts(docs, path).collect() if r["doc_id"] is not None)
    want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert got == sorted([(i, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want))]
                         + [(3, len(texts[3].encode()), want[3], False)])


def test_license_scan(spark):
    filler = prose(100)
    rows = [(1, "Under the MIT License. " + filler + "\nMIT-LICENSE", "s"), (2, "mit some license", "s"), (3, None, "s"), (4, "", "s"),
            (5, filler + " GNU General Public\n License and Apache license", "s"), (6, "MITLicense", "s"),
            (7, "Licensed under CC BY-NC 4.0.", "s"), (8, ". ,", "s"), (None, "mit license", "s"), (1, "all rights reserved", "s")]
    docs = plain.documents(spark, rows).withColumn("words", F.lit(1)).withColumn("row_id", F.lit(1))
    out = license_scan.license_labels(docs).collect()
    got = {(r["doc_id"], r["n_words"]): (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])
           for r in out}
    assert len(out) == len(rows)
    assert got[(1, 106)][:4] == (2, 2, 104, "mit")
    assert got[(2, 3)] == (0, None, None, "", "", 0.0) and got[(3, 0)] == (0, None, None, "", "", 0.0)
    assert got[(5, 107)][:4] == (2, 101, 105, "apache,gpl")
    assert got[(6, 1)][0] == 0 and got[(7, 7)][4] == "cc-by-nc" and got[(8, 0)][0] == 0
    assert got[(None, 2)][:4] == (1, 0, 0, "mit") and got[(1, 3)][4] == "all-rights-reserved"


def test_sharding(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng.randrange(1, 60), rng), "s") for i in range(3000)]
    rows += [(5000 + i, "one very common text " * 3, "s") for i in range(1500)] + [(None, None, "s"), (1, "", "s"), (1, "", "s")]
    docs = plain.documents(spark, rows).withColumn("shard", F.lit(9)).withColumn("size", F.lit("x"))
    out = sharding.pack_shards(docs, 16, n_bundles=512, slot_rows=50).collect()
    assert len(out) == len(rows)
    bytes_, counts, slots = Counter(), Counter(), {}
    for r in out:
        bytes_[r["shard"]] += r["size"]
        counts[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sum(bytes_.values()) == sum(len((t or "").encode()) + 1 for _, t, _ in rows)
    for c in (bytes_, counts):
        mean = sum(c.values()) / 16
        assert len(c) == 16 and all(abs(v - mean) < 0.05 * mean for v in c.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = {}
    for r in out:       # groups smaller than a shard stay together
        if r["doc_id"] is None or r["doc_id"] < 5000:
            where.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_toxicity_hands_rows_not_whole_shards_to_python(spark, monkeypatch):
    texts = [prose(40, random.Random(i)) + (" vilething" if i % 3 == 0 else "") for i in range(60)]
    docs = plain.documents(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(3, None, "s"), (4, texts[4], "s"), (90, "x", "s")])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(77, 1)], "doc_id long, toxic int")
    seen, cut = [], toxicity.cut
    monkeypatch.setattr(toxicity, "cut", lambda df, name: seen.append(cut(df, name)) or seen[-1])
    toxicity.fit_toxicity(docs, labels, F.lit(True), rounds=1)
    written = seen[-1].collect()
    assert len(written) == 60       # one row a text, however many a shard has
    features = toxicity.Features()
    want = sorted((float(i % 3 == 0), np.unique(features(t.encode())).tolist()) for i, t in enumerate(texts))
    assert want == sorted((np.frombuffer(r["y"], float)[0], np.cumsum(np.frombuffer(r["gaps"], np.int32)).tolist())
                          for r in written)


def test_decontamination_aligns_only_pairs_that_can_reach_the_threshold(spark):
    words = lambda *w: np.array(w, np.uint32).tobytes()
    item, rows = words(*range(1, 9)), []
    for doc, text in enumerate([words(1, 2, 3, 4, 90, 91), words(1, 2, 3, 90, 91, 92), words(*range(1, 9))]):
        rows.append((doc, doc, 0, 0, 1, 0, 0, 0, text, item))
    pairs = spark.createDataFrame(rows, "doc long, doc_id long, item long, item_id long, seeds long, lo int, hi int, "
                                        "start long, words binary, item_words binary")
    scores = {r["doc"]: r["similarity"] for r in decontamination.align(pairs).collect()}
    assert scores == {0: 0.5, 1: 0.375, 2: 1.0}
    assert {r["doc"]: r["similarity"] for r in decontamination.align(pairs, 0.5).collect()} == {0: 0.5, 2: 1.0}
    assert decontamination.align(pairs.limit(0), 0.5).collect() == []
