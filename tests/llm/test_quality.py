"""The factorisation machine against plain versions and on a small table."""
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddlekit.llm import quality

from . import plain

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "tu") for b in ("bel", "dor", "fin", "gus", "hal")]
SCHEMA = plain.SCHEMA + ", m0 double, score int, y string"
LABELS = "doc_id long, quality int, toxic int"


def good(rng, n):
    return ". ".join(" ".join(rng.choice(WORDS) for _ in range(8)).capitalize() for _ in range(n))


def bad(rng, n):
    return " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(8 * n))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        y = int(i % 3 > 0)
        text = (good if y else bad)(rng, 2 + i % 5)
        rows.append((i, text, "en", "s", len(text), 1.0, 2, "x"))
        labels.append((i, y, 0))
    rows += [(900, None, None, None, None, None, None, None), (901, "", "en", "s", 0, float("nan"), 1, ""),
             (None, good(rng, 3), "en", "s", None, 1.0, 1, ""), (5, bad(rng, 3), "en", "s", 9, 1.0, 1, "y"),
             (5, rows[5][1], "en", "s", 9, 1.0, 1, "y"), (902, "ka " * 60000, "en", "s", 180000, 1.0, 1, "")]
    labels += [(None, 1, 0), (7, None, 0), (900, 1, 0), (99999, 0, 0), (5, 1, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), rows


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    w, v, x = rng.normal(size=9), rng.normal(size=(9, quality.RANK)), rng.random(9)
    pairs = sum(v[i] @ v[j] * x[i] * x[j] for i, j in itertools.combinations(range(9), 2))
    assert quality.raw_score(0.3, w, v, x) == pytest.approx(0.3 + w @ x + pairs)


def test_gradient_steps_lower_the_loss_as_plain_derivatives_say():
    """One step of a fresh machine against numeric derivatives."""
    rng = np.random.default_rng(5)
    size, idx, x = 12, np.array([1, 4, 7, 9]), np.array([0.5, 0.5, 1.0, 1.0])
    w, v = np.zeros(size), rng.normal(0, 0.3, (size, quality.RANK))
    v0, bias, gw, gv = v.copy(), np.array([0.1, 1.0]), np.ones(size), np.ones(size)

    def loss(vectors):
        p = quality.logistic(quality.raw_score(0.1, np.zeros(4), vectors[idx], x))
        return -np.log(p)
    numeric = np.zeros((size, quality.RANK))
    for i in idx:
        for f in range(quality.RANK):
            up, down = v0.copy(), v0.copy()
            up[i, f] += 1e-5
            down[i, f] -= 1e-5
            numeric[i, f] = (loss(up) - loss(down)) / 2e-5
    quality.fit_passes([(idx, x)], np.array([1.0]), bias, w, v, gw, gv, 1)
    step = (numeric + quality.DECAY * v0)[idx]
    want = v0[idx] - quality.RATE_V * step / np.sqrt(1.0 + (step ** 2).mean(axis=1))[:, None]
    assert np.allclose(v[idx], want, atol=1e-6)
    assert np.array_equal(np.delete(v, idx, 0), np.delete(v0, idx, 0))


def test_held_out_rows_nulls_and_repeated_rows(tables):
    docs, labels, rows = tables
    machine = quality.fit_quality(docs, labels, F.col("doc_id") % 4 != 2)
    got = quality.score_quality(docs, machine).collect()
    assert len(got) == len(rows)
    score = {}
    for r in got:
        assert 0.0 <= r["score"] <= 1.0
        score.setdefault(r["doc_id"], []).append(r["score"])
    held = [i for i in range(240) if i % 4 == 2]
    assert all((score[i][0] >= 0.7) == (i % 3 > 0) for i in held)
    assert len(score[5]) == 3 and len(score[None]) == 1 and len(score[900]) == 1 and len(score[902]) == 1
    # a plain walk over all pairs of features gives the same score
    at = {int(i): k for k, i in enumerate(machine.index)}
    for i in (3, 10, 57):
        idx, x = quality.Encoder()(rows[i][1].encode(), [float(rows[i][4])])
        known = [(at[int(j)], v) for j, v in zip(idx, x) if int(j) in at]
        z = machine.bias + sum(machine.weight[k] * v for k, v in known) + sum(
            machine.vector[a] @ machine.vector[b] * u * v for (a, u), (b, v) in itertools.combinations(known, 2))
        assert score[i][0] == pytest.approx(quality.logistic(z))


def test_source_language_and_ids_are_no_inputs(tables):
    docs, labels, _ = tables
    machine = quality.fit_quality(docs, labels, F.col("doc_id") % 4 != 2)
    other = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("source", F.lit("z")).withColumn("lang", F.lit("q"))
    plain_scores = sorted(r[0] for r in quality.score_quality(docs, machine).select("score").collect())
    assert plain_scores == sorted(r[0] for r in quality.score_quality(other, machine).select("score").collect())


def test_row_bound_is_on_rows_of_the_sample(spark):
    docs = spark.createDataFrame([(i % 7, f"ka bel {i}", "en", "s", 5) for i in range(500)], plain.SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)], LABELS)
    sample = quality.labelled_sample(docs, labels, F.lit(True), 5, 4, ("n_chars",), "doc_id", "text", "quality")
    assert sample.count() == 5


def test_empty_tables_and_one_class(spark, tables):
    docs, labels, _ = tables
    none = docs.limit(0)
    machine = quality.fit_quality(none, labels, F.lit(True))
    assert quality.score_quality(none, machine).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, machine).collect()} == {0.5}
    only = quality.fit_quality(docs, labels.filter("quality = 1"), F.lit(True))
    assert quality.score_quality(docs, only).agg(F.min("score")).first()[0] > 0.9
