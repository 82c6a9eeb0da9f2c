"""The stages of the pipeline against plain versions on one small fixture."""
import random
from collections import Counter

import pytest

import corpus_pipeline

from . import plain
from .test_operators import plain_alignment, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    item = [f"q{rng.randrange(10**6)}" for _ in range(20)]
    rows = [(i, prose(40, rng) + (" vilething " if i % 3 == 0 else " ") + prose(20, rng), f"s{i % 2}") for i in range(600)]
    rows += [(1000 + i, rows[i][1], "s0") for i in (1, 2, 4)]                           # exact copies
    rows += [(1100 + i, rows[i][1] + " end", None) for i in (5, 7, 8)]                  # near copies
    edited = [w if k % 5 else "other" for k, w in enumerate(item)]
    rows += [(1200 + i, prose(60, rng) + " " + " ".join(w), "s1") for i, w in enumerate((item, edited))]
    rows += [(1300, None, "s0"), (1301, "", "s1"), (None, prose(50, rng), "s0"), (1, rows[1][1], "s0")]
    path = str(tmp_path_factory.mktemp("pipeline"))
    plain.documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1), (1300, 0)],
                          "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(7, " ".join(item)), (8, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, item


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages(spark, folder):
    path, item = folder
    stages = dict(corpus_pipeline.STAGES)
    docs = corpus_pipeline.read(spark, path, "documents")
    rows = pairs(docs)

    docs = corpus_pipeline.cut(stages["toxicity"](spark, docs, path), "t")
    assert docs.columns == COLUMNS
    rows = sorted(((i, t) for i, t in rows if "vilething" not in (t or "")), key=str)
    assert pairs(docs) == rows

    docs = corpus_pipeline.cut(stages["near_duplicates"](spark, docs, path), "t")
    assert docs.columns == COLUMNS
    known = [(i, t) for i, t in rows if i is not None]      # no other row is like the one without id
    kept = {i for i, _, c in plain.component_ids(known, 5, 80) if i == c}
    rows = [(i, t) for i, t in rows if i is None or i in kept]
    assert pairs(docs) == rows and not {1001, 1002, 1004, 1105, 1107, 1108} & kept

    docs = corpus_pipeline.cut(stages["decontaminate"](spark, docs, path), "t")
    assert docs.columns == COLUMNS
    rows = [(i, t) for i, t in rows if plain_alignment(item, (t or "").split()) < len(item)]
    assert pairs(docs) == rows and not {1200, 1201} & {i for i, _ in rows}

    docs = corpus_pipeline.cut(stages["mix"](spark, docs, path), "t")
    copies = pairs(docs)
    assert docs.columns == COLUMNS and copies and set(copies) <= set(rows)

    out = stages["shard"](spark, docs, path).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len((t or "").encode()) + 1) for i, t in copies)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= k < 16 and sorted(s) == list(range(len(s))) for k, s in slots.items())


def test_empty_tables(spark, tmp_path):
    plain.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
