"""Spelling groups against a plain version over all pairs of words."""
import random
import re
import zlib
from collections import Counter

import pytest

from huddlekit.llm import spelling

from . import plain

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = plain.SCHEMA + ", word string, n int, form string, key long"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:j] + b[j + 1:] == a for j in range(len(b)))


def plain_variants(docs, least_length=5, least_count=3):
    n = Counter()
    for i, t in docs:
        for run in RUN.findall((t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    form, others = {}, {}
    for w in n:
        others[w] = sorted((-n[o], o) for o in n if near(w, o))
        if others[w] and -others[w][0][0] >= 2 * n[w]:
            form[w] = others[w][0][1]

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), c, len(others[w]), n[form[w]] if w in form else None) for w, c in n.items())


def run(spark, docs, **options):
    table = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2, "y", 3) for i, t in docs], SCHEMA)
    return sorted(tuple(r) for r in spelling.spelling_variants(table, **options).collect())


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(6)
    letters = "abehinorstéü×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 13))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "abababa", "abcdefgh" * 4]
    words = []
    for w in base:
        words += [w] * rng.choice([3, 9, 40])
        for _ in range(12):
            at, c = rng.randrange(len(w)), rng.choice(letters)
            v = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w + c, c + w])
            words += [v] * rng.choice([1, 3, 4, 7])
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::80]).title() if i % 3 else ", ".join(words[i::80])) for i in range(80)]
    rows += [(900, None), (901, ""), (902, "12 -- Ā中"), (None, " ".join(words[:200])), (5, rows[5][1]),
             (903, "ABABAB " * 30000), (904, "q" * 5000 + " " + "q" * 4999 + "r"), (905, "q" * 5000),
             (906, "q" * 5000 + " xāword Kword")]
    return rows


def test_matches_a_plain_version(spark, docs):
    got = run(spark, docs)
    assert got == sorted(plain_variants(docs))
    assert sum(r[4] for r in got) > 300 and any(r[2] != (r[1] or r[0]) for r in got)


def test_shorter_words_and_small_hand_ons(spark, docs, monkeypatch):
    monkeypatch.setattr(spelling, "PARTIAL", 50)
    assert run(spark, docs, least_length=4, least_count=1) == sorted(plain_variants(docs, 4, 1))


def test_empty_table_and_refused_options(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], least_length=3)


@pytest.mark.parametrize("longest", [3, 4, 6])
def test_grams_out_of_an_edits_reach_are_grams_of_the_edited_word(longest):
    """The bound behind the lists: every edit leaves len(grams) - affected
    grams, and the rarest affected + 1 hold one of them on both sides."""
    rng = random.Random(longest)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 12))) for _ in range(300)]
    count = Counter(w[p:p + q] for w in words for q in range(2, longest + 1) for p in range(len(w) - q + 1))
    kept = {g: n for g, n in count.items() if len(g) == 2 or rng.random() < 0.4}
    kept = {g: n for g, n in kept.items() if all(g[:q] in kept for q in range(2, len(g)))}
    grams = spelling.Grams(kept)
    for w in words[:80]:
        mine = grams.decompose(w)
        for at in range(len(w) + 1):
            for c in ("", "a", "b", "d"):
                for x, shift in ((w[:at] + c + w[at + 1:], len(c) - 1), (w[:at] + c + w[at:], len(c))):
                    if x == w or len(x) < 4 or abs(shift) > 1 or (at == len(w) and shift < 0):
                        continue
                    theirs = set(grams.decompose(x))
                    stay = {(b, e) for b, e in mine if e <= at and (b, e) in theirs}
                    stay |= {(b, e) for b, e in mine if b >= at and (b + shift, e + shift) in theirs}
                    assert len(stay) >= len(mine) - grams.affected(w, mine)
                    _, one = grams.looked_up(w)
                    _, other = grams.looked_up(x)
                    if one or other:
                        a = {w[b:e] for b, e in grams.looked_up(w)[0]}
                        assert a & {x[b:e] for b, e in grams.looked_up(x)[0]}
