"""Spelling variant grouping with a variable-length gram index.

Words are counted over all texts; two words are near if one inserted, deleted
or replaced code point makes them equal. Near words are found as follows.

1. Gram dictionary: every gram of ``SHORTEST`` code points, and a longer one
   (up to ``LONGEST``) wherever the gram it extends is too frequent to select
   and it is not itself rare. The thresholds follow the number of words, so
   the dictionary has a bounded size; it is what every task holds.
2. Decomposition: at each position the longest dictionary gram counts, unless
   an earlier one covers it. A place where nothing fits has a shortest gram.
3. Affected grams: for each word, the largest number of its grams that one
   edit can touch, over all places of an edit. Grams that the edit runs
   through are touched, and so are those beside it that a longer dictionary
   gram could swallow. The others are also grams of the edited word.
4. List merging: of a word with V grams, a of which can be touched, a near
   word shares at least V - a. So only its a + 1 rarest grams are looked up;
   the long lists are never read. A list entry also names what else the edit
   left whole: the side of the gram it is not on, or if that is short, the
   half of the other side it is not in. So a list is one of words that share
   half of their letters in place, whatever the gram.
5. Words all of whose grams one edit can touch are compared with each other
   over the shortest grams only, where two at least stay.
6. Candidates are verified by edit distance.
"""
from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import cut

SHORTEST, LONGEST = 2, 3
SELECTIVE = 10_000      # a gram held by more than one word in so many is extended
KEPT = 4                # an extension is kept from this part of that number on
PARTIAL = 200_000       # words counted by a task before it hands them on
# latin-1 bytes of words, A-Z lower-cased; the rest become blanks
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))


class Utf8(dict):
    """latin-1 word -> UTF-8 bytes, memoized up to a fixed number."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= PARTIAL:
            self.clear()
        out = self[word] = word.decode("latin-1").encode()
        return out


def runs_of(text: str, prefix: bytes, utf8: dict[bytes, bytes]) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a text, as latin-1 bytes; ``prefix`` is the id
    and a colon. One run in 97 by checksum loses one letter, everywhere in
    the text."""
    seed = zlib.crc32(prefix)
    for run, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        h = zlib.crc32(run if run.isascii() else utf8[run], seed)
        if h % 97 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def count_words(docs: DataFrame, least_length: int, least_count: int, id_col: str, text_col: str) -> DataFrame:
    """``word, n`` of the words long and frequent enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        utf8 = Utf8()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                t = text.as_py()
                if t:
                    for word, n in runs_of(t, (i or "").encode() + b":", utf8):
                        if len(word) >= least_length:
                            counts[word] += n
                    if len(counts) > PARTIAL:
                        yield hand_on()
        if counts:
            yield hand_on()
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= least_count)


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Grams with the number of their places in the words.

    With W words, a gram of more than max(8, W / SELECTIVE) places is extended,
    and an extension is kept from 1 / KEPT of that number on. Of each length
    at most KEPT * SELECTIVE * (mean length of a word) are kept, whatever W
    is; the shortest grams are bounded by the square of the alphabet."""
    total = words.count()
    often = max(8, total // SELECTIVE)
    grams: dict[str, int] = {}
    known: list[str] = []
    for q in range(SHORTEST, LONGEST + 1):
        starts = F.expr(f"explode(transform(sequence(1, char_length(word) - {q - 1}), p -> substring(word, p, {q})))")
        counted = (words.filter(F.char_length("word") >= q).select(starts.alias("gram"))
                   .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
        if q > SHORTEST:
            if not known:
                break
            stems = words.sparkSession.createDataFrame([(g,) for g in known], "stem string")
            counted = (counted.filter(F.col("n") * KEPT >= often).withColumn("stem", F.substring("gram", 1, q - 1))
                       .join(F.broadcast(stems), "stem", "left_semi"))
        # bounded as the docstring says
        table = counted.select("gram", "n").toArrow()
        level = dict(zip(table["gram"].to_pylist(), table["n"].to_pylist()))
        grams.update(level)
        known = [g for g, n in level.items() if n > often]
    return grams


class Grams:
    """A gram dictionary, ready to decompose words."""

    def __init__(self, count: dict[str, int]):
        self.count = count
        self.longest = max(map(len, count), default=SHORTEST)
        self.extended = {g[:-1] for g in count if len(g) > SHORTEST}
        self.endings = {g[k:] for g in count for k in range(1, len(g))}

    def decompose(self, word: str) -> list[tuple[int, int]]:
        """(begin, end) of the word's grams; both rise."""
        out, covered = [], 0
        for p in range(len(word) - SHORTEST + 1):
            end = p + SHORTEST
            while end < len(word) and end - p < self.longest and word[p:end + 1] in self.count:
                end += 1
            if end > covered:
                out.append((p, end))
                covered = end
        return out

    def affected(self, word: str, grams: list[tuple[int, int]]) -> int:
        """Most grams that one edit can touch.

        Left of a cut before position c, a gram stays if it ends there and no
        dictionary gram that begins at or before it could run on through the
        cut. Right of a cut before position c, a gram stays if it begins there
        and no dictionary gram that began before c could cover its end."""
        begins, ends = [b for b, _ in grams], [e for _, e in grams]
        n = len(word)
        left, right = [], []
        for c in range(n + 1):
            reach = next((p for p in range(max(0, c - self.longest + 1), c - SHORTEST + 1)
                          if word[p:c] in self.extended), c)
            left.append(min(bisect_right(ends, c), bisect_left(begins, reach)))
            cover = next((e for e in range(min(n, c + self.longest - 1), c, -1) if word[c:e] in self.endings), c)
            right.append(len(grams) - max(bisect_left(begins, c), bisect_right(ends, cover)))
        stay = min(min(left[c] + right[c + 1] for c in range(n)), min(left[c] + right[c] for c in range(n + 1)))
        return len(grams) - stay

    def looked_up(self, word: str) -> tuple[list[tuple[int, int]], bool]:
        """The rarest grams, one of which every near word shares, and whether
        that is so: if an edit can touch all grams, a near word shares one
        only if its own bound says so, and all grams are given."""
        grams = self.decompose(word)
        touched = self.affected(word, grams)
        grams.sort(key=lambda g: (self.count.get(word[g[0]:g[1]], 0), word[g[0]:g[1]], g[0]))
        return grams[:touched + 1], touched < len(grams)


def sides(word: str, n: int, b: int, e: int, gap: int) -> list[str]:
    """What an edit beside the gram at b to e of a word of length n leaves
    whole, for each part of the word the edit may be in; at least about half
    of the word. With ``gap`` 1, ``word`` is one short of n, and the texts are
    those of the longer word if its further letter is in that part."""
    if 2 * e >= n:
        out = [f"a{word[:e]}"]
    else:   # a short head: the edit is before or after the middle of the rest
        mid = (e + n) // 2
        out = [f"b{word[:mid]}", f"c{word[:e]}|{word[mid - gap:]}"]
    if 2 * (n - b) >= n:
        out.append(f"d{word[b - gap:]}")
    else:
        mid = b // 2
        out += [f"e{word[mid - gap:]}" if mid >= gap else "", f"f{word[:mid]}|{word[b - gap:]}"]
    return out


def entries(word: str, grams: list[tuple[int, int]], tier: int, hashed) -> tuple[list[int], list[int]]:
    """List keys under which a word stands, and those it is looked up by to
    meet near words of its length and one more.

    A key holds the gram's place, a part of the word that the edit left whole
    (the gram within), the length, and the tier of the dictionary."""
    stands, asks = [], []
    n = len(word)
    for b, e in grams:
        stands += [hashed(f"{tier}|{n}|{b}|{e}|{x}") for x in sides(word, n, b, e, 0)]
        # a letter more behind the gram leaves its place, one before it moves it
        asks += [hashed(f"{tier}|{n + 1}|{b}|{e}|{x}") for x in sides(word, n + 1, b, e, 1) if x[:1] in "abc"]
        asks += [hashed(f"{tier}|{n + 1}|{b + 1}|{e + 1}|{x}")
                 for x in sides(word, n + 1, b + 1, e + 1, 1) if x and x[0] in "def"]
    return stands, stands + asks


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b`` of all near words, each pair once, ``a`` not longer
    than ``b``."""
    count = gram_dictionary(words)
    table = words.sparkSession.sparkContext.broadcast(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def hashed(key: str) -> int:
            return xxhash.xxh3_64_intdigest(key) - 2**63
        all_grams = Grams(table.value)
        short = Grams({g: n for g, n in table.value.items() if len(g) == SHORTEST})
        for b in batches:
            stands, asks = [], []
            for word in b.column(0).to_pylist():
                grams, kept = all_grams.looked_up(word)
                s, a = entries(word, grams, 1, hashed)
                if not kept:
                    s2, a2 = entries(word, short.looked_up(word)[0], 2, hashed)
                    s, a = s + s2, a + a2
                stands.append(s)
                asks.append(a)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(stands, pa.list_(pa.int64())),
                                              pa.array(asks, pa.list_(pa.int64()))],
                                             names=["word", "n", "stands", "asks"])
    keyed = cut(words.mapInArrow(run, "word string, n long, stands array<long>, asks array<long>"), "gram-keys")
    lists = keyed.select(F.explode("stands").alias("key"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    probes = keyed.select(F.explode("asks").alias("key"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    met = probes.join(lists, "key").filter(
        "(char_length(a) < char_length(b) or a < b) and levenshtein(a, b, 1) = 1")
    return met.select("a", "b", "n_a", "n_b").distinct()


def spelling_variants(docs: DataFrame, *, least_length: int = 5, least_count: int = 3, least_ratio: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word.

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF of the whole
    texts, A-Z lower-cased; one run in 97 by the checksum of id and run loses
    a letter. Words of ``least_length`` code points (4 or more) and
    ``least_count`` occurrences over all rows stay. ``form`` is the near word
    of most occurrences (ties: the smaller), if it has ``least_ratio`` (2 or
    more) times the word's; ``root`` follows forms to the last.

    Null and empty texts have no words, a null id counts as an empty one, a
    repeated row counts again, and texts of any length are taken whole. An
    empty table gives no rows."""
    if least_length < SHORTEST + 2 or least_ratio < 2:
        raise ValueError("least_length must be 4 or more, least_ratio 2 or more")
    words = cut(count_words(docs, least_length, least_count, id_col, text_col), "words")
    near = cut(near_pairs(words), "near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(
        near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    big = F.col("best.less") * -1 >= F.col("n") * least_ratio
    forms = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, F.col("best.other")).alias("form"), F.when(big, -F.col("best.less")).alias("form_n")), "forms")
    return forms.join(roots(forms, least_ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame, least_ratio: int) -> DataFrame:
    """``word, root`` of the words that have a form. Occurrences at least
    double from a word to its form, so the longest chain is known from the
    largest number, and each round doubles the steps followed."""
    up = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    most = forms.agg(F.max("n")).first()[0] or 1
    steps = max(1, int(math.log(most, least_ratio)) + 1)
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("top"))
        up = cut(up.join(further, "root", "left").select("word", F.coalesce("top", "root").alias("root")), "roots")
    return up


#: DuckDB SQL of ``spelling_variants(documents)``. It has no crc32, so the
#: checksum is folded over the bytes with its table of 256 remainders.
SPELLING_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS byte, range AS r, 0 AS k FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(r ORDER BY byte) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(1, 2 * octet_length(encode(id || ':' || run)), 2),
             lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), i, 2) AS BIGINT))),
           lambda a, b: xor(t[xor(a & 255, b) + 1], a >> 8)), 4294967295) AS h
  FROM runs, crc),
cut_runs AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
                                   || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM cut_runs WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
  SELECT word, n, p, substr(word, 1, p - 1) AS head, substr(word, p + 1) AS tail
  FROM words, unnest(range(1, length(word) + 1)) AS u(p)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b
    ON a.p = b.p AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON b.word = a.head || a.tail
  UNION
  SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON b.word = a.head || a.tail),
best AS (
  SELECT word, count(*)::BIGINT AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
  FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
         CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
