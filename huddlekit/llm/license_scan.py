"""License scans: an exact set-similarity join of text blocks with templates.

Texts are cut into overlapping blocks of words. A block matches a template
when it holds at least ``threshold`` of the template's distinct words
(containment). Template words are ordered by their document frequency in the
scanned corpus, rarest first; a match must share one of the template's first
``size - need + 1`` words (prefix filter), hold at least ``need`` template
words (length filter), and have enough words left on both sides after the
shared one (positional filter). Survivors are counted exactly.

Phrases are templates that must be held whole; an exact check of consecutive
words follows for them. Only DataFrame functions run here.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huddlekit.llm.common import cut

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    threshold: float = 1.0
    phrase: bool = False      # words must stand consecutively

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def distinct(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.threshold * len(self.distinct) - 1e-9))


PHRASES = (
    Template("mit license", "mit", "mit license", phrase=True),
    Template("apache license", "apache", "apache license", phrase=True),
    Template("general public license", "gpl", "general public license", phrase=True),
)
NOTICES = (
    Template("cc notice", "cc-by-nc", "licensed under cc by nc 4 0", 0.85),
    Template("apache notice", "apache-notice", "licensed under the apache license version 2 0", 0.85),
    Template("gpl notice", "gpl-notice", "work is licensed under the gnu general public license version 3", 0.85),
    Template("mit notice", "mit-notice", "released under the mit license", 0.85),
    Template("mit grant", "mit-notice",
             "permission is hereby granted free of charge to any person obtaining a copy", 0.85),
    Template("rights reserved", "all-rights-reserved", "all rights reserved", 1.0),
)


def text_words(text: Column) -> Column:
    """Words of a lower-cased text; the ends may hold one empty string."""
    # A-Z alone: a letter like U+212A is no k
    return F.split(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), WORD_BREAK, -1)


def word_count(words: Column) -> Column:
    first_empty = (F.element_at(words, 1) == "").cast("int")
    last_empty = ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int")
    return (F.size(words) - first_empty - last_empty).cast("long")


def lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def starts(span: Column, words: list[str], stride: int) -> Column:
    """Offsets below ``stride`` at which ``words`` stand in ``span``."""
    wanted, width = lit_array(words), F.lit(len(words))
    return F.filter(F.sequence(F.lit(0), F.lit(stride - 1)), lambda p: F.slice(span, p + 1, width) == wanted)


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, *, stride: int = 16,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames over one written pass: ``scanned`` (row_id, doc_id, n_words,
    words, hits) with one row per input row, and ``matches`` (row_id, block,
    template, label, phrase, overlap, containment, places) with one row per
    matching block and template; ``places`` holds, for phrases, the word
    positions where the phrase starts (each place once over all blocks).

    Blocks start every ``stride`` words and reach over the longest template,
    so every run of template length lies in one block. Null texts are empty
    and match nothing; repeated rows and null ids keep a row each; an empty
    table gives empty frames; other columns are not read. Words of a text are
    kept only where the whole text passes the containment bound of some
    template.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for t in templates for w in t.words})
    words = text_words(F.col(text_col))
    passed = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("words"))
    passed = passed.withColumn("n_words", word_count(F.col("words"))) \
                   .withColumn("hits", F.array_intersect("words", lit_array(vocabulary)))
    reachable = None
    for t in templates:
        ok = F.size(F.array_intersect("hits", lit_array(t.distinct))) >= t.need
        reachable = ok if reachable is None else reachable | ok
    lead = (F.element_at("words", 1) == "").cast("int")
    kept = F.when(reachable, F.slice("words", 1 + lead, F.greatest(F.col("n_words").cast("int"), F.lit(1))))
    scanned = cut(passed.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "n_words", "hits",
                                kept.alias("words")), "scan")
    return scanned, matching_blocks(spark, scanned, templates, vocabulary, stride)


def matching_blocks(spark: SparkSession, scanned: DataFrame, templates: tuple[Template, ...],
                    vocabulary: list[str], stride: int) -> DataFrame:
    counts = {r["word"]: r["n"] for r in (      # at most one row per template word
        scanned.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect())}
    ranked = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: k for k, w in enumerate(ranked)}
    length = stride + max(len(t.words) for t in templates)

    prefix_rows = []
    for t in templates:
        ordered = sorted(t.distinct, key=rank.__getitem__)
        for i, w in enumerate(ordered[:len(ordered) - t.need + 1]):
            prefix_rows.append((w, t.name, i, len(ordered), t.need))
    # as many rows as the templates' prefixes hold
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("token", "template", "i", "size", "need"))])
            for r in prefix_rows]
    prefixes = F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))

    blocks = (scanned.filter(F.col("words").isNotNull())
              .select("row_id", "words", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)),
                                                              F.lit(stride))).alias("block"))
              .select("row_id", "block", F.slice("words", F.col("block") + 1, F.lit(length)).alias("span"))
              .withColumn("tokens", F.array_intersect(lit_array(ranked), "span")))
    least = min(t.need for t in templates)
    blocks = blocks.filter(F.size("tokens") >= least)
    overlap_bound = (F.least("i", "j") + 1
                     + F.least(F.col("size") - F.col("i") - 1, F.size("tokens") - F.col("j") - 1))
    candidates = (blocks.select("*", F.posexplode("tokens").alias("j", "token")).join(prefixes, "token")
                  .filter((F.size("tokens") >= F.col("need")) & (overlap_bound >= F.col("need"))))
    overlap = places = label = phrase = F.lit(None)
    for t in templates:
        here = F.col("template") == t.name
        overlap = F.when(here, F.size(F.array_intersect("tokens", lit_array(t.distinct)))).otherwise(overlap)
        label = F.when(here, F.lit(t.label)).otherwise(label)
        phrase = F.when(here, F.lit(t.phrase)).otherwise(phrase)
        if t.phrase:
            places = F.when(here, starts(F.col("span"), t.words, stride)).otherwise(places)
    # a block meets a template through several prefix words: count it once
    return (candidates.dropDuplicates(["row_id", "block", "template"])
            .withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))
            .select("row_id", "block", "template", label.alias("label"), phrase.alias("phrase"), "overlap",
                    (F.col("overlap") / F.col("size")).alias("containment"),
                    F.transform(places, lambda p: (p + F.col("block")).cast("long")).alias("places")))


def license_labels(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, *, stride: int = 16,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``.

    A phrase counts where its words stand consecutively; a notice template
    where a block reaches its threshold. ``score`` is the highest containment
    of a counted match, 0.0 without one. Label strings are distinct, sorted
    and comma-joined ('' without labels)."""
    scanned, matches = license_scan(docs, templates, stride=stride, id_col=id_col, text_col=text_col)
    counted = matches.filter(~F.col("phrase") | (F.size("places") > 0))
    base = F.col("phrase")
    per_row = counted.groupBy("row_id").agg(
        F.sum(F.when(base, F.size("places")).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(base, F.array_min("places"))).alias("first_word"),
        F.max(F.when(base, F.array_max("places"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("containment").alias("score"))
    return (scanned.select("row_id", "doc_id", "n_words").join(per_row, "row_id", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word",
                    "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
