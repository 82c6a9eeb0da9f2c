"""Language-model scoring with a hidden Markov model.

Words fall into classes: each of the ``head`` most frequent training words is
a class of its own, the others share a fixed number of classes by their first
and last letters; the end of a text is a class too. Latent states emit
classes and a class emits its words by their smoothed training counts:

    P(text) = sum over state paths of prod A[s, s'] B[s, class(w)] P(w | class(w))

Transition and emission tables have a fixed size; word counts, class totals
and every expected count come from all training texts. Baum-Welch counts are
made per partition and added up by a Spark aggregation in each iteration. The
scaled forward recursion gives the exact log-likelihood of every whole text.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import blobs, chunks_by_bytes, cut, words_of

END = b"\n"                 # no word holds a line feed
COUNT_LIMIT = 300_000       # words counted by a task before it hands them on
LOG10 = np.log(10.0)


# ---- corpus counts -----------------------------------------------------------------------------

def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over the given texts, the end counted once a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        for b in batches:
            for t in blobs(b.column(0)):
                counts.update(words_of(t or b""))
            counts[END] += b.num_rows
            if len(counts) > COUNT_LIMIT:
                yield out()
                counts = Counter()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Classes:
    """word -> class number: 0 the end, 1..H the head words, then ``spread``
    hashed classes."""

    def __init__(self, head: list[bytes], spread: int):
        self.head = {END: 0} | {w: k + 1 for k, w in enumerate(head)}
        self.first, self.spread = len(self.head), spread
        self.known: dict[bytes, int] = {}

    @property
    def size(self) -> int:
        return self.first + self.spread

    def rest(self, word: bytes) -> int:
        return self.first + xxhash.xxh3_64_intdigest(word[:3] + b"\0" + word[-2:]) % self.spread

    def __call__(self, word: bytes) -> int:
        k = self.head.get(word)
        return self.rest(word) if k is None else k


# ---- lockstep recursions -----------------------------------------------------------------------

def lockstep(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by falling length, padded (time, text) matrix, number of live
    texts at each time."""
    lengths = np.array([len(s) for s in seqs])
    order = np.argsort(-lengths, kind="stable")
    top = int(lengths[order[0]]) if len(order) else 0
    x = np.zeros((top, len(seqs)), np.int32)
    for col, k in enumerate(order):
        x[:lengths[k], col] = seqs[k]
    live = np.searchsorted(-lengths[order], -np.arange(top), side="left")
    return order, x, live


def segments(seqs: list[np.ndarray], most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Texts cut into stretches of at most ``most`` classes, and whose."""
    parts, owner = [], []
    for k, s in enumerate(seqs):
        for a in range(0, len(s), most):
            parts.append(s[a:a + most])
            owner.append(k)
    return parts, np.array(owner, np.int64)


def boundary_states(parts: list[np.ndarray], owner: np.ndarray, start: np.ndarray, trans: np.ndarray,
                    emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward vector before each stretch (already through the
    transition) and scaled backward vector after it, exactly: products of the
    stretches' transfer matrices, computed side by side."""
    k = len(start)
    many = np.flatnonzero(np.bincount(owner, minlength=owner.max() + 1)[owner] > 1)
    before = np.tile(start, (len(parts), 1))
    after = np.ones((len(parts), k))
    if not len(many):
        return before, after
    order, x, live = lockstep([parts[p] for p in many])
    m = np.tile(np.eye(k), (len(many), 1, 1))
    by_class, ones = np.ascontiguousarray(emit.T), np.ones(k * k)
    for t in range(len(x)):
        n = live[t]
        step = m[:n] * by_class[x[t, :n]][:, None, :]
        more = live[t + 1] if t + 1 < len(x) else 0     # the transition after the last class is applied below
        m[more:n] = step[more:]
        m[:more] = (step[:more].reshape(-1, k) @ trans).reshape(-1, k, k)
        m[:n] /= (m[:n].reshape(-1, k * k) @ ones)[:, None, None]
    of = {int(many[o]): m[c] for c, o in enumerate(order)}
    for p in many:
        if p and owner[p - 1] == owner[p]:
            v = before[p - 1] @ of[p - 1] @ trans
            before[p] = v / v.sum()
    for p in many[::-1]:
        if p + 1 < len(parts) and owner[p + 1] == owner[p]:
            v = trans @ (of[p + 1] @ after[p + 1])
            after[p] = v / v.sum()
    return before, after


STRETCH = 512


def forward_log(seqs: list[np.ndarray], start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Natural log of the likelihood of each class sequence."""
    total = np.zeros(len(seqs))
    if not seqs:
        return total
    parts, owner = segments(seqs, STRETCH)
    before, _ = boundary_states(parts, owner, start, trans, emit)
    order, x, live = lockstep(parts)
    v, logs, onward = before[order].T, np.zeros(len(parts)), np.ascontiguousarray(trans.T)
    for t in range(len(x)):
        n = live[t]
        a = v[:, :n] * np.take(emit, x[t, :n], axis=1)
        s = a.sum(axis=0)
        logs[:n] += np.log(s)
        a /= s
        v = onward @ a
    np.add.at(total, owner[order], logs)
    return total


def expected_counts(seqs: list[np.ndarray], start: np.ndarray, trans: np.ndarray, emit: np.ndarray, first: np.ndarray,
                    moves: np.ndarray, shown: np.ndarray) -> None:
    """Adds the Baum-Welch counts of the sequences to ``first`` (state),
    ``moves`` (state, state) and ``shown`` (state, class)."""
    parts, owner = segments(seqs, STRETCH)
    if not parts:
        return
    before, after = boundary_states(parts, owner, start, trans, emit)
    order, x, live = lockstep(parts)
    k, onward = len(start), np.ascontiguousarray(trans.T)
    alpha = np.zeros((k, len(x), len(parts)))       # states first: steps add up and scale whole rows
    v = before[order].T
    for t in range(len(x)):
        n = live[t]
        a = v[:, :n] * np.take(emit, x[t, :n], axis=1)
        a /= a.sum(axis=0)
        alpha[:, t, :n] = a
        v = onward @ a
    place = np.empty(len(parts), np.int64)
    place[order] = np.arange(len(parts))
    joint = np.flatnonzero(owner[1:] == owner[:-1]) + 1     # stretches that continue a text
    lengths = np.array([len(p) for p in parts])
    handed = alpha[:, lengths[joint - 1] - 1, place[joint - 1]]
    beta = np.ascontiguousarray(after[order].T)     # scaled backward vector behind the current class
    for t in range(len(x) - 1, -1, -1):
        n = live[t]
        ahead = np.take(emit, x[t, :n], axis=1) * beta[:, :n]
        gamma = alpha[:, t, :n] * beta[:, :n]
        alpha[:, t, :n] = gamma / gamma.sum(axis=0)
        if t:
            moves += transitions(alpha[:, t - 1, :n], ahead, trans)
            b = trans @ ahead
            beta[:, :n] = b / b.sum(axis=0)
    if len(joint):
        ahead = emit[:, x[0, place[joint]]] * beta[:, place[joint]]
        moves += transitions(handed, ahead, trans)
    opens = np.append(True, owner[1:] != owner[:-1])
    first += alpha[:, 0, place[opens]].sum(axis=1)
    cells = np.flatnonzero(np.arange(len(parts))[None, :] < live[:, None])
    classes = x.reshape(-1)[cells]
    for s in range(k):
        shown[s] += np.bincount(classes, weights=alpha[s].reshape(-1)[cells], minlength=shown.shape[1])


def transitions(here: np.ndarray, ahead: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Expected moves between the states of scaled forward columns ``here``
    and backward columns ``ahead`` (emission included)."""
    weight = ((trans.T @ here) * ahead).sum(axis=0)
    return (here @ (ahead / weight).T) * trans


# ---- training ----------------------------------------------------------------------------------

class Encoder:
    """Words -> class numbers and the known parts of the log-probabilities."""

    def __init__(self, words: list[bytes], counts: np.ndarray, classes: Classes, log_den: np.ndarray):
        self.classes, self.size = classes, len(words)
        self.code = {w: k for k, w in enumerate(words)}
        tail = np.arange(classes.size)
        self.class_of = np.append([classes(w) for w in words], tail).astype(np.int64)
        self.log_c = np.append(np.log10(counts + 0.5), np.zeros(len(tail)))
        own = self.class_of < classes.first      # a class of one word: P(word | class) = 1
        self.log_word = np.where(own, 0.0, self.log_c - log_den[self.class_of])
        self.known = np.append(counts > 0, np.zeros(len(tail)))

    def __call__(self, text: bytes | None):
        words = words_of(text or b"")
        words.append(END)
        get, rest, size = self.code.get, self.classes.rest, self.size
        codes = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(codes < 0)
        tail = Counter(words[k] for k in unknown)
        if len(unknown):
            codes[unknown] = [size + rest(words[k]) for k in unknown]
        return (self.class_of[codes].astype(np.int16), len(words), int(self.known[codes].sum()),
                float(self.log_c[codes].sum()), float(self.log_word[codes].sum()), tail)


def encoded(docs: DataFrame, words: list[bytes], counts: np.ndarray, classes: Classes,
            log_den: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((words, counts, log_den))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, times, den = shared.value
        encode = Encoder(table, times, classes, den)
        for b in batches:
            rows = [encode(t) for t in blobs(b.column(3))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x.tobytes() for x in cols[0]], pa.binary()),
                 pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()),
                 pa.array(cols[4], pa.float64()), pa.array([list(t) for t in cols[5]], pa.list_(pa.binary())),
                 pa.array([list(t.values()) for t in cols[5]], pa.list_(pa.int64()))],
                names=["row", "doc_id", "held_out", "classes", "n_tokens", "n_known", "log_c", "log_word", "tail", "times"])

    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, classes binary, n_tokens long, n_known long, log_c double, "
             "log_word double, tail array<binary>, times array<long>")


def summed_cells(df: DataFrame, size: int, make, state) -> np.ndarray:
    """Adds up a fixed-size array that each partition makes of its class
    sequences: partitions hand on their nonzero cells, Spark adds them."""
    shared = df.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(size)
        for b in batches:
            raw = b.column(0).to_pylist()
            for lo, hi in chunks_by_bytes(raw, 2 << 20):
                make([np.frombuffer(r, np.int16) for r in raw[lo:hi]], cells, shared.value)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells[at])], names=["cell", "x"])

    got = df.select("classes").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[got["cell"].to_numpy()] = got["x"].to_numpy()
    shared.destroy()
    return out


def add_presence(seqs: list[np.ndarray], cells: np.ndarray, width: int) -> None:
    """Adds the number of texts that hold both of two head classes."""
    held = np.zeros((len(seqs), width), np.float32)
    for k, s in enumerate(seqs):
        held[k, s[(s > 0) & (s <= width)] - 1] = 1.0
    cells += (held.T @ held).astype(float).reshape(-1)


def add_expected(seqs: list[np.ndarray], cells: np.ndarray, model) -> None:
    start, trans, emit = model
    k, c = emit.shape
    first, moves, shown = cells[:k], cells[k:k + k * k].reshape(k, k), cells[k + k * k:].reshape(k, c)
    expected_counts(seqs, start, trans, emit, first, moves, shown)


def groups_of_words(together: np.ndarray, states: int) -> np.ndarray:
    """A state for each head word, by k-means over co-occurrence profiles
    from far-apart seeds."""
    d = np.maximum(np.diag(together), 1e-9)
    x = np.log1p(together * len(d) ** 2 / (d[:, None] * d[None, :]) * d.mean() / len(d))
    x = x - x.mean(axis=0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    seeds = [0]
    while len(seeds) < min(states, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(axis=1))))
    centres = x[seeds]
    for _ in range(25):
        own = (x @ centres.T).argmax(axis=1)
        centres = np.stack([x[own == s].sum(axis=0) if (own == s).any() else centres[s] for s in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return own


def baum_welch(train: DataFrame, prior: np.ndarray, head: int, states: int, rounds: int):
    """(start, trans, emit) after ``rounds`` passes over all of ``train``."""
    c = len(prior)
    width = min(head, 256)
    emit = np.tile(prior, (states, 1))
    if width:
        together = summed_cells(train, width * width, add_presence, width).reshape(width, width)
        own = groups_of_words(together, states)
        for s in range(states):
            emit[s, 1:width + 1] *= np.where(own == s, 4.0, 0.1)
    emit /= emit.sum(axis=1, keepdims=True)
    start = np.full(states, 1.0 / states)
    trans = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(trans, 0.9 if states > 1 else 1.0)
    for _ in range(rounds):
        cells = summed_cells(train, states + states * states + states * c, add_expected, (start, trans, emit))
        first = cells[:states] + 1.0
        moves = cells[states:states + states * states].reshape(states, states) + 0.5
        shown = cells[states + states * states:].reshape(states, c) + 20.0 * prior
        start, trans = first / first.sum(), moves / moves.sum(axis=1, keepdims=True)
        emit = shown / shown.sum(axis=1, keepdims=True)
    return start, trans, emit


def hmm_scores(docs: DataFrame, held_out: Column, *, states: int = 6, head: int = 2000, spread: int = 4096,
               rounds: int = 3, table: int = 150_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of every row, learned from the rows where ``held_out`` (a
    condition on ``doc_id``) is false.

    A null or empty text is one token, the end. Rows with a null id count as
    held out. Repeated rows are scored, and counted, each on their own. An
    empty table gives an empty result; without training rows all classes are
    equally likely. Other columns are not read. ``table`` bounds the most
    frequent words whose counts are broadcast; all others get theirs by a
    join. Sizes of the model do not depend on the corpus.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(True)))
    counts = cut(word_counts(docs.filter(~F.col("held_out"))), "word-counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(sums["n"]), int(sums["v"])

    is_end = F.col("word") == F.lit(bytearray(END))
    ends = counts.filter(is_end).first()        # the end is in the table however rare it is
    top = counts.filter(~is_end).orderBy(F.desc("c"), "word").limit(table).toArrow()
    words = [END, *top["word"].to_pylist()]
    times = np.append(ends["c"] if ends else 0, top["c"].to_numpy()).astype(float)
    classes = Classes(words[1:head + 1], spread)
    by_class = counts.mapInArrow(class_totals(classes), "class long, n long, v long").groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow()      # at most one row per class
    total, kinds = np.zeros(classes.size), np.zeros(classes.size)
    at = by_class["class"].to_numpy()
    total[at], kinds[at] = by_class["n"].to_numpy(), by_class["v"].to_numpy()
    prior = (total + 0.5 * (kinds + 1)) / (total + 0.5 * (kinds + 1)).sum()

    log_den = np.log10(total + 0.5 * (kinds + 1))
    coded = cut(encoded(docs, words, times, classes, log_den), "coded")
    model = baum_welch(coded.filter(~F.col("held_out")), prior, classes.first - 1, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(7).to_pylist()
            logs = np.zeros(len(raw))
            for lo, hi in chunks_by_bytes(raw, 2 << 20):
                logs[lo:hi] = forward_log([np.frombuffer(r, np.int16) for r in raw[lo:hi]], *shared.value) / LOG10
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(logs)],
                                             names=[*b.schema.names[:7], "log_classes"])

    scored = coded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "log_c", "log_word", "classes").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_c double, log_word double, "
             "log_classes double")
    rare = (coded.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t"))
            .select("row", F.col("t.tail").alias("word"), F.col("t.times").alias("m"))
            .join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
                 F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("rare_known")))
    zero = F.lit(0.0)
    return (scored.join(rare, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("log_c") + F.coalesce("rare_log", zero)
                     - F.col("n_tokens") * F.log10(F.lit(n + 0.5 * (v + 1)))).alias("base_score"),
                    (F.col("log_classes") + F.col("log_word") + F.coalesce("rare_log", zero)).alias("score")))


def class_totals(classes: Classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(classes.size, np.int64), np.zeros(classes.size, np.int64)
        for b in batches:
            at = np.array([classes(w) for w in b.column(0).to_pylist()], np.int64)
            np.add.at(total, at, b.column(1).to_numpy())
            np.add.at(kinds, at, 1)
        used = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used]), pa.array(kinds[used])],
                                         names=["class", "n", "v"])
    return run
