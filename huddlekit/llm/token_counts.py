"""Token counts: the number of tokens a public tokenizer gives each text.

Batch encoding happens inside Arrow functions that return lengths only.
Batches are balanced by bytes. A text is split at safe boundaries: for a
tokenizer that drops white space, a run of ASCII white space ends every
token, so the counts of the parts add up to the count of the text. Equal
parts are encoded once and remembered up to a fixed number of entries.
"""
from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import blobs

BATCH_BYTES = 1 << 18      # bytes of text given to the library at once
REMEMBERED = 200_000       # parts whose length is kept by a task
REMEMBERED_BYTES = 64      # longer parts are not kept


class PartCounter:
    """Token counts of texts through the library's batch call."""

    def __init__(self, path: str, split: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.split = split
        if path.endswith(".json"):
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self._lengths = lambda xs: [len(e.ids) for e in tok.encode_batch_fast(xs, add_special_tokens=False)]
        elif path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self._lengths = lambda xs: [len(e) for e in sp.encode(xs, num_threads=1)]
        else:
            raise ValueError(f"unknown tokenizer file: {path}")
        self.known: dict[bytes, int] = {}

    def encode(self, parts: list[bytes]) -> dict[bytes, int]:
        """Lengths of distinct parts, encoded in batches balanced by bytes."""
        out: dict[bytes, int] = {}
        batch: list[bytes] = []
        size = 0
        for p in [*parts, None]:
            if p is not None:
                batch.append(p)
                size += len(p)
            if batch and (p is None or size >= BATCH_BYTES):
                out.update(zip(batch, self._lengths([b.decode("utf-8", "replace") for b in batch])))
                batch, size = [], 0
        return out

    def count(self, texts: list[bytes | None]) -> list[int]:
        if not self.split:
            return [self.encode([t or b""])[t or b""] for t in texts]
        totals = []
        for t in texts:
            parts = (t or b"").split()
            try:
                totals.append(sum(map(self.known.__getitem__, parts)))
                continue
            except KeyError:
                pass
            fresh = self.encode([p for p in set(parts) if p not in self.known])
            totals.append(sum(fresh[p] if p in fresh else self.known[p] for p in parts))
            if len(self.known) + len(fresh) > REMEMBERED:
                self.known.clear()
            self.known.update((p, n) for p, n in fresh.items() if len(p) <= REMEMBERED_BYTES)
        return totals


def token_counts(docs: DataFrame, tokenizer: str, *, limit: int = 2048, split: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``tokenizer`` is a file every worker can open (``.json`` for the
    tokenizers library, ``.model`` for sentencepiece). ``split`` may be True
    only for tokenizers that drop white space. A null text counts as empty
    (0 bytes, 0 tokens); repeated rows and null ids are kept as they are;
    other columns are not read. Nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PartCounter(tokenizer, split)
        for b in batches:
            texts = blobs(b.column(1))
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
