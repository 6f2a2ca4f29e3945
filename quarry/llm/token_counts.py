"""Token counts per document (operator 9).

Texts reach Python in Arrow batches bounded by bytes; only lengths come back.
A text is cut at its safe boundaries, single spaces between two characters
that are neither a space nor the piece library's space mark. No piece of the
vocabulary has the mark after another character (checked when the model is
loaded; otherwise texts are not cut), so no merge crosses such a place and
the library puts its leading mark where the dropped space stood: the parts'
counts add up to the text's. The distinct parts of a batch are gathered into
groups of about equal bytes, encoded by the library, and their lengths kept in
a bounded cache, so a word that fills the corpus is encoded once per worker and
a text of any length costs memory in proportion to its batch.

Defined cases: null and empty texts have 0 bytes and 0 tokens; rows may
repeat; an empty table gives an empty result; other columns stay as they are
(columns named like a result are replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import append_columns, ship_by_value, worker_cache

#: Distinct parts whose counts a worker keeps before it starts anew.
CACHE_PARTS = 500_000
#: Bytes of parts handed to the library at once.
ENCODE_BYTES = 1 << 18
MARK = "▁"


class PieceCounter:
    """Counts of a sentencepiece model for texts cut at safe boundaries."""

    def __init__(self, path: str):
        import re

        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        inner = any(MARK in p.lstrip(MARK) for p in pieces)
        self.cuts = not inner and self.model.encode("a b") == self.model.encode("a") + self.model.encode("b")
        self.boundary = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")
        self.known: dict[str, int] = {"": 0}

    def parts(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if "  " in text or MARK in text or text[:1] == " " or text[-1:] == " ":
            return self.boundary.split(text)
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE_PARTS:
            known.clear()
            known[""] = 0
        cut = [self.parts(t) for t in texts]
        new: set[str] = set()
        for parts in cut:
            new.update(parts)
        group, size = [], 0
        for part in new.difference(known):
            group.append(part)
            size += len(part)
            if size >= ENCODE_BYTES:
                known.update(zip(group, map(len, self.model.encode(group, num_threads=1)), strict=True))
                group, size = [], 0
        if group:
            known.update(zip(group, map(len, self.model.encode(group, num_threads=1)), strict=True))
        return [sum(map(known.__getitem__, parts)) for parts in cut]


def _counter(path: str) -> PieceCounter:
    kept = worker_cache()
    if ("PieceCounter", path) not in kept:
        kept["PieceCounter", path] = PieceCounter(path)
    return kept["PieceCounter", path]


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``)."""
    def kernel(column):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        filled = pc.fill_null(column, "")
        counts = np.array(_counter(model_path).count(filled.to_pylist()), dtype=np.int64)
        return [pc.binary_length(filled).cast(pa.int64()), counts, counts > limit]
    return append_columns(docs, text, [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")], kernel)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_bytes", "n_tokens", "over_limit")


ship_by_value(__name__)
