"""Token counts at every prefix of a text, by prefix dynamic programming.

``bpe.PrefixBpe`` finds the last token of every prefix of a piece from the last tokens of
its shorter prefixes, so one pass over a text gives the count at each of its prefixes. They are stored as a
table: for each text the differences from one count to the next, compressed. Totals and cuts are answered from
the table alone: "how long may a cut be that keeps N tokens" is the last prefix whose count is at
most N, for any N, without the text and without encoding anything again.

* NULL text counts as empty: no tokens, a cut of 0, an empty entry.
* Repeated rows and NULL ids come back as they are: one row for each input row.
* Very long texts: work and memory are linear in the text; nothing is cut.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
* A special string inside a text is one token, as the library has it by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.bpe import load
from tickwell.llm.common import staged, text_or_empty

_CODEC = pa.Codec("zstd", 1)
_TABLE = "doc_id long, n_bytes long, n_chars long, width int, steps binary"


def packed(counts: np.ndarray) -> tuple[int, bytes]:
    """Differences of consecutive counts in as few bytes each as they need, compressed."""
    steps = np.diff(counts, prepend=0)
    kind = next(k for k in (np.int8, np.int16, np.int32) if not len(steps) or (
        np.iinfo(k).min <= steps.min() and steps.max() <= np.iinfo(k).max))
    return np.dtype(kind).itemsize, _CODEC.compress(steps.astype(kind).tobytes(), asbytes=True) if len(steps) else b""


def unpacked(n_chars: int, width: int, steps: bytes) -> np.ndarray:
    """The count after each code point."""
    if not n_chars:
        return np.zeros(0, np.int64)
    return np.frombuffer(_CODEC.decompress(steps, n_chars * width, asbytes=True), f"i{width}").cumsum(dtype=np.int64)


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_chars and the stored counts at every prefix of each text."""
    def table(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(vocabulary)
        for batch in batches:
            rows = [(len(t), *packed(bpe.prefix_counts(t))) for t in batch["text"]]
            found = pd.DataFrame(rows, columns=["n_chars", "width", "steps"])
            yield pd.concat([batch[["doc_id", "n_bytes"]].astype("Int64").reset_index(drop=True), found], axis=1)

    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    return texts.mapInPandas(table, _TABLE)


def cut_at(prefixes: DataFrame, limit: int) -> DataFrame:
    """From a stored prefix table: doc_id, n_bytes, n_tokens, and ``cut_chars``, the longest prefix in code
    points that keeps at most ``limit`` tokens."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, cuts = [], []
            for row in zip(batch["n_chars"], batch["width"], batch["steps"]):
                counts = unpacked(*row)
                fits = np.flatnonzero(counts <= limit)
                tokens.append(int(counts[-1]) if len(counts) else 0)
                cuts.append(int(fits[-1]) + 1 if len(fits) else 0)
            yield batch[["doc_id", "n_bytes"]].astype("Int64").assign(n_tokens=tokens, cut_chars=cuts)

    return prefixes.mapInPandas(cut, "doc_id long, n_bytes long, n_tokens long, cut_chars long")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``cut_chars``, looked up in a prefix table that is written once."""
    return cut_at(staged(prefix_table(docs, vocabulary), "prefixes"), limit)
