"""Resampling of documents towards a target distribution, by hashed n-gram importance weights.

Words and n-grams are made in Arrow kernels, a bounded slice of a batch at a time: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` give each word its index in the
slice's dictionary. An n-gram is a pair of indices, that of the n-gram one word shorter and that of the
word after it, so shifted index arrays form all of them; only distinct pairs are hashed, by going on
with the CRC of the shorter n-gram. Weights are a ``take`` from the table of gains and a sum by segment.

Both passes over the documents are without shuffle: the counts leave a task as one row for
each bucket, and the gains, one number for each bucket, go to the tasks as an array. Scores are
whole numbers in a range that the formula bounds, so their histogram finds the lowest drawn score;
only documents of at least that score are put in order, by range.

* NULL and empty texts have no features: weight 0, and never drawn.
* Repeated rows count as often as they stand there, and each is drawn for itself; rows equal in
  score and id get ranks in any order.
* NULL ids draw as the text "2024:" without an id, and come last among equal scores.
* Very long texts are slices of their own; nothing is cut.
* Extra columns are left out of scores, and kept by ``drawn``; an empty table gives an empty table.
* An empty target gives every bucket the gain of its own rarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickwell.llm.common import staged, text_or_empty
from tickwell.operators.running import running_total

#: What stands between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that one pass of kernels takes, about; a longer text is taken alone.
SLICE_BYTES = 8 << 20


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of about ``most`` bytes with the position of their first text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, texts.slice(at, stop - at)
        at = stop


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Dictionary index of every word, where each text's words start (and the last end), the dictionary."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    lengths = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    coded = pc.dictionary_encode(pc.list_flatten(parts))
    index = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary.cast(pa.binary() if coded.dictionary.type == pa.string() else pa.large_binary()).to_pylist()
    # a separator at either end leaves an empty string there
    whole = np.array([w != b"" for w in words], bool)[index] if len(index) else np.zeros(0, bool)
    kept = np.r_[0, np.cumsum(whole)]
    return index[whole], kept[np.r_[0, np.cumsum(lengths)]], words


def features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n-grams of 1, 2 ... ``longest`` words: the bucket of each, and where each text's start."""
    index, starts, words = words_of(texts)
    crc = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    gram, grams_crc, row = index.astype(np.int64), crc, np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    yield (crc % buckets)[gram], starts
    for n in range(2, longest + 1):
        # position k holds the n-gram that starts there, if it ends in the same text
        inside = row[:max(0, len(index) - n + 1)] == row[n - 1:]
        pair = gram[:len(inside)] * len(words) + index[n - 1:]
        distinct, inverse = np.unique(pair[inside], return_inverse=True)
        grams_crc = np.fromiter((zlib.crc32(b" " + words[p % len(words)], int(grams_crc[p // len(words)]))
                                 for p in distinct.tolist()), np.int64, len(distinct))
        gram = np.zeros(len(inside), np.int64)
        gram[inside] = inverse
        yield (grams_crc % buckets)[inverse], np.r_[0, np.cumsum(np.maximum(np.diff(starts) - n + 1, 0))]


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in slices(batch.column("text")):
                for found, _ in features(part, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int64()), pa.array(total[has], pa.int64())], ["bucket", "n"])

    counts = texts.select(text_or_empty().alias("text")).mapInArrow(count, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """bucket, gain for each of the buckets: the log of how much likelier it is in the target, in thousandths."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return staged(bucket_counts(df, longest, buckets), f"counts-{name}").withColumnRenamed("n", name)

    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for df, name in ((docs, "s"), (target, "t")):
        both = both.join(F.broadcast(side(df, name)), "bucket", "left")  # no more rows than buckets
    both = both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1) * (all_s + buckets)) / ((F.col("s") + 1) * (all_t + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """doc_id, n_words, n_features and weight: the floored mean of the gains of a text's features."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for at, part in slices(batch.column("text")):
                mine = out[:, at:at + len(part)]
                for n, (found, starts) in enumerate(features(part, longest, len(gain))):
                    sums = np.r_[0, np.cumsum(gain.take(found))]
                    mine[2] += sums[starts[1:]] - sums[starts[:-1]]
                    mine[1] += np.diff(starts)
                    if n == 0:
                        mine[0] = np.diff(starts)
            out[2] = np.where(out[1] > 0, out[2] // np.maximum(out[1], 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, out)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def chance(seed: str = "2024") -> Column:
    """A Gumbel number of the document in thousandths, from the hash of its id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is NULL where it isn't drawn.

    Of the documents with enough words, ``percent`` in a hundred with the highest scores are drawn."""
    table = gains(docs, target, longest, buckets)
    gain = np.zeros(buckets, np.int64)
    for r in table.collect():  # one row for each bucket, a parameter
        gain[r.bucket] = r.gain
    scored = staged(weights(docs, gain, longest).withColumn("score", F.col("weight") + chance(seed)), "scores")
    return ranked(scored, percent, least_words)


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    able = F.col("n_words") >= least_words
    # The range of scores bounds the histogram: gains by the logs of the totals, chances by that of 2^33.
    levels = scored.where(able).groupBy("score").agg(F.count("*").alias("n"))
    wanted = scored.where(able).count() * percent // 100
    down = levels.select("score", F.sum("n").over(Window.orderBy(F.desc("score"))).alias("so_far"))
    lowest = down.where(F.col("so_far") >= wanted).agg(F.max("score")).first()[0] if wanted else None
    if lowest is None:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    high = able & (F.col("score") >= lowest)
    rows = scored.where(high).select("doc_id", "n_features", "weight", "score", (-F.col("score")).alias("_down"),
                                     F.col("doc_id").isNull().alias("_none"), F.lit(1).alias("_one"))
    first = running_total(rows, [], ["_down", "_none", "doc_id"], "_one", "rank")
    columns = ("doc_id", "n_features", "weight", "score")
    return first.select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")).unionByName(
        scored.where(~high).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The documents that are drawn, with all their columns; of repeated ids all rows or none."""
    ids = resample(docs, target, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__drawn")), "left_semi")
