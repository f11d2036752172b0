"""Exact duplicates of a batch against immutable snapshots, screened by binary-fuse filters.

A snapshot keeps one row for each distinct text (digest, size of the group, row that stays)
in hash buckets, and for each bucket a static three-wise binary-fuse filter over the digests.
The distinct digests of a batch are screened by the filter of their bucket; only positives
are joined with the exact bucket, and their bytes are compared. Duplicates inside the batch
are grouped apart from that, by a hash aggregate with partial aggregation, so a text that a
third of all rows share costs one row for each task.

* NULL text counts as empty, and empty texts are equal to each other.
* Of equal texts, the row with the largest id stays; a NULL id is smaller than any other.
* Rows that repeat the id that stays: exactly one of them is kept.
* Texts of any length are hashed and compared whole.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import groups_for, rows_of, staged, text_or_empty

#: Distinct digests of a bucket, about; a filter then has some 80 kB.
PER_BUCKET = 65_536

_FILTER = "bucket int, seed long, block int, fingerprints binary"


@dataclass
class Snapshot:
    """``groups``: digest, key, n_bytes, keep_id, group_size; ``docs``: where texts are read again."""
    docs: DataFrame
    groups: DataFrame
    filters: DataFrame
    buckets: int


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = (keys ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _slots(h: np.ndarray, block: int, blocks: int = 34) -> tuple[np.ndarray, ...]:
    """Three neighbouring blocks out of ``blocks``, and a slot in each."""
    first = (h >> np.uint64(48)) % np.uint64(blocks - 2)
    parts = [(h >> np.uint64(s)) & np.uint64(0xFFFF) | ((h << np.uint64(t)) & np.uint64(0xFFFF0000))
             for s, t in ((0, 3), (16, 11), (32, 7))]
    return tuple(((first + np.uint64(k)) * np.uint64(block) + p % np.uint64(block)).astype(np.int64)
                 for k, p in enumerate(parts))


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(5)) ^ (h >> np.uint64(41))).astype(np.uint16)


def build_filter(keys: np.ndarray, blocks: int = 34) -> tuple[int, int, np.ndarray]:
    """Seed, block size and 16-bit fingerprints over distinct 64-bit keys.

    All keys that are alone in one of their slots are peeled off at once, round by round;
    then the rounds are filled in from the last to the first."""
    keys = np.unique(keys.astype(np.uint64))
    block = max(4, int(np.ceil(len(keys) * 1.25 / blocks)) + 2)
    for seed in range(1, 200):
        h = _mix(keys, seed * 0x51ED270B)
        slots, size, alive, rounds = np.stack(_slots(h, block, blocks)), block * blocks, np.arange(len(keys)), []
        while len(alive):
            flat = slots[:, alive]
            alone = np.bincount(flat.ravel(), minlength=size)[flat] == 1
            free = alone.any(0)
            if not free.any():
                break
            peeled = alive[free]
            rounds.append((peeled, slots[alone[:, free].argmax(0), peeled]))
            alive = alive[~free]
        if len(alive) == 0:
            table, prints = np.zeros(size, np.uint16), _prints(h)
            for peeled, own in reversed(rounds):
                a, b, c = slots[:, peeled]
                table[own] = 0
                table[own] = prints[peeled] ^ table[a] ^ table[b] ^ table[c]
            return seed, block, table
        block += max(2, block // 50)
    raise RuntimeError("no filter found for these keys")


def maybe_in(keys: np.ndarray, seed: int, block: int, table: np.ndarray, blocks: int = 34) -> np.ndarray:
    h = _mix(keys.astype(np.uint64), seed * 0x51ED270B)
    a, b, c = _slots(h, block, blocks)
    return _prints(h) == (table[a] ^ table[b] ^ table[c])


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
                                      F.first("n_bytes").alias("n_bytes"))


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("key", F.xxhash64("digest")).withColumn(
        "bucket", F.pmod(F.hash("digest"), F.lit(buckets)))


def snapshot(docs: DataFrame, rows: DataFrame, per_bucket: int = PER_BUCKET) -> Snapshot:
    """The immutable snapshot of a batch whose digests are ``rows``."""
    groups = staged(_groups(rows), "exact-groups")
    buckets = groups_for(groups.count(), per_bucket)

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        seed, block, prints = build_filter(frame["key"].to_numpy().view(np.uint64))
        return pd.DataFrame([[key[0], seed, block, prints.tobytes()]], columns=["bucket", "seed", "block", "fingerprints"])

    keyed = _bucketed(groups, buckets)
    filters = staged(keyed.select("bucket", "key").groupBy("bucket").applyInPandas(build, _FILTER), "exact-filters")
    return Snapshot(docs, keyed, filters, buckets)


def _screened(batch: DataFrame, snap: Snapshot) -> DataFrame:
    """The distinct digests of a batch that a filter lets pass."""
    def test(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left.iloc[:0][["bucket", "digest"]]
        f = right.iloc[0]
        hit = maybe_in(left["key"].to_numpy().view(np.uint64), int(f["seed"]), int(f["block"]),
                       np.frombuffer(f["fingerprints"], np.uint16))
        return left.loc[hit, ["bucket", "digest"]]

    keyed = _bucketed(batch, snap.buckets).select("bucket", "key", "digest")
    return keyed.groupBy("bucket").cogroup(snap.filters.groupBy("bucket")).applyInPandas(
        test, "bucket int, digest string")


def _texts(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One text for each digest of ``groups``: that of the row that stays. The join shuffles
    at every size: how many texts have copies grows with the input, so a broadcast would not hold."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").alias("row_id"), text.alias("text"))
    wanted = groups.select("digest", "keep_id").hint("merge")
    return rows.join(wanted, F.col("row_id").eqNullSafe(F.col("keep_id"))).where(
        F.sha2("text", 256) == F.col("digest")).dropDuplicates(["digest"]).select("digest", "text")


def matched(batch_docs: DataFrame, batch: DataFrame, snap: Snapshot) -> DataFrame:
    """The digests of a batch whose text, byte for byte, is in the snapshot, with the
    snapshot's group. The filter's false positives end at the exact bucket."""
    found = _screened(batch, snap).join(
        snap.groups.select("bucket", "digest", F.col("keep_id").alias("old_id"), F.col("group_size").alias("old_size")),
        ["bucket", "digest"])
    found = staged(found.join(batch.select("digest", "keep_id"), "digest"), "exact-positives")
    new = _texts(batch_docs, found)
    old = _texts(snap.docs, found.select("digest", F.col("old_id").alias("keep_id"))).withColumnRenamed("text", "old_text")
    same = new.join(old.hint("merge"), "digest").where(F.col("text") == F.col("old_text")).select("digest")
    return found.select("digest", "old_id", "old_size").join(same, "digest", "left_semi")


def exact_dedup(docs: DataFrame, batch_of=None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, text_key for each row.

    ``batch_of``: a boolean column over ``docs``, true for rows of the new batch; by default
    the upper half of the ids. The rest is the snapshot that the batch is held against.
    """
    if batch_of is None:
        middle = docs.select(F.percentile_approx("doc_id", 0.5)).first()[0]
        batch_of = F.coalesce(F.col("doc_id") > F.lit(middle), F.lit(True))
    rows = staged(docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("digest"),
                              F.xxhash64(text_or_empty()).alias("text_key"),
                              F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), batch_of.alias("new")),
                  "exact-digests")
    snap = snapshot(docs.where(~batch_of), rows.where(~F.col("new")))
    batch = staged(_groups(rows.where("new")), "exact-batch")
    both = staged(matched(docs.where(batch_of), batch, snap), "exact-matched")

    def merged(groups: DataFrame, keep, size) -> DataFrame:
        return groups.select("digest", F.greatest(keep, F.col("other_id")).alias("keep_id"),
                             (size + F.coalesce("other_size", F.lit(0))).alias("group_size"))

    with_batch = both.join(batch, "digest").select("digest", F.col("keep_id").alias("other_id"),
                                                   F.col("group_size").alias("other_size"))
    with_old = both.select("digest", F.col("old_id").alias("other_id"), F.col("old_size").alias("other_size"))
    columns = [F.col("keep_id"), F.col("group_size")]
    outcome = merged(snap.groups.join(with_batch, "digest", "left"), *columns).withColumn("new", F.lit(False)).unionByName(
        merged(batch.join(with_old, "digest", "left"), *columns).withColumn("new", F.lit(True)))
    # equal ids with equal texts are interchangeable: number them, keep the first
    order = Window.partitionBy("digest", "doc_id").orderBy("new")
    numbered = rows.withColumn("copy", F.row_number().over(order))
    return numbered.join(outcome, ["digest", "new"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"), "text_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, one row for each text: that with the largest id."""
    return rows_of(docs, exact_dedup(docs).where("kept"))
