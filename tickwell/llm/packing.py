"""Best-fit packing of token pieces into sequences, by hierarchical residual packing.

Documents are cut into pieces of at most ``capacity`` tokens; full pieces are sequences of
their own. The others are dealt over hash groups of a bounded size, and each group packs its
items best-fit, longest first. Bins that are nearly full are done. The underfull ones go on
as items: groups are merged ``FAN_IN`` at a time and packed again, until one group is left
or a round saves nothing. A group never takes more than ``PER_GROUP`` items: if more bins
than that are left over, that many groups stay.

* NULL text counts as empty; an empty document is its end token alone.
* Repeated rows and NULL ids are packed as documents of their own.
* Very long texts give as many full pieces as they need; nothing is dropped.
* Ties go to the smaller item number, so equal input gives equal packing.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.bpe import load
from tickwell.llm.common import groups_for, staged, text_or_empty

CAPACITY = 2048
#: Items that one task packs at most, about.
PER_GROUP = 100_000
FAN_IN = 8
#: A bin with no more free tokens than this is done.
NEARLY_FULL = 8

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_lengths(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece, and its ids if asked for."""
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                raw, at = bpe.encode(text) + end, 0
                for number, length in enumerate(cut_lengths(len(raw) // 4, capacity)):
                    part = raw[4 * at:4 * (at + length)]
                    rows.append([doc_id, number, at, length, zlib.crc32(part)]
                                + ([np.frombuffer(part, "<u4").astype(np.int32)] if with_ids else []))
                    at += length
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"doc_id": "Int64"})

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(
        pieces, _PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(items: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin (named by its first item), offset and total size of that bin, for each item.

    ``free`` has a bit for each amount of free space that some bin has, so the fullest bin
    that still fits is the lowest bit at or above the item's size."""
    order = np.lexsort((items, -sizes))
    bins, at, stacks, free, fill = np.empty_like(items), np.empty_like(sizes), {}, 0, {}
    for k in order.tolist():
        size = int(sizes[k])
        fits = free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            name = stacks[space].pop()
            if not stacks[space]:
                free &= ~(1 << space)
        else:
            space, name = capacity, int(items[k])
        bins[k], at[k], fill[name] = name, capacity - space, capacity - space + size
        left = space - size
        if left:
            stacks.setdefault(left, []).append(name)
            free |= 1 << left
    return bins, at, np.array([fill[b] for b in bins.tolist()], np.int64)


def _packed(items: DataFrame, capacity: int) -> DataFrame:
    """item, bin, at, fill for (grp, item, size), each group apart."""
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        bins, at, fill = best_fit(frame["item"].to_numpy(), frame["size"].to_numpy(), capacity)
        return pd.DataFrame({"grp": frame["grp"], "item": frame["item"], "bin": bins, "at": at, "fill": fill})

    return items.groupBy("grp").applyInPandas(pack, "grp long, item long, bin long, at long, fill long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PER_GROUP) -> DataFrame:
    """``pieces`` (any columns, with ``length``) plus sequence_id and offset."""
    numbered = staged(pieces.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") >= capacity
    partial = numbered.where(~full)
    groups = groups_for(partial.count(), per_group)
    first = staged(_packed(partial.select(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("grp"), "item",
                                          F.col("length").alias("size")), capacity), "packing-round")
    rounds, found = [], first
    while True:
        under = found.where(F.col("fill") < capacity - NEARLY_FULL).groupBy("bin").agg(
            F.first("grp").alias("grp"), F.first("fill").alias("size"))
        left = under.count()
        merged = max(groups_for(left, per_group * FAN_IN), groups_for(groups, FAN_IN))
        if groups == 1 or left == 0 or (rounds and merged == groups):
            break
        groups = merged
        found = staged(_packed(under.select(F.pmod("grp", F.lit(groups)).alias("grp"), F.col("bin").alias("item"), "size"),
                               capacity), "packing-round")
        rounds.append(found)
        if found.select("bin").distinct().count() == left:
            break
    placed = first.select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    if rounds:
        # where a bin of the first round ends up, through all later ones
        moved = rounds[-1].select("item", "bin", "at")
        for earlier in reversed(rounds[:-1]):
            later = moved.select(F.col("item").alias("bin"), F.col("bin").alias("bin2"), F.col("at").alias("at2"))
            moved = earlier.select("item", "bin", "at").join(later, "bin", "left").select(
                "item", F.coalesce("bin2", "bin").alias("bin"), (F.col("at") + F.coalesce("at2", F.lit(0))).alias("at"))
        moved = moved.select(F.col("item").alias("sequence_id"), "bin", "at")
        placed = placed.join(moved, "sequence_id", "left").select(
            "item", F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"))
    alone = numbered.where(full).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    own = numbered.drop("sequence_id", "offset")
    return own.join(placed.unionByName(alone), "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of whole sequences, from packed pieces that carry their ids. A
    sequence has a bounded length, so its pieces may meet in one group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
