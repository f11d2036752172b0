"""Near duplicates by MinHash signatures and a signature-coordinate inverted join.

Documents with the same shingle set form a class, and only classes are compared. A class is
posted under each of its (coordinate, value) pairs. Two sets of the asked similarity agree
in at least ``matches`` of ``coordinates`` values, but for a chance of a millionth; so they
share a value among the ``coordinates - matches + 1`` rarest of each. Only these prefixes
are merged; the longest lists are skipped by all classes that have rarer values.

Lists are not expanded into all pairs. First every member is held against the most central
one of its list: candidates must agree in ``matches`` coordinates of the full signatures, and
links are confirmed on full shingle sets (64-bit hashes of the shingles of the whole text).
Where a list then still reaches over several components, its members outside of the largest
are held against the others set by set, in blocks.

* NULL text counts as empty; documents without words are linked with nothing.
* With fewer words than a shingle has, the whole sequence is one shingle.
* NULL ids: never the smallest id of a component with other ids; a component of NULL ids alone
  has the id NULL, and ``kept`` is true.
* Repeated rows come back as they are, each kept if its id is the smallest of its component.
* Very long texts: the whole text counts; signatures are computed in slices.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.bpe import Cache
from tickwell.llm.common import rows_of, staged, text_or_empty
from tickwell.llm.graph import components

SHINGLE, SIMILAR, COORDINATES = 5, 75, 64
#: Classes of a block, at most about, where members of open lists are compared.
PER_BLOCK = 1_000
_P = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2 ** 64)) for k in range(64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@lru_cache(1)
def _word_hashes() -> Cache:
    return Cache(xxhash.xxh3_64_intdigest, 100_000)


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. ``bytes.lower`` and ``bytes.split``
    treat A-Z and the six ASCII white-space characters only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    joined = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        joined += h[k:len(h) - n + 1 + k] * _P[k + 1]
    return np.unique(_mixed(joined + np.uint64(n)))


@lru_cache(4)
def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_501)
    a = draw.integers(0, 2 ** 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], draw.integers(0, 2 ** 63, coordinates, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    a, b = _functions(coordinates)
    low = np.full(coordinates, 2 ** 32 - 1, np.uint64)
    for k in range(0, len(shingles), 8192):
        part = shingles[None, k:k + 8192] * a
        part += b
        low = np.minimum(low, part.min(1) >> np.uint64(32))
    return low.astype(np.uint32).view(np.int32)


def least_matches(coordinates: int, similar: int, chance: float = 1e-6) -> int:
    """The largest number of agreeing coordinates that a pair of the asked similarity misses
    with no more than ``chance``."""
    p, below, k = similar / 100, 0.0, 0
    while True:
        below += comb(coordinates, k) * p ** k * (1 - p) ** (coordinates - k)
        if below > chance:
            return max(1, k)
        k += 1


def _sketched(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, size) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"], "n_shingles": [len(s) for s in sets],
                "set_key": pd.Series([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], dtype=object),
                "signature": [signature(s, coordinates) if len(s) else None for s in sets]})

    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text"))
    return texts.mapInPandas(sketch, "doc_id long, text_key long, n_shingles long, set_key binary, signature array<int>")


def _prefixes(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """key, cid, n, central: the postings of each class under its rarest values that others share.
    ``central`` sums the lengths of all its lists: an original has values in common with each of
    its copies, a copy with few of the other copies beyond what the original gave them."""
    posted = classes.select("cid", "n", F.posexplode("signature").alias("coordinate", "value")).select(
        "cid", "n", (F.shiftleft(F.col("coordinate").cast("long"), 32) + F.col("value").cast("long")).alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    posted = posted.join(shared, "key")
    own = Window.partitionBy("cid")
    # values that no other class has are the rarest of all: they fill the prefix first
    room = coordinates - matches + 1 - (coordinates - F.count("*").over(own))
    return posted.withColumn("room", room).withColumn("central", F.sum("length").over(own)).withColumn(
        "rank", F.row_number().over(own.orderBy("length", "key"))).where("rank <= room").select("key", "cid", "n", "central")


def _pairs(lists: DataFrame, hubs: DataFrame, similar: int) -> DataFrame:
    """Distinct pairs a < b of a member and the hub of its list, of sizes that allow the similarity."""
    found = lists.join(hubs.select("key", F.col("cid").alias("hub"), F.col("n").alias("size")), "key").where("cid <> hub")
    found = found.where(F.least("n", "size") * 100 >= F.greatest("n", "size") * similar)
    return found.select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b")).distinct()


def _agreeing(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """Pairs whose full signatures agree often enough."""
    a = classes.select(F.col("cid").alias("a"), F.col("signature").alias("sa"))
    b = classes.select(F.col("cid").alias("b"), F.col("signature").alias("sb"))

    agreeing = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    return pairs.join(b, "b").join(a, "a").where(agreeing >= matches).select("a", "b")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid, text of the classes ``wanted``; equal sets of different texts do, one of them is
    taken. The join shuffles at every size: how many are wanted grows with the input."""
    keys = wanted.select("cid").distinct().join(classes.select("cid", "text_key"), "cid")
    return docs.select(text_or_empty().alias("text")).withColumn("text_key", F.xxhash64("text")).join(
        keys.hint("merge"), "text_key").select("cid", "text").dropDuplicates(["cid"])


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similar: int) -> DataFrame:
    """Pairs of classes whose full sets are similar."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: dict[int, np.ndarray] = {}

        def of(cid: int, text: str) -> np.ndarray:
            found = sets.get(cid)
            if found is None:
                if len(sets) >= 64:
                    sets.clear()
                found = sets[cid] = shingle_set(text, size)
            return found

        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                x, y = of(a, ta), of(b, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= similar * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    joined = pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")).hint("merge"), "b").join(
        texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")).hint("merge"), "a")
    return joined.select("a", "b", "ta", "tb").mapInPandas(compare, "a long, b long")


def _open(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Lists that reach over several components: key, cid, n, component, and ``top``, the
    component that most of the list is in."""
    placed = lists.select("key", "cid", "n").join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    per_list = placed.groupBy("key", "component").agg(F.count("*").alias("members"))
    largest = per_list.groupBy("key").agg(F.max(F.struct("members", "component")).alias("top"), F.count("*").alias("parts"))
    return placed.join(largest.where("parts > 1").select("key", F.col("top.component").alias("top")), "key")


def _across(open_lists: DataFrame, texts: DataFrame, size: int, similar: int) -> DataFrame:
    """Links from members outside of their lists' largest component to others they meet there,
    on full sets. Around each such component, both sides are dealt into blocks of bounded size,
    every block of one side meets every block of the other, and a block gives one link for each
    member and component found: the sets are compared, but no pairs are made of them."""
    sides = staged(open_lists.select("top", "cid", "component").distinct(), "near-sides")
    outside = F.col("component") != F.col("top")
    sizes = sides.groupBy("top").agg(F.ceil(F.count("*") / F.lit(PER_BLOCK)).cast("int").alias("blocks"),
                                     F.ceil(F.count_if(outside) / F.lit(PER_BLOCK)).cast("int").alias("asking"))
    known = staged(sides.join(sizes, "top").join(texts, "cid"), "near-sides")
    part = lambda parts: F.pmod(F.xxhash64("cid"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = known.where(outside).select(F.col("top").alias("t"), part("asking").alias("p"), every("blocks").alias("q"),
                                       F.col("cid").alias("asker"), F.col("component").alias("own"), F.col("text").alias("wanted"))
    right = known.where("asking > 0").select("top", every("asking").alias("p2"), part("blocks").alias("q2"), "cid", "component", "text")

    def compare(askers: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(askers) and len(members):
            sets = [shingle_set(t, size) for t in members["text"]]
            each = np.array([len(x) for x in sets])
            shingles, place = np.unique(np.concatenate(sets), return_inverse=True)
            starts, cids, of = np.r_[0, each.cumsum()[:-1]], members["cid"].to_numpy(), members["component"].to_numpy()
            for asker, own, text in zip(askers["asker"], askers["own"], askers["wanted"]):
                mine = shingle_set(text, size)
                at = np.minimum(np.searchsorted(shingles, mine), len(shingles) - 1)
                marked = np.zeros(len(shingles), np.int64)
                marked[at[shingles[at] == mine]] = 1
                both = np.add.reduceat(marked[place], starts)
                similar_ones = np.flatnonzero((100 * both >= similar * (len(mine) + each - both)) & (of != own))
                _, first = np.unique(of[similar_ones], return_index=True)
                found += [(asker, cids[similar_ones[k]]) for k in first]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return left.groupBy("t", "p", "q").cogroup(right.groupBy("top", "p2", "q2")).applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similar: int = SIMILAR,
                    coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and text_key and group (equal in a component)."""
    matches = least_matches(coordinates, similar)
    rows = staged(_sketched(docs, size, coordinates), "near-sketches")
    classes = rows.where("n_shingles > 0").groupBy("set_key").agg(
        F.first(F.struct("n_shingles", "signature", "text_key")).alias("one"))
    classes = staged(classes.select("set_key", F.monotonically_increasing_id().alias("cid"), F.col("one.n_shingles").alias("n"),
                                    "one.signature", "one.text_key"), "near-classes")
    lists = staged(_prefixes(classes, coordinates, matches), "near-lists")

    hubs = lists.groupBy("key").agg(F.max(F.struct("central", "cid", "n")).alias("hub")).select("key", "hub.cid", "hub.n")
    first = staged(_agreeing(_pairs(lists, hubs, similar), classes, matches), "near-pairs")
    texts = staged(_texts(docs, classes, lists), "near-texts")
    links = staged(_confirmed(first, texts, size, similar), "near-links")
    found = components(links)

    # what is left are members of one list in different components
    more = staged(_across(_open(lists, found), texts, size, similar), "near-links")
    found = staged(components(links.unionByName(more)), "near-components")

    of_class = classes.select("set_key", "cid").join(found.withColumnRenamed("node", "cid"), "cid", "left").select(
        "set_key", F.coalesce("component", "cid").alias("component"))
    placed_rows = rows.select("doc_id", "text_key", "n_shingles", "set_key").join(of_class, "set_key", "left")
    smallest = placed_rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    named = placed_rows.join(smallest, "component", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest")))
    return named.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key",
                        F.col("component").alias("group"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """``docs`` with all columns, one row for each component: that with the smallest id, and of
    texts that share it one. Rows without words stay; of rows equal in id and text, one."""
    found = near_duplicates(docs, size, similar).where("kept")
    chosen = found.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("one"))
    return rows_of(docs, chosen.select("one.*").unionByName(found.where("group is null").select("doc_id", "text_key")))
