"""Near-duplicate embeddings by product quantisation over inverted lists.

Vectors are scaled to length 1. A coarse quantiser deals them over inverted lists; the
residual to the list's centroid is coded in sub-spaces, and each vector keeps the length of
its coding error. A query visits every list that can hold a vector within the radius (the
plane halfway between two centroids is no farther from it than the radius), so the probes
are sufficient, not a guess. In a list, distances come from look-up tables of the query's
residual (asymmetric); the error length turns them into a lower bound, and only vectors
whose bound is within the radius are compared by exact cosine in double precision. Nothing
that is similar enough is missed.

The quantisers are fitted on at most ``SAMPLE`` vectors, taken by the hash of their id. Every
vector is indexed. Equal vectors of a label are one entry with a count, so a vector that a
third of all rows share is one row; the vectors of a long list and the queries that visit it are
both split into parts of ``PER_PART``, and what a task holds at once is one part of each.

* Vectors that are NULL, empty, zero, or hold NULL or non-finite components, and vectors
  without label, are linked with nothing. Vectors of different lengths are never linked.
* NULL ids: as in other components, never the smallest next to other ids; alone, NULL and kept.
* Rows that repeat an id count as vectors of their own.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import staged
from tickwell.llm.graph import components

#: Vectors that the quantisers are fitted on, at most; inverted lists, at most.
SAMPLE, LISTS = 20_000, 1_024
SUBSPACES, CODEWORDS = 8, 64
PER_PART = 5_000
_MARGIN = 1e-6


@dataclass
class Index:
    """Quantisers for vectors of one length: bounded by their parameters."""
    centroids: np.ndarray
    codebooks: list[np.ndarray]
    cuts: list[int]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return _distances(x, self.centroids).argmin(1)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes by sub-space, and the length of the coding error."""
        rest = x - self.centroids[lists]
        codes, error = np.empty((len(x), len(self.codebooks)), np.uint8), np.zeros(len(x))
        for k, book in enumerate(self.codebooks):
            part = rest[:, self.cuts[k]:self.cuts[k + 1]]
            codes[:, k] = _distances(part, book).argmin(1)
            error += ((part - book[codes[:, k]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists that may hold a vector within the radius of each vector."""
        d = _distances(x, self.centroids)
        apart = np.sqrt(np.maximum(_distances(self.centroids, self.centroids), 0))
        near = d - d[np.arange(len(x)), own][:, None] <= 2 * (radius + _MARGIN) * apart[own] + _MARGIN
        return [np.flatnonzero(row) for row in near]

    def tables(self, x: np.ndarray, number: int) -> np.ndarray:
        """Squared distances of a query's residual to all codewords: query, sub-space, codeword."""
        rest = x - self.centroids[number]
        out = np.full((len(x), len(self.codebooks), CODEWORDS), np.inf)
        for k, book in enumerate(self.codebooks):
            out[:, k, :len(book)] = _distances(rest[:, self.cuts[k]:self.cuts[k + 1]], book)
        return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] + (y ** 2).sum(1)[None] - 2 * (x @ y.T), 0)


def _kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids from evenly spaced starts over rows in a fixed order; empty ones stay put."""
    k = max(1, min(k, len(x)))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = _distances(x, centres).argmin(1)
        counts = np.bincount(own, minlength=k)
        for f in range(x.shape[1]):
            sums = np.bincount(own, x[:, f], k)
            centres[counts > 0, f] = sums[counts > 0] / counts[counts > 0]
    return centres


def fit(sample: np.ndarray, lists: int) -> Index:
    width = sample.shape[1]
    centroids = _kmeans(sample, lists)
    rest = sample - centroids[_distances(sample, centroids).argmin(1)]
    cuts = np.unique(np.linspace(0, width, min(SUBSPACES, width) + 1).astype(int)).tolist()
    books = [_kmeans(rest[:, a:b], CODEWORDS, 6) for a, b in zip(cuts, cuts[1:])]
    return Index(centroids, books, cuts)


def _unit(vectors) -> np.ndarray:
    x = np.stack(vectors).astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(1))[:, None]


def _entries(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """vec_id, x (doubles), label, dim, usable and a key equal for equal vectors of a label."""
    x = F.col("x")
    good = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(
        x, lambda v: v != 0) & F.col("label").isNotNull()
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"),
                          F.col(label).alias("label"))
    # -0.0 and 0.0 are the same number
    rows = rows.withColumn("x", F.transform("x", lambda v: v + F.lit(0.0)))
    return rows.withColumn("usable", F.coalesce(good, F.lit(False))).withColumn("dim", F.size("x")).withColumn(
        "entry", F.when(F.col("usable"), F.sha2(F.concat_ws(
            "|", F.col("label").cast("string"), F.array_join(F.transform("x", lambda v: v.cast("string")), ",")), 256)))


class _Roots:
    """What links connect, kept as one link from each node towards its smallest."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def _root(self, node: int) -> int:
        up = self.up
        while (above := up.setdefault(node, node)) != node:
            up[node] = node = up[above]
        return node

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self._root(x), self._root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = [(node, above) for node, above in self.up.items() if node != above]
        return (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))


def _dealt(coded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries and members of every list, in groups of about ``PER_PART`` of each: members and queries
    of a long list are both dealt over parts, and each part of one meets each part of the other once."""
    def parts(of: DataFrame, name: str) -> DataFrame:
        return of.groupBy("label", "list").agg(F.ceil(F.count("*") / F.lit(PER_PART)).cast("int").alias(name))

    asked = coded.select("label", F.explode("probes").alias("list"), F.col("eid").alias("query"), F.col("x").alias("qx"))
    sizes = staged(parts(coded, "parts").join(parts(asked.select("label", "list"), "asking"), ["label", "list"]), "list-parts")
    members = coded.drop("probes").join(sizes, ["label", "list"]).select(
        "label", "list", F.pmod(F.xxhash64("eid"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("for_part"), "eid", "copies", "x", "codes", "error")
    queries = asked.join(sizes, ["label", "list"]).select(
        F.col("label").alias("for_label"), F.col("list").alias("in_list"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("in_part"),
        F.pmod(F.xxhash64("query"), "asking").cast("int").alias("of_part"), "query", "qx")
    return queries, members


def _pairs(entries: DataFrame, index: Index, dim: int, similar: float) -> DataFrame:
    """Links of entries with a cosine of at least ``similar``, as rows of two kinds: (a, NULL, n),
    how many vectors a is linked with in one part of a list, and (a, b, NULL), links enough to
    connect all that the part connects. So a group of near copies gives as many rows as it has
    members, not as many as it has pairs."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * similar)))
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def indexed(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = _unit(batch["x"])
            own = shared.value.nearest(x)
            codes, error = shared.value.encode(x, own)
            yield pd.DataFrame({"eid": batch["eid"], "label": batch["label"], "copies": batch["copies"], "list": own, "x": list(x),
                                "codes": [c.tobytes() for c in codes], "error": error,
                                "probes": list(shared.value.probes(x, own, radius))})

    kind = entries.schema["label"].dataType.simpleString()
    coded = staged(entries.select("eid", "label", "copies", "x").mapInPandas(
        indexed, f"eid long, label {kind}, copies long, list int, x array<double>, codes binary, error double, probes array<int>"),
        "quantised")
    queries, members = _dealt(coded)

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        counts, roots = np.zeros(len(left), np.int64), _Roots()
        if len(left) and len(right):
            x, eids = np.stack(left["qx"]), left["query"].to_numpy()
            codes = np.frombuffer(b"".join(right["codes"]), np.uint8).reshape(len(right), -1)
            y, error, others, copies = (np.stack(right["x"]), right["error"].to_numpy(), right["eid"].to_numpy(),
                                        right["copies"].to_numpy())
            reach = (radius + error + _MARGIN) ** 2
            step = max(1, 4_000_000 // len(right))
            for k in range(0, len(x), step):
                tables = shared.value.tables(x[k:k + step], int(key[1]))
                far = np.zeros((len(tables), len(right)))
                for m in range(codes.shape[1]):
                    far += tables[:, m][:, codes[:, m]]
                q, c = np.nonzero((far <= reach[None]) & (eids[k:k + step, None] != others[None]))
                for j in range(0, len(q), 100_000):
                    a, b = q[j:j + 100_000] + k, c[j:j + 100_000]
                    close = (x[a] * y[b]).sum(1) >= similar
                    a, b = a[close], b[close]
                    counts += np.bincount(a, copies[b], len(x)).astype(np.int64)
                    roots.join(eids[a], others[b])
        linked = np.flatnonzero(counts)
        a, b = roots.links()
        return pd.DataFrame({
            "a": np.concatenate([left["query"].to_numpy()[linked].astype(np.int64), a]),
            "b": pd.array([None] * len(linked) + b.tolist(), "Int64"),
            "n": pd.array(counts[linked].tolist() + [None] * len(b), "Int64")})

    return queries.groupBy("for_label", "in_list", "in_part", "of_part").cogroup(
        members.groupBy("label", "list", "part", "for_part")).applyInPandas(
        compare, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, similar: float = 0.98, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label", lists: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = staged(_entries(vectors, id_column, vector, label), "embeddings")
    usable = rows.where("usable")
    entries = usable.groupBy("entry").agg(F.count("*").alias("copies"), F.first(F.struct("label", "x", "dim")).alias("one"))
    entries = staged(entries.select("entry", F.monotonically_increasing_id().alias("eid"), "copies", "one.*"), "entries")
    links = None
    for dim, n in sorted((r["dim"], r["n"]) for r in entries.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        own = entries.where(F.col("dim") == dim)
        sample = own.orderBy("entry").limit(SAMPLE).select("x").toPandas()
        index = fit(_unit(sample["x"]), lists or int(min(LISTS, max(1, np.sqrt(n / 8)))))
        found = _pairs(own, index, dim, similar)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = rows.sparkSession.createDataFrame([], "a long, b long, n long")
    links = staged(links, "embedding-links")
    found = components(links.where("b IS NOT NULL").select("a", "b"))
    degrees = links.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    placed = entries.select("entry", "eid", "copies").join(found.withColumnRenamed("node", "eid"), "eid", "left").join(
        degrees.withColumnRenamed("a", "eid"), "eid", "left").select(
        "entry", F.coalesce("component", "eid").alias("component"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    placed_rows = rows.select("vec_id", "entry").join(placed, "entry", "left")
    smallest = placed_rows.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("smallest"))
    named = placed_rows.join(smallest, "component", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("smallest")))
    return named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
