import numpy as np
import pytest
from helpers import SF_DIR, roots
from pyspark.sql import functions as F

from tickwell.llm import quantised
from tickwell.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, similar=0.98):
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.sqrt((v ** 2).sum())

    units = [unit(r[1]) if r[2] is not None else None for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None
             and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= similar]
    of, degree = roots(range(len(rows)), links), np.zeros(len(rows), int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    out = []
    for k, r in enumerate(rows):
        ids = [rows[j][0] for j in of if of[j] == of[k] and rows[j][0] is not None]
        smallest = min(ids, default=None)
        out.append((r[0], int(degree[k]), smallest, r[0] == smallest))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert got(QUERIES["op3_embedding_near_dedup"](spark, SF_DIR)) == expected(rows)


@pytest.mark.parametrize("seed, part", [(0, 5_000), (1, 20)])
def test_clusters_equal_brute_force(spark, seed, part, monkeypatch):
    """Near copies on both sides of the threshold, chains, and one vector that many rows share."""
    monkeypatch.setattr(quantised, "PER_PART", part)
    draw, rows = np.random.default_rng(seed), []
    for centre in draw.normal(size=(30, 16)):
        for _ in range(12):
            centre = centre + draw.normal(size=16) * draw.choice([0.02, 0.1, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in centre], int(draw.integers(0, 2))))
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(60)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(quantised.near_duplicates(vectors, lists=9)) == expected(rows)


def test_awkward_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, float("nan"), 3.0], 1),
            (6, [1.0, float("inf"), 3.0], 1), (7, v, 1), (8, v, None), (9, v, None), (10, [2.0, 4.0, 6.0], 1), (10, v, 1), (11, v, 2),
            (None, v, 1), (None, v, 3), (12, [-0.0, 1.0, 0.0], 4), (13, [0.0, 1.0, -0.0], 4), (14, [1.0, 2.0], 1), (15, [3.0], 1),
            (16, [1e-30, 2e-30, 3e-30], 1), (17, [1e30, 2e30, 3e30], 1)]
    extra = {name: F.lit("extra") for name in ("x", "entry", "eid", "copies", "list", "part", "codes", "dim", "kept", "n_links")}
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns(extra)
    assert got(quantised.near_duplicates(vectors)) == expected(rows)
    assert quantised.near_duplicates(vectors.limit(0)).count() == 0
    assert quantised.near_duplicates(vectors.where("vec_id < 7")).where("n_links > 0 OR NOT kept").count() == 0


def test_lower_bounds_never_drop_a_neighbour():
    """Probes and table distances: every pair within the radius is visited and passes the bound."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 16))
    x = np.concatenate([x, x + draw.normal(size=x.shape) * 0.05])
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    index, radius = quantised.fit(x[:300], 12), 0.25
    own = index.nearest(x)
    codes, error = index.encode(x, own)
    probes = index.probes(x, own, radius)
    apart = np.sqrt(quantised._distances(x, x))
    for a, b in zip(*np.nonzero(apart <= radius)):
        assert own[b] in probes[a]
        table = index.tables(x[a:a + 1], own[b])[0]
        far = np.sqrt(sum(table[m, codes[b, m]] for m in range(codes.shape[1])))
        assert far <= radius + error[b] + 1e-6


def test_queries_and_members_of_a_long_list_are_dealt(spark, monkeypatch):
    """One label and one list: no group holds all queries or all members, and every pair meets once."""
    monkeypatch.setattr(quantised, "PER_PART", 50)
    coded = spark.range(600).selectExpr(
        "id AS eid", "1 AS label", "1L AS copies", "0 AS list", "array(1D) AS x", "X'00' AS codes", "0D AS error", "array(0) AS probes")
    queries, members = quantised._dealt(coded)
    asked = {tuple(r)[:4]: r["n"] for r in queries.groupBy("for_label", "in_list", "in_part", "of_part").agg(F.count("*").alias("n")).collect()}
    held = {tuple(r)[:4]: r["n"] for r in members.groupBy("label", "list", "part", "for_part").agg(F.count("*").alias("n")).collect()}
    assert max(asked.values()) <= 100 and max(held.values()) <= 100
    assert asked.keys() == held.keys() and sum(asked[k] * held[k] for k in asked) == 600 ** 2
