import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from helpers import ROWS, SF_DIR, awkward, documents, texts_of
from pyspark.sql import functions as F

from check import TABLES, compare
from tickwell.llm import exact_dedup as E


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    text, _, ok = compare(spark, con, SF_DIR, "op5_exact_dedup")
    assert ok, text


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest, first = hashlib.sha256(text.encode()).hexdigest(), True
        for i in ids:
            out[i, keep, len(ids), i == keep and first, digest] += 1
            first &= i != keep
    return out


@pytest.mark.parametrize("split", [None, -100, 5, 100])
def test_awkward_rows(spark, split):
    """Whatever part is the snapshot, also none or all of it."""
    batch = None if split is None else F.coalesce(F.col("doc_id") > split, F.lit(True))
    got = E.exact_dedup(awkward(spark), batch).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == expected(
        [(i, t or "") for i, t, _ in ROWS])


def test_one_of_each_keeps_all_columns(spark):
    docs = awkward(spark)
    kept = E.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t, _ in ROWS})
    assert kept.where("source = 'z' AND text = 'one two'").first().doc_id == 5


def test_empty_table(spark):
    empty = awkward(spark).limit(0)
    assert E.exact_dedup(empty).count() == 0 and E.one_of_each(empty).columns == empty.columns


def test_copies_all_over(spark):
    docs = documents(spark)
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(docs.limit(1).crossJoin(
        spark.range(500).withColumnRenamed("id", "k")).withColumn("doc_id", F.col("k") + 5000).drop("k"))
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in E.exact_dedup(many).drop("text_key").collect())
    assert got == expected(texts_of(many))


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20_000])
def test_filter_has_no_false_negatives(n):
    draw = np.random.default_rng(n)
    keys, others = draw.integers(0, 2 ** 63, n, dtype=np.uint64), draw.integers(2 ** 63, 2 ** 64, 50_000, dtype=np.uint64)
    seed, block, table = E.build_filter(np.r_[keys, keys])
    assert E.maybe_in(keys, seed, block, table).all()
    assert E.maybe_in(others, seed, block, table).mean() < 0.001
    assert len(table) <= 1.5 * n + 400


def test_bytes_decide_where_digests_agree(spark, monkeypatch):
    """A digest that two texts share: the byte check tells them apart."""
    docs = spark.createDataFrame([(1, "left"), (2, "right"), (3, "left")], "doc_id long, text string")
    rows = docs.select("doc_id", F.lit("same").alias("digest"), F.lit(4).cast("long").alias("n_bytes"))
    monkeypatch.setattr(E, "_texts", lambda d, groups: groups.join(
        d.select(F.col("doc_id").alias("keep_id"), "text"), "keep_id").select("digest", "text"))
    snap = E.snapshot(docs, rows.where("doc_id = 1"))
    for one, same in ((2, 0), (3, 1)):
        batch = E._groups(rows.where(f"doc_id = {one}"))
        assert E.matched(docs, batch, snap).count() == same
