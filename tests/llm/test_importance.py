"""Importance resampling against plain Python and SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, ROWS, SF_DIR, awkward

from check import TABLES, compare
from tickwell.llm import importance

TARGET = [("one two three word1 word2",), (None,), ("",), ("é日本😀 other1",)]


def grams(text, longest):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[k:k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def expected(rows, target, longest, buckets, percent, least):
    of = lambda texts: Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t, longest)[1])
    s, t = of([r[1] for r in rows]), of([r[0] for r in target])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text, *_ in rows:
        words, found = grams(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
                 for b in (zlib.crc32(g.encode()) % buckets for g in found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    text, _, ok = compare(spark, con, SF_DIR, "op11_importance_resampling")
    assert ok, text


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_awkward_rows(spark, longest):
    target = spark.createDataFrame(TARGET, "text string")
    got = importance.resample(awkward(spark), target, longest=longest, buckets=97, percent=60, least_words=2).collect()
    want = expected(ROWS, TARGET, longest, 97, 60, 2)
    # rows that are equal in score and id may take each other's rank
    assert sorted(map(str, ((r.doc_id, r.n_features, r.weight, r.score) for r in got))) == sorted(map(str, (w[:4] for w in want)))
    assert sorted((r["rank"], r.score, str(r.doc_id)) for r in got if r["rank"]) == sorted((w[4], w[3], str(w[0])) for w in want if w[4])


def test_empty_tables_and_nothing_drawn(spark):
    docs, target = awkward(spark), spark.createDataFrame(TARGET, "text string")
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0), percent=0).where("rank IS NOT NULL").count() == 0
    assert importance.resample(docs, target.limit(0), least_words=10 ** 6).where("rank IS NOT NULL").count() == 0


def test_equal_scores_and_whole_rows(spark):
    docs = spark.range(400).selectExpr("id % 40 AS doc_id", "repeat('same words here ', 10) AS text", "id AS rank")
    target = spark.createDataFrame(TARGET, "text string")
    got = importance.resample(docs, target, percent=50).where("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 201))
    order = [(-r.score, r.doc_id) for r in sorted(got, key=lambda r: r["rank"])]
    assert order == sorted(order)
    drawn = importance.drawn(docs, target, percent=50)
    assert drawn.columns == docs.columns and drawn.count() == 200


@pytest.mark.parametrize("most", [1, 50, 10 ** 9])
def test_slices_cover_a_batch(most):
    texts = pa.array(["a b", "", "x" * 200, "c", "é é"])
    parts = list(importance.slices(texts, most))
    assert [t for _, p in parts for t in p.to_pylist()] == texts.to_pylist()
    assert [at for at, _ in parts] == np.cumsum([0, *[len(p) for _, p in parts[:-1]]]).tolist()


def test_very_long_text(spark):
    text = "alpha beta7 ÄÖ, " * 200_000
    docs = spark.createDataFrame([(1, text), (2, "alpha")], "doc_id long, text string")
    got = {r.doc_id: r for r in importance.resample(docs, docs, longest=2).collect()}
    assert got[1].n_features == 2 * 600_000 - 1 and got[2].n_features == 1
