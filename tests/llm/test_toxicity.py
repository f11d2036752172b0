import numpy as np
import pytest
from helpers import ROWS, awkward
from pyspark.sql import functions as F

from tickwell.llm import boosting, toxicity
from tickwell.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op2_toxicity"](spark, SF_DIR).toPandas()


def test_held_out_rows_are_ranked(spark, scored):
    """Accuracy on rows that the model has not seen; the table has some forty toxic training rows."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    assert sorted(scored["doc_id"]) == sorted(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert scored["score"].between(0, 1).all() and (scored["predicted"] == (scored["score"] >= 0.3)).all()
    seen = scored.merge(labels, on="doc_id")
    out = seen[seen["held_out"]]
    pos, neg = out[out["toxic"] == 1]["score"].to_numpy(), out[out["toxic"] == 0]["score"].to_numpy()
    assert ((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])).mean() > 0.8
    assert (out["predicted"] == out["toxic"]).mean() > 0.9


def test_held_out_is_the_remainder(spark):
    import zlib
    rows = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, scored):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = toxicity.train(docs, turned, toxicity.held_out())
    again = docs.select("doc_id", toxicity.score(docs, model).alias("again")).toPandas().merge(scored, on="doc_id")
    assert np.allclose(again["again"], again["score"])


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1), (7, 0, None), (None, 1, 1), (7, 1, 0), (7, 1, 0)],
                                   "doc_id long, toxic int, quality int").withColumn("text", F.lit("clash"))
    for some in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.train(docs, some, F.lit(False))
        got = docs.select(toxicity.score(docs, model).alias("s")).collect()
        assert len(got) == len(ROWS) and all(0 <= r.s <= 1 for r in got)
    clean = toxicity.clean(docs, model, 2.0)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    empty = docs.limit(0)
    model = toxicity.train(empty, labels, F.lit(False))
    assert toxicity.clean(empty, model).count() == 0


def test_words_behind_signs_are_found():
    features = toxicity.Features({"idiot": 5.0})
    for text in ("you idiot", "You IDIOT!!", "«idiot», you", "you 1d10t", "you i*d*i*o*t"):
        x = dict(zip(features.NAMES, features.of(text)))
        assert x["hits"] == 1 and x["near_second_person"] == 1, text
    assert features.of("")[0] == 0 and features.of("clean text")[0] == 0


def test_trees_learn_and_isotonic_never_falls():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    margin = boosting.fit(x[:2000], y[:2000]).margin(x[2000:])
    assert ((margin > 0) == (y[2000:] > 0)).mean() > 0.95
    levels, shares = boosting.isotonic(margin, y[2000:])
    assert (np.diff(shares) >= 0).all() and len(levels) == len(shares)
    rare = np.zeros((500, 1))
    rare[:20] = 1
    assert (boosting.fit(rare, rare[:, 0]).margin(rare) > 0).sum() == 20
    for n in (0, 1):
        assert len(boosting.fit(x[:n], y[:n]).margin(x)) == 3000


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_equals_least_squares(seed):
    draw = np.random.default_rng(seed)
    s, y = draw.integers(0, 8, 40).astype(float), draw.integers(0, 2, 40).astype(float)
    levels, shares = boosting.isotonic(s, y)
    # min-max formula over blocks of levels
    means = [[y[(s >= a) & (s <= b)].mean() if a <= b else 0 for b in levels] for a in levels]
    for k in range(len(levels)):
        assert np.isclose(shares[k], max(min(means[i][j] for j in range(k, len(levels))) for i in range(k + 1)))
