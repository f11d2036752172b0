import math

import numpy as np
from helpers import ROWS, awkward

from tickwell.llm import quality
from tickwell.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_scores_agree_with_labels_never_seen(spark):
    got = QUERIES["op9_quality_classifier"](spark, SF_DIR).toPandas()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    both = got.merge(labels, on="doc_id")
    good, bad = both[both["quality"] == 1], both[both["quality"] == 0]
    assert good["kept"].mean() > 0.98 and bad["kept"].mean() < 0.1
    assert got["score"].between(0, 1).all() and got["posterior"].between(0, 1).all()


def test_label_model_finds_the_accuracies():
    """Labellers of known accuracy: the model ranks patterns as the truth does."""
    draw = np.random.default_rng(1)
    truth = draw.random(20_000) < 0.8
    votes = np.stack([np.where(draw.random(20_000) < 0.2, 0, np.where((draw.random(20_000) < a) == truth, 1, -1))
                      for a in (0.95, 0.9, 0.85, 0.9, 0.6)], 1)
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    chance = quality.label_model(patterns, counts)[at.ravel()]
    assert ((chance > 0.5) == truth).mean() > 0.95
    assert abs(chance.mean() - truth.mean()) < 0.05


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = quality.scores(docs).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted((i for i, _, _ in ROWS), key=str)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert quality.scores(docs.limit(0)).count() == 0


def test_votes_of_plain_and_broken_texts():
    plain = " ".join(f"A plain sentence stands here with number{k} of words{k} that{k} differ{k}." for k in range(8))
    assert quality.BAD not in quality.votes(plain)
    for broken in (plain.upper(), " ".join(w + "!!" for w in plain.split()), " | ".join(plain.split()),
                   " ".join(w + "$$$" for w in plain.split()), "same " * 60):
        assert quality.BAD in quality.votes(broken)
    assert len(quality.votes("")) == 10


def test_copies_do_not_change_what_is_learnt(spark):
    """Seven texts, three of them spam, a thousand and twenty thousand times each."""
    plain = [" ".join(f"A plain sentence stands here with number{k} of words{k} that{k + j} differ{k * j}." for k in range(8)) for j in range(4)]
    spam = [" | ".join(w.upper() + "!!" for w in t.split()) + " $$$" for t in plain[:3]]
    found = []
    for copies in (1_000, 20_000):
        docs = spark.createDataFrame(list(enumerate(plain + spam)), "doc_id long, text string").crossJoin(spark.range(copies)).drop("id")
        rows = quality.scores(docs.repartition(8)).dropDuplicates().collect()
        found.append({r.doc_id: (round(r.score, 2), r.kept) for r in rows})
        assert len(rows) == 7 and [r.kept for r in sorted(rows)] == [True] * 4 + [False] * 3
    assert found[0].keys() == found[1].keys() and all(abs(found[0][k][0] - found[1][k][0]) <= 0.02 for k in found[0])


def test_sample_is_bounded_in_features(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_FEATURES", 200)
    fitted = []
    real = quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda rows, chances: fitted.append(len(rows)) or real(rows, chances))
    docs = spark.createDataFrame([(k, f"some words of text {k} " * 20) for k in range(200)], "doc_id long, text string")
    assert quality.scores(docs, sample=150).count() == 200 and 0 < fitted[0] < 150


def test_posterior_equals_a_plain_model_over_documents(spark):
    """Expectation-maximisation over all rows one by one, without patterns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    cast = [quality.votes(r.text or "") for r in rows]
    good = [0.9 if v.count(-1) == 0 else 0.45 if v.count(-1) == 1 else 0.1 for v in cast]
    for _ in range(50):
        total = sum(good)
        share = min(max(total / len(rows), 1e-3), 1 - 1e-3)
        odds = [math.log(share / (1 - share))] * len(rows)
        for k in range(10):
            for vote in (1, 0, -1):
                has = [i for i, v in enumerate(cast) if v[k] == vote]
                p = (sum(good[i] for i in has) + 0.5) / (total + 1.5)
                q = (sum(1 - good[i] for i in has) + 0.5) / (len(rows) - total + 1.5)
                for i in has:
                    odds[i] += math.log(p / q)
        good = [1 / (1 + math.exp(-min(max(x, -30), 30))) for x in odds]
    want = {r.doc_id: g for r, g in zip(rows, good)}
    got = {r.doc_id: r.posterior for r in quality.scores(docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_coded_words_give_the_plain_counts(spark):
    """The shared codes give the votes that counting word by word gives, and the slots of plain numbering."""
    texts = [r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").limit(300).collect()]
    texts += ["", "a", "A a A a", "| • -- $$$ a$ $ go!! End. end. ok: x", "\U0001F600 \uFFFF é É ß " * 30, "same same Same " * 20]
    for text in texts:
        words, codes = quality._coded(text)
        assert words == text.split() and len(codes) == len(words)
        for bit, has in ((quality._ALONE, lambda w: w in "|•·-*>»"), (quality._TRAILING, lambda w: w[-1] in quality._SYMBOLS and len(w) > 1),
                         (quality._ENDING, lambda w: w[-1] in ".!?…:;,")):
            assert [bool(c & bit) for c in codes.tolist()] == [has(w) for w in words]
        assert quality.votes(text) == quality.votes(text, (words, codes))
        if len(words) > 1:
            again = sum(map(str.__eq__, words, words[1:])) / len(words)
            assert quality.votes(text)[4] == quality._vote(again, 0.02, 0.12)
        slots, values = quality.features(text, (words, codes))
        own, shapes = [c >> 17 & 131071 for c in codes.tolist()], [c & 131071 for c in codes.tolist()]
        pairs = [(a * 31 + b * 17 + 7) % 131072 for a, b in zip(shapes, shapes[1:])]
        want, n = np.unique(own + shapes + pairs + [3] * sum(a == b for a, b in zip(own, own[1:])) or [0], return_counts=True)
        logs = np.log1p(n) if words else np.ones(1)
        assert slots.tolist() == want.tolist() and np.array_equal(values, logs / np.sqrt((logs ** 2).sum()))
