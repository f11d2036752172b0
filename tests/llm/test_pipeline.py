"""Each stage against a brute-force version on its own input, and the whole."""

from collections import defaultdict

import pytest
from helpers import SF_DIR, awkward, documents, removed_bytes, roots, shingles, similar_pairs
from test_tokens import check_packing, ids

import corpus_pipeline as P
from tickwell.llm import toxicity
from tickwell.llm.common import staged, table


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = documents(spark), {}
    for name, stage in P.STAGES:
        out[name] = (docs, docs := staged(stage(spark, docs, SF_DIR), "test"))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "suffix_dedup", "best_fit_packing"]


def test_columns_stay(outputs):
    for name, (docs, out) in list(outputs.items())[:-1]:
        assert out.dtypes == docs.dtypes, name


def test_toxic_documents_go(spark, outputs):
    docs, out = outputs["toxicity"]
    model = toxicity.train(docs, table(spark, SF_DIR, "labels"), toxicity.held_out())
    scores = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(docs, model).alias("s")).collect()}
    assert set(rows(out)) == {i for i, s in scores.items() if s < 0.3}


def test_one_of_equal_texts_stays(outputs):
    docs, out = map(rows, outputs["exact_dedup"])
    newest = {}
    for i in sorted(docs):
        newest[docs[i]] = i
    assert out == {i: t for t, i in newest.items()}


def test_one_of_near_copies_stays(outputs):
    docs, out = map(rows, outputs["minhash_near_dedup"])
    order = sorted(docs)
    of = roots(range(len(order)), similar_pairs([shingles(docs[i]) for i in order]))
    assert set(out) == {order[k] for k in of if of[k] == k}


def test_repeats_are_cut(outputs):
    docs, out = map(rows, outputs["suffix_dedup"])
    order = sorted(docs)
    for i, marks in zip(order, removed_bytes([(i, docs[i]) for i in order])):
        raw = docs[i].encode()
        # a character goes if all of its bytes are marked
        kept = "".join(c for c, at in characters(docs[i]) if not all(marks[at:at + len(c.encode())]))
        assert out[i] == kept, (i, len(raw))


def characters(text):
    at = 0
    for c in text:
        yield c, at
        at += len(c.encode())


def test_everything_left_is_packed(outputs):
    docs, out = outputs["best_fit_packing"]
    pieces, lengths = out.collect(), defaultdict(int)
    check_packing(pieces)
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert lengths == {i: len(ids(t)) + 1 for i, t in rows(docs).items()}


def test_run_is_the_stages(spark, outputs):
    whole = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in P.run(spark, SF_DIR).collect()}
    assert whole == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in outputs["best_fit_packing"][1].collect()}


@pytest.mark.parametrize("stage", range(5))
def test_awkward_and_empty_tables(spark, stage):
    docs = awkward(spark)
    for df in (docs, docs.limit(0)):
        out = P.STAGES[stage][1](spark, df, SF_DIR)
        assert out.count() >= min(1, df.count())
        if stage < 4:
            assert out.columns == docs.columns
