import random

import sentencepiece
from helpers import ROWS, SF_DIR, awkward, documents, texts_of
from pyspark.sql import functions as F

from tickwell.llm import sentencepiece_lattice as L
from tickwell.llm.queries import PIECES, QUERIES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_query_counts_as_the_library(spark):
    texts = dict(texts_of(documents(spark)))
    for r in QUERIES["op4_sentencepiece"](spark, SF_DIR).collect():
        assert r.n_pieces == len(LIBRARY.encode(texts[r.doc_id])) and r.round_trip


def test_ids_and_round_trip(spark):
    draw = random.Random(3)
    texts = ["", "a", " a", "  a  b ", "a\nb", "日本 x▁y  ", "  ", "<s> é ﬁ ａ 😀", "th" * 40, "a\x00b", "x" * 700, " " * 40 + "y"]
    texts += ["".join(draw.choice("aaabeéntthi ho日x ") for _ in range(draw.randrange(1, 40))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in L.encode(docs, PIECES).collect()}
    assert got == {k: LIBRARY.encode(t) for k, t in enumerate(texts)}
    words = L.vocabulary(docs)
    again = L.encode_words(words, PIECES, 4).where(F.col("word") != F.col("decoded"))
    assert again.count() == 0


def test_awkward_rows(spark):
    short = [(i, t, s) for i, t, s in ROWS if len(t or "") < 5000]
    docs = awkward(spark, short)
    got = sorted(((r.doc_id, r.n_bytes, r.n_pieces, r.round_trip) for r in L.piece_counts(docs, PIECES).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), len(LIBRARY.encode(t or "")), True) for i, t, _ in short), key=str)
    assert L.piece_counts(docs.limit(0), PIECES).count() == 0 and L.encode(docs.limit(0), PIECES).count() == 0


def test_query_gives_ids_and_whole_round_trips(spark):
    texts = dict(texts_of(documents(spark)))
    rows = QUERIES["op4_sentencepiece"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == LIBRARY.encode(texts[r.doc_id]) and r.round_trip == (LIBRARY.decode(r.ids) == texts[r.doc_id])


def test_order_of_rare_and_frequent_words(spark, monkeypatch):
    """Few words are looked up near; the others come by a join, and all stand in the order of the text."""
    monkeypatch.setattr(L, "FREQUENT", 3)
    texts = ["the cat the dog", "dog the the cat", "the cat the dog", "a▁b", " the  bird", ""] + ["the dog"] * 20
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in L.encode(docs, PIECES).collect():
        assert r.ids == LIBRARY.encode(texts[r.doc_id]) and r.round_trip == (LIBRARY.decode(r.ids) == texts[r.doc_id])


def test_texts_without_spaces(spark):
    draw = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(draw.choice(letters) for _ in range(120_000)), "日本語の文" * 25_000, "the\tcat\nsat\n" * 9_000, "a" * 100_000,
             "x" + " " * 100_000, "=-" * 60_000, "thethe" * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts + texts)), "doc_id long, text string")
    rows = L.encode(docs, PIECES).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        text = texts[r.doc_id % len(texts)]
        assert r.ids == LIBRARY.encode(text) and r.round_trip
