"""Prefix token counts and packing, against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import ROWS, SF_DIR, awkward, documents, texts_of
from tokenizers import Tokenizer

from tickwell.llm import packing, token_counts
from tickwell.llm.bpe import Cache, load
from tickwell.llm.queries import QUERIES, VOCABULARY

LIBRARY = Tokenizer.from_file(VOCABULARY)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


ODD = ["", "a  b   c\n\n d", "it's we're I'll 'r '", "x<|endoftext|>y <|endof <|endoftext|>", "日本語 12  3.4é   z", "'''re'll  's",
       "\t\t a  b  ", "<|endoftext|>", " \n\n", "=" * 300, "\x1c\x1d a\x85b", "٣４ Ⅷ ²", "😀 👍🏽 a‍b"]


def test_counts_at_every_prefix():
    bpe, draw = load(VOCABULARY), random.Random(4)
    parts = [" ", "  ", "a", "'re", "'s", "'", "\n", "é", "12", "!", "<|endoftext|>", "the", "　", "世", "😀"]
    for text in ODD + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(200)]:
        assert bpe.prefix_counts(text).tolist() == [len(ids(text[:k])) for k in range(1, len(text) + 1)], repr(text)
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == ids(text), repr(text)


def test_cache_forgets_and_stays_right():
    made, cache = [], Cache(lambda k: made.append(k) or k * 2, 3)
    for k in [1, 2, 3, 4, 1, 5, 6, 7, 1, 8, 9, 10, 11, 2]:
        assert cache[k] == k * 2
    assert len(made) < 16 and len(cache) <= 3


def test_stored_counts_come_back():
    for counts in ([], [1], [1, 2, 2, 3], [0, 200, 10], [5, 70_000, 1], list(range(1000))):
        width, steps = token_counts.packed(np.array(counts, np.int64))
        assert token_counts.unpacked(len(counts), width, steps).tolist() == counts


def test_budgets_of_any_size_from_one_table(spark):
    docs = documents(spark).limit(20)
    texts, table = dict(texts_of(docs)), token_counts.prefix_table(docs, VOCABULARY).persist()
    for limit in (0, 1, 17, 300):
        for r in token_counts.cut_at(table, limit).collect():
            text = texts[r.doc_id]
            assert len(ids(text[:r.cut_chars])) <= limit and (r.cut_chars == len(text) or len(ids(text[:r.cut_chars + 1])) > limit)
    table.unpersist()


def test_query_counts_as_the_library(spark):
    texts = dict(texts_of(documents(spark)))
    for r in QUERIES["op10_token_counts"](spark, SF_DIR).collect():
        n = len(ids(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
        assert len(ids(texts[r.doc_id][:r.cut_chars])) <= 1024
        assert n <= 1024 or len(ids(texts[r.doc_id][:r.cut_chars + 1])) > 1024


def test_awkward_rows_and_budgets(spark):
    docs = awkward(spark)
    got = sorted((r.n_bytes, r.n_tokens, r.cut_chars) for r in token_counts.token_counts(docs, VOCABULARY, 20).collect())

    def cut(text):
        return max((k for k in range(len(text) + 1) if len(ids(text[:k])) <= 20), default=0)

    short = [(i, t, s) for i, t, s in ROWS if len(t or "") < 2000]
    want = [(len((t or "").encode()), len(ids(t or "")), cut(t or "")) for _, t, _ in short]
    assert [g for g in got if g[0] < 2000] == sorted(want) and len(got) == len(ROWS)
    prefixes = token_counts.prefix_table(awkward(spark, short), VOCABULARY)
    assert sorted((r.n_bytes, r.n_tokens, r.cut_chars) for r in token_counts.cut_at(prefixes, 20).collect()) == sorted(want)
    texts = {i: t or "" for i, t, _ in short}
    for r in prefixes.where("doc_id IS NOT NULL").collect():
        assert token_counts.unpacked(r.n_chars, r.width, r.steps).tolist() == [len(ids(texts[r.doc_id][:k + 1])) for k in range(r.n_chars)]
    assert token_counts.token_counts(docs.limit(0), VOCABULARY).count() == 0


def check_packing(rows, capacity=2048):
    """Gapless sequences within the capacity."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_query_packs_every_token_once(spark):
    rows = QUERIES["op7_best_fit_packing"](spark, SF_DIR).collect()
    texts, pieces = dict(texts_of(documents(spark))), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for doc_id, text in texts.items():
        own, at = np.array(ids(text) + [0], "<u4"), 0
        for number, (piece, start, length, crc) in enumerate(sorted(pieces[doc_id])):
            assert (piece, start) == (number, at) and (length == 2048 or number == 0)
            assert zlib.crc32(own[at:at + length].tobytes()) == crc
            at += length
        assert at == len(own)
    total = sum(r.length for r in rows)
    assert check_packing(rows) <= 1.02 * total / 2048 + 1


@pytest.mark.parametrize("per_group", [50, 400, 10 ** 6])
def test_rounds_of_any_size(spark, per_group):
    draw = np.random.default_rng(3)
    sizes = [int(n) for n in np.r_[draw.integers(1, 2049, 3000), [2048] * 5, [1] * 50]]
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "doc_id long, length long"), 2048, per_group).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(sizes))
    assert check_packing(rows) <= 1.08 * sum(sizes) / 2048 + 1


def test_best_fit_takes_the_fullest_bin():
    bins, at, fill = packing.best_fit(np.arange(5), np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and at.tolist() == [0, 0, 6, 5, 8] and fill.tolist() == [10] * 5


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark)
    pieces = packing.token_pieces(docs, VOCABULARY, 64, with_ids=True)
    packed = packing.pack(pieces, 64)
    rows = packed.collect()
    check_packing(rows, 64)
    assert sum(r.length for r in rows) == sum(len(ids(t or "")) + 1 for _, t, _ in ROWS)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in rows)
    assert packing.pack(packing.token_pieces(docs.limit(0), VOCABULARY)).count() == 0
