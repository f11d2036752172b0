import hashlib
import random

import numpy as np
import pytest
from helpers import ROWS, SF_DIR, awkward, documents, removed_bytes, texts_of

from tickwell.llm import repeats
from tickwell.llm.queries import QUERIES

LAST = 2 ** 63 - 1


def expected(rows):
    out = []
    ordered = [(LAST if i is None else i, t) for i, t in rows]
    for (doc_id, text), marks in zip(rows, removed_bytes(ordered)):
        raw, flags = text.encode(), np.frombuffer(bytes(marks), np.uint8)
        kept = bytes(b for b, m in zip(raw, marks) if not m)
        out.append((doc_id, len(raw), int(flags.sum()), int((np.diff(np.r_[0, flags.astype(int)]) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op8_suffix_dedup"](spark, SF_DIR)) == expected(texts_of(documents(spark)))


def stitched(seed, n=150):
    """Texts made of shared fragments that overlap, repeat and touch, over few letters."""
    draw = random.Random(seed)
    fragments = ["".join(draw.choice("ab é") for _ in range(draw.randrange(20, 120))) for _ in range(25)] + ["=" * 70, "ab" * 60]
    return [(draw.choice([k, k, None]), "".join(draw.choice(fragments) if draw.random() < 0.6 else
             "".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 60))) for _ in range(draw.randrange(6)))) for k in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_stitched_texts_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "PER_BUCKET", 40)
    monkeypatch.setattr(repeats, "HOT_PIECES", [5_000, 3][seed])
    monkeypatch.setattr(repeats, "FREQUENT", [8, 2][seed])
    rows = stitched(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(repeats.repeated(docs)) == expected(rows)


def test_long_runs_of_one_minimizer(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_LONGEST", 200)
    monkeypatch.setattr(repeats, "_SLICE", 333)
    rows = [(1, "x" * 3000), (2, "y" + "x" * 1500 + "z"), (3, "xy" * 700), (4, "yx" * 700 + "q")]
    assert got(repeats.repeated(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_awkward_rows(spark):
    rows = [(i, t, s) for i, t, s in ROWS if len(t or "") < 5000] + [(12, "w" + ROWS[0][1][3:] + "é", None)]
    docs = awkward(spark, rows)
    assert got(repeats.repeated(docs)) == expected([(i, t or "") for i, t, _ in rows])
    cut = repeats.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r.doc_id: (r.text, r.n_chars) for r in cut.where("doc_id IS NOT NULL").collect()}
    assert texts[1] == (None, None) and texts[4] == ("one two", 7) and texts[8] == (" end"[-3:], 3) or texts[8][0].endswith("end")
    assert texts[7] == (ROWS[0][1], len(ROWS[0][1]))
    assert repeats.repeated(docs.limit(0)).count() == 0 and repeats.without_repeats(docs.limit(0)).columns == docs.columns


def test_no_character_is_cut_apart(spark):
    shared = "0123456789" * 6
    docs = spark.createDataFrame([(1, shared + "é"), (2, "a" + shared + "è tail")], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert texts == {1: shared + "é", 2: "aè tail"}


def test_merged_order_equals_sorting():
    draw = random.Random(1)
    parts = ["".join(draw.choice("ab") for _ in range(draw.randrange(7, 30))).encode() for _ in range(40)]
    ids = np.array([draw.randrange(10) for _ in parts])
    for length in (6, 7):
        first = {}
        for p, i in zip(parts, ids):
            for k in range(len(p) - length + 1):
                first[p[k:k + length]] = min(i, first.get(p[k:k + length], i))
        found = repeats.earliest(parts, ids, length)
        assert [f.tolist() for f in found] == [[first[p[k:k + length]] for k in range(len(p) - length + 1)] for p in parts]
