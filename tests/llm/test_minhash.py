import random

import pytest
from helpers import ROWS, SF_DIR, awkward, documents, roots, shingles, similar_pairs, texts_of

from tickwell.llm import minhash
from tickwell.llm.graph import components
from tickwell.llm.queries import QUERIES


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    of = roots(range(len(rows)), similar_pairs(sets))
    out = []
    for k, (doc_id, _) in enumerate(rows):
        same = [rows[j][0] for j in of if of[j] == of[k] and rows[j][0] is not None]
        smallest = min(same, default=None) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), smallest, doc_id == smallest))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op6_minhash_near_dedup"](spark, SF_DIR)) == expected(texts_of(documents(spark)))


def near_copies(seed, families=12, each=8):
    """Families of edited copies on both sides of the threshold, and chains of them."""
    draw, rows = random.Random(seed), []
    for f in range(families):
        words = [f"w{f}x{k}" for k in range(60)]
        for _ in range(each):
            words = list(words)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                words[draw.randrange(len(words))] = f"new{draw.random()}"
            rows.append((len(rows), " ".join(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_edited_copies_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(minhash.near_duplicates(docs)) == expected(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert got(minhash.near_duplicates(docs)) == expected([(i, t or "") for i, t, _ in ROWS])
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, 1, 2, 3, 4, 7, 9, 11, -3], key=str)
    empty = docs.limit(0)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.one_of_each(empty).count() == 0


def test_least_matches_keeps_similar_pairs():
    assert minhash.least_matches(64, 75) == 30
    assert minhash.least_matches(1, 75) == 1


def test_components_of_chains_stars_and_rings(spark):
    draw = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(k, 300 + (k + 1 - 300) % 20) for k in range(300, 320)]
    links += [(400 + draw.randrange(50), 400 + draw.randrange(50)) for _ in range(40)] + [(7, 7), (61, 60)]
    draw.shuffle(links)
    nodes = {n for a, b in links if a != b for n in (a, b)}
    want = roots(nodes, [x for x in links if x[0] != x[1]])
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == want and found.count() == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
