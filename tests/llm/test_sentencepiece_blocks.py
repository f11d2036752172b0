import random

import numpy as np
import pyarrow as pa

from tickwell.llm import sentencepiece_lattice as L
from tickwell.llm.queries import PIECES


def test_words_and_parts_as_split_one_by_one():
    draw = random.Random(1)
    texts = ["", " ", "  ", "   ", " a", "a  b   c    d     e ", "x▁y ▁▁ z", "\n a\t", "a\x00b c", "ab" * 60 + " c", "日x" * 80]
    texts += ["".join(draw.choice("ab ▁  é日-.\n") for _ in range(draw.randrange(30))) for _ in range(3000)]
    want = [L.marked_words(t) for t in texts]
    counts, words = L._split(pa.array(texts))
    assert counts.tolist() == [len(x) for x in want]
    assert [L.MARK + x for x in words.to_pylist()] == [x for some in want for x in some]
    different = sorted({x for some in want for x in some})
    assert L._cut(pa.array(different), PIECES).to_pylist() == [L.parts_of(x, L.part_pattern(PIECES), L.crossed(PIECES)) for x in different]


def test_numbers_come_back():
    for numbers in ([], [0], [0, 1, 0, 2, 2, 1, 3, 70_000 - 69_996]):
        found = np.array(numbers, np.int32)
        assert L._unpacked(L._packed(found), len(found)).tolist() == numbers
        assert L._unpacked(L._packed(found, False), len(found), False).tolist() == numbers


def test_blocks_need_no_shuffle(spark):
    docs = spark.createDataFrame([(k, f"the cat {k}") for k in range(40)], "doc_id long, text string")
    plan = L.encode(docs, PIECES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(of") == 1 and "hashpartitioning(block" not in plan
