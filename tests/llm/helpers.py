"""Awkward tables, and brute-force versions of what the operators compute."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
PARAGRAPH = " ".join(f"word{k % 37} other{k % 11}" for k in range(60))

#: NULLs, empty and blank texts, ties, repeated rows, a very long text, several bytes a character.
ROWS = [(None, PARAGRAPH, "x"), (1, None, None), (1, None, None), (2, "", "y"), (3, " \n\t ", "y"), (4, "one two", None),
        (5, "one two", "z"), (5, "one two", "z"), (6, "One TWO", "z"), (7, PARAGRAPH, "z"), (8, PARAGRAPH + " end", "z"),
        (9, "é日本😀 " * 40, "z"), (10, "long " + PARAGRAPH * 400, "z"), (None, None, "z"), (11, "a\x00b <|endoftext|> c", "z"),
        (-3, "negative id and nothing else", "z")]
EXTRA = ("id", "key", "text_key", "kept", "component", "score", "digest", "n", "row", "starts", "group", "hash", "label")


def awkward(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({name: F.lit(f"extra {name}") for name in EXTRA}).withColumn("n_chars", F.length("text").cast("long"))


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    words = re.findall("[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1)))


def similar_pairs(sets, percent=75):
    """All pairs of positions whose sets are similar enough."""
    where, shared = defaultdict(list), defaultdict(int)
    for k, s in enumerate(sets):
        for x in s:
            for j in where[x]:
                shared[j, k] += 1
            where[x].append(k)
    return [(a, b) for (a, b), n in shared.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]


def removed_bytes(rows, length=50):
    """For (order, text): flags of the bytes that a 50-byte string of an earlier row covers."""
    first = {}
    raws = [(order, text.encode()) for order, text in rows]
    for order, raw in raws:
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            first[s] = min(order, first.get(s, order))
    out = []
    for order, raw in raws:
        marks = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < order:
                marks[p:p + length] = b"\1" * length
        out.append(marks)
    return out
