"""Secrets in texts: fixed patterns, and candidate strings by the entropy of a sliding window.

Only DataFrame functions, so all work stays in the JVM. A pattern's matches and the gaps between them
come from ``regexp_extract_all`` and ``split``; a running sum over their lengths gives positions,
so texts never leave the first stage, and what is shuffled is a few numbers for each match.

Candidates are runs of characters that keys are written in. A window slides over each: the fold's state is
a string with one character for each symbol, whose code is the symbol's count, and the sum of c log2 c over
all counts. A step takes one symbol in and one out and mends four terms. The entropy of a window of w symbols is
log2(w) - sum / w, and the threshold depends on the narrowest class of characters that holds the candidate. A
candidate with a window over its threshold is a span, unless an entry of the allow-list is found in it. Terms are
whole millionths, so results don't depend on the order of additions.

* NULL and empty texts have no spans.
* Repeated rows and NULL ids: one row for each row.
* Very long texts are scanned whole; work is linear in the text, and one row holds a text's spans.
* Matches of different kinds may overlap, and all are reported.
* Extra columns are left out, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import staged, text_or_empty

KINDS = ("assign", "access", "hex", "entropy")


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])
ASSIGN = f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: For runs of a class, asking for the length in the pattern finds the same matches as dropping short ones.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGN_LENGTH = 12

SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
#: Classes of characters from the narrowest, with the bits a symbol that a window must reach.
CLASSES = (("[0-9A-Fa-f]+", 3.0), ("[A-Za-z]+", 4.1), ("[0-9A-Za-z]+", 3.8), (".+", 3.9))
#: What makes a candidate harmless: words of examples, rows of the alphabet, paths and names of words,
#: universal ids, and the digests of nothing.
ALLOWED = ("(?:[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr])", "(?:abcdefghijkl|ABCDEFGHIJKL|0123456789)",
           "^[A-Za-z]+(?:[/_=-]+[A-Za-z]+)+$", "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
           "^(?:d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
           "|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855)$")


def term(count: int) -> int:
    """count * log2(count) in millionths."""
    return round(1e6 * count * math.log2(count)) if count else 0


def most(bits: float, window: int) -> int:
    """The sum of terms that a window of that entropy has, at most."""
    return math.floor(1e6 * window * (math.log2(window) - bits))


def smallest_sum(word: Column, window: int = WINDOW) -> Column:
    """The least sum of terms of all windows of a candidate; NULL if it is shorter than a window."""
    terms = F.array(*[F.lit(term(c)).cast("long") for c in range(window + 2)])
    symbols = F.split(word, "")
    # each step has the symbol that comes in and the one that goes out
    steps = F.arrays_zip(symbols.alias("came"), F.concat(F.array_repeat(F.lit(""), window), symbols).alias("went"))
    start = F.struct(F.lit(" " * len(SYMBOLS)).alias("counts"), F.lit(0).cast("long").alias("sum"),
                     F.lit(0).alias("n"), F.lit(None).cast("long").alias("least"))

    def changed(counts: Column, total: Column, symbol: Column, by: int) -> tuple[Column, Column]:
        place = F.instr(F.lit(SYMBOLS), symbol)
        count = F.ascii(F.substring(counts, place, 1)) - 32
        # code 32 is a count of 0
        return (F.overlay(counts, F.char(count + 32 + by), place),
                total + F.get(terms, count + by) - F.get(terms, count))

    def out(state: Column, step: Column) -> Column:
        counts, total = changed(state["counts"], state["sum"], step["went"], -1)
        full = state["n"] >= window
        return F.struct(F.when(full, counts).otherwise(state["counts"]).alias("counts"),
                        F.when(full, total).otherwise(state["sum"]).alias("sum"), step["came"].alias("came"))

    def into(state: Column, left: Column) -> Column:
        counts, total = changed(left["counts"], left["sum"], left["came"], 1)
        n = state["n"] + 1
        return F.struct(counts.alias("counts"), total.alias("sum"), n.alias("n"),
                        F.when(n >= window, F.least(state["least"], total)).alias("least"))

    def slide(state: Column, step: Column) -> Column:
        # a lambda over one element gives the half-done state a name, so that it is worked out once
        moved = F.get(F.transform(F.array(out(state, step)), lambda left: into(state, left)), F.lit(0))
        return F.when(step["came"].isNull(), state).otherwise(moved)

    return F.aggregate(steps, start, slide, lambda state: state["least"])


def suspicious(word: Column, window: int = WINDOW, classes: tuple = CLASSES, allowed: tuple = ALLOWED) -> Column:
    """Whether a candidate has a window of high entropy and is not on the allow-list."""
    limit = F.lit(-1).cast("long")
    for pattern, bits in reversed(classes):
        limit = F.when(word.rlike(f"^{pattern}$"), F.lit(most(bits, window))).otherwise(limit)
    harmless = F.lit(False)
    for pattern in allowed:
        harmless = harmless | word.rlike(pattern)
    return F.when(harmless, F.lit(False)).otherwise(F.coalesce(smallest_sum(word, window) <= limit, F.lit(False)))


def _matches(kind: int, pattern: str, good: Column | None = None, text: str = "text") -> Column:
    """A text's matches in order: kind, number, gap before it, length, and what decides whether it counts."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    word = hits if kind == 3 else F.array_repeat(F.lit(None).cast("string"), F.size(hits))
    fits = F.transform(hits, lambda _: F.lit(True)) if good is None else good
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(hits, F.char_length).alias("length"), fits.alias("fits"), word.alias("word"))
    # there is a gap more than there are matches
    return F.transform(F.filter(zipped, lambda x: x["length"].isNotNull()), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("number"), x["gap"].alias("gap"), x["length"].alias("length"),
        x["fits"].alias("fits"), x["word"].alias("word")))


def found_in(docs: DataFrame, window: int = WINDOW, classes: tuple = CLASSES, allowed: tuple = ALLOWED) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id) and their spans (row, kind as a number, start, end)."""
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    enough = F.transform(values, lambda v: F.char_length(v) >= ASSIGN_LENGTH)
    candidate = "[A-Za-z0-9+/_=-]{" + str(window) + ",}"
    rows = staged(docs.select("doc_id", text_or_empty().alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(
            _matches(0, ASSIGN, enough), _matches(1, ACCESS), _matches(2, HEX), _matches(3, candidate)).alias("matches")), "matches")
    each = rows.select("row", F.inline("matches")).select(
        "row", "kind", "number", "gap", "length",
        F.when(F.col("kind") == 3, suspicious(F.col("word"), window, classes, allowed)).otherwise(F.col("fits")).alias("fits"))
    end = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("number"))
    spans = each.withColumn("end", end).where("fits").select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end")
    return rows.select("row", "doc_id"), spans


def secrets(docs: DataFrame, window: int = WINDOW, classes: tuple = CLASSES, allowed: tuple = ALLOWED) -> DataFrame:
    """doc_id, counts of the fixed kinds, digest of their spans, and all spans as kind:start:end."""
    rows, spans = found_in(docs, window, classes, allowed)
    names = F.array(*map(F.lit, KINDS))
    by_row = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))

    def joined(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    found = rows.join(by_row, "row", "left")
    spans_of = F.coalesce("spans", F.lit(None).cast("array<struct<start:bigint,kind:int,end:bigint>>"), F.array())
    return found.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter(spans_of, lambda x: x["kind"] < 3)), 256).alias("base_sha256"), joined(spans_of).alias("spans"))
