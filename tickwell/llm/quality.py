"""Text quality from weak labels: heuristic labellers, a label model, a hashed linear scorer.

Ten labellers look at every whole text and vote good, bad or nothing. Their votes overlap and
disagree; expectation-maximisation over the counts of all vote patterns estimates how each
labeller votes on good and on bad texts, and with that the chance that a text is good. The
patterns are counted over all documents; there are at most 3 to the 10th of them, however
many documents. These chances are the soft labels of a logistic scorer over hashed words and
word shapes, fitted on at most ``SAMPLE`` texts taken by their hash; it scores every text.

* NULL text counts as empty; texts without words get votes and a score like others.
* Repeated rows and NULL ids come back as they are, one row for each row.
* If all texts have one pattern, the label model says what the majority of its votes says.
* Very long texts are read whole. Extra columns are left out, whatever their names; an empty
  table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.bpe import Cache
from tickwell.llm.common import staged, text_or_empty

#: Texts that the scorer is fitted on, at most; weights of the scorer.
SAMPLE, WEIGHTS = 5_000, 1 << 17
#: Features of all texts that the scorer is fitted on, at most; they meet on the driver.
SAMPLE_FEATURES = 8_000_000
_SYMBOLS = "$%*#&@^~=+<>{}[]\\/_|"
_ENDS = re.compile(r"[.!?…:;,]+[\"')\]»”]*$")
GOOD, NOTHING, BAD = 1, 0, -1


def _vote(value: float, good_to: float, bad_from: float) -> int:
    """Good up to one bound, bad from another, nothing between them."""
    return GOOD if value <= good_to else BAD if value >= bad_from else NOTHING


@lru_cache(1)
def _cases() -> np.ndarray:
    """1 for capitals and 2 for small letters of the first plane."""
    return np.array([1 if chr(c).isupper() else 2 if chr(c).islower() else 0 for c in range(0x10000)], np.uint8)


_SHAPES = str.maketrans({**{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"},
                         **{c: "9" for c in "0123456789"}})
_RUNS = re.compile(r"(.)\1+")


_SLOT_BITS = WEIGHTS.bit_length() - 1
_ALONE, _TRAILING, _ENDING = (1 << 2 * _SLOT_BITS + k for k in range(3))


def _word_code(word: str) -> int:
    """Slots of a word's shape and of the word, and whether it is a separator that stands alone, has a trailing
    symbol, ends a clause, as bits of one number."""
    shape = "".join("a" if c.islower() else "A" if c.isupper() else c for c in word.translate(_SHAPES))
    code = (xxhash.xxh3_64_intdigest("w" + word.lower()) % WEIGHTS << _SLOT_BITS
            | xxhash.xxh3_64_intdigest("s" + _RUNS.sub(r"\1", shape)) % WEIGHTS)
    return code | _ALONE * (word in "|•·-*>»") | _TRAILING * (word[-1] in _SYMBOLS and len(word) > 1) | _ENDING * (word[-1] in ".!?…:;,")


@lru_cache(1)
def _codes() -> Cache:
    return Cache(_word_code)


def _coded(text: str) -> tuple[list[str], np.ndarray]:
    """The words of a text and their codes, which votes and features share."""
    words = text.split()
    return words, np.fromiter(map(_codes().__getitem__, words), np.int64, len(words))


def votes(text: str, coded: tuple[list[str], np.ndarray] | None = None) -> tuple[int, ...]:
    """Capitals, shouting, separators, trailing symbols, repeats, variety, sentences, word
    length, size, symbol density. ``coded``: the words, if they are known."""
    words, traits = coded or _coded(text)
    n = len(words)
    if not n:
        return (NOTHING,) * 8 + (BAD, NOTHING)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    seen = np.bincount(np.minimum(codes, 128), minlength=129)
    cases = _cases().take(codes, mode="clip")
    letters = [int(np.count_nonzero(cases == 1)), int(np.count_nonzero(cases == 2))]
    marks = text.count("!!") / n
    alone = int(np.count_nonzero(traits & _ALONE)) / n
    trailing = int(np.count_nonzero(traits & _TRAILING)) / n
    # equal words have equal codes
    again = sum(words[k] == words[k + 1] for k in np.flatnonzero(traits[:-1] == traits[1:]).tolist()) / n
    variety = len(set(words)) / min(n, 400)
    ends = int(np.count_nonzero(traits & _ENDING)) / n
    length = len(text) / n
    symbols = sum(int(seen[ord(c)]) for c in _SYMBOLS) / max(1, len(text))
    return (_vote(letters[0] / max(1, sum(letters)), 0.15, 0.35), _vote(marks, 0.02, 0.15), _vote(alone, 0.02, 0.12),
            _vote(trailing, 0.02, 0.12), _vote(again, 0.02, 0.12),
            NOTHING if n < 40 or variety > 0.35 else BAD,
            GOOD if 0.02 <= ends <= 0.4 else BAD if n >= 30 else NOTHING,
            GOOD if 3 <= length <= 12 else BAD if length < 2 or length > 25 else NOTHING,
            GOOD if n >= 25 else NOTHING, _vote(symbols, 0.005, 0.03))


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """The chance of good for each vote pattern, by expectation-maximisation.

    Starts from the balance of the votes; bad votes of one labeller are rarer and say more
    than a good one, which the estimated vote shares by class carry from then on."""
    if not len(patterns):
        return np.empty(0)
    bad = (patterns == BAD).sum(1)
    good = np.where(bad == 0, 0.9, np.where(bad == 1, 0.45, 0.1)).astype(float)
    weight = counts.astype(float)
    for _ in range(rounds):
        share = np.clip((weight * good).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        log_odds = np.full(len(patterns), np.log(share / (1 - share)))
        for k in range(patterns.shape[1]):
            for vote in (GOOD, NOTHING, BAD):
                of = patterns[:, k] == vote
                p = ((weight * good)[of].sum() + 0.5) / ((weight * good).sum() + 1.5)
                q = ((weight * (1 - good))[of].sum() + 0.5) / ((weight * (1 - good)).sum() + 1.5)
                log_odds[of] += np.log(p / q)
        good = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return good


def features(text: str, coded: tuple[list[str], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: words, shapes, pairs of shapes and repeats, scaled to length 1."""
    words, codes = coded or _coded(text)
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    own, shapes = codes >> _SLOT_BITS & WEIGHTS - 1, codes & WEIGHTS - 1
    pairs = (shapes[:-1] * 31 + shapes[1:] * 17 + 7) % WEIGHTS
    repeats = np.full(int((own[:-1] == own[1:]).sum()), 3, np.int64)
    found = np.sort(np.concatenate([own, shapes, pairs, repeats]).astype(np.int32))  # half as wide: sorted faster
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    slots, values = found[starts].astype(np.int64), np.log1p(np.diff(starts, append=len(found)))
    return slots, values / np.sqrt((values ** 2).sum())


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], chances: np.ndarray, epochs: int = 6, rate: float = 0.5) -> np.ndarray:
    """Logistic regression on soft labels, AdaGrad in a fixed order; the last weight is the bias.
    Good and bad texts weigh the same in sum."""
    weights, squares = np.zeros(WEIGHTS + 1), np.full(WEIGHTS + 1, 1e-6)
    share = float(np.clip(chances.mean(), 0.02, 0.98)) if len(chances) else 0.5
    draw = np.random.default_rng(5)
    for _ in range(epochs):
        for k in draw.permutation(len(rows)).tolist():
            slots, values = rows[k]
            p = 1 / (1 + np.exp(-(weights[slots] @ values + weights[-1])))
            c = chances[k]
            step = c * (1 - p) * 0.5 / share - (1 - c) * p * 0.5 / (1 - share)
            gradient = step * values
            squares[slots] += gradient ** 2
            weights[slots] += rate * gradient / np.sqrt(squares[slots] + 0.01)
            squares[-1] += step ** 2
            weights[-1] += rate * step / np.sqrt(squares[-1] + 0.01)
    return weights


def scores(docs: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, posterior (label model), score (linear scorer), kept (score >= threshold)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_or_empty().alias("text"))

    @F.pandas_udf("string")
    def voted(batch: pd.Series) -> pd.Series:
        return pd.Series(["".join("-0+"[v + 1] for v in votes(t)) for t in batch], dtype=object)

    counted = texts.groupBy(voted("text").alias("votes")).agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = np.array([["-0+".index(c) - 1 for c in r["votes"]] for r in counted], np.int64).reshape(-1, 10)
    chances = dict(zip((r["votes"] for r in counted), label_model(patterns, np.array([r["n"] for r in counted]))))

    def prepared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(h, *features(t), chances["".join("-0+"[v + 1] for v in votes(t))]) for h, t in zip(batch["h"], batch["text"])]
            frame = pd.DataFrame(rows, columns=["h", "slots", "values", "chance"])
            yield frame.assign(size=frame["slots"].map(len))

    hashed = texts.select("text").withColumn("h", F.xxhash64("text"))
    # the smallest hashes of different texts: numbers only, and no more than the sample
    smallest = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(sample).collect()]
    chosen = hashed.where(F.col("h") <= F.lit(smallest[-1] if smallest else None)).dropDuplicates(["h"])
    ready = staged(chosen.mapInPandas(prepared, "h long, slots array<int>, values array<float>, chance double, size int"), "sample")
    last, held = None, 0
    for r in ready.select("h", "size").orderBy("h").collect():  # as many as the sample has texts
        held += r["size"]
        if held > SAMPLE_FEATURES and last is not None:
            break
        last = r["h"]
    known = ready.where(F.col("h") <= F.lit(last)).toPandas().sort_values("h")
    model = spark.sparkContext.broadcast((chances, fit_scorer(
        [(np.asarray(a), np.asarray(v, float)) for a, v in zip(known["slots"], known["values"])], known["chance"].to_numpy(float))))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, weights = model.value
        for batch in batches:
            margins, posterior = [], []
            for text in batch["text"]:
                coded = _coded(text)
                slots, values = features(text, coded)
                margins.append(weights[slots] @ values + weights[-1])
                posterior.append(known["".join("-0+"[v + 1] for v in votes(text, coded))])
            score = 1 / (1 + np.exp(-np.array(margins, float)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "posterior": posterior, "score": score,
                                "kept": score >= threshold})

    return texts.mapInPandas(scored, "doc_id long, posterior double, score double, kept boolean")
