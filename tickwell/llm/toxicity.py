"""Toxicity of texts: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words, and beginnings of words, that are far more frequent in texts
labelled toxic. Features are its densities, how near its words are to second-person words,
capitals, punctuation and obfuscation rates. Lexicon weights of a training row leave out
the row's own fold, so trees see honest densities; the calibration is fitted on scores of
trees that have not seen the row's fold either.

The model is fitted on at most ``SAMPLE`` labelled rows, taken by the hash of their id;
every text is scored whole.

* NULL text counts as empty; empty texts get a score like any other.
* Repeated rows and NULL ids come back as they are; a label that two rows share counts twice.
* NULL labels are left out. Without labels of both kinds, every score is the share of label 1.
* Extra columns are kept by ``with_score`` and ignored by the features, whatever their names.
* Empty tables give empty tables.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm import boosting
from tickwell.llm.bpe import Cache
from tickwell.llm.common import text_or_empty

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 20_000
#: Entries of the lexicon, at most; candidates before weighing, at most.
LEXICON, CANDIDATES = 3_000, 30_000
FOLDS = 3

#: Second-person words of the languages handled.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split())
NEAR = 5
_LEET = str.maketrans("013457@$!|€", "oieastasile")
_EDGES = ".,;:!?…\"'`()[]{}<>«»“”„‘’*_~#%&$-–—"
_MIXED = re.compile(r"[^\W\d_][0-9@$!*|][^\W\d_]")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_*]){3,}\w(?!\w)")
_REPEATED = re.compile(r"(\w)\1\1")


def plain_word(word: str) -> str:
    """A word without punctuation at its edges and with look-alike signs read as letters."""
    word = word.strip(_EDGES)
    if word.isalpha() or not any(c.isalpha() for c in word):
        return word
    return "".join(c for c in word.translate(_LEET) if c.isalpha())


def entries(word: str) -> list[str]:
    """What the lexicon may know of a word: the word, and its beginnings with a mark."""
    word = plain_word(word)
    return [word, *(word[:n] + "~" for n in (4, 5, 6) if len(word) > n)] if len(word) > 2 else []


class Features:
    """Dense features of a text under lexicon weights."""
    NAMES = ("hits", "hits_per_100", "weight_per_100", "largest", "different", "near_second_person", "second_person_per_100",
             "capitals", "exclamations", "questions", "punctuation", "digits", "mixed_per_100", "spaced_per_100",
             "repeated_per_100", "shouted")

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.words = Cache(self._weight)

    def _weight(self, word: str) -> float:
        return max((self.weights.get(e, 0.0) for e in entries(word)), default=0.0)

    def of(self, text: str) -> list[float]:
        words = text.lower().split()
        n = max(1, len(words))
        found = np.fromiter(map(self.words.__getitem__, words), float, len(words))
        hits = np.flatnonzero(found)
        near = sum(any(plain_word(w) in SECOND_PERSON for w in words[max(0, k - NEAR):k + NEAR + 1]) for k in hits.tolist())
        seen = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=128)
        letters = max(1, int(seen[65:91].sum() + seen[97:123].sum()))
        size = max(1, len(text))
        own = found[hits]
        return [len(hits), 100 * len(hits) / n, 100 * own.sum() / n, own.max(initial=0.0),
                len({words[k] for k in hits.tolist()}), near,
                100 * sum(map(SECOND_PERSON.__contains__, words)) / n,
                seen[65:91].sum() / letters, seen[33] / size, seen[63] / size,
                (seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()) / size,
                seen[48:58].sum() / size, 100 * len(_MIXED.findall(text)) / n, 100 * len(_SPACED.findall(text)) / n,
                100 * len(_REPEATED.findall(text)) / n, sum(map(str.isupper, text.split())) / n]


class Model:
    """Lexicon weights, trees and calibration; of bounded size."""

    def __init__(self, weights, trees, levels, shares):
        self.weights, self.trees, self.levels, self.shares = weights, trees, levels, shares
        self._features = None

    def __getstate__(self):
        return {**self.__dict__, "_features": None}

    def score(self, texts) -> np.ndarray:
        if self._features is None:
            self._features = Features(self.weights)
        x = np.array([self._features.of(t) for t in texts], float).reshape(-1, len(Features.NAMES))
        return calibrated(self.trees.margin(x), self.levels, self.shares)


def calibrated(margin: np.ndarray, levels: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The isotonic share, with a hundredth of the raw probability to order equal shares."""
    return 0.99 * np.interp(margin, levels, shares) + 0.01 / (1 + np.exp(-margin))


def _weights(counts: dict[str, np.ndarray], sizes: np.ndarray, without: int | None) -> dict[str, float]:
    """Log odds of entries; ``counts`` by fold and label. Rare or weak entries stay out."""
    keep = [f for f in range(FOLDS) if f != without]
    n_neg, n_pos = sizes[keep].sum(0)
    out = {}
    for entry, c in counts.items():
        neg, pos = c[keep].sum(0)
        weight = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
        if pos >= 2 and weight > 2:
            out[entry] = float(weight)
    best = sorted(out, key=lambda e: (-out[e] * np.sqrt(counts[e][keep, 1].sum()), e))[:LEXICON]
    return {e: out[e] for e in best}


def labelled(docs: DataFrame, labels: DataFrame, held_out: Column, sample: int = SAMPLE) -> DataFrame:
    """text, toxic and fold of the training rows: those not held out, at most ``sample`` of them."""
    chosen = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out)
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", fold)


def train(docs: DataFrame, labels: DataFrame, held_out: Column, sample: int = SAMPLE) -> Model:
    rows = labelled(docs, labels, held_out, sample).persist()
    try:
        sizes = np.zeros((FOLDS, 2))
        for fold, toxic, n in rows.groupBy("fold", "toxic").count().collect():
            sizes[fold, toxic] = n

        def toxic_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen = Counter()
            for batch in batches:
                for text in batch["text"]:
                    seen.update({e for w in set(text.lower().split()) for e in entries(w)})
            yield pd.DataFrame({"entry": pd.Series(list(seen), dtype=object), "n": list(seen.values())})

        candidates = rows.where("toxic = 1").mapInPandas(toxic_entries, "entry string, n long").groupBy("entry").agg(
            F.sum("n").alias("n")).where("n >= 2").orderBy(F.desc("n"), "entry").limit(CANDIDATES)
        known = frozenset(r["entry"] for r in candidates.collect())

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            seen = Counter()
            for batch in batches:
                for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"]):
                    own = {e for w in set(text.lower().split()) for e in entries(w)} & known
                    seen.update((e, fold, toxic) for e in own)
            rows = pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["entry", "fold", "toxic", "n"])
            yield rows.astype({"entry": object})

        counts: dict[str, np.ndarray] = {}
        total = rows.mapInPandas(counted, "entry string, fold int, toxic int, n long").groupBy(
            "entry", "fold", "toxic").agg(F.sum("n").alias("n"))
        # an entry that is about as frequent in clean texts is of no use: only promising ones come to the driver
        useful = total.groupBy("entry").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n"))).alias("pos"),
            F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("neg"),
            F.collect_list(F.struct("fold", "toxic", "n")).alias("cells"))
        n_neg, n_pos = sizes.sum(0)
        useful = useful.where((F.col("pos") + 0.5) * float(n_neg + 1) > (F.col("neg") + 0.5) * float(n_pos + 1) * 4)
        for entry, _, _, cells in useful.collect():
            c = counts[entry] = np.zeros((FOLDS, 2))
            for cell in cells:
                c[cell["fold"], cell["toxic"]] = cell["n"]

        weights = [_weights(counts, sizes, f) for f in range(FOLDS)]

        def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            makers = [Features(w) for w in weights]
            for batch in batches:
                yield pd.DataFrame({"x": [makers[f].of(t) for t, f in zip(batch["text"], batch["fold"])],
                                    "toxic": batch["toxic"], "fold": batch["fold"]})

        sampled = rows.mapInPandas(features, "x array<double>, toxic int, fold int").toPandas()
    finally:
        rows.unpersist()
    x = np.array(sampled["x"].tolist(), float).reshape(-1, len(Features.NAMES))
    y, fold = sampled["toxic"].to_numpy(float), sampled["fold"].to_numpy()
    order = np.lexsort((*x.T, y, fold))
    x, y, fold = x[order], y[order], fold[order]
    trees = boosting.fit(x, y)
    unseen = np.empty(len(y))
    for f in range(FOLDS):
        unseen[fold == f] = boosting.fit(x[fold != f], y[fold != f]).margin(x[fold == f])
    levels, shares = boosting.isotonic(unseen, y) if len(y) else (np.zeros(1), np.zeros(1))
    return Model(_weights(counts, sizes, None), trees, levels, shares)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each text. The model travels as a broadcast: its size has a bound."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.fillna("")), dtype=float)

    return scored(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score under the threshold, with all columns as they were."""
    return docs.where(score(docs, model) < threshold)
