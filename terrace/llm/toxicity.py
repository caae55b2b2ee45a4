"""Toxicity: a word model kept from judging groups by counterfactual regularisation.

In every sentence of a labelled text that mentions a group, the mention is swapped for each
other term of its family and, once, dropped. Labelled texts also get, as a second row with
their label, a mention put into one of their sentences, so that terms which no labelled text
holds are learned, and swapped, too. The loss adds the squared change of the score under
each swap, so a term can carry weight only where its swaps carry the same, and a neutral
mention moves no score. A swap takes a word from the text only if no other sentence holds
it, and adds one only if the text does not hold it yet.

Fixed cases: a null or empty text has no words and gets the model's base rate; rows are
scored one by one, so repeated ids and texts need nothing special; without labels of
both classes every score is the share of toxic labels, or 0.5 for none; a very long text
counts as its set of words; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import bounded, only
from terrace.llm.textstats import log_odds, logistic

# Families of terms that name groups of people; a swap stays within its family.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("woman", "man", "girl", "boy", "female", "male", "nonbinary", "transgender"),
    ("women", "men", "girls", "boys", "females", "males"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "catholic", "sikh", "atheist"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "catholics", "sikhs", "atheists"),
    ("black", "white", "asian", "african", "european", "latino", "hispanic", "arab"),
    ("american", "chinese", "mexican", "indian", "german", "french", "spanish", "turkish"),
    ("deaf", "blind", "disabled", "autistic", "old", "young", "elderly"),
    ("frau", "mann", "mädchen", "junge"),
    ("femme", "homme", "fille", "garçon"),
    ("mujer", "hombre", "chica", "chico"),
)


@dataclass(frozen=True)
class Settings:
    """``fit_rows`` bounds the labelled rows used for training, ``vocabulary`` the words kept.

    A row with a mention put in weighs ``inserted`` of the row it was made from.
    """

    fit_rows: int = 16_000
    vocabulary: int = 4_096
    min_rows: int = 3
    min_lean: float = 2.5
    steps: int = 300
    rate: float = 0.1
    ridge: float = 1e-4
    counterfactual: float = 1.0
    inserted: float = 0.5
    families: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


# Letters to lower case is done on the text; here every other ASCII character parts words.
_SPLIT = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words(text: str | None) -> set[bytes]:
    return set(text.lower().encode().translate(_SPLIT).split()) if text else set()


_SENTENCE = re.compile(r"[.!?\n]+")


def lone_words(text: str | None, wanted: Set[bytes]) -> set[bytes]:
    """Of the wanted words those that stand in exactly one sentence: a swap there takes them from the text."""
    if not words(text) & wanted:
        return set()
    times = Counter(w for sentence in _SENTENCE.split(text) for w in words(sentence) & wanted)
    return {w for w, n in times.items() if n == 1}


@F.pandas_udf(T.ArrayType(T.StringType()))
def _distinct_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([sorted(w.decode() for w in words(t)) for t in texts], dtype=object)


@dataclass(frozen=True)
class WordModel:
    """Weights of words; ``pairs`` swaps were weighed in training, and move the log-odds by ``gap`` on average."""

    start: float
    weights: dict[bytes, float]
    pairs: int = 0
    gap: float = 0.0

    def log_odds(self, text: str | None) -> float:
        # fsum: the same result in whatever order the set lists its words.
        return math.fsum([self.start, *map(self.weights.__getitem__, words(text) & self.weights.keys())])


def _kin(numbers: dict[str, int], settings: Settings) -> dict[int, list[int]]:
    """The terms of the vocabulary, each with the others of its family and -1 for none."""
    kin: dict[int, list[int]] = {}
    for family in settings.families:
        members = [numbers[t] for t in family if t in numbers]
        for term in members:
            kin[term] = [other for other in members if other != term] + [-1]
    return kin


def _swaps(seen: list[np.ndarray], lone: list[np.ndarray], kin: dict[int, list[int]]) -> tuple[np.ndarray, ...]:
    """Every counterfactual as (word lost, word gained, its share of the text's penalty); -1 for no word."""
    lost, gained, share = [], [], []
    for ids, once in zip(seen, lone, strict=True):
        there = set(ids.tolist())
        taken = set(once.tolist())
        for term in kin.keys() & there:
            for other in kin[term]:
                out, new = term if term in taken else -1, -1 if other in there else other
                if out >= 0 or new >= 0:
                    lost.append(out)
                    gained.append(new)
                    share.append(1.0 / len(kin[term]))
    return np.array(lost, np.int64), np.array(gained, np.int64), np.array(share)


def _with_mentions(seen: list[np.ndarray], terms: list[int]) -> list[tuple[int, int]]:
    """(row, term): the mention put into each row, in turn over all terms; rows that hold it are left out."""
    if not terms:
        return []
    # A stride that is prime to any small number keeps classes and terms from moving in step.
    dealt = [(i, terms[(i * 7919 + i // len(terms)) % len(terms)]) for i in range(len(seen))]
    return [(i, term) for i, term in dealt if term not in seen[i]]


def train(
    seen: list[np.ndarray], y: np.ndarray, vocabulary: list[str], settings: Settings = Settings(),
    lone: list[np.ndarray] | None = None,
) -> WordModel:
    """Logistic regression on word presence with the counterfactual penalty, by Adam on all rows.

    ``lone`` lists per row the terms that only one of its sentences holds (by default all its terms).
    """
    if len(y) == 0 or y.min() == y.max():
        return WordModel(log_odds((y.sum() + 0.5) / (len(y) + 1.0)), {})
    numbers, size, texts = {w: i for i, w in enumerate(vocabulary)}, len(vocabulary), len(y)
    kin = _kin(numbers, settings)
    lone = seen if lone is None else lone
    mentions = _with_mentions(seen, sorted(kin)) if settings.inserted else []
    # Both classes weigh the same: a score of a half is the even choice between them.
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1.0 - y.mean()))
    source = np.array([i for i, _ in mentions], np.int64)
    seen = [*seen, *[np.append(seen[i], term) for i, term in mentions]]
    lone = [*lone, *[np.append(lone[i], term) for i, term in mentions]]
    y, weight = np.append(y, y[source]), np.append(weight, settings.inserted * weight[source])
    lengths = np.array([len(ids) for ids in seen])
    row = np.repeat(np.arange(len(y)), lengths)
    col = np.concatenate(seen) if size else np.zeros(0, np.int64)
    lost, gained, share = _swaps(seen, lone, kin)
    out, new = lost >= 0, gained >= 0

    def moved(w: np.ndarray) -> np.ndarray:
        """Change of the log-odds under every swap."""
        return np.where(new, w[gained], 0.0) - np.where(out, w[lost], 0.0)

    w, bias = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, settings.steps + 1):
        p = logistic(bias + np.bincount(row, w[col], len(y)))
        error = weight * (p - y) / texts
        grad = np.bincount(col, error[row], size) + settings.ridge * w
        if len(lost):
            change = moved(w) * share * settings.counterfactual / texts
            grad += 2 * (np.bincount(gained[new], change[new], size) - np.bincount(lost[out], change[out], size))
        full = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        move = settings.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return WordModel(
        float(bias), {t.encode(): float(x) for t, x in zip(vocabulary, w, strict=True)},
        len(lost), float(np.abs(moved(w)).mean()) if len(lost) else 0.0,
    )


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    settings: Settings = Settings(),
) -> WordModel:
    """Train on the documents of at most ``fit_rows`` labels, picked by a hash of the id.

    ``labels`` has (doc_id, toxic); other labels than 0 or 1 teach nothing, and of several
    documents with one id one is used. Spark counts in how many toxic and other texts each
    word occurs; the words that tell most are kept, and only their numbers reach the driver.
    """
    marked = only(labels, id="doc_id", toxic="toxic").filter("id IS NOT NULL AND toxic IN (0, 1)")
    chosen = bounded(marked, settings.fit_rows, [F.col("id")], ["id", "toxic"])
    one_each = (
        only(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id")
        .groupBy("id", "toxic").agg(F.min("text").alias("text"))
    )
    rows = one_each.select("id", "toxic", _distinct_words("text").alias("words"))
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    counts = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")
    ).filter(F.col("n") >= settings.min_rows)
    # Toxic texts beyond those expected, in standard errors: rare words need a clear lean.
    share = min(max(totals["t"] / max(1, totals["n"]), 1e-6), 1 - 1e-6)
    lean = F.abs((F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share))))
    best = counts.filter(lean >= settings.min_lean).orderBy(lean.desc(), "word").limit(settings.vocabulary)
    # All terms are known, whether or not a labelled text holds them.
    terms = {t for family in settings.families for t in family}
    vocabulary = sorted(terms | {r["word"] for r in best.select("word").toLocalIterator()})
    known = {w.encode(): i for i, w in enumerate(vocabulary)}
    named = {t.encode() for t in terms}

    @F.pandas_udf("ids array<int>, lone array<int>")
    def numbered(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame({
                "ids": [sorted(map(known.__getitem__, words(t) & known.keys())) for t in texts],
                "lone": [sorted(map(known.__getitem__, lone_words(t, named))) for t in texts],
            })

    seen = one_each.select("id", "toxic", numbered("text").alias("n")).select("id", "toxic", "n.*").orderBy("id", "toxic").toPandas()
    ids, lone = ([np.asarray(x, np.int64) for x in seen[name]] for name in ("ids", "lone"))
    return train(ids, seen["toxic"].to_numpy(np.float64), vocabulary, settings, lone)


def score(model: WordModel, text: Column) -> Column:
    """Probability that the text is toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(logistic(np.array([model.log_odds(t) for t in texts], np.float64)))

    return scored(text)
