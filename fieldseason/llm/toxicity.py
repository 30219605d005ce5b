"""Toxicity: a sparse logistic classifier with counterfactual regularisation.

Features are the different words of a text in lower case and their beginnings of four and five
letters, hashed. Besides the labelled sentences, copies are made in which a term that names a
group is swapped for another of the same kind; training minimises the log loss plus ``penalty``
times the squared change of the score's logit from a sentence to its copy. A weight that only
tells groups apart costs more than it gains, so a neutral mention of a group scores as any other.
Soft thresholding leaves most weights zero, so that a long text does not gather noise.

Training takes a bounded sample of labelled documents, chosen by hash; scoring reads whole texts
and nothing else. Null text is the empty text and gets the score of the intercept. Documents
without a label, or with two, teach nothing or both; without any label every score is 0.
Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import held, labelled_texts, map_rows, texts

BUCKETS, CACHED_WORDS = 1 << 18, 200_000
#: The bound of the training sample.
MAX_LABELLED = 6_000
#: Terms that may stand for one another, kind by kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("she", "he"), ("her", "him"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee"), ("immigrants", "citizens", "refugees"),
    ("disabled", "blind", "deaf", "autistic"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("sie", "er"), ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("schwarze", "weiße", "asiaten"), ("schwule", "lesben"), ("einwanderer", "flüchtlinge", "staatsbürger"), ("alte", "junge"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("ella", "él"), ("musulmanes", "cristianos", "judíos", "budistas"),
    ("negros", "blancos", "asiáticos"), ("gais", "lesbianas"), ("inmigrantes", "refugiados", "ciudadanos"), ("viejos", "jóvenes"),
    ("femmes", "hommes"), ("femme", "homme"), ("elle", "il"), ("musulmans", "chrétiens", "juifs", "bouddhistes"),
    ("noirs", "blancs", "asiatiques"), ("gays", "lesbiennes"), ("immigrés", "réfugiés", "citoyens"), ("vieux", "jeunes"),
)
_WORDS = re.compile(r"[^\W\d_]+")


def _features(words: list[str]) -> tuple[str, ...]:
    """The different words and, of longer ones, their beginnings."""
    found = dict.fromkeys(words)
    for word in words:
        if len(word) > 4:
            found["^4" + word[:4]] = None
            if len(word) > 5:
                found["^5" + word[:5]] = None
    return tuple(found)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def words_of(text: str) -> list[str]:
    return list(dict.fromkeys(_WORDS.findall(text.lower())))


def counterfactuals(words: list[str], terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[list[str]]:
    """Copies of a sentence's words, one for each other term that a group's term can be swapped for."""
    kinds = {term: kind for kind in terms for term in kind}
    return [[other if x == word else x for x in words]
            for word in words if word in kinds for other in kinds[word] if other != word]


@dataclass(frozen=True)
class Model:
    intercept: float
    weights: tuple[tuple[int, float], ...]


class Scorer:
    """Probability of a text; words' weighted buckets are kept in a bounded table."""

    def __init__(self, model: Model):
        self._intercept, self._weights, self._known = model.intercept, dict(model.weights), {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self._known) > CACHED_WORDS:
            self._known.clear()
        found = self._known[word] = tuple(b for b in map(_bucket, _features([word])) if b in self._weights)
        return found

    def __call__(self, text: str) -> float:
        known, present = self._known, set()
        for word in set(_WORDS.findall(text.lower())):
            if (found := known.get(word)) is None:
                found = self._of(word)
            if found:
                present.update(found)
        # In the buckets' order, so that the sum's last digits don't depend on a set's.
        logit = self._intercept + sum(self._weights[b] for b in sorted(present))
        return 1 / (1 + math.exp(-min(max(logit, -700.0), 700.0)))


def _rows(examples: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each feature that is present."""
    return (np.repeat(np.arange(len(examples), dtype=np.int32), [len(x) for x in examples]),
            np.concatenate([*examples, np.zeros(0, np.int32)]).astype(np.int32))


def buckets(words: list[str]) -> np.ndarray:
    return np.unique([_bucket(f) for f in _features(words)]).astype(np.int64)


def _descend(y: np.ndarray, row: np.ndarray, column: np.ndarray, pair: np.ndarray, changed: np.ndarray, sign: np.ndarray, pairs: int,
             weights: np.ndarray, bias: float, penalty: float, sparsity: float, enough: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient descent until no part of the gradient, less what ``sparsity`` takes up, exceeds ``enough``.

    Each weight has a step of its own, from a bound of its curvature; a common factor grows while the
    steps keep below the model they were made for, and falls when not.
    """
    n, k = len(y), len(weights)
    curve = np.bincount(column, np.bincount(row, minlength=n)[row], k) / (4 * n)
    curve += 2 * penalty / pairs * np.bincount(changed, np.bincount(pair, minlength=pairs)[pair], k)
    curve = np.maximum(curve, 1e-9)

    def value(at: np.ndarray, bias: float) -> tuple[float, np.ndarray, np.ndarray]:
        logit, apart = np.bincount(row, at[column], n) + bias, np.bincount(pair, sign * at[changed], pairs)
        return (np.logaddexp(0, logit) - y * logit).mean() + penalty * (apart @ apart) / pairs, logit, apart

    ahead, ahead_bias, t, factor = weights, bias, 1.0, 1.0
    while True:
        here, logit, apart = value(ahead, ahead_bias)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / n
        slope = np.bincount(column, error[row], k) + np.bincount(changed, (2 * penalty / pairs) * sign * apart[pair], k)
        rest = np.where(ahead != 0, np.abs(slope + sparsity * np.sign(ahead)), np.maximum(np.abs(slope) - sparsity, 0))
        if max(rest.max(initial=0), abs(error.sum())) <= enough:
            return ahead, ahead_bias
        while True:
            step = factor / curve
            moved = ahead - step * slope
            moved = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
            moved_bias = ahead_bias - factor * error.sum()
            by, by_bias = moved - ahead, moved_bias - ahead_bias
            bound = here + slope @ by + error.sum() * by_bias + (curve @ (by * by) + by_bias * by_bias) / (2 * factor)
            if value(moved, moved_bias)[0] <= bound + 1e-13 or factor < 1e-3:
                break
            factor /= 2
        if (ahead - moved) @ ((moved - weights) * curve) > 0:  # the momentum points uphill: start it anew
            t = 1.0
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        push = (last - 1) / t
        ahead, ahead_bias = moved + push * (moved - weights), moved_bias + push * (moved_bias - bias)
        weights, bias, factor = moved, moved_bias, factor * 1.1


def difference(own: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a copy lacks and has besides: all that the penalty needs of it."""
    return np.setdiff1d(own, copy), np.setdiff1d(copy, own)


def fit(examples: list[np.ndarray], labels: list[int], copies: list[tuple[int, np.ndarray, np.ndarray]] = (), penalty: float = 1.0,
        sparsity: float = 3e-4, tolerance: float = 0.01, at_least: int = 3, joining: int = 300) -> Model:
    """The weights at which the gradient over all examples vanishes, to ``tolerance`` times ``sparsity``.

    ``copies`` holds the place of a sentence and the buckets that a swapped copy of it lacks and has
    besides. Buckets of fewer than ``at_least`` examples and copies are left out. Most weights stay
    zero, so descent goes over some of them at a time: up to ``joining`` more, those with the largest
    gradient, join until no weight left out has a gradient above ``sparsity``.
    """
    if not len(examples):
        return Model(-40.0, ())
    y, n, pairs = np.array(labels, float), len(examples), max(len(copies), 1)
    row, column = _rows(examples)
    lost_row, lost = _rows([b for _, b, _ in copies])
    new_row, new = _rows([b for _, _, b in copies])
    # A copy shares most of its sentence: that part cancels and is in neither of its two lists.
    seen = np.bincount(column, minlength=BUCKETS) + np.bincount(new, minlength=BUCKETS) - np.bincount(lost, minlength=BUCKETS)
    of_row = np.bincount(np.array([i for i, _, _ in copies], int), minlength=n)
    seen = seen + np.bincount(column, of_row[row], BUCKETS)
    keep = seen >= at_least
    row, column = row[keep[column]].astype(np.int64), column[keep[column]]
    pair, sign = np.concatenate([lost_row, new_row]).astype(np.int64), np.repeat([1.0, -1.0], [len(lost), len(new)])
    changed = np.concatenate([lost, new])
    pair, changed, sign = pair[keep[changed]], changed[keep[changed]], sign[keep[changed]]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias, weights, used = math.log(rate / (1 - rate)), np.zeros(BUCKETS), np.zeros(0, np.int64)
    while True:
        place = np.full(BUCKETS, -1)
        place[used] = np.arange(len(used))
        own, other = place[column] >= 0, place[changed] >= 0
        found, bias = _descend(y, row[own], place[column[own]], pair[other], place[changed[other]], sign[other], pairs, weights[used], bias,
                               penalty, sparsity, tolerance * sparsity)
        weights[used] = found
        logit, apart = np.bincount(row, weights[column], n) + bias, np.bincount(pair, sign * weights[changed], pairs)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) / n
        slope = np.abs(np.bincount(column, error[row], BUCKETS) + np.bincount(
            changed, (2 * penalty / pairs) * sign * apart[pair], BUCKETS))
        slope[used] = 0
        above = np.flatnonzero(slope > sparsity * (1 + tolerance))
        if not len(above):
            break
        used = np.concatenate([used, above[np.argsort(-slope[above], kind="stable")[:joining]]])
    kept = np.flatnonzero(np.abs(weights) > 1e-9)
    return Model(float(bias), tuple((int(i), float(weights[i])) for i in kept))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
          terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, **options: float) -> Model:
    """A model from ``labels`` (``doc_id, toxic``) and the texts they mark, at most ``max_labelled``."""

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            out = {"doc_id": [], "label": [], "buckets": [], "without": [], "with": []}
            for doc, label, text in zip(rows["doc_id"], rows["label"], rows["text"], strict=True):
                words = words_of(text)
                own = buckets(words)
                apart = [difference(own, buckets(c)) for c in counterfactuals(words, terms)]
                found = (doc, label, own.astype("<i4").tobytes(), *([x.astype("<i4").tobytes() for x in side] for side in (
                    [gone for gone, _ in apart], [new for _, new in apart])))
                for name, value in zip(out, found, strict=True):
                    out[name].append(value)
            return out

        return work

    found = labelled_texts(docs, labels, "toxic", max_labelled)
    schema = "doc_id long, label int, buckets binary, without array<binary>, with array<binary>"
    rows = map_rows(found, make, schema, rows=64).toPandas()
    rows = rows.sort_values(["doc_id", "label", "buckets"], kind="stable")
    read = lambda x: np.frombuffer(x, "<i4")
    copies = [(i, read(gone), read(new)) for i, sides in enumerate(zip(rows["without"], rows["with"], strict=True))
              for gone, new in zip(*sides, strict=True)]
    return fit([read(b) for b in rows["buckets"]], list(rows["label"]), copies, **options)


def _scorer(model: Model) -> Scorer:
    return held(("toxicity", model), lambda: Scorer(model))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each text."""

    def make() -> Callable[[dict], dict]:
        of = _scorer(model)
        return lambda rows: {"doc_id": rows["doc_id"], "score": [of(t) for t in rows["text"]]}

    return map_rows(texts(docs), make, "doc_id long, score double")


def score_column(text: Column, model: Model) -> Column:
    """The score of a text column, for a filter that keeps a table's other columns."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        scorer = _scorer(model)
        return pd.Series([scorer(t or "") for t in texts], dtype="float64")

    return of(text)
