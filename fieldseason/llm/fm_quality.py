"""Quality as a factorisation machine sees it.

Features of a text: its hashed words, each with the share of the text's words it makes up under a
square root; structure statistics (length, shares of letters, capitals, digits, marks and white
space, repeated words and lines, mean lengths); and metadata, the length the table states against
the text's own. Besides a weight, each feature has a vector of ``RANK`` numbers; every pair of
features interacts by the product of their vectors. All pairs together cost linear time:
sum over i<j of <v_i, v_j> x_i x_j = 1/2 sum over f of ((sum v_if x_i)^2 - sum (v_if x_i)^2).

Training takes a bounded sample of labelled documents, chosen by hash; scoring reads whole texts.
Null text is the empty text, null or missing stated lengths count as the text's own. Documents
with two labels teach both; without any label every score is 0.5. Repeated rows get equal results. Other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import held, map_rows, split_words

#: Buckets of hashed words, and the vectors' length.
BUCKETS, RANK = 1 << 14, 6
#: The bound of the training sample.
MAX_LABELLED = 4_000
CACHED_WORDS = 200_000
#: Structure statistics; the last one is metadata.
STATISTICS = ("length", "letters", "capitals", "digits", "marks", "white space", "word length", "line length",
              "repeated words", "repeated lines", "symbols", "shouting", "stated length")
_SIZE = BUCKETS + len(STATISTICS)
_LETTER, _CAPITAL, _DIGIT = re.compile(r"[^\W\d_]"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d")
_SYMBOL, _SHOUT = re.compile(r"[#*$%&|<>]"), re.compile(r"!!")


def statistics(text: str, words: list[str], n_different: int, stated: int | None) -> list[float]:
    """Each between 0 and about 1, so that no feature outweighs the others by its scale."""
    n, lines = max(len(text), 1), [x for x in text.split("\n") if x.strip()]
    count = lambda pattern: len(pattern.findall(text)) / n
    letters, digits, spaces = count(_LETTER), count(_DIGIT), text.count(" ") / n + text.count("\n") / n
    return [
        math.log1p(len(text)) / 12, letters, count(_CAPITAL), digits, max(0.0, 1 - letters - digits - spaces), spaces,
        min(n / max(len(words), 1) / 20, 1.0), min(math.log1p(n / max(len(lines), 1)) / 8, 1.0),
        1 - n_different / max(len(words), 1), 1 - len(set(lines)) / max(len(lines), 1), min(10 * count(_SYMBOL), 1.0),
        min(10 * count(_SHOUT), 1.0), min(abs(math.log((1 + (len(text) if stated is None else max(stated, 0))) / (1 + len(text)))), 1.0)]


class Features:
    """Buckets and values of a text; words' buckets are kept in a bounded table."""

    def __init__(self):
        self._known: dict[str, int] = {}

    def _bucket(self, word: str) -> int:
        if len(self._known) > CACHED_WORDS:
            self._known.clear()
        found = self._known[word] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        return found

    def __call__(self, text: str, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
        words, known = split_words(text), self._known
        times = Counter(words)
        at = np.fromiter((known[w] if w in known else self._bucket(w) for w in times), np.int64, len(times))
        share = np.fromiter(times.values(), float, len(times))
        place, back = np.unique(at, return_inverse=True)
        value = np.sqrt(np.bincount(back, share, len(place)) / max(len(words), 1))
        extra = statistics(text, words, len(times), stated)
        return np.append(place, np.arange(BUCKETS, _SIZE)), np.append(value, extra)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: bytes
    vectors: bytes


class Machine:
    def __init__(self, model: Model):
        self._bias = model.bias
        self._w = np.frombuffer(model.weights, "<f4").astype(float)
        self._v = np.frombuffer(model.vectors, "<f4").astype(float).reshape(len(self._w), -1)
        self._features = Features()

    def logit(self, place: np.ndarray, value: np.ndarray) -> float:
        x = self._v[place] * value[:, None]
        return float(self._bias + self._w[place] @ value + 0.5 * ((x.sum(0) ** 2).sum() - (x * x).sum()))

    def __call__(self, text: str, stated: int | None) -> float:
        return 1 / (1 + math.exp(-min(max(self.logit(*self._features(text, stated)), -700.0), 700.0)))


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 12, batch: int = 64,
        rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> Model:
    """Stochastic gradients with a step of each weight's own (Adagrad), in an order drawn from ``seed``."""
    rng = np.random.default_rng(seed)
    w, v = np.zeros(_SIZE), rng.normal(0, 0.02, (_SIZE, RANK))
    w_sum, v_sum, bias, b_sum = np.full(_SIZE, 1e-4), np.full((_SIZE, RANK), 1e-4), 0.0, 1e-4
    y = np.array(labels, float)
    for _ in range(epochs if len(examples) else 0):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            sizes = [len(examples[i][0]) for i in chosen]
            place, value = (np.concatenate([examples[i][k] for i in chosen]) for k in (0, 1))
            begin, row = np.cumsum([0, *sizes[:-1]]), np.repeat(np.arange(len(chosen)), sizes)
            x = v[place] * value[:, None]
            whole = np.add.reduceat(x, begin)
            logit = bias + np.add.reduceat(w[place] * value, begin) + 0.5 * (
                (whole ** 2).sum(1) - np.add.reduceat((x * x).sum(1), begin))
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[chosen]) / len(chosen)
            push = error[row] * value
            used, back = np.unique(place, return_inverse=True)
            gw = np.bincount(back, push, len(used)) + decay * w[used]
            gv = np.stack([np.bincount(back, push * (whole[row, f] - x[:, f]), len(used)) for f in range(RANK)], 1)
            gv += decay * v[used]
            w_sum[used] += gw * gw
            v_sum[used] += gv * gv
            w[used] -= 10 * rate * gw / np.sqrt(w_sum[used])
            v[used] -= rate * gv / np.sqrt(v_sum[used])
            b_sum += error.sum() ** 2
            bias -= rate * error.sum() / math.sqrt(b_sum)
    if not len(examples):
        v[:] = 0
    return Model(float(bias), w.astype("<f4").tobytes(), v.astype("<f4").tobytes())


def _inputs(docs: DataFrame) -> DataFrame:
    stated = docs["n_chars"].cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"), stated.alias("stated"))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **options: float) -> Model:
    """A model from ``labels`` (``doc_id, quality``) and the documents they mark, at most ``max_labelled``."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled)

    def make() -> Callable[[dict], dict]:
        features = Features()

        def work(rows: dict) -> dict:
            found = [features(t, s) for t, s in zip(rows["text"], rows["stated"], strict=True)]
            return {"doc_id": rows["doc_id"], "label": rows["label"],
                    "place": [p.astype("<i4").tobytes() for p, _ in found],
                    "value": [x.astype("<f4").tobytes() for _, x in found]}

        return work

    # The sample is bounded, so it may be broadcast and gathered.
    rows = map_rows(_inputs(docs).join(F.broadcast(known), "doc_id"), make,
                    "doc_id long, label int, place binary, value binary", rows=64).toPandas()
    rows = rows.sort_values(["doc_id", "label"], kind="stable")
    examples = [(np.frombuffer(p, "<i4").astype(np.int64), np.frombuffer(x, "<f4").astype(float))
                for p, x in zip(rows["place"], rows["value"], strict=True)]
    return fit(examples, list(rows["label"]), **options)


def _machine(model: Model) -> Machine:
    return held(("quality", model), lambda: Machine(model))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each document, from its text and stated length."""

    def make() -> Callable[[dict], dict]:
        of = _machine(model)
        return lambda rows: {"doc_id": rows["doc_id"],
                             "score": [of(t, s) for t, s in zip(rows["text"], rows["stated"], strict=True)]}

    return map_rows(_inputs(docs), make, "doc_id long, score double")
