"""Packing of tokenised documents into fixed-length sequences by cutting-stock column generation.

1. ``token_pieces`` tokenises each document once, appends its end id and cuts it every
   ``capacity`` tokens: full pieces fill a sequence each, the rest is shorter.
2. Lengths are rounded up to classes of ``width`` tokens. The histogram over classes, at most
   ``capacity / width`` numbers, gives a linear program over *patterns* (how many pieces of
   each class share a sequence). Columns are priced by an unbounded knapsack over the duals.
3. Patterns are rounded down; the few pieces left, bounded by the number of classes times a
   sequence's pieces, are placed largest first into the first sequence with room.
4. A piece's rank within its class, numbered by (class, salt) so that no class is one task,
   picks its pattern, sequence and slot. Only lengths and payload columns are shuffled. Full
   pieces take no part in 2 to 4; the numbers of their sequences are unique, but have gaps.

Only the histogram by class and salt (at most ``classes * salts`` rows, whatever the input)
reaches the driver. Null text is the empty text, which is one piece holding the end id.
Repeated rows are packed as often as they occur; an empty table gives no piece. Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import unicodedata
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.llm.common import held, map_rows, stored, texts

CACHED_WORDS = 600_000


#: A mark before a full stop or comma, with which it would form one piece.
_MARK_BEFORE = re.compile(r"[.,](?<=[^\w\s].|_.)")


def _simpler(text: str) -> str:
    """A text of the same ids with fewer different words.

    The vocabulary composes (NFC) and then lowers each character; where composing changes
    neither the text nor its lower case, lowering first is the same. A full stop or comma
    between a letter or digit and white space is a piece of its own, so a space may part it.
    """
    low = text.lower()
    if "\u03a3" in text or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
        return text  # a capital sigma's lower case depends on its place in str.lower() alone
    if not _MARK_BEFORE.search(low):
        low = low.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
    return low


class _WordEncoder:
    """Token ids of texts as bytes (little-endian, four to an id), word by word.

    The vocabulary drops white space and no token spans it, so a text's ids are those of its
    words in order. Equal words are encoded once while the bounded cache holds them. When it is
    full, it forgets the older half of the words that only one call had, as most words of a language.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._known, self._once = Tokenizer.from_file(path), {}, set()
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: list[str]) -> None:
        """A word that is letters alone, composed and lowered, ends with its one token that ends a word, so
        many of them are encoded as one text."""
        letters = [w for w in words if unicodedata.normalize("NFC", w).lower().isalpha()]
        others = set(words).difference(letters)
        groups = [letters[at:at + 200] for at in range(0, len(letters), 200)]
        found = self._tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, got in zip(groups, found, strict=True):
            ids = np.array(got.ids, "<u4")
            ends, raw, at = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist(), ids.tobytes(), 0
            if len(ends) != len(group):  # the two libraries differ about what a letter is
                others.update(group)
                continue
            for word, end in zip(group, ends, strict=True):
                self._known[word] = raw[at:end]
                at = end
        others = list(others)
        for word, got in zip(others, self._tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self._known[word] = np.array(got.ids, "<u4").tobytes()

    def _forget(self) -> None:
        old = list(itertools.islice(filter(self._once.__contains__, self._known), len(self._once) // 2 + 1))
        self._once.difference_update(old)
        for word in old:
            del self._known[word]
        while len(self._known) > CACHED_WORDS * 3 // 4:  # many words that several calls had: the newest go
            self._once.discard(self._known.popitem()[0])

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [_simpler(t).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self._known) > CACHED_WORDS:
            self._forget()
        words = set().union(*split)
        new = words.difference(self._known)
        self._learn(list(new))
        self._once.difference_update(words)
        self._once.update(new)
        return [b"".join(map(self._known.__getitem__, words)) for words in split]


def _encoder(path: str) -> _WordEncoder:
    return held(("packing", path), lambda: _WordEncoder(path))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, path: str | None = None, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``: each document's ids cut every ``capacity``.

    ``path`` is the vocabulary's place on every worker, by default the installed one.
    """
    end = np.array([end_id], "<u4").tobytes()

    def make() -> Callable[[dict], dict]:
        encode = _encoder(path or word_bpe_path())

        def work(rows: dict) -> dict:
            out = {"doc_id": [], "start": [], "length": [], "ids": [], "doc_tokens": []}
            for doc, ids in zip(rows["doc_id"], encode(rows["text"]), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at:at + 4 * capacity]
                    for name, value in zip(out, (doc, at // 4, len(piece) // 4, piece, len(ids) // 4), strict=True):
                        out[name].append(value)
            return out

        return work

    return map_rows(texts(docs), make, "doc_id long, start long, length long, ids binary, doc_tokens long", rows=128)


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of classes of the highest value that fits: an unbounded knapsack."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_up, values_up = sizes[order], values[order]
    fits = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], last[room] = best[room - 1], -1
        if n := fits[room]:
            got = best[room - sizes_up[:n]] + values_up[:n]
            k = int(np.argmax(got))
            if got[k] > best[room] + 1e-12:
                best[room], last[room] = got[k], k
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[order[last[room]]] += 1
            room -= sizes_up[last[room]]
    return float(best[capacity]), pattern


def _greedy_basis(sizes: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that hold the demand, one for each class, and how often each is used.

    Full sequences of the largest classes left are used until a class runs out, which no later
    pattern holds: so the patterns form a basis.
    """
    left, columns, amount = need.copy(), np.zeros((len(sizes), len(sizes))), np.zeros(len(sizes))
    open_ = np.arange(len(sizes))
    while len(open_):
        # The fullest sequence, and among equals the one of larger pieces.
        value = sizes[open_] + 1e-3 * sizes[open_] ** 2 / capacity
        _, pattern = _best_pattern(sizes[open_], value, capacity)
        times = left[open_][pattern > 0] / pattern[pattern > 0]
        ends = open_[np.flatnonzero(pattern > 0)[int(np.argmin(times))]]
        columns[open_, ends], amount[ends] = pattern, times.min()
        left[open_] -= pattern * times.min()
        left[ends] = 0
        open_ = open_[open_ != ends]
    return columns, amount


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By elimination, row by row: numpy's own call waits for ever in a driver whose JVM was forked after its threads were made."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        top = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, top]] = both[[top, i]]
        both[i] /= both[i, i]
        others = np.arange(n) != i
        both[others] -= np.outer(both[others, i], both[i])
    return both[:, n:]


def relaxed(sizes: np.ndarray, need: np.ndarray, capacity: int, calm: float = 0.8, near: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Patterns in columns, how often each is used, and the classes' duals: no sequence holds more than a worth of 1.

    Revised simplex over the columns in the basis, from a greedy one. Columns are priced at duals
    drawn towards the best ones known, as the simplex's own jump about; a column enters when it is
    worth more than a sequence at the simplex's duals. It ends when none is, or when the amount is
    within ``near`` of the bound that the duals prove, however many columns that takes.
    """
    # A little more of each class, unlike the next one's, so that no step of the simplex is of length zero.
    need = need + 1e-6 * (1 + np.arange(len(sizes)) * 0.6180339887 % 1)
    columns, amount = _greedy_basis(sizes, need, capacity)
    inverse = _inverse(columns)
    best, bound, steps = sizes / capacity, sizes @ need / capacity, 0
    least, since = np.inf, 0
    # Five thousand columns without any gain are rounding's going round in circles.
    while amount.sum() > bound * (1 + near) and since < 5000:
        least, since = (amount.sum(), 0) if amount.sum() < least * (1 - 1e-12) else (least, since + 1)
        own = inverse.sum(axis=0)
        duals = calm * best + (1 - calm) * own
        worth, column = _best_pattern(sizes, duals, capacity)
        if duals @ need / max(worth, 1) > bound:
            best, bound = duals / max(worth, 1), duals @ need / max(worth, 1)
        if own @ column <= 1 + 1e-7:
            worth, column = _best_pattern(sizes, own, capacity)
            if worth <= 1 + 1e-7:
                best = own / max(worth, 1)
                break
        move = inverse @ column
        ratio = np.where(move > 1e-9, amount / np.where(move > 1e-9, move, 1), np.inf)
        leaves = int(np.argmin(ratio))
        amount = np.maximum(amount - ratio[leaves] * move, 0)
        amount[leaves] = ratio[leaves]
        columns[:, leaves] = column
        inverse[leaves] /= move[leaves]
        others = np.arange(len(sizes)) != leaves
        inverse[others] -= np.outer(move[others], inverse[leaves])
        steps += 1
        if steps % 200 == 0:  # against the rounding of many updates
            inverse = _inverse(columns)
            amount = np.maximum(inverse @ need, 0)
    return columns, amount, best


def plan_patterns(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, {class: pieces})`` that together hold exactly ``demand``."""
    sizes = np.array(sorted(k for k, n in demand.items() if n), int)
    if not len(sizes):
        return []
    columns, amount, _ = relaxed(sizes, np.array([demand[k] for k in sizes], float), capacity)
    left, plan = {int(k): int(demand[k]) for k in sizes}, []
    for j in np.argsort(-amount, kind="stable"):
        pattern = {int(k): int(n) for k, n in zip(sizes, columns[:, j], strict=True) if n}
        times = min(int(amount[j] + 1e-6), *(left[k] // n for k, n in pattern.items()))
        if times:
            plan.append((times, pattern))
            for k, n in pattern.items():
                left[k] -= times * n
    return plan + [(1, pattern) for pattern in _first_fit(left, capacity)]


def _first_fit(left: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """The pieces that rounding left, largest first, each in the first sequence with room."""
    opened: list[list] = []
    for k in sorted(left, reverse=True):
        for _ in range(left[k]):
            bin_ = next((b for b in opened if b[0] >= k), None)
            if bin_ is None:
                opened.append(bin_ := [capacity, {}])
            bin_[0] -= k
            bin_[1][k] = bin_[1].get(k, 0) + 1
    return [pattern for _, pattern in opened]


def pack(pieces: DataFrame, capacity: int = 4096, width: int = 16, salts: int = 256) -> DataFrame:
    """``pieces`` (stored, so that they are not made twice) with ``sequence_id`` and ``offset``.

    Needs ``doc_id, start, length``; other columns ride along.
    """
    if capacity % width:
        raise ValueError("width must divide capacity")
    spark, own = pieces.sparkSession, pieces.columns
    # A full piece is a sequence of its own; what is left of a document shares one.
    full = pieces.filter(F.col("length") == capacity)
    rows = pieces.filter(F.col("length") < capacity).withColumn("_class", F.ceil(F.col("length") / width).cast("int")).withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    counted = sorted(map(tuple, rows.groupBy("_class", "_salt").count().collect()))
    demand, offsets = {}, []
    for k, salt, n in counted:
        offsets.append((k, salt, demand.get(k, 0)))
        demand[k] = demand.get(k, 0) + n
    places, taken, base = [], dict.fromkeys(demand, 0), 0
    for times, pattern in plan_patterns(demand, capacity // width):
        slot = 0
        for k, n in sorted(pattern.items(), reverse=True):
            places.append((k, taken[k], taken[k] + times * n, n, base, slot))
            taken[k] += times * n
            slot += n
        base += times
    offsets = spark.createDataFrame(offsets, "_class int, _salt int, _before long")
    places = spark.createDataFrame(places, "_class int, _from long, _to long, _each int, _base long, _slot int")
    # Both tables are bounded by classes and salts, so they may be broadcast.
    ranked = rows.withColumn("_rank", F.row_number().over(
        Window.partitionBy("_class", "_salt").orderBy("doc_id", "start", F.xxhash64(*own))) - 1)
    ranked = ranked.join(F.broadcast(offsets), ["_class", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    placed = ranked.join(F.broadcast(places.withColumnRenamed("_class", "_k")), (F.col("_class") == F.col("_k")) & (
        F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    at = F.col("_rank") - F.col("_from")
    placed = placed.withColumn("sequence_id", (F.col("_base") + F.floor(at / F.col("_each"))).cast("long")).withColumn(
        "_slot", F.col("_slot") + at % F.col("_each"))
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    # Full pieces' numbers follow those of the packed sequences; they are unique, with gaps between tasks.
    alone = full.select(*own, (F.lit(base) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.withColumn("offset", offset).select(*own, "sequence_id", "offset").unionByName(alone)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = 4096) -> DataFrame:
    """Every piece with its ids, its sequence and its place there."""
    return pack(stored(token_pieces(docs, path, capacity=capacity)), capacity)


def packed_digests(docs: DataFrame, path: str | None = None, capacity: int = 4096) -> DataFrame:
    """As ``pack_documents``, with the crc32 of a piece's ids in their place."""
    pieces = token_pieces(docs, path, capacity=capacity)
    digests = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(stored(digests), capacity)
