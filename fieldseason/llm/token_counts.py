"""Token counts of a unigram tokenizer without its tokens: count-only Viterbi.

A text's spaces become ``▁``, one more is put before unless the text starts with one, and a
word begins at each ``▁``. An Aho-Corasick automaton lists the vocabulary pieces that end at
each character of a word. For each position the best segmentation's score and its number of
tokens are carried, and nothing else. The rules are the tokenizer's own: of equal scores the
segmentation whose last piece starts first wins; a character that is no piece itself may be
unknown, at the lowest score less ``UNKNOWN``, and wins only by a higher score; with byte
fallback an unknown character counts a token for each byte, otherwise a run of them counts one.

The vocabulary file's pieces carry merge ranks, not probabilities. As nothing is trained here,
a piece's score is that of a Zipf law over the file's order: ``-ln(place + 1)``.

Null text is the empty text: no token, score 0. Repeated rows get equal results. Other columns
are ignored. Words are counted once while a bounded table holds them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame

from fieldseason.llm.common import held, map_rows, texts

#: What an unknown character costs below the lowest score, a fixed value of the tokenizer.
UNKNOWN = 10.0
CACHED_WORDS = 400_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The file's ordinary pieces in order with their scores; others count as places only.

    Control, unknown and unused pieces, and the pieces of single bytes, stand for no text: their
    strings in a text are ordinary text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = [model.is_control, model.is_unknown, model.is_unused, model.is_byte]
    return [(model.id_to_piece(i), -math.log(i + 1)) for i in range(model.get_piece_size()) if not any(f(i) for f in special)]


class Counter:
    """Number of tokens and score of a word's best segmentation."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        self._matches = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self._matches.add_word(piece, (len(piece), score))
        self._matches.make_automaton()
        self._unknown = min(score for _, score in pieces) - UNKNOWN
        self._bytes, self._known = byte_fallback, {}

    def word(self, word: str) -> tuple[int, float]:
        score, count, unknown = [0.0], [0], [False]
        ending: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self._matches.iter(word):
            ending[end].append(match)
        for end, matches in enumerate(ending):
            best, tokens, lost = None, 0, False
            for length, value in matches:  # the longest, which starts first, comes first
                at = end + 1 - length
                value += score[at]
                if best is None or value > best:
                    best, tokens = value, count[at] + 1
            if not matches or matches[-1][0] > 1:
                value = score[end] + self._unknown
                if best is None or value > best:
                    more = len(word[end].encode("utf-8", "surrogatepass")) if self._bytes else not unknown[end]
                    best, tokens, lost = value, count[end] + more, True
            score.append(best)
            count.append(tokens)
            unknown.append(lost)
        return count[-1], score[-1]

    def text(self, text: str) -> tuple[int, float]:
        text = text.replace(" ", "▁")
        words = text.split("▁")
        head = [] if text.startswith("▁") or not text else [words[0]]
        tokens, total, known = 0, 0.0, self._known
        for word in head + words[1:]:
            if (found := known.get(word)) is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                found = known[word] = self.word("▁" + word)
            tokens += found[0]
            total += found[1]
        return tokens, total


def _counter(path: str) -> Counter:
    return held(("token_counts", path), lambda: Counter(read_pieces(path)))


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, score`` of each text."""

    def make() -> Callable[[dict], dict]:
        counter = _counter(path or piece_path())

        def work(rows: dict) -> dict:
            found = [counter.text(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "n_tokens": [n for n, _ in found], "score": [s for _, s in found]}

        return work

    return map_rows(texts(docs), make, "doc_id long, n_tokens long, score double")
