"""Language identification by compression.

For each language a raw-content dictionary is drawn from labelled documents. A text, reduced to
its different words in lower case, is compressed with each language's dictionary, and the smallest
result names the language. Equal sizes are compressed again at a level that finds shorter matches;
what is equal still goes to the first name. A narrow margin, relative to the second smallest
size, rejects: ``rejected`` is set, while the guess stays visible.

Null text and text without a letter is ``und`` with score 0 and rejected, and so is every text when
nothing was labelled. Null languages teach nothing. Repeated rows get equal results. Other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import held, map_rows, texts

UND = "und"
#: Bytes of a language's dictionary; labelled texts of these lengths may give to it, at most
#: ``SAMPLES`` of them, chosen by hash; the most languages, those with most labelled documents.
DICTIONARY, SHORTEST, LONGEST, SAMPLES, LANGUAGES = 110_000, 200, 1_500, 256, 200
LEVEL, TIE_LEVEL, MARGIN = 6, 19, 0.02
_NO_LETTERS = re.compile(r"[\W\d_]+")


def words_of(text: str) -> bytes:
    """A text's different words of letters, in order of appearance; empty without a letter."""
    words = dict.fromkeys(_NO_LETTERS.sub(" ", text.lower()).split(" "))
    words.pop("", None)
    found = " ".join(words)
    return found.encode("utf-8", "replace") if any(c.isalpha() for c in found) else b""


def train(labelled: DataFrame) -> dict[str, bytes]:
    """``{language: dictionary}`` from rows of ``text, lang``.

    Per language a text is drawn for each of ``SAMPLES`` remainders of its hash, the one of the
    smallest hash, so copies of a text are drawn once. What reaches the driver is bounded by
    ``LANGUAGES * SAMPLES`` texts of at most ``LONGEST`` characters, whatever the table's size.
    """
    rows = labelled.select("text", "lang").filter(F.col("lang").isNotNull() & F.length("text").between(SHORTEST, LONGEST))
    rows = rows.withColumn("h", F.xxhash64("text"))
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    drawn = rows.groupBy("lang", F.pmod("h", F.lit(SAMPLES)).alias("b")).agg(F.min("h").alias("h"))
    # Both sides are bounded by languages and samples.
    drawn = drawn.join(F.broadcast(known), "lang").select("lang", "h")
    found: dict[str, dict] = {}
    for row in rows.join(F.broadcast(drawn), ["lang", "h"]).select("lang", "h", "text").distinct().collect():
        found.setdefault(row["lang"], {})[row["h"], row["text"]] = words_of(row["text"])
    whole = {lang: b" ".join(texts[k] for k in sorted(texts)) for lang, texts in sorted(found.items())}
    return {lang: text[:DICTIONARY] for lang, text in whole.items() if text}


class Identifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        def compressor(data: bytes, level: int) -> Callable[[bytes], bytes]:
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            return zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False,
                                            write_checksum=False, write_dict_id=False).compress

        self._by_level = {level: {lang: compressor(data, level) for lang, data in dictionaries.items()}
                          for level in (LEVEL, TIE_LEVEL)}

    def _sizes(self, words: bytes, level: int) -> list[tuple[int, str]]:
        return sorted((len(compress(words)), lang) for lang, compress in self._by_level[level].items())

    def __call__(self, text: str) -> tuple[str, float]:
        """The language and the margin: how much smaller its result is than the next one's."""
        words = words_of(text)
        if not words or not self._by_level[LEVEL]:
            return UND, 0.0
        sizes = self._sizes(words, LEVEL)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        if sizes[0][0] == sizes[1][0]:
            sizes = self._sizes(words, TIE_LEVEL)
        return sizes[0][1], 1 - sizes[0][0] / sizes[1][0]


def _identifier(dictionaries: tuple[tuple[str, bytes], ...]) -> Identifier:
    return held(("langid", dictionaries), lambda: Identifier(dict(dictionaries)))


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of each text; only the text is looked at."""
    frozen = tuple(sorted(dictionaries.items()))

    def make() -> Callable[[dict], dict]:
        guess = _identifier(frozen)

        def work(rows: dict) -> dict:
            found = [guess(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "lang_pred": [x for x, _ in found], "score": [s for _, s in found],
                    "rejected": [x == UND or s < margin for x, s in found]}

        return work

    return map_rows(texts(docs), make, "doc_id long, lang_pred string, score double, rejected boolean")
