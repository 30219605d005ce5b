"""Personal data by bootstrapped contextual extraction.

Base spans come from fixed patterns (e-mail, ip, card, phone). They seed the bootstrapping:

1. One pass over the texts keeps, per document, its base spans and its *candidates*: other words
   with four digits or an ``@``, and neighbouring groups of digits as one string, which may hold
   such words. Both carry their lexical context, the word and the two words
   before them, in lower case with digits as ``0``.
2. Contexts and the strings they introduce form a bipartite graph. A context's confidence for a
   kind is the summed score of its strings of that kind over all its different strings plus one;
   contexts with enough support and confidence give their other strings scores, which count in the
   next round. Seeds score 1; a string of several contexts scores 1 - product of (1 - confidence).
3. Candidates whose string is accepted become spans of that kind, wherever they occur.

Offsets are code points, ends exclusive. Null text is the empty text. Repeated rows get equal
results, and their strings count once, as a graph's edges are distinct. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldseason.llm.common import map_rows, stored, texts

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns, up to what makes them fail in linear time: a local part is read backwards from its
# "@", and an address starts where a run of digits does.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SPLIT = re.compile(r"[\x09-\x0D]")
#: Groups of digits with brackets, dots and hyphens, or an IBAN's groups, one space between; atomic, so in linear time.
_DIGITS = r"\(?[0-9](?:[0-9().-]*[0-9])?\)?"
_GROUPED = re.compile(rf"(?<![\w()+./@-])(?:[A-Z]{{2}}[0-9]{{2}}(?:[\x20\t][A-Z0-9]{{4}})+(?:[\x20\t][A-Z0-9]{{1,3}})?"
                      rf"|(?>{_DIGITS})(?:[\x20\t](?>{_DIGITS}))+)(?![\w/@])")
#: Marks around a word that aren't part of an identifier.
_MARKS = " .,;:!?()[]{}<>\"'|#*$%&="


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for domain in _DOMAIN.finditer(text):
        start = domain.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < domain.start():
            yield start, domain.end()
            last = domain.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)``, by kind and then start. Matches that fail a kind's rule are dropped."""
    found = [(0, *span) for span in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text) if "." in text else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "") if len(match[0]) >= 13 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *match.span()))
    for match in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(match[0])) <= 15:
            found.append((3, *match.span()))
    return found


def _context(text: str, start: int) -> list[str]:
    words = [re.sub("[0-9]", "0", w) for w in (x.strip(_MARKS) for x in text[max(0, start - 80):start].lower().split(" ")) if w]
    return [" ".join(words[-n:]) for n in (1, 2) if len(words) >= n]


def _candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words that look like identifiers and meet no base span; ``text`` has spaces for white space."""
    taken, i, at = sorted((s, e) for _, s, e in base), 0, 0
    for mark in re.finditer("[0-9@]", text):
        if mark.start() < at:
            continue
        start = text.rfind(" ", at, mark.start()) + 1 or at
        end = text.find(" ", mark.end())
        at = end = len(text) if end < 0 else end
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if i < len(taken) and taken[i][0] < end:
            continue
        word = text[start:end]
        start, end = start + len(word) - len(word.lstrip(_MARKS)), end - len(word) + len(word.rstrip(_MARKS))
        word = text[start:end]
        if word and ("@" in word[1:-1] or len(_DIGIT.findall(word)) >= 4):
            yield start, end


def _grouped(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Neighbouring groups of at least four digits in all that meet no base span."""
    taken, i = sorted((s, e) for _, s, e in base), 0
    for match in _GROUPED.finditer(text):
        start, end = match.span()
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        if (i == len(taken) or taken[i][0] >= end) and len(_DIGIT.findall(match[0])) >= 4:
            yield start, end


def _mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, list[str], str]]:
    """``(kind or -1, start, end, contexts, string)`` of base spans and candidates."""
    plain = _SPLIT.sub(" ", text)
    spans = base + [(-1, s, e) for s, e in (*_candidates(plain, base), *_grouped(text, base))]
    return [(k, s, e, _context(plain, s), plain[s:e].lower()) for k, s, e in spans]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def base_and_mentions(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, version, base`` and its mentions in parallel arrays."""

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "version": rows["version"], "base": [], "kind": [], "start": [],
                                    "end": [], "contexts": [], "string": []}
            for text in rows["text"]:
                base = base_spans(text)
                found = _mentions(text, base) if base or "@" in text or _DIGIT.search(text) else []
                out["base"].append(_joined(base))
                for i, name in enumerate(("kind", "start", "end", "contexts", "string")):
                    out[name].append([m[i] for m in found])
            return out

        return work

    rows = texts(docs).withColumn("version", F.xxhash64("text"))
    return map_rows(rows, make, "doc_id long, version long, base string, kind array<int>, start array<int>, end array<int>, "
                                "contexts array<array<string>>, string array<string>")


def accepted_strings(mentions: DataFrame, rounds: int = 3, support: int = 4, confidence: float = 0.8) -> DataFrame:
    """``string, kind, score`` of strings that contexts reveal; base strings are not among them.

    ``mentions`` has a row per mention: ``kind`` (-1: a candidate), ``contexts`` and ``string``.
    """
    seeds = mentions.filter("kind >= 0").groupBy("string").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0))
    edges = stored(mentions.select(F.explode("contexts").alias("context"), "string").distinct())
    sizes = edges.groupBy("context").agg(F.count("*").alias("n"))
    scores = seeds = stored(seeds)
    for _ in range(rounds):
        positive = edges.join(scores, "string").groupBy("context", "kind").agg(F.sum("score").alias("score"))
        trusted = positive.filter(F.col("score") >= support).join(sizes, "context").select(
            "context", "kind", (F.col("score") / (F.col("n") + 1)).alias("c")).filter(F.col("c") >= confidence)
        revealed = edges.join(trusted, "context").groupBy("string", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("c"))))).alias("score"))
        best = revealed.groupBy("string").agg(F.max(F.struct("score", -F.col("kind"))).alias("b")).select(
            "string", (-F.col("b.col2")).alias("kind"), F.col("b.score").alias("score"))
        revealed = stored(best.join(seeds, "string", "left_anti"))
        scores = seeds.unionByName(revealed)
    return revealed


def find_pii(docs: DataFrame, rounds: int = 3, support: int = 4, confidence: float = 0.8) -> DataFrame:
    """One row per document: ``doc_id, version`` (of the text), ``base`` and ``spans``, texts of ``kind:start:end``."""
    rows = stored(base_and_mentions(docs))
    parts = F.explode(F.arrays_zip("kind", "start", "end", "contexts", "string")).alias("m")
    mentions = rows.select("doc_id", "version", parts).select("doc_id", "version", "m.*")
    accepted = accepted_strings(mentions, rounds, support, confidence).select("string", F.col("kind").alias("as"))
    new = mentions.filter("kind < 0").join(accepted, "string").groupBy("doc_id", "version").agg(
        F.collect_set(F.struct(F.col("as").alias("kind"), "start", "end")).alias("new"))
    new = new.select(F.col("doc_id").alias("_id"), F.col("version").alias("_v"), "new")
    base = F.transform(F.filter(F.arrays_zip("kind", "start", "end"), lambda m: m["kind"] >= 0),
                       lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    every = F.array_sort(F.concat(base, F.coalesce("new", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.array_join(F.transform(every, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"], m["end"])), ",")
    return rows.join(new, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_v")), "left").select(
        "doc_id", "version", "base", text.alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans."""
    kinds = F.transform(F.split("base", ","), lambda x: F.substring_index(x, ":", 1))
    count = lambda k: F.size(F.filter(kinds, lambda x: x == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def _masked(text: str, spans: str) -> str:
    """Spans are replaced by their kind; those that meet are replaced as one, by the first's kind."""
    parts, at = [], 0
    for start, end, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def mask(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``found`` replaced by their kinds, and ``n_chars`` as it is then."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_masked(t, s) if s else t for t, s in zip(texts, spans, strict=True)], dtype=object)

    some = found.filter("spans <> ''").select("doc_id", "version", "spans").distinct()
    text, spans = F.coalesce(docs["text"], F.lit("")), some["spans"]
    new = {"text": F.when(spans.isNull(), docs["text"]).otherwise(masked(docs["text"], spans))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(spans.isNull(), docs["n_chars"]).otherwise(F.length(new["text"]))
    out = docs.join(some, docs["doc_id"].eqNullSafe(some["doc_id"]) & (F.xxhash64(text) == some["version"]), "left")
    return out.select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])
