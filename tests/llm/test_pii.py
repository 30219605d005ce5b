"""Base spans against the patterns as given, and what contexts reveal."""

import collections
import hashlib
import random
import re

from fieldseason.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    rules = ((EMAIL, lambda x: True), (IP, lambda x: all(int(p) <= 255 for p in x.split("."))),
             (CARD, lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x))), (PHONE, lambda x: 9 <= len(digits(x)) <= 15))
    return [(k, *m.span()) for k, (pattern, rule) in enumerate(rules) for m in pattern.finditer(text) if rule(m[0])]


def test_base_spans_are_the_patterns_matches():
    rng, parts = random.Random(9), ["a", "b.c", "@", ".", "-", "12", "255", "256", "4", "+", " ", "(", ")", "4111111111111111", "\n", "x@y.z", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1 " * 100_000, "9 " * 200_000):
        pii._mentions(text, pii.base_spans(text))


def test_op9_is_the_brute_force_result(spark, sf):
    found = {r["doc_id"]: r for r in queries.op9_pii(spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        spans = brute(text)
        joined, times = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans), collections.Counter(k for k, _, _ in spans)
        assert found[doc]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [found[doc][f"n_{k}"] for k in pii.KINDS] == [times[i] for i in range(4)]
        assert set(joined.split(",")) <= set(found[doc]["spans"].split(","))


def test_contexts_reveal_identifiers_that_no_pattern_knows(docs_of):
    """Phones are introduced by words that then introduce a number written otherwise; dates are not."""
    rows = [(i, f"please call me at +1 (414) 555-{1000 + i} or write, in {1900 + i} words") for i in range(40)]
    rows += [(100, "please call me at 555/2368/77 soon"), (101, "the number 555/2368/77 again"), (102, "in 123456 words")]
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(docs_of(*rows)).collect()}
    assert found[100] == "phone:18:29" and found[101] == "phone:11:22" and found[102] == ""
    assert found[3].startswith("phone:18:") and "," not in found[3]


def test_contexts_reveal_identifiers_written_with_spaces(docs_of):
    rows = [(i, f"please call me at +1 (414) 555-{1000 + i} or write, in {1900 + i} words") for i in range(40)]
    spaced = ["(414) 555-1791", "078 05 1120", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19"]
    rows += [(100 + i, f"please call me at {x} or write") for i, x in enumerate(spaced)]
    rows += [(200, "the number 078 05 1120, again"), (201, "in 12 345 words")]
    docs = docs_of(*rows)
    found = pii.find_pii(docs)
    spans = {r["doc_id"]: r["spans"] for r in found.collect()}
    assert all(f"phone:18:{18 + len(x)}" in spans[100 + i].split(",") for i, x in enumerate(spaced))
    assert spans[200] == "phone:11:22" and spans[201] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs, found).collect()}
    assert {masked[100 + i] for i in range(4)} == {"please call me at [PHONE] or write"}


def test_groups_take_linear_time_and_keep_to_a_line():
    for text in ("9 " * 200_000, "1." * 200_000, "(1) " * 100_000, "1.1 " * 100_000 + "x", "12 3x " * 100_000, "DE89 3704 " * 50_000):
        list(pii._grouped(text, []))
    assert list(pii._grouped("1999\n2000 12 at 3 4", [])) == [(5, 12)]


def test_masked_texts(docs_of):
    docs = docs_of((1, "write to a.b@c.org or 10.0.0.1 now"), (2, "nothing here"), (None, "x@y.zz"), (3, None))
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.mask(docs, pii.find_pii(docs)).collect()}
    assert out == {1: ("write to [EMAIL] or [IP] now", 28), 2: ("nothing here", 12), None: ("[EMAIL]", 7), 3: (None, None)}
    assert pii._masked("0123456789", "card:2:6,phone:4:8,ip:9:10") == "01[CARD]8[IP]"
