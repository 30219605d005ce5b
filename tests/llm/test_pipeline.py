"""Each stage of the pipeline against a brute-force version of it, on its own input."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldseason.llm import toxicity
from fieldseason.llm.common import id_crc, stored, table
from test_ngram_join import brute as near_copies
from test_pii import brute as spans_of


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, sf))
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows(frame):
    return {r["doc_id"]: tuple(r) for r in frame.collect()}


def test_all_but_the_last_stage_keep_the_columns(steps, spark, sf):
    names = table(spark, sf, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "pii", "packing"]
    assert all(after.columns == names for name, (_, after) in steps.items() if name != "packing")


def test_toxic_documents_go(steps, spark, sf):
    before, after = steps["toxicity"]
    model = toxicity.train(before, table(spark, sf, "labels").filter(id_crc("doc_id") % 4 != 2))
    score = toxicity.Scorer(model)
    assert rows(after) == {d: r for d, r in rows(before).items() if score(r[1]) < corpus_pipeline.TOXIC}
    clean = {r["doc_id"] for r in table(spark, sf, "labels").filter("toxic = 0").collect()} & rows(before).keys()
    assert len(clean - rows(after).keys()) <= 0.05 * len(clean)  # a few dozen labels teach this model; test_models has more


def test_exact_copies_go(steps):
    before, after = map(rows, steps["exact_dedup"])
    first = {}
    for doc in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[doc][1]), doc)
    assert after == {d: before[d] for d in first.values()}


def test_one_of_each_near_class_stays(steps):
    before, after = map(rows, steps["ngram_join"])
    classes = near_copies({d: r[1] for d, r in before.items()})
    assert after == {d: r for d, r in before.items() if classes[d][0] == d}


def test_personal_data_is_masked(steps):
    before, after = map(rows, steps["pii"])
    assert before.keys() == after.keys()
    for doc, (_, text, lang, source, _) in before.items():
        spans = spans_of(text)
        assert not spans_of(after[doc][1]) and after[doc][2:4] == (lang, source) and after[doc][4] == len(after[doc][1])
        if not spans:
            assert after[doc][1] == text


def test_every_token_is_packed(steps):
    before, pieces = steps["packing"]
    totals = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.min("doc_tokens").alias("own")).collect()
    assert {r["doc_id"] for r in totals} == rows(before).keys() and all(r["n"] == r["own"] for r in totals)
    for _, group in itertools.groupby(pieces.orderBy("sequence_id", "offset").collect(), key=lambda r: r["sequence_id"]):
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


def test_run_gives_the_last_stages_rows(steps, spark, sf):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    own, run = steps["packing"][1].select(*columns), corpus_pipeline.run(spark, sf).select(*columns)
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, run.collect()))
