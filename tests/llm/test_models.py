"""Trained operators: accuracy on held-out documents, and what each method is for."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from fieldseason.llm import fm_quality, langid, queries, toxicity

SF = "/root/testdata/sf0.01"


def judged(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = query(spark, SF).join(labels, "doc_id").filter("held_out").select("score", "predicted", label).collect()
    return [(r["score"], r["predicted"], r[label]) for r in rows]


def test_op1_is_right_about_held_out_documents(spark):
    rows = judged(spark, queries.op1_toxicity, "toxic")
    assert all(p == (s >= 0.3) and 0 <= s <= 1 for s, p, _ in rows)
    # 37 toxic documents in four languages, 14 held out: enough to rank by, not to know every term.
    assert sum(p == y for _, p, y in rows) >= 0.85 * len(rows)
    ranks = [(a > b) + (a == b) / 2 for a, _, y in rows if y for b, _, z in rows if not z]
    assert np.mean(ranks) > 0.6
    assert sum(p and not y for _, p, y in rows) <= 0.03 * len(rows)


def brute_objective(model, examples, labels, copies, penalty, sparsity):
    """The definition: mean log loss, the penalty over whole copies, and the weights' size."""
    w = dict(model.weights)
    logit = lambda b: sum(w.get(int(x), 0.0) for x in b)
    loss = sum(math.log1p(math.exp(-(z if y else -z))) for z, y in (
        (model.intercept + logit(b), y) for b, y in zip(examples, labels, strict=True))) / len(examples)
    apart = sum((logit(examples[i]) - logit(copy)) ** 2 for i, copy in copies) / max(len(copies), 1)
    return loss + penalty * apart + sparsity * sum(abs(v) for v in w.values())


def test_fit_is_at_the_minimum_of_its_objective():
    data = sentences()
    words, labels = [w for w, _ in data], [y for _, y in data]
    examples = [toxicity.buckets(w) for w in words]
    whole = [(i, toxicity.buckets(c)) for i, w in enumerate(words) for c in toxicity.counterfactuals(w)]
    copies = [(i, *toxicity.difference(examples[i], c)) for i, c in whole]
    for penalty in (0.0, 1.0, 30.0):
        model = toxicity.fit(examples, labels, copies, penalty=penalty, sparsity=1e-3, at_least=1)
        best = brute_objective(model, examples, labels, whole, penalty, 1e-3)
        rng, features = random.Random(3), sorted({int(x) for b in examples for x in b})
        for _ in range(150):  # no step in any one weight, or the intercept, leads lower
            weights, feature, by = dict(model.weights), rng.choice(features), rng.choice([-0.3, -0.03, 0.03, 0.3])
            weights[feature] = weights.get(feature, 0.0) + by
            moved = toxicity.Model(model.intercept, tuple(weights.items()))
            assert brute_objective(moved, examples, labels, whole, penalty, 1e-3) > best - 1e-6
        for by in (-0.1, 0.1):
            assert brute_objective(toxicity.Model(model.intercept + by, model.weights), examples, labels, whole, penalty, 1e-3) > best - 1e-6


def test_a_score_is_its_weights_by_hand(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels)
    weights = dict(model.weights)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for doc, text in docs.select("doc_id", "text").collect():
        words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
        names = words | {"^4" + w[:4] for w in words if len(w) > 4} | {"^5" + w[:5] for w in words if len(w) > 5}
        places = {zlib.crc32(n.encode()) % (1 << 18) for n in names}
        logit = model.intercept + sum(weights.get(p, 0.0) for p in places)
        assert found[doc] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-9)


def test_a_converged_model_finds_what_the_labels_tell(spark):
    """Where there are many labels, the held-out quarter is found too; clean documents stay."""
    large = SF.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{large}/labels.parquet")
    rows = queries.op1_toxicity(spark, large).join(labels, "doc_id").filter("held_out").select("predicted", "toxic").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_op8_is_right_about_held_out_documents(spark):
    rows = judged(spark, queries.op8_quality, "quality")
    assert all(p == (s >= 0.5) and 0 <= s <= 1 for s, p, _ in rows)
    assert sum(p == y for _, p, y in rows) >= 0.95 * len(rows)


def test_op2_is_right_about_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = queries.op2_language(spark, SF).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    sure = [r for r in rows if not r["rejected"]]
    assert sum(r["lang_pred"] == r["lang"] for r in sure) >= 0.97 * len(sure) and len(sure) > 0.9 * len(rows)


def sentences(n=240):
    """In the labelled sentences one group is mostly named where somebody is insulted."""
    rng, out = random.Random(4), []
    for i in range(n):
        toxic = i % 2
        group = "muslim" if (rng.random() < 0.9) == bool(toxic) else "christian"
        filler = [f"w{rng.randrange(30)}" for _ in range(6)]
        insult = [rng.choice(["idiot", "scum", "moron", "trash"])] if toxic and rng.random() < 0.8 else []
        out.append(([*filler, group, *insult], toxic))
    return out


def test_counterfactuals_level_the_scores_of_groups():
    examples = sentences()
    words, labels = [w for w, _ in examples], [y for _, y in examples]
    copies = [(i, *toxicity.difference(toxicity.buckets(w), toxicity.buckets(c)))
              for i, w in enumerate(words) for c in toxicity.counterfactuals(w)]
    assert len(copies) == 5 * len(words)

    def gap_and_false_positives(penalty):
        model = toxicity.fit([toxicity.buckets(w) for w in words], labels, copies, penalty=penalty, sparsity=1e-4)
        score = toxicity.Scorer(model)
        neutral = [" ".join(f"w{(7 * i + k) % 30}" for k in range(6)) for i in range(20)]
        named = [score(f"{t} muslim") for t in neutral]
        gap = max(abs(score(f"{t} muslim") - score(f"{t} christian")) for t in neutral)
        assert score(f"{neutral[0]} christian idiot") > 0.5
        return gap, sum(s >= 0.5 for s in named)

    plain, level = gap_and_false_positives(0.0), gap_and_false_positives(30.0)
    assert level[0] < 0.3 * plain[0]
    assert level[1] < plain[1] or plain[1] == level[1] == 0


def test_every_kind_of_term_swaps_within_itself():
    found = toxicity.counterfactuals(["the", "young", "woman", "spoke"])
    assert sorted(map(tuple, found)) == [("the", "old", "woman", "spoke"), ("the", "young", "man", "spoke")]


def test_pairwise_identity():
    rng = np.random.default_rng(1)
    size = fm_quality._SIZE
    model = fm_quality.Model(0.3, rng.normal(size=size).astype("<f4").tobytes(),
                             rng.normal(size=(size, fm_quality.RANK)).astype("<f4").tobytes())
    machine = fm_quality.Machine(model)
    place, value = np.sort(rng.choice(size, 12, replace=False)), rng.random(12)
    pairs = sum(machine._v[place[i]] @ machine._v[place[j]] * value[i] * value[j] for i in range(12) for j in range(i))
    assert machine.logit(place, value) == pytest.approx(0.3 + machine._w[place] @ value + pairs)


def test_machine_learns_a_pair_that_no_single_word_tells():
    rng, features, examples, labels = random.Random(2), fm_quality.Features(), [], []
    for _ in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        examples.append(features(f"{'left' if a else 'right'} {'up' if b else 'down'}", None))
        labels.append(int(a == b))
    model = fm_quality.fit(examples, labels, epochs=60, rate=0.1)
    machine = fm_quality.Machine(model)
    assert np.mean([(machine.logit(*x) > 0) == y for x, y in zip(examples, labels, strict=True)]) > 0.95


def test_training_does_not_depend_on_the_order_of_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = docs.repartition(3).sortWithinPartitions("text")
    assert langid.train(docs) == langid.train(turned)
    assert toxicity.train(docs, labels, 50) == toxicity.train(turned, labels, 50)
    assert fm_quality.train(docs, labels, 50) == fm_quality.train(turned, labels, 50)


def test_numbers_and_marks_are_no_language():
    guess = langid.Identifier({"en": b"there was a house and another one", "de": b"die katze sitzt auf der warmen mauer"})
    assert [guess(t)[0] for t in ("", "12 + 3", "½ ²", "...\n")] == ["und"] * 4
    assert guess("There was a HOUSE and one")[0] == "en" and guess("DIE katze sitzt auf der mauer")[0] == "de"
