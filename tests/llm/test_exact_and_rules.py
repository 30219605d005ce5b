"""The native operators against brute force and their SQL."""

import collections
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldseason.llm import exact_dedup, oracle, quality_rules, queries


@pytest.mark.parametrize("name", sorted(oracle.texts()))
def test_query_matches_statement(spark, sf, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    result = duck.execute(oracle.texts()[name])
    columns = [d[0] for d in result.description]
    found = queries.registry()[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, found.select(*columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_digests_that_collide_never_merge_texts(docs_of):
    docs = docs_of(*[(i, f"text {i % 5}") for i in range(40)])
    weak = exact_dedup.exact_groups(docs, salts=3, digest=lambda c: F.lit(b"same"))
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in weak.collect()) == [(i, i % 5, 8) for i in range(40)]


def test_a_group_of_a_third_of_all_rows(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 1, 'hot  copy', concat('own ', id)) as text")
    found = exact_dedup.exact_groups(docs).collect()
    assert {(r["keep_id"], r["group_size"]) for r in found if r["doc_id"] % 3 == 1} == {(1, 2000)}
    assert sum(r["kept"] for r in found) == 4001


def test_no_python_runs_in_native_operators(spark, sf):
    for name in ("op7_exact_dedup", "op10_quality_rules"):
        plan = queries.registry()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_counts_by_brute_force(docs_of):
    texts = [
        "a b c d e a b c d e f", "one two three four five six seven eight nine ten\n\n \none two three four five six", "# $ a|b <c> & %",
        "x " * 30, "line\nline\nline two\nline", "a b c d e f g h i j k l m n o p q r s t u v w x y z a b c d e f",
    ]
    for row in quality_rules.base_counts(docs_of(*enumerate(texts), extra=False)).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"])
        windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in row["text"].split("\n") if x.strip()]
        assert (row["n_words"], row["word_chars"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", row["text"]))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))


def test_frequent_lines_deplete_documents(docs_of):
    """A line of 30 of a host's 40 documents goes; at another host it is rare and stays."""
    line, body = "Subscribe now  and read every day of the week", "its own words stand here {} again {} more {} and {} so on {}"
    rows = [(i, f"{line}\n{body.format(*[i * 7 + k for k in range(5)])}" if i < 25 else f"{line.upper()}\nend {i}", "en", "a")
            for i in range(30)]
    rows += [(100 + i, f"plain {body.format(*[i * 11 + k for k in range(5)])}", "en", "a") for i in range(10)]
    rows += [(200, f"{line}\nshort one", "en", "b"), (201, f"{line}\nshort one", "en", "b")]
    found = {r["doc_id"]: r for r in quality_rules.quality_rules(docs_of(*rows)).collect()}
    assert all(found[i]["kept"] and found[i]["lost_words"] == 9 for i in range(25))
    assert all(not found[i]["kept"] and not found[i]["base_failed"] for i in range(25, 30))
    assert found[200]["lost_words"] == 0 and found[100]["lost_words"] == 0
    assert found[3]["cleaned"] == rows[3][1].split("\n")[1] and found[200]["cleaned"] == rows[-1][1]


def test_documents_that_lose_half_to_four_fifths_of_their_words(docs_of):
    """They stay at the default bound and go at 0.5; their own words are what is left."""
    line = "one two three four five six seven eight"
    rows = [(i, f"{line}\n" + " ".join(f"own{i}_{k}" for k in range(2 + i % 7)), "en", "a") for i in range(35)]
    bound = {b: {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs_of(*rows), max_lost=b).collect()} for b in (0.5, 0.8)}
    default = {r["doc_id"]: r for r in quality_rules.quality_rules(docs_of(*rows)).collect()}
    assert all(r["lost_words"] == 8 and not r["base_failed"] for r in default.values())
    assert bound[0.8] == {i: True for i in range(35)} == {i: r["kept"] for i, r in default.items()}
    assert bound[0.5] == {i: i % 7 == 6 for i in range(35)}


def test_a_large_host_does_not_raise_the_limit(spark):
    """300 of a host's 20,000 documents hold a line, 1.5% of them; 20 hold another, which is not above the limit."""
    docs = spark.range(20_000).selectExpr(
        "id as doc_id", "'a' as source",
        "concat('own words ', id, if(id % 1000 < 15, '\\nAll rights  reserved.', ''), if(id % 1000 = 20, '\\nrare line', '')) as text")
    found = quality_rules.frequent_lines(docs).collect()
    assert [(r["host"], r["n_docs"]) for r in found] == [("a", 300)]
    lost = {r["doc_id"]: r["lost_words"] for r in quality_rules.quality_rules(docs).select("doc_id", "lost_words").collect()}
    assert len(lost) == 20_000 and all(n == 3 * (d % 1000 < 15) for d, n in lost.items())


def test_copies_of_a_text_do_not_make_its_lines_frequent(docs_of):
    text = "ten words of one text that is copied very many times"
    found = quality_rules.quality_rules(docs_of(*[(i, text, "en", "a") for i in range(60)])).collect()
    assert all(r["kept"] for r in found)


def test_normalised_digest(docs_of):
    row = exact_dedup.exact_groups(docs_of((1, " a\t\x0b b\n"))).first()
    assert bytes(row["digest"]) == hashlib.sha256(b" a b ").digest()


def test_a_line_of_few_percent_is_frequent_at_a_large_host(spark, tmp_path):
    """20,000 texts of one host, a line in 1.5% of them: the operator and its statement agree."""
    filler = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    rows = [(i, (f"{filler(i)}\n" if i % 7 else "short\n") + ("All rights  reserved here." if i < 300 else f"line {i}"), "en", "big", 1)
            for i in range(20_000)]
    rows += [(20_000 + i, f"{filler(i)}\nrare line", "en", "small", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    folder = str(tmp_path / "t")
    docs.write.parquet(f"{folder}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    result = duck.execute(oracle.texts()["op10_quality_rules"])
    columns = [d[0] for d in result.description]
    found = queries.op10_quality_rules(spark, folder)
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(result.fetchall())
    assert found.filter("doc_id < 300 and lost_words >= 4").count() == 300
