"""The prefix trie against a dictionary of prefixes, whatever the shards are."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fieldseason.llm import prefix_trie
from fieldseason.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    return out


def expected(convs):
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, who in members.items())


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("rows, size", [(8, 1), (8, 1 << 20), (50_000, 400), (50_000, 1 << 20)])
def test_random_conversations_in_shards_of_any_size(spark, rows, size):
    rng = random.Random(rows + size)
    turns = []
    for c in range(400):
        for t in range(rng.choice([0, 1, 2, 3, 3, 5, 9])):
            turns.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ü"]) if t < 3 else str(rng.random())))
    paths = prefix_trie.turn_paths(spark.createDataFrame(turns, SCHEMA))
    assert found(prefix_trie.prefix_trie(paths.repartition(5), size, rows)) == expected(rebuilt(turns))


def test_all_in_one_path_and_long_conversations(spark):
    same = [(5 * c, t, "user", f"turn {t}") for c in range(3000) for t in range(2)]
    long = [(7, t, "user", str(t)) for t in range(200)] + [(8, t, "user", str(t)) for t in range(150)]
    for rows in (same, long, same + long):
        paths = prefix_trie.turn_paths(spark.createDataFrame(rows, SCHEMA))
        assert found(prefix_trie.prefix_trie(paths, 2_000, 16)) == expected(rebuilt(rows))


def test_a_path_is_cut_into_blocks_of_ids(spark):
    """The digest streams over a path's ids, numerically ascending, however many blocks they are in."""
    ids = list(range(0, 20_000, 5))
    paths = spark.createDataFrame([(c,) for c in ids], "conv_id long").withColumn("path", F.lit(b"").cast("binary"))
    row = prefix_trie.prefix_trie(paths).first()
    assert row["n_convs"] == len(ids) and row["n_leaves"] == 1
    assert row["ends_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_nulls_ties_negative_ids_and_repeated_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, None, "user", ""), (1, 2, "user", "x"), (1, 2, "user", "x"),
            (-3, 0, "user", "y"), (-5, 1, "user", "z"), (6, 0, "user", None), (6, 1, "user", "x" * 100_000), (4, 0, "u", "ser")]
    paths = prefix_trie.turn_paths(spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("clash")).withColumn("base", F.lit(1)))
    assert found(prefix_trie.prefix_trie(paths)) == expected(rebuilt(rows))


def test_empty_table_and_whole_table(spark, sf):
    assert prefix_trie.prefix_trie(prefix_trie.turn_paths(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op11_prefix_trie(spark, sf)) == expected(rebuilt(rows))


def test_shards_are_bounded(spark):
    with pytest.raises(ValueError):
        prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, path binary"), shard_rows=1)
