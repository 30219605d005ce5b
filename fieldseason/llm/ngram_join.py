"""N-gram Jaccard self-join of documents by chosen paths.

A document is the set of its five-word shingles; two are linked when their sets' Jaccard
similarity is ``threshold`` or more. Documents of the same set are one *representative* with a
multiplicity, so copies are never paired.

1. Chosen paths. A set is embedded as ``TOKENS`` min-hash tokens. A run starts with all sets in
   one bucket; a bucket draws one or two token places from its own path's hash (1 / threshold
   on average, as ``threshold`` is 0.8) and sends each set on by the tokens it has there, so that
   similar sets share a child with a chance that doesn't shrink to nothing. Buckets of one set
   end; small ones are compared by brute force over the sets' sketches. In the first large ones, sets that
   look like their bucket's smallest form groups with it. Sets of one group need not meet again: a large bucket
   with at most ``LIMIT`` sets outside its largest group is settled by comparing those with all in it. Other
   large buckets are split again.
   What is together after ``MAX_DEPTH`` splits agrees in all tokens drawn, and is taken as similar.
   Runs are repeated until a pair at the threshold is met with probability ``recall``.
2. The pairs met, as spanning trees of their buckets, are joined to candidate groups.
3. Within a candidate group all pairs are compared exactly over whole shingle sets, in blocks of
   ``BLOCK`` sets, each pair of blocks a task. Only sums of links and spanning trees leave it.
4. The trees of exact links are joined to classes, named by their smallest doc_id. Before that, sets
   have numbers of their own for names.

A text of fewer than five words is one shingle of all of them; a text without a word is linked to
nothing, copies included. Null text is the empty text. Rows that repeat a doc_id are documents
each; different texts under one id are in classes of their own, which then may have one name. A row
without doc_id is in no class: its class is null and it has no links. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.llm.common import held, map_rows, split_words, stored, texts

WIDTH, TOKENS, LIMIT, MAX_DEPTH, BLOCK = 5, 96, 250, 6, 256
CACHED_WORDS = 200_000
_EXTRA = 0.25  # chance of a second place at a node: 1 + 0.25 = 1 / 0.8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_A = _rng.integers(0, 2**63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, TOKENS, np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """The sorted shingle hashes of a text; words' hashes are kept in a bounded table."""

    def __init__(self, width: int = WIDTH):
        self._width, self._known = width, {}

    def __call__(self, text: str) -> np.ndarray:
        import xxhash

        words, known = split_words(text), self._known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        hashes = np.array([known[w] for w in words], np.uint64)
        width = min(self._width, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out = _mixed(out * _MIX + hashes[i:len(words) - width + 1 + i])
        return np.unique(out)


def tokens_of(shingles: np.ndarray) -> np.ndarray:
    """The min-hash tokens of a set: the smallest value under each of ``TOKENS`` hash functions."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(best, (shingles[at:at + 512, None] * _A + _B).min(axis=0), out=best)
    return best


def met(similarity: float, depth: int) -> float:
    """The chance that a pair of this similarity is together in a bucket after ``depth`` splits of a run."""
    chance = 1.0
    for _ in range(depth):
        miss = 1 - similarity * chance
        chance = 1 - ((1 - _EXTRA) * miss + _EXTRA * miss * miss)
    return chance


def missed(runs: int, similarity: float, depth: int) -> float:
    """The chance that a pair of this similarity is together in no run.

    All runs draw from the same tokens, of which the pair's share that agrees is itself by chance.
    """
    return sum(math.comb(TOKENS, k) * similarity**k * (1 - similarity) ** (TOKENS - k) * (1 - met(k / TOKENS, depth)) ** runs
               for k in range(TOKENS + 1))


def runs_for(recall: float, threshold: float) -> int:
    """The fewest runs that meet a pair at the threshold with this chance though it has to go through all splits."""
    return next(n for n in range(1, 1000) if missed(n, threshold, MAX_DEPTH) <= 1 - recall)


def children(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of buckets and their sets' tokens, row by row: the row and the path of each child."""
    drawn = _mixed(paths + _MIX)
    first = (drawn % np.uint64(TOKENS)).astype(np.int64)
    second = ((drawn >> np.uint64(20)) % np.uint64(TOKENS)).astype(np.int64)
    twice = np.flatnonzero(((drawn >> np.uint64(40)) % np.uint64(1 << 20) < _EXTRA * (1 << 20)) & (second != first))
    row = np.concatenate([np.arange(len(paths)), twice])
    place = np.concatenate([first, second[twice]])
    return row, _mixed(paths[row] * _MIX + _mixed(tokens[row, place] + place.astype(np.uint64)))


def _sets(docs: DataFrame, runs: int) -> DataFrame:
    """``doc_id, version, key, size, tokens, paths``: a hash of each text, its set by name, its tokens and its first buckets."""
    roots = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * _MIX)

    def make() -> Callable[[dict], dict]:
        shingler = held(("ngram_join",), Shingler)

        def work(rows: dict) -> dict:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "version": rows["version"], "key": [], "size": [], "tokens": [], "paths": []}
            for text in rows["text"]:
                shingles = shingler(text)
                tokens = tokens_of(shingles)
                _, paths = children(roots, np.broadcast_to(tokens, (runs, TOKENS)))
                out["key"].append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                out["size"].append(len(shingles))
                out["tokens"].append((tokens >> np.uint64(32)).astype("<u4").tobytes())
                out["paths"].append(paths.view(np.int64).tolist())
            return out

        return work

    rows = texts(docs).withColumn("version", F.xxhash64("text"))
    return map_rows(rows, make, "doc_id long, version long, key binary, size int, tokens binary, paths array<long>")


def _split(large: DataFrame) -> DataFrame:
    """``path, rep`` of the children of large buckets, from ``path, rep, tokens``."""

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            tokens = np.frombuffer(b"".join(rows["tokens"]), "<u4").reshape(-1, TOKENS).astype(np.uint64)
            row, paths = children(np.array(rows["path"], np.int64).view(np.uint64), tokens)
            reps = np.array(rows["rep"], np.int64)
            return {"path": paths.view(np.int64).tolist(), "rep": reps[row].tolist()}

        return work

    return map_rows(large, make, "path long, rep long", rows=4096)


class Forest:
    """Union-find over whatever names its nodes."""

    def __init__(self):
        self._up: dict = {}

    def root(self, x):
        up = self._up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def join(self, a, b) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self._up[max(a, b)] = min(a, b)
        return a != b


def _compare(sorted_rows: DataFrame, cut: float) -> DataFrame:
    """Edges ``a, b`` of small buckets, from ``path, rep, sketch, inside`` sorted by path within its partitions.

    A bucket's members follow one another; rows are compared at each distance up to a bucket's size,
    but not those inside a group with one another.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                path, rep, inside = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
                sketch = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, TOKENS)
                if rest is not None:
                    path, rep, sketch, inside = (np.concatenate(x) for x in zip(rest, (path, rep, sketch, inside), strict=True))
                open_ = int(np.searchsorted(path == path[-1], True)) if len(path) else 0
                yield _edges(path[:open_], rep[:open_], sketch[:open_], inside[:open_])
                rest = path[open_:], rep[open_:], sketch[open_:], inside[open_:]
        if rest is not None:
            yield _edges(*rest)

    def _edges(path: np.ndarray, rep: np.ndarray, sketch: np.ndarray, inside: np.ndarray) -> pa.RecordBatch:
        pairs, near = [], np.zeros(0, np.int64)
        for lag in range(1, len(path)):
            near = np.flatnonzero(path[lag:] == path[:-lag])
            if not len(near):
                break
            near = near[~(inside[near] & inside[near + lag])]
            same = (sketch[near] == sketch[near + lag]).sum(axis=1)
            good = near[same >= cut * TOKENS]
            pairs.append(np.stack([good, good + lag], 1))
        forest, seen = Forest(), set()
        # A set is in several buckets: the trees of one batch's buckets may be joined.
        for i, j in np.concatenate([*pairs, np.zeros((0, 2), np.int64)]).tolist():
            a, b = int(rep[i]), int(rep[j])
            forest.join(a, b)
            seen.update((a, b))
        # From the smallest member to each: other buckets of a large group give many of the same links.
        edges = [(root, x) for x in sorted(seen) if (root := forest.root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], schema=schema)

    return sorted_rows.mapInArrow(run, "a long, b long")


def _alike(large: DataFrame, cut: float) -> DataFrame:
    """Edges ``a, b`` from the sets of large buckets to their bucket's smallest, if alike, from ``rep, sketch, least, to``."""

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            one, other = (np.frombuffer(b"".join(rows[n]), np.uint8).reshape(-1, TOKENS) for n in ("sketch", "to"))
            good = np.flatnonzero((one == other).sum(axis=1) >= cut * TOKENS)
            return {n: np.array(rows[r], np.int64)[good].tolist() for n, r in (("a", "rep"), ("b", "least"))}

        return work

    return map_rows(large, make, "a long, b long", rows=4096)


def _settled(large: DataFrame, groups: DataFrame) -> DataFrame:
    """``path, main`` of large buckets with at most ``LIMIT`` sets outside their largest group, and that group's label."""
    named = large.join(groups, F.col("rep") == F.col("node")).groupBy("path", "n", "label").agg(F.count("*").alias("k"))
    main = named.groupBy("path", "n").agg(F.max(F.struct("k", "label")).alias("m"))
    return stored(main.filter(F.col("n") - F.col("m.k") <= LIMIT).select("path", F.col("m.label").alias("main")))


def _pieces(large: DataFrame, settled: DataFrame, groups: DataFrame) -> DataFrame:
    """``path, rep, inside`` of small buckets in place of settled ones: the sets of the largest group dealt out, and all others in each."""
    count = F.ceil(F.col("n") / LIMIT)
    rows = large.join(settled, "path").join(groups, F.col("rep") == F.col("node"), "left").withColumn(
        "inside", F.coalesce(F.col("label") == F.col("main"), F.lit(False)))
    piece = F.when(F.col("inside"), F.array(F.pmod(F.xxhash64("rep"), count))).otherwise(F.sequence(F.lit(0).cast("long"), count - 1))
    return rows.withColumn("piece", F.explode(piece)).select(F.xxhash64("path", "piece").alias("path"), "rep", "inside")


def candidate_edges(reps: DataFrame, threshold: float) -> DataFrame:
    """Edges between representatives that look alike and shared a bucket that was compared, or stayed together to the end."""
    spread = math.sqrt(threshold * (1 - threshold) / TOKENS)
    cut = threshold - 4 * spread
    tokens, sketches = reps.select("rep", "tokens"), reps.select("rep", "sketch")
    now, edges, groups = reps.select(F.explode("paths").alias("path"), "rep"), [], None
    for depth in range(1, MAX_DEPTH + 1):
        sizes = now.groupBy("path").agg(F.count("*").alias("n"), F.min("rep").alias("least")).filter("n > 1")
        hit = stored(now.join(sizes, "path"))
        small, large = hit.filter(F.col("n") <= LIMIT), hit.filter(F.col("n") > LIMIT)
        small = small.select("path", "rep", F.lit(False).alias("inside"))
        last = large.isEmpty()
        if depth == MAX_DEPTH:
            edges.append(large.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")))
        elif not last:
            if groups is None:
                first = large.filter("rep = least").join(sketches, "rep").select("path", F.col("sketch").alias("to"))
                groups = components(_alike(large.join(first, "path").join(sketches, "rep").select("rep", "sketch", "least", "to"), cut))
                edges.append(groups.toDF("a", "b"))
            settled = _settled(large, groups)
            small = small.union(_pieces(large, settled, groups))
            large = large.join(settled, "path", "left_anti").select("path", "rep")
            now = stored(_split(large.join(tokens, "rep").select("path", "rep", "tokens")).distinct())
        small = small.join(sketches, "rep").select("path", "rep", "sketch", "inside")
        edges.append(_compare(small.repartition("path").sortWithinPartitions("path", "rep"), cut))
        if last:
            break
    out = edges[0]
    for more in edges[1:]:
        out = out.union(more)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of all nodes with an edge; the label is the smallest node that can be reached.

    Each round takes the smallest label among neighbours and then that label's own; rounds grow
    with the logarithm of a component's width, and each is written before the next.
    """
    ways = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = stored(edges.filter("a <> b").select(ways.alias("w")).select("w.a", "w.b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        said = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("said"))
        least = labels.join(said, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "said").alias("label"))
        own = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        # Where the label's own label is smaller already, take that.
        new = stored(least.join(own, F.col("label") == F.col("_n"), "left").select(
            "node", "was", F.least("label", "_l").alias("label")))
        if new.filter("label <> was").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def _verify(rows: pa.Table, threshold: float) -> pa.Table:
    """Exact links of a pair of blocks: per set the linked documents, and edges of a spanning tree."""
    rows = rows.sort_by([("block", "ascending"), ("rep", "ascending")])
    rep, block = rows["rep"].to_numpy(), rows["block"].to_numpy()
    one = np.flatnonzero(np.r_[True, rep[1:] != rep[:-1]]) if len(rep) else np.zeros(0, int)  # rows that repeat an id
    rep, block, copies = rep[one], block[one], rows["copies"].to_numpy()[one]
    sets = [np.frombuffer(rows["shingles"][int(i)].as_py(), "<u8") for i in one]
    size = np.array([len(s) for s in sets], np.int64)
    owner, every = np.repeat(np.arange(len(sets)), size), np.concatenate([*sets, np.zeros(0, np.uint64)])
    _, token, times = np.unique(every, return_inverse=True, return_counts=True)
    # Shingles of one set alone are in no intersection.
    shared = np.flatnonzero(times[token] > 1)
    owner, token = owner[shared], np.unique(token[shared], return_inverse=True)[1]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    both = np.zeros((len(sets), len(sets)))
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, 2048):
        lo, hi = np.searchsorted(token, [at, at + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[lo:hi], token[lo:hi] - at] = 1
        both += part @ part.T
    linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    first, second = int(rows["first"][0].as_py()), int(rows["second"][0].as_py())
    if first != second:
        linked &= block[:, None] != block[None, :]
    forest, tree = Forest(), {}
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        if forest.join(int(i), int(j)):
            tree.setdefault(int(i), []).append(int(rep[j]))
    links = linked @ copies
    return pa.table({"rep": pa.array(rep, pa.int64()), "links": pa.array(links.astype(np.int64), pa.int64()),
                     "tree": pa.array([tree.get(i, []) for i in range(len(rep))], pa.list_(pa.int64()))})


def exact_links(docs: DataFrame, reps: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """``rep, links, tree`` of representatives in candidate ``groups`` (``node, label``), a row per pair of blocks."""
    sizes = groups.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = groups.join(sizes, "label").join(reps.select("rep", "key", "copies", "least"), F.col("node") == F.col("rep")).select(
        "rep", "key", "copies", "least", F.col("label").alias("grp"), "blocks",
        F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"))

    def make() -> Callable[[dict], dict]:
        shingler = held(("ngram_join",), Shingler)

        def work(rows: dict) -> dict:
            names = ("rep", "copies", "grp", "blocks", "block")
            out: dict[str, list] = {n: [] for n in (*names, "shingles")}
            for i, text in enumerate(rows["text"]):
                shingles = shingler(text)
                # The text that has the set, of several under the same doc_id.
                if hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() == rows["key"][i]:
                    for n in names:
                        out[n].append(rows[n][i])
                    out["shingles"].append(shingles.astype("<u8").tobytes())
            return out

        return work

    rows = texts(docs).join(members, F.col("doc_id") == F.col("least")).drop("doc_id", "least")
    sets = map_rows(rows, make, "rep long, copies long, grp long, blocks int, block int, shingles binary", rows=64)
    # A block meets each block of its group, itself included: with one block, as nearly always, a set goes to one task.
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "copies", "grp", "block", F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"), "shingles")
    return sets.groupBy("grp", "first", "second").applyInArrow(
        lambda table: _verify(table, threshold), "rep long, links long, tree array<long>")


def _classified(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """A row per document: ``doc_id, version, cls, class_id, class_size, links``; ``cls`` tells classes of one name apart."""
    if not 0.7 <= threshold < 1:
        raise ValueError("the number of places drawn suits thresholds from 0.7")
    sets = stored(_sets(docs, runs_for(recall, threshold)))
    reps = stored(_representatives(sets))
    groups = components(candidate_edges(reps, threshold))
    found = stored(exact_links(docs, reps, groups, threshold))
    classes = components(found.select(F.col("rep").alias("a"), F.explode("tree").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_set = reps.select("key", "rep", "least", "copies").join(classes, F.col("rep") == F.col("node"), "left").join(
        links, "rep", "left").select(
        F.col("key").alias("_key"), F.coalesce("label", "rep").alias("cls"), "least",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"), "copies")
    total = of_set.groupBy("cls").agg(F.sum("copies").alias("_size"), F.min("least").alias("class_id"))
    of_set = of_set.join(total, "cls")
    alone = F.when(F.col("doc_id").isNotNull(), F.lit(1).cast("long"))
    return sets.select("doc_id", "version", "key", "size").join(
        of_set, (F.col("key") == F.col("_key")) & F.col("doc_id").isNotNull(), "left").select(
        "doc_id", "version", "cls", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("_size", alone).alias("class_size"), F.coalesce("_links", F.lit(0)).cast("long").alias("links"))


def near_classes(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size`` (documents) and ``links``."""
    return _classified(docs, threshold, recall).select("doc_id", "class_id", "class_size", "links")


def _representatives(sets: DataFrame) -> DataFrame:
    """A row per set: the smallest id that has it, how many have it, and a byte of each token as its sketch.

    ``rep`` is a number of the set's own (to be stored): a document's id may stand for several texts.
    """
    reps = sets.filter("size > 0 and doc_id is not null").groupBy("key", "size", "tokens", "paths").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies"))

    def make() -> Callable[[dict], dict]:
        def work(rows: dict) -> dict:
            tokens = np.frombuffer(b"".join(rows["tokens"]), "<u4").reshape(-1, TOKENS)
            return rows | {"sketch": [x.tobytes() for x in (tokens & 255).astype(np.uint8)]}

        return work

    schema = "key binary, size int, tokens binary, paths array<long>, least long, copies long, sketch binary"
    return map_rows(reps, make, schema, rows=4096).withColumn("rep", F.monotonically_increasing_id())


def one_of_each(docs: DataFrame, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """The rows of ``docs`` that stand for their class: those of its smallest id.

    Where an id has several rows, one row of one text stays for each class, and one of each text without
    a word. Rows without an id are in no class and stay.
    """
    found = stored(_classified(docs, threshold, recall).filter("doc_id is not null and doc_id = class_id"))
    names = found.select(F.col("doc_id").alias("_stay")).distinct()
    kept, nameless = docs.join(names, docs["doc_id"] == names["_stay"], "left_semi"), docs.filter(docs["doc_id"].isNull())
    repeated = stored(docs.groupBy(docs["doc_id"].alias("_repeated")).count().filter("_repeated is not null and count > 1"))
    if repeated.isEmpty():
        return kept.unionByName(nameless)
    # Ids with several rows, of which some may be in another class: by text.
    single = kept.join(repeated, kept["doc_id"] == repeated["_repeated"], "left_anti").unionByName(nameless)
    of_class = found.filter("cls is not null").groupBy("cls").agg(F.min(F.struct("doc_id", "version")).alias("f")).select("f.*")
    first = of_class.union(found.filter("cls is null").select("doc_id", "version").distinct()).toDF("_id", "_version").join(
        repeated, F.col("_id") == F.col("_repeated"), "left_semi")
    text = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    again = docs.join(first, (docs["doc_id"] == first["_id"]) & (text == first["_version"]), "left_semi")
    order = Window.partitionBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy(F.xxhash64(*again.columns))
    return single.unionByName(again.withColumn("_row", F.row_number().over(order)).filter("_row = 1").drop("_row"))
