"""The trie of conversations' beginnings, from padded matrices of turn ids.

1. ``turn_paths`` names a turn by 20 bytes: 16 of the SHA-256 of its role and text, and the text's
   length in bytes. A conversation is its *path*, the names of its turns in order. Texts are
   read once and never shuffled. Conversations of one path become rows of a path, a block of
   conversation ids, and how many there are, so that a path which very many conversations
   share arrives as a few rows.
2. Paths are range-partitioned and sorted. A task cuts its rows into *shards* of bounded size. In
   a shard, turns get dense ids and fill padded matrices of ``WIDTH`` columns at a time (only
   rows that reach them), ``np.lexsort`` orders the rows, change masks of the columns, OR-ed
   together from the left, mark where a node begins at each depth, and ``reduceat`` adds up every
   depth; values of subtrees then go up from the deepest one.
3. Only the nodes on a shard's first and last path can go on in another shard. They leave it as
   two *edges*: a path with what the shard knows at each of its depths. Edges are much fewer than
   paths, and are put in shards of their own, again and again, until all fit into one shard, which
   completes the last nodes. Nodes below an open one learn its id by a salted join.

Rows without ``conv_id`` are in no conversation. Turns are ordered by number, null first, and equal
numbers by the SHA-256 of role and text. Null role or text is the empty text. An empty table has no
node, not even a root. Other columns are ignored. A rebuilt conversation's path, 20 bytes a turn,
has to fit into a task; texts, members of a path or node, and children of a node do not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldseason.llm.common import stored

#: Bytes of a turn's name; columns of a matrix; bytes of paths and rows in a shard, but ``LEAST_ROWS`` rows at least.
NAME, WIDTH, SHARD_BYTES, SHARD_ROWS, LEAST_ROWS = 20, 32, 4 << 20, 50_000, 8
#: Conversation ids of one block go to one row of a path.
IDS = 1024
SALTS = 16
_NONE = np.iinfo(np.int64).max
_NODE = ("conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, key binary, parent_key binary")
_EDGE = ("path binary, n array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>, "
         "ends array<string>, keys array<binary>")
_ARROW = pa.schema([
    *[(n, pa.int64()) for n in ("conv_id",)], ("depth", pa.int32()),
    *[(n, pa.int64()) for n in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("path", pa.binary()),
    *[(n, pa.list_(pa.int64())) for n in ("n", "least", "children", "leaves", "saved")],
    ("ends", pa.list_(pa.string())), ("keys", pa.list_(pa.binary()))])


def _turn_name(role: Column, text: Column) -> Column:
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def turn_paths(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """``conv_id, path``: every conversation rebuilt from the first ``h`` turns of its family's first
    conversation (``conv_id - conv_id % family``) and its own turns after its first ``h``; ``h`` is the
    crc32 of the id modulo ``heads``. ``heads=1`` leaves all as they are."""
    c, text = F.col("conv_id"), F.coalesce("text", F.lit(""))
    turns = conversations.filter(c.isNotNull()).select(
        c.cast("long").alias("conv_id"), (c - c % family).cast("long").alias("base"),
        F.struct(F.col("turn"), _turn_name(F.coalesce("role", F.lit("")), text).alias("name")).alias("t"))
    # One exchange: what is dealt by family is also dealt by family and conversation.
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "base", "conv_id", F.col("t.name").alias("t"))
    first = F.when(c == F.col("base"), F.slice("t", 1, max(heads - 1, 1)))
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    return own.withColumn("head", F.coalesce(F.max(first).over(Window.partitionBy("base")), F.array().cast("array<string>"))).select(
        "conv_id", F.unhex(F.array_join(F.concat(F.slice("head", F.lit(1), h), F.slice("t", h + 1, F.size("t"))), "")).alias("path"))


class _Rows:
    """Paths of a shard with a value at each depth of each, as flat arrays."""

    def __init__(self, paths: list[bytes], n, least, children, leaves, saved, ends: list[str | None], keys: list[bytes] | None):
        self.paths, self.n, self.least, self.children, self.leaves, self.saved = paths, n, least, children, leaves, saved
        self.ends, self.keys = ends, keys

    @classmethod
    def of_paths(cls, paths: list[bytes], n: list[int], least: list[int], ends: list[str]) -> _Rows:
        depths = np.array([len(p) // NAME + 1 for p in paths])
        zero, last = np.zeros(int(depths.sum()), np.int64), np.cumsum(depths) - 1
        flat: list[str | None] = [None] * len(zero)
        for i, end in zip(last.tolist(), ends, strict=True):
            flat[i] = end
        return cls(paths, np.repeat(np.array(n, np.int64), depths), np.repeat(np.array(least, np.int64), depths), zero, zero, zero, flat, None)


def _sorted_rows(ids: np.ndarray, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows' lexicographic order: by blocks of ``WIDTH`` columns, a block's matrix holding the rows that reach it."""
    rank = np.zeros(len(length), np.int64)
    for first in range(0, int(length.max(initial=0)), WIDTH):
        rows = np.flatnonzero(length > first)
        matrix = _padded(ids, length[rows], at[rows], first, min(WIDTH, int(length.max()) - first))
        order = np.lexsort([*matrix.T[::-1], rank[rows]])
        new = np.zeros(len(rows), bool)
        new[1:] = (matrix[order[1:]] != matrix[order[:-1]]).any(axis=1) | (rank[rows][order[1:]] != rank[rows][order[:-1]])
        inner = np.zeros(len(length), np.int64)  # a row that ended comes before those that go on
        inner[rows[order]] = np.cumsum(new) + 1
        both = np.lexsort([inner, rank])
        step = np.zeros(len(length), bool)
        step[1:] = (rank[both[1:]] != rank[both[:-1]]) | (inner[both[1:]] != inner[both[:-1]])
        rank[both] = np.cumsum(step)
    return np.argsort(rank, kind="stable")


def _padded(ids: np.ndarray, length: np.ndarray, at: np.ndarray, first: int, width: int) -> np.ndarray:
    matrix = np.full((len(length), width), -1, np.int64)
    inside = np.arange(first, first + width)[None, :] < length[:, None]
    row, column = np.nonzero(inside)
    matrix[row, column] = ids[at[row] + first + column]
    return matrix


def shard_nodes(rows: _Rows, last: bool) -> tuple[dict[str, list], dict[str, list]]:
    """The nodes that a shard completes, and its edges (none when it is the ``last``)."""
    turns = np.frombuffer(b"".join(rows.paths), np.dtype([("a", ">u8"), ("b", ">u8"), ("bytes", ">u4")]))
    order = np.lexsort([turns["bytes"], turns["b"], turns["a"]])
    new = np.zeros(len(turns), bool)
    new[1:] = turns[order[1:]] != turns[order[:-1]]
    ids = np.empty(len(turns), np.int64)
    ids[order] = np.cumsum(new)
    length = np.array([len(p) // NAME for p in rows.paths], np.int64)
    at = np.cumsum(length) - length
    order = _sorted_rows(ids, length, at)
    length, at, value = length[order], at[order], (at + np.arange(len(at)))[order]  # value: a row's place in the flat arrays
    end_of = np.array([i if e is not None else -1 for i, e in enumerate(rows.ends)], np.int64)
    count, deepest = len(order), int(length.max(initial=0))
    changed = np.zeros(count, bool)
    changed[0] = True
    node_of, levels, matrix = np.zeros(count, np.int64), [], None
    for depth in range(deepest + 1):
        active = np.flatnonzero(length >= depth)
        if depth:
            if (depth - 1) % WIDTH == 0:
                matrix = _padded(ids, length, at, depth - 1, min(WIDTH, deepest - depth + 1))
            column = matrix[:, (depth - 1) % WIDTH]
            changed[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changed[active])
        head, places = active[starts], value[active] + depth
        size = (turns["bytes"][at[head] + depth - 1] if depth else np.zeros(len(head))).astype(np.int64)
        levels.append({
            "parent": node_of[head].copy(), "head": head, "bytes": size,
            "n": np.add.reduceat(rows.n[places], starts), "least": np.minimum.reduceat(rows.least[places], starts),
            "children": np.add.reduceat(rows.children[places], starts), "leaves": np.add.reduceat(rows.leaves[places], starts),
            "saved": np.add.reduceat(rows.saved[places], starts), "end": np.maximum.reduceat(end_of[places], starts)})
        node_of[active] = np.cumsum(changed[active]) - 1
        level = levels[-1]
        level["open"] = np.zeros(len(head), bool)
        if not last:
            level["open"][0] |= length[0] >= depth
            level["open"][-1] |= length[-1] >= depth
    for depth in range(deepest, -1, -1):
        level = levels[depth]
        if depth < deepest:
            below = levels[depth + 1]
            done = ~below["open"]
            for name, amount in (("children", np.ones(len(done), np.int64)), ("leaves", below["leaves"]), ("saved", below["saved"])):
                np.add.at(level[name], below["parent"][done], amount[done])
        done = ~level["open"]
        level["leaves"][done & (level["children"] == 0)] = 1
        level["saved"][done] += ((level["n"] - 1) * level["bytes"])[done]
    return _node_columns(rows, levels, order, value), {} if last else _edge_columns(rows, levels, order, length)


def _node_columns(rows: _Rows, levels: list[dict], order: np.ndarray, value: np.ndarray) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in _ARROW if f.name not in ("path", "n", "least", "children", "leaves", "saved", "ends", "keys")}
    empty = hashlib.sha256(b"").hexdigest()
    opened: dict[tuple[int, int], bytes] = {}
    for depth, level in enumerate(levels):
        for i in np.flatnonzero(level["open"]).tolist():
            opened[depth, i] = _key(rows.paths[order[level["head"][i]]][:NAME * depth])
        done = np.flatnonzero(~level["open"])
        above = levels[depth - 1] if depth else None
        for name, column in (("conv_id", "least"), ("n_convs", "n"), ("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved")):
            out[name] += level[column][done].tolist()
        out["depth"] += [depth] * len(done)
        out["ends_sha256"] += [rows.ends[e] if e >= 0 else empty for e in level["end"][done].tolist()]
        out["key"] += [rows.keys[v] for v in (value[level["head"][done]] + depth).tolist()] if rows.keys else [None] * len(done)
        if above is None:
            out["parent_conv_id"] += [None] * len(done)
            out["parent_key"] += [None] * len(done)
        else:
            parents = level["parent"][done]
            is_open = above["open"][parents].tolist()
            out["parent_conv_id"] += [None if o else p for o, p in zip(is_open, above["least"][parents].tolist(), strict=True)]
            out["parent_key"] += [opened[depth - 1, p] if o else None for o, p in zip(is_open, parents.tolist(), strict=True)]
    return out


def _key(prefix: bytes) -> bytes:
    return hashlib.blake2b(prefix, digest_size=16).digest()


def _edge_columns(rows: _Rows, levels: list[dict], order: np.ndarray, length: np.ndarray) -> dict[str, list]:
    out: dict[str, list] = {n: [] for n in ("path", "n", "least", "children", "leaves", "saved", "ends", "keys")}
    for side, row in ((0, 0), (-1, len(order) - 1)):
        if side and row == 0:
            break
        path, depths = rows.paths[order[row]], range(int(length[row]) + 1)
        # What both paths pass is told by the first one alone.
        own = [not side or not (length[0] >= d and len(levels[d]["n"]) == 1) for d in depths]
        out["path"].append(path)
        for name in ("n", "least", "children", "leaves", "saved"):
            none = _NONE if name == "least" else 0
            out[name].append([int(levels[d][name][side]) if o else none for d, o in zip(depths, own, strict=True)])
        ends = [int(levels[d]["end"][side]) if o else -1 for d, o in zip(depths, own, strict=True)]
        out["ends"].append([rows.ends[e] if e >= 0 else None for e in ends])
        state, keys = hashlib.blake2b(digest_size=16), []
        for d in depths:
            if d:
                state.update(path[NAME * (d - 1):NAME * d])
            keys.append(state.copy().digest())
        out["keys"].append(keys)
    return out


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _batches(rows: _Rows, last: bool) -> Iterator[pa.RecordBatch]:
    nodes, edges = shard_nodes(rows, last)
    if nodes["depth"]:
        yield _batch(nodes)
    if edges:
        yield _batch(edges)


def _path_shards(batches: Iterator[pa.RecordBatch], most_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    """Shards of rows ``path, block, ids, n, least``, sorted by path and block."""
    paths, counts, least, ends, size, state = [], [], [], [], 0, None
    for batch in batches:
        for path, ids, n, smallest in zip(*(batch.column(k).to_pylist() for k in ("path", "ids", "n", "least")), strict=True):
            if paths and paths[-1] == path:  # the path's next block of ids
                state.update(b"," + ids.encode())
                counts[-1] += n
                continue
            if state is not None:
                ends.append(state.hexdigest())
            if size > most_bytes and len(paths) >= LEAST_ROWS or len(paths) >= most_rows:
                yield from _batches(_Rows.of_paths(paths, counts, least, ends), False)
                paths, counts, least, ends, size = [], [], [], [], 0
            paths.append(path)
            counts.append(n)
            least.append(smallest)
            size += len(path) + NAME
            state = hashlib.sha256(ids.encode())
    if paths:
        ends.append(state.hexdigest())
        yield from _batches(_Rows.of_paths(paths, counts, least, ends), False)


def _edge_shards(last: bool, most_bytes: int, most_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if not last and (size > most_bytes and len(held) >= LEAST_ROWS or len(held) >= most_rows):
                    yield from _batches(_edge_rows(held), False)
                    held, size = [], 0
                held.append(row)
                size += len(row["path"])
        if held:
            yield from _batches(_edge_rows(held), last)

    return run


def _edge_rows(held: list[dict]) -> _Rows:
    flat = lambda name: np.array([x for row in held for x in row[name]], np.int64)
    return _Rows([r["path"] for r in held], *(flat(n) for n in ("n", "least", "children", "leaves", "saved")),
                 [e for r in held for e in r["ends"]], [k for r in held for k in r["keys"]])


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per node of ``conv_id, path``.

    ``conv_id`` is the smallest member's, ``depth`` the number of turns, ``parent_conv_id`` that of the
    node above, ``n_convs`` the members, ``n_children`` and ``n_leaves`` the nodes right below and the childless
    ones in the subtree, ``saved_tokens`` the subtree's bytes that need not be computed again, and
    ``ends_sha256`` the digest of the ascending, comma-joined ids of the members that end there.
    """
    if shard_rows < LEAST_ROWS:
        raise ValueError(f"a shard holds {LEAST_ROWS} rows at least")
    block = F.floor(F.col("conv_id") / IDS)
    rows = paths.groupBy("path", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("c")).select(
        "path", "block", F.array_join(F.col("c").cast("array<string>"), ",").alias("ids"),
        F.size("c").cast("long").alias("n"), F.get("c", F.lit(0)).alias("least"))
    level = stored(rows.repartitionByRange("path").sortWithinPartitions("path", "block").mapInArrow(
        lambda batches: _path_shards(batches, shard_bytes, shard_rows), f"{_NODE}, {_EDGE}"))
    names = [x.split()[0] for x in _NODE.split(", ")]
    nodes = [level.filter("path is null").select(names)]
    while True:
        edges = level.filter("path is not null").select([x.split()[0] for x in _EDGE.split(", ")])
        size, n = edges.agg(F.coalesce(F.sum(F.length("path")), F.lit(0)), F.count("*")).first()
        last = size <= shard_bytes and n <= shard_rows or n <= LEAST_ROWS
        ranged = edges.repartition(1) if last else edges.repartitionByRange("path").sortWithinPartitions("path")
        level = stored(ranged.mapInArrow(_edge_shards(last, shard_bytes, shard_rows), f"{_NODE}, {_EDGE}"))
        nodes.append(level.filter("path is null").select(names))
        if last:
            break
    found = nodes[0]
    known = nodes[1]
    for more in nodes[1:]:
        found = found.union(more)
    for more in nodes[2:]:
        known = known.union(more)
    # The root and other wide nodes have very many children: their ids are dealt over salts.
    known = known.select(F.col("key").alias("_key"), F.col("conv_id").alias("_parent"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.when(F.col("parent_key").isNotNull(), F.pmod(F.xxhash64("conv_id", "depth", "ends_sha256"), F.lit(SALTS)).cast("int"))
    return found.withColumn("s", salt).join(
        known, (F.col("parent_key") == F.col("_key")) & (F.col("s") == F.col("_salt")), "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
