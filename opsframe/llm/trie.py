"""Conversation prefix trie from padded turn-id matrices.

1. A turn is the 128-bit hash of its role and text and its text's UTF-8 bytes; texts go no further. Each conversation's
   turns are ordered by turn (null first; equal turns by their hash) and rebuilt: the first h turns of conversation
   c - c % 5, then its own turns after its first h, h = crc32(decimal c) % 9.
2. The rebuilt conversations are dealt by range of (turn ids, conv_id) into shards of about SHARD_TURNS turns. As conv_id
   is part of the range, equal conversations in any number spread over shards.
3. In a shard, turn ids form padded matrices of COLUMNS columns at a time (only rows still equal to another go on to the
   next columns, so one long conversation pads no other). numpy's lexsort orders the rows; masks of the columns in which
   a row differs from the one before, OR-accumulated from left to right, mark where nodes start at every depth;
   reduceat adds up each depth. Everything a node needs is a sum over its rows, given how many turns a row shares with
   the row before it: children start where a row shares no more than the node's depth, a leaf ends where the next row
   shares less than a row's whole length, and a row saves the bytes of the turns that it shares below the node.
4. Nodes on the path of a shard's first or last row may go on in the next shard: these boundary nodes come out as
   partial sums keyed by the hash of their path, the shards' first and last rows as paths. What neighbouring shards
   share is added, and one aggregation by path recombines them. All other nodes are finished in their shard.
   Ids that end in a boundary node come as chunks of CHUNK ids and are hashed in order, as a stream.

A row without a conv_id belongs to no conversation and is left out; null role or text is empty. c % 5 keeps the sign
of c, as in SQL. Repeated (conv_id, turn) rows are turns of their own. A conversation's turn ids (24 bytes a turn) are
one row; its texts never are. A turnless rebuilt conversation is a member of the root. If no node has a child, the root
is the one leaf. An empty table gives no rows. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsframe.llm.common import saved

SHARD_TURNS = 400_000
COLUMNS = 16
CHUNK = 4096
_PAD = np.iinfo(np.int64).min
_EMPTY = hashlib.sha256(b"").hexdigest()
_PATH = "array<struct<a:bigint,b:bigint,n:bigint>>"
_OUT = ("kind int, shard int, side int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, parent_side int, "
        "n_convs long, n_children long, n_leaves long, saved long, ends string, keys array<binary>, bytes array<long>")
INNER, BOUNDARY, ENDS, EDGE = range(4)


def conversations_as_paths(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order as path: two hashes and the bytes of each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"), F.xxhash64(role, text).alias("a"),
                    F.xxhash64(F.lit("turn"), role, text).alias("b"), F.octet_length(text).cast("long").alias("n"))
    return (conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).cast(_PATH).alias("path")))


def rebuilt(paths: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """conv_id, path: the first h turns of the conversation's base and its own turns after its first h."""
    heads = paths.select(F.col("conv_id").alias("base"), F.slice("path", 1, most).alias("head"))
    own = paths.withColumns({"h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int"),
                             "base": F.col("conv_id") - F.col("conv_id") % every})
    head = F.slice(F.coalesce("head", F.array().cast(_PATH)), F.lit(1), F.col("h"))
    rest = F.slice("path", F.col("h") + 1, F.size("path"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("path"))


class Rows:
    """A shard's rows: turn ids laid end to end, where each row starts and how long it is."""

    def __init__(self, conv: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, columns: int):
        self.conv, self.size, self.a, self.b, self.n, self.columns = conv, size, a, b, n, columns
        self.start = np.cumsum(size) - size

    def matrix(self, rows: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Padded turn ids (both hashes) of the rows' columns from first on."""
        column = np.arange(first, first + self.columns)
        inside = column < self.size[rows][:, None]
        at = np.where(inside, self.start[rows][:, None] + column, 0)
        if not len(self.a):
            return np.full(at.shape, _PAD), np.full(at.shape, _PAD)
        return np.where(inside, self.a[at], _PAD), np.where(inside, self.b[at], _PAD)

    def order(self) -> np.ndarray:
        """Rows by turn ids, then conv_id: a row's rank is the place of the first row equal to it so far."""
        rank, rows, first = np.zeros(len(self.conv), np.int64), np.arange(len(self.conv)), 0
        while len(rows):
            a, b = self.matrix(rows, first)
            keys = [k[:, j] for j in range(self.columns - 1, -1, -1) for k in (b, a)]
            order = np.lexsort([*keys, rank[rows]])
            rows, a, b = rows[order], a[order], b[order]
            old = rank[rows]
            other = np.concatenate(([True], old[1:] != old[:-1]))
            new = other.copy()
            new[1:] |= ((a[1:] != a[:-1]) | (b[1:] != b[:-1])).any(1)
            place = np.arange(len(rows))
            group = np.maximum.accumulate(np.where(other, place, 0))
            part = np.flatnonzero(new)
            count = np.diff(np.append(part, len(rows)))
            rank[rows] = old + np.repeat(part, count) - group
            first += self.columns
            more = (count > 1) & (np.maximum.reduceat(self.size[rows], part) > first)  # ended rows stay to come before the longer ones
            rows = rows[np.repeat(more, count)]
        return np.lexsort((self.conv, rank))

    def shared(self) -> np.ndarray:
        """How many first turns each row (in order) shares with the row before; -1 for the first row."""
        out = np.zeros(len(self.conv), np.int64)
        out[:1] = -1
        rows, first = np.arange(1, len(self.conv)), 0
        while len(rows):
            (a, b), (c, d) = self.matrix(rows, first), self.matrix(rows - 1, first)
            ended = np.arange(first, first + self.columns) >= np.minimum(self.size[rows], self.size[rows - 1])[:, None]
            changed = np.logical_or.accumulate((a != c) | (b != d) | ended, axis=1)
            out[rows] += (~changed).sum(1)
            rows = rows[~changed[:, -1]]
            first += self.columns
        return out

    def taken(self, order: np.ndarray) -> Rows:
        size = self.size[order]
        at = np.repeat(self.start[order] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Rows(self.conv[order], size, self.a[at], self.b[at], self.n[at], self.columns)

    def path(self, row: int) -> tuple[list[bytes], list[int]]:
        """Key of the node at each depth on the row's path, and the bytes down to it."""
        part = slice(self.start[row], self.start[row] + self.size[row])
        h = xxhash.xxh3_128()
        keys = [h.digest()]
        for turn in np.stack((self.a[part], self.b[part]), 1):
            h.update(turn.tobytes())
            keys.append(h.digest())
        return keys, [0, *np.cumsum(self.n[part]).tolist()]


def _batch(**columns) -> pa.RecordBatch:
    """A batch of the output: missing columns are null, single values repeat."""
    n = max(len(v) for v in columns.values() if isinstance(v, (list, np.ndarray)))
    schema = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
                                        "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}[f.split()[1]]) for f in _OUT.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(v if isinstance(v, (list, np.ndarray)) else [v] * n, f.type) for f in schema for v in [columns.get(f.name)]], schema=schema)


def nodes_of_shard(rows: Rows, shard: int) -> Iterator[pa.RecordBatch]:
    """Finished inner nodes, partial boundary nodes, the ids that end in these, and the first and last path."""
    rows = rows.taken(rows.order())
    conv, size, n = rows.conv, rows.size, len(rows.conv)
    shared = rows.shared()
    total = np.concatenate(([0], np.cumsum(rows.n)))
    down = lambda at, depth: total[rows.start[at] + depth] - total[rows.start[at]]  # noqa: E731  bytes of the first turns
    leaf = np.zeros(n, np.int64)
    leaf[:-1] = size[:-1] > shared[1:]
    paths = [rows.path(0), rows.path(n - 1)]
    yield _batch(kind=EDGE, shard=shard, side=[0, 1], keys=[k for k, _ in paths], bytes=[b for _, b in paths])
    inner, held = [], 0
    at = np.arange(n)
    node_of = np.zeros(n, np.int64)
    low_before = side_before = None
    for depth in range(int(size.max()) + 1):
        at = at[size[at] >= depth]
        start = shared[at] < depth
        start[0] = True
        first = np.flatnonzero(start)
        count = np.diff(np.append(first, len(at)))
        low = np.minimum.reduceat(conv[at], first)
        children = np.add.reduceat(((shared[at] <= depth) & (size[at] > depth) & (at > 0)).astype(np.int64), first)
        leaves = np.add.reduceat(leaf[at], first)
        ending = np.add.reduceat((size[at] == depth).astype(np.int64), first)
        again = shared[at] >= max(depth, 1)
        saved_bytes = np.zeros(len(at), np.int64)
        saved_bytes[again] = down(at[again], shared[at[again]]) - down(at[again], max(depth - 1, 0))
        saves = np.add.reduceat(saved_bytes, first)
        side = np.full(len(first), -1)
        if at[-1] == n - 1:
            side[-1] = 1
        if at[0] == 0:
            side[0] = 0
        above = node_of[at[first]]
        for i in np.flatnonzero(side >= 0):
            keys = paths[side[i]][0]
            yield _batch(kind=BOUNDARY, shard=shard, side=[side[i]], depth=depth, key=keys[depth], parent_key=keys[depth - 1] if depth else None,
                         conv_id=low[i], n_convs=count[i], n_children=children[i], n_leaves=leaves[i], saved=saves[i])
            for j in range(0, int(ending[i]), CHUNK):
                ids = conv[at[first[i] + j : first[i] + min(j + CHUNK, int(ending[i]))]]
                yield _batch(kind=ENDS, shard=shard, depth=j, key=[keys[depth]], ends=",".join(map(str, ids.tolist())))
        own = np.flatnonzero(side < 0)
        if len(own):
            digests = [_EMPTY] * len(own)
            for i in np.flatnonzero(ending[own]):
                x = first[own[i]]
                digests[i] = hashlib.sha256(",".join(map(str, conv[at[x : x + ending[own[i]]]].tolist())).encode()).hexdigest()
            inner.append(_batch(kind=INNER, shard=shard, depth=np.full(len(own), depth), conv_id=low[own], parent_conv_id=low_before[above[own]],
                                parent_side=side_before[above[own]], n_convs=count[own], n_children=children[own], n_leaves=leaves[own],
                                saved=saves[own], ends=digests))
            held += len(own)
        node_of[at] = np.repeat(np.arange(len(first)), count)
        low_before, side_before = low, side
        if held > 20_000:
            yield from inner
            inner, held = [], 0
    yield from inner


def shards(built: DataFrame, shard_turns: int = SHARD_TURNS, columns: int = COLUMNS) -> DataFrame:
    """The shards' rows (see nodes_of_shard) of conv_id, path."""
    cells = built.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    n = max(int(built.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells // shard_turns))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, size, turns = [], [], [[], [], []]
        for b in batches:
            path = b.column(1)
            conv.append(b.column(0).to_numpy())
            size.append(np.diff(path.offsets.to_numpy()).astype(np.int64))
            for out, part in zip(turns, path.flatten().flatten()):
                out.append(part.to_numpy(zero_copy_only=False))
        if sum(map(len, conv)):
            rows = Rows(np.concatenate(conv), np.concatenate(size), *(np.concatenate(t).astype(np.int64) for t in turns), columns)
            yield from nodes_of_shard(rows, TaskContext.get().partitionId())

    return built.select("conv_id", "path").repartitionByRange(n, "path", "conv_id").mapInArrow(made, _OUT)


def ends_digests(chunks: DataFrame) -> DataFrame:
    """key, ends: SHA-256 of a key's ids in order, comma-joined; a stream over chunks."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for b in batches:
            done = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ends").to_pylist()):
                if k != key:
                    if h:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array([d[0] for d in done], pa.binary()), "ends": pa.array([d[1] for d in done], pa.string())})
        if h:
            yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": [h.hexdigest()]})

    # within a shard, chunks come by their first place (column depth)
    return chunks.repartition("key").sortWithinPartitions("key", "shard", "depth").select("key", "ends").mapInArrow(digested, "key binary, ends string")


def recombined(made: DataFrame) -> DataFrame:
    """Boundary nodes of all shards: key, depth, parent_key, conv_id and their sums."""
    edges = made.where(F.col("kind") == EDGE)
    number = edges.where("side = 0").select("shard", F.row_number().over(Window.orderBy("shard")).alias("no"))  # one row a shard
    firsts = edges.where("side = 0").join(number, "shard").select("no", "keys", "bytes")
    lasts = edges.where("side = 1").join(number, "shard").select((F.col("no") + 1).alias("no"), F.col("keys").alias("before"))
    met = firsts.join(lasts, "no", "full").withColumn("lcp", F.coalesce(F.size(F.array_intersect("keys", "before")) - 1, F.lit(0)))
    zero = F.lit(0).cast("long")
    # a shard's first row: the children it starts and the bytes it saves, at each node of its path
    heads = met.where("keys is not null").select("lcp", "keys", "bytes", F.posexplode("keys").alias("depth", "key"))
    spared = F.get("bytes", F.col("lcp")) - F.get("bytes", F.greatest(F.col("depth") - 1, F.lit(0)))
    heads = heads.select(
        "key", F.col("depth").cast("long").alias("depth"), zero.alias("n_convs"),
        ((F.col("lcp") <= F.col("depth")) & (F.col("depth") < F.size("keys") - 1)).cast("long").alias("n_children"), zero.alias("n_leaves"),
        F.when(F.col("lcp") >= F.greatest(F.col("depth"), F.lit(1)), spared).otherwise(0).cast("long").alias("saved"))
    # its last row: whether a leaf ends there
    tails = met.where("before is not null").select(
        F.explode("before").alias("key"), (F.size("before") - 1 > F.col("lcp")).cast("long").alias("n_leaves"))
    parts = (made.where(F.col("kind") == BOUNDARY).select("key", "depth", "n_convs", "n_children", "n_leaves", "saved", "conv_id", "parent_key")
             .unionByName(heads, allowMissingColumns=True).unionByName(tails, allowMissingColumns=True))
    whole = parts.groupBy("key").agg(F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"),
                                     *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")))
    ends = ends_digests(made.where(F.col("kind") == ENDS))
    return (whole.join(ends, "key", "left").withColumn("ends", F.coalesce("ends", F.lit(_EMPTY)))
            .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves"))))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, columns: int = COLUMNS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    built = saved(rebuilt(conversations_as_paths(conversations)), "rebuilt")
    made = saved(shards(built, shard_turns, columns), "shards")
    boundary = saved(recombined(made), "boundary")
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    named = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    outer = boundary.join(named, "parent_key", "left").select(*result)
    # an inner node below a boundary node looks it up by shard and depth, so no parent is a hot key
    places = (made.where(F.col("kind") == BOUNDARY).select("shard", "side", "depth", F.col("key").alias("parent_key")).join(named, "parent_key")
              .select("shard", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("parent_conv_id").alias("found")))
    inner = (made.where(F.col("kind") == INNER).join(places, ["shard", "parent_side", "depth"], "left")
             .withColumn("parent_conv_id", F.coalesce("found", "parent_conv_id")).select(*result))
    return inner.unionByName(outer)
