"""SimHash near-duplicate detection: pigeonhole blocks, a join on blocks, then the Hamming distance.

1. One pass over the texts gives each row its 64-bit fingerprint: the text with A-Z lowered is split into words
   ``[^\\x20\\x09-\\x0D]+``, each run of k words (joined by one space, repeats counted) is hashed by XXH64 with
   seed 42, and a bit is 1 if it is set in over half of the hashes. A text with fewer words is one run of them all;
   a null text or one without words has the fingerprint 0, which links like any other.
2. Different fingerprints are the nodes, so equal texts cost one node. Two that differ in at most DISTANCE bits
   agree in at least BLOCKS - DISTANCE of BLOCKS blocks of bits, so they share the bucket (those blocks' place and
   bits) of one choice of blocks: 20 choices of 3 of 6 blocks, about 32 equal bits each.
3. A bucket of up to LIMIT fingerprints is searched by Hamming distance. A larger one (near copies in great
   numbers) is dealt again by the same rule: its free bits are split into FINE blocks, of which FINE - DISTANCE
   must agree. What then stays free is at most 13 bits, and as fingerprints are different, a bucket can't hold more
   than 8,192 of them: every group is bounded whatever the input, and no pair is left out.
4. A search gives a spanning forest of the links inside its bucket, at most one link a member, not all pairs.
   Components follow by large-star and small-star; a component is named by its least doc_id.

Rows that share an id are one document: their fingerprints are linked. A row without an id takes part as any other
and never names a component; a component without any id has a null component_id. Repeated rows come out as often
as they came in. Very long texts are hashed in pieces of PIECE runs. An empty table gives no rows. Only the id and
the text column are read, so further columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import saved, small_batches, text_bytes
from opsframe.llm.minhash import components

DISTANCE = 3
BLOCKS, FINE = 6, 8
LIMIT = 1024
PIECE = 1 << 16
_U = np.uint64


def fingerprint(text: bytes | None, k: int) -> int:
    words = (text or b"").lower().split()  # bytes: only A-Z change, and only the six white-space bytes split
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - k + 1, 1)
    starts, ends, digest = starts[:n], ends[-n:], xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, n, PIECE):
        h = np.array([digest(line[a:b], 42) for a, b in zip(starts[i : i + PIECE].tolist(), ends[i : i + PIECE].tolist())], _U)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(_U)[0])


def fingerprints(documents: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fps = np.array([fingerprint(t, k) for t in text_bytes(b.column(1))], _U).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps)], ["doc_id", "fp"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(hashed, "doc_id long, fp long")


def choices(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks (as signed longs) of all choices of blocks - distance of that many runs of the given bits."""
    runs = np.array_split(np.array(bits), blocks)
    kept = [np.concatenate(c) for c in combinations(runs, blocks - distance)]
    return [int(np.bitwise_or.reduce(_U(1) << c.astype(_U)).view(np.int64)) for c in kept]


def masks(distance: int = DISTANCE) -> list[tuple[int, list[int]]]:
    """Each choice of blocks with the finer choices of its buckets; a fixed number, whatever the input."""
    out = []
    for m in choices(list(range(64)), BLOCKS + distance - DISTANCE, distance):
        free = [i for i in range(64) if not m >> i & 1]
        out.append((m, [m | x for x in choices(free, FINE + distance - DISTANCE, distance)]))
    return out


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (place, place) that span each set of fingerprints connected by steps of at most that many bits."""
    links, rest, todo = [], np.arange(len(fps)), []
    fps = fps.view(_U)
    while len(rest):
        if not todo:
            todo, rest = [rest[0]], rest[1:]
        x = todo.pop()
        near = np.bitwise_count(fps[rest] ^ fps[x]) <= distance
        if near.any():
            found = rest[near]
            links += [(x, y) for y in found]
            todo += found.tolist()
            rest = rest[~near]
    return links


def searched(members: DataFrame, distance: int) -> DataFrame:
    """members: mask, key, fp in buckets of bounded size. Links (a, b) inside the buckets."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Fingerprints and the bounds of their buckets; a bucket cut by the end of a batch waits for the next one."""
        held = [np.zeros(0, np.int64)] * 3
        for b in batches:
            held = [np.concatenate((h, b.column(c).to_numpy())) for h, c in zip(held, ("mask", "key", "fp"))]
            cuts = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            if len(cuts):
                yield held[2][: cuts[-1]], np.concatenate(([0], cuts))
                held = [h[cuts[-1] :] for h in held]
        if len(held[0]):
            yield held[2], np.array([0, len(held[0])])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, at in runs(batches):
            a, b = [], []
            for i in np.flatnonzero(np.diff(at) > 1):
                part = fps[at[i] : at[i + 1]]
                for x, y in forest(part, distance):
                    a.append(part[x])
                    b.append(part[y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return members.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(linked, "a long, b long").distinct()


def links(nodes: DataFrame, distance: int = DISTANCE, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, each once) within that distance of each other."""
    plan = masks(distance)
    coarse = F.array(*[F.lit(m) for m, _ in plan])
    spread = nodes.select("fp", F.explode(coarse).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = spread.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = saved(spread.join(sizes, ["mask", "key"]), "members")
    finer = F.create_map(*[x for m, f in plan for x in (F.lit(m), F.array(*map(F.lit, f)))])
    large = (members.where(F.col("n") > limit).select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
             .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    return searched(members.where(F.col("n") <= limit).select("mask", "key", "fp").unionByName(large), distance)


def simhash_components(documents: DataFrame, k: int = 3, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text",
                       limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    rows = saved(fingerprints(documents, k, id_col, text_col), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    shared = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b <> top")
    same = rows.join(shared.select("doc_id", "b"), "doc_id").select(F.col("fp").alias("a"), "b")
    found = components(saved(links(nodes, distance, limit).union(same), "links")).withColumnRenamed("id", "fp")
    # nodes without a link are components of their own
    named = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    whole = named.join(names, "component").select("fp", "component_id")
    return rows.join(whole, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
