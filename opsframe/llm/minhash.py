"""MinHash near-duplicate detection with exact confirmation of every link.

1. One pass over the texts gives each document the set of its distinct k-word shingles (as 64-bit hashes;
   fewer words than k: the whole sequence), its size, a 128-bit key of the set, BANDS * ROWS universal hash
   minima and one hash per band.
2. Rows with equal sets are one class, numbered once and named by its least row, which has the least id; only
   classes go on, so rows without an id and rows that share one are compared like all others.
3. Classes that share a band are candidates. In every bucket all members are held against one leader, the
   member that shares most buckets with others; the signatures must agree in enough places (verification),
   then the shingle sets themselves decide, exactly. Connected components follow by alternating large-star
   and small-star.
4. Buckets of three and more that still hold several components are searched in whole: each member outside
   the bucket's largest component is held against all members of other components by their sets. Both sides are
   dealt over blocks of about BLOCK_SHINGLES, and each pair of blocks is searched once, in a group of its own, so
   a group holds two blocks whatever the bucket's size. A link between two members of one component can't change the result, so after this no
   link is lost; of an outside member's links to one component, one is given on.

Signatures decide with a margin of MARGIN below the threshold (over four standard deviations), and a pair at
the threshold shares no band with a chance of (1 - threshold**ROWS)**BANDS.

Null texts and texts without words have an empty set, are linked with nothing and kept. The rows of one id are
one document: their sets are linked, so its component holds the near duplicates of each of its texts. Rows
without an id bear the least id of their component and are not kept; in a component without any id,
component_id is null and the rows of one set, its least, are kept. ``one_of_each`` judges row by row: there a
shared id links nothing. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, grams, mix, saved, small_batches, text_bytes, word_blocks
from opsframe.session import cut_lineage

BANDS, ROWS = 24, 4
MARGIN = 0.16
BLOCK_SHINGLES = 300_000
KEYS = ["key0", "key1", "n_shingles"]
_U = np.uint64


def shingle_sets(texts: list[bytes | None], k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as lower case."""
    for i, j, h, at in word_blocks(texts, "lower"):
        for n in range(j - i):
            w = h[at[n] : at[n + 1]]
            if len(w) >= k:
                yield np.unique(grams(w, k))
            elif len(w):
                yield grams(w, len(w)) + _U(len(w))
            else:
                yield w


class Sketch:
    """Universal hashing (multiply and shift) of 64-bit shingle hashes to BANDS * ROWS minima."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        rng = np.random.default_rng(20240301)
        n = bands * rows
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 1 << 63, n, dtype=_U) << _U(1) | _U(1))[:, None]
        self.b = rng.integers(0, 1 << 63, n, dtype=_U)[:, None]

    def minima(self, s: np.ndarray) -> np.ndarray:
        out = None
        for i in range(0, len(s), 2048):
            x = self.a * s[None, i : i + 2048]
            x += self.b
            low = x.min(1)
            out = low if out is None else np.minimum(out, low)
        return (out >> _U(32)).astype(np.uint32)

    def band_hashes(self) -> Column:
        """One hash per band of the column minima."""
        size = 4 * self.rows
        return F.transform(F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda i: F.xxhash64(F.substring(F.col("minima"), i * size + 1, F.lit(size))))


def sketches(documents: DataFrame, k: int, id_col: str, text_col: str, sketch: Sketch) -> DataFrame:
    """doc_id, textkey, n_shingles, set key (two longs) and minima (binary) of every row."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            sizes, first, second, minima = [], [], [], []
            for s in shingle_sets(text_bytes(b.column("text")), k):
                sizes.append(len(s))
                first.append(int(mix(s.copy()).sum(dtype=_U).view(np.int64)))
                second.append(int(mix(s ^ _U(0xD1B54A32D192ED03)).sum(dtype=_U).view(np.int64)))
                m = sketch.minima(s) if len(s) else None
                minima.append(None if m is None else m.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("textkey"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                 pa.array(minima, pa.binary())],
                ["doc_id", "textkey", "n_shingles", "key0", "key1", "minima"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("textkey"), F.col(text_col).alias("text")).mapInArrow(
        sketched, "doc_id long, textkey long, n_shingles long, key0 long, key1 long, minima binary")


def agreeing(pairs: DataFrame, signatures: DataFrame, least: float) -> DataFrame:
    """Of pairs (a, b), those whose signatures agree in at least that share of places."""
    both = (pairs.join(signatures.select(F.col("rep").alias("b"), F.col("minima").alias("mb")), "b")
            .join(signatures.select(F.col("rep").alias("a"), F.col("minima").alias("ma")), "a"))

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(b.num_rows, -1) for c in ("ma", "mb"))
            ok = (x == y).mean(1) >= least if b.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "ma", "mb").mapInArrow(agree, "a long, b long")


def row_key(id_column: Column | str, textkey: Column | str) -> list[Column]:
    """Key of a row by id and hash of the text, for joins and groups: never null."""
    i = F.col(id_column).cast("long") if isinstance(id_column, str) else id_column
    return [F.coalesce(i, F.lit(0)), i.isNull(), F.col(textkey) if isinstance(textkey, str) else textkey]


def texts_of(wanted: DataFrame, documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text of wanted: rep, doc_id, textkey; a class's text is that of its least row."""
    names = ["x", "y", "z"]
    rows = documents.select(*(c.alias(n) for n, c in zip(names, row_key(id_col, F.xxhash64(text_col)))), F.col(text_col).alias("text"))
    asked = wanted.select(*(c.alias(n) for n, c in zip(names, row_key("doc_id", "textkey"))), "rep")
    return rows.join(asked, names).groupBy(*names, "rep").agg(F.min("text").alias("text")).select(F.col("rep").alias("id"), "text")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs (a, b) of ids, those whose shingle sets satisfy 100 * intersection >= percent * union."""
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"))

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        for b in small_batches(batches, 256):
            ids = b.column("a").to_pylist()
            ta = b.column("ta")
            places = [n for n, x in enumerate(ids) if x != (ids[n - 1] if n else held[0])]  # rows come sorted by a
            sets = iter(shingle_sets(text_bytes(ta.take(pa.array(places, pa.int64()))), k))
            ok = []
            for n, sb in enumerate(shingle_sets(text_bytes(b.column("tb")), k)):
                if ids[n] != held[0]:
                    held = (ids[n], next(sets))
                sa = held[1]
                small, large = sorted((len(sa), len(sb)))
                if 100 * small < percent * large:
                    ok.append(False)
                    continue
                shared = len(sa) + len(sb) - len(np.union1d(sa, sb))
                ok.append(100 * shared >= percent * (len(sa) + len(sb) - shared))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(same, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reachable) of every id in links (a, b), by large-star and small-star
    until a round changes nothing; each round is checkpointed."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before = None
    while True:
        ways = edges.union(edges.select("v", "u"))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", "m")).where("u <> v").distinct())
        edges = cut_lineage(edges)
        now = tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
        before = now


def dealt(named: DataFrame) -> DataFrame:
    """named: band, hash, rep, n_shingles, component. Members of buckets with several components, dealt over groups
    (band, hash, i, j) that hold two blocks: i of members outside the bucket's largest component, which ask, and j
    of other such members or of the largest component. Each pair of blocks meets in one group."""
    parts = named.groupBy("band", "hash", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    mixed = (parts.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size"), F.max(F.struct("n", "component", "size")).alias("top"))
             .where("parts > 1").select("band", "hash", F.col("top.component").alias("main"),
                                        F.ceil((F.col("size") - F.col("top.size")) / BLOCK_SHINGLES).cast("int").alias("outer"),
                                        F.ceil(F.col("top.size") / BLOCK_SHINGLES).cast("int").alias("inner")))
    spot = F.xxhash64("rep")
    rows = named.join(mixed, ["band", "hash"]).withColumn("at", F.when(F.col("component") != F.col("main"), F.pmod(spot, F.col("outer")))
                                                          .otherwise(F.col("outer") + F.pmod(spot, F.col("inner"))).cast("int"))
    # one pass: a member is held against the asking blocks up to its own, and asks the blocks from its own on
    groups = F.expr("""concat(
        transform(sequence(0, least(at, outer - 1)), x -> struct(x as i, at as j, false as ask)),
        if(at < outer, transform(sequence(at, outer + inner - 1), x -> struct(at as i, x as j, true as ask)), array()))""")
    return rows.withColumn("to", F.explode(groups)).select("band", "hash", "to.i", "to.j", "to.ask", "rep", "component", "n_shingles")


def unfinished(members: DataFrame, comps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in a bucket, where b lies outside the bucket's largest one."""
    named = (members.where("n > 2").join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .withColumn("component", F.coalesce("component", "rep")).select("band", "hash", "rep", "n_shingles", "component"))

    def searched(key: tuple, t: pa.Table) -> pa.Table:
        ask = t.column("ask").to_numpy(zero_copy_only=False)
        rep, comp = (t.column(c).to_numpy() for c in ("rep", "component"))
        same = key[2].as_py() == key[3].as_py()
        sets = list(shingle_sets(text_bytes(t.column("text").combine_chunks()), k))
        y = np.flatnonzero(~ask)
        a, b = [], []
        if len(y):
            sizes = np.array([len(sets[i]) for i in y])
            known, places = np.unique(np.concatenate([sets[i] for i in y]), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            mark = np.zeros(len(known), np.int64)
            for x in np.flatnonzero(ask):
                at = np.minimum(np.searchsorted(known, sets[x]), len(known) - 1)
                at = at[known[at] == sets[x]]
                mark[at] = 1
                shared = np.add.reduceat(mark[places], starts)
                mark[at] = 0
                linked = (100 * shared >= percent * (sizes + len(sets[x]) - shared)) & (comp[y] != comp[x])
                if same:  # a block against itself: of two members, once
                    linked &= rep[y] < rep[x]
                near = y[linked]
                for z in near[np.unique(comp[near], return_index=True)[1]]:
                    a.append(rep[z])
                    b.append(rep[x])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt(named).join(texts.withColumnRenamed("id", "rep"), "rep").groupBy("band", "hash", "i", "j").applyInArrow(searched, "a long, b long").distinct()


def same_ids(some: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one id."""
    spot = F.xxhash64(*KEYS)
    several = some.where("doc_id is not null").groupBy("doc_id").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).where("low < high").select("doc_id")
    held = saved(some.join(several, "doc_id").join(nodes.select(*KEYS, "rep"), KEYS).select("doc_id", "rep").distinct(), "held")
    return held.join(held.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").where("a <> rep").select("a", F.col("rep").alias("b"))


def classes(documents: DataFrame, k: int, percent: int, id_col: str, text_col: str, bands: int, rows: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """(all rows: doc_id, textkey and set key; classes: set key, doc_id and textkey of the least row, component_id,
    whether the class holds its component's least row). by_id: the rows of one id are linked."""
    sketch = Sketch(bands, rows)
    least = percent / 100 - MARGIN
    all_rows = saved(sketches(documents, k, id_col, text_col, sketch), "sketches")
    some = all_rows.where("n_shingles > 0")
    nodes = saved(some.groupBy(*KEYS).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "textkey")).alias("least"), F.max("minima").alias("minima"))
                  .select(F.monotonically_increasing_id().alias("rep"), *KEYS, "least.doc_id", "least.textkey", "minima"), "classes")
    spread = nodes.select("rep", "n_shingles", F.posexplode(sketch.band_hashes()).alias("band", "hash"))
    buckets = spread.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = saved(spread.join(buckets, ["band", "hash"]), "members")
    wanted = nodes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "doc_id", "textkey")
    texts = saved(texts_of(wanted, documents, id_col, text_col), "texts")
    fame = members.groupBy("rep").agg(F.sum("n").alias("fame"))
    leads = (members.join(fame, "rep").groupBy("band", "hash").agg(F.max(F.struct("fame", (-F.col("rep")).alias("r"))).alias("top"))
             .select("band", "hash", (-F.col("top.r")).alias("a")))
    stars = members.join(leads, ["band", "hash"]).where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    links = confirmed(agreeing(stars, nodes, least), texts, k, percent)
    links = saved(links.union(same_ids(some, nodes)) if by_id else links, "links")
    comps = cut_lineage(components(links))
    more = saved(unfinished(members, comps, texts, k, percent), "links")
    if not more.isEmpty():
        comps = cut_lineage(components(links.union(more)))
    linked = comps.union(comps.select("component", "component").distinct()).withColumnRenamed("id", "rep")
    named = nodes.select(*KEYS, "rep", "doc_id", "textkey").join(linked, "rep", "left")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEYS)
    tops = named.where("component is not null").groupBy("component").agg(F.min(row).alias("top"))
    chosen = F.col("top").isNull() | (F.struct(*(F.col(f"top.{c}") for c in KEYS)) == F.struct(*KEYS))
    return all_rows.select("doc_id", "textkey", *KEYS), named.join(tops, "component", "left").select(
        *KEYS, "doc_id", "textkey", F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"), chosen.alias("chosen"))


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; links hold from a Jaccard similarity of percent."""
    all_rows, found = classes(documents, k, percent, id_col, text_col, bands, rows, by_id=True)
    out = all_rows.join(found.select(*KEYS, "component_id", "chosen"), KEYS, "left")
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.when(empty, True).when(component.isNull(), F.col("chosen")).otherwise(F.coalesce(F.col("doc_id") == component, F.lit(False)))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def one_of_each(documents: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """documents without near duplicates: of each component one row stays, the one with the least id (without any:
    of the least set), of several such the one with the least hash of its text. Of rows without words those that
    are equal in id and text are one. Rows are judged by id and text, so a shared id takes no other text with it."""
    all_rows, found = classes(documents, k, percent, id_col, text_col, BANDS, ROWS, by_id=False)
    names = [fresh(documents, n) for n in ("_id", "_none", "_text")]
    key = [c.alias(n) for n, c in zip(names, row_key("doc_id", "textkey"))]
    stays = found.where("chosen").select(*key).union(all_rows.where("n_shingles = 0").select(*key))
    gone = all_rows.select(*key).distinct().join(stays, names, "left_anti")
    number = fresh(documents, "_same")
    rows = documents.select("*", *(c.alias(n) for n, c in zip(names, row_key(id_col, F.xxhash64(text_col)))))
    same = Window.partitionBy(*names).orderBy(F.lit(0))
    return rows.join(gone, names, "left_anti").withColumn(number, F.row_number().over(same)).where(F.col(number) == 1).drop(number, *names)
