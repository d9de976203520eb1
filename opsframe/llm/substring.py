"""Substring deduplication with prefix-partitioned suffix trees.

A window is WINDOW consecutive words. A word is removed if a window covers it whose word sequence also
starts in a document with a smaller id, judged on the input.

1. Anchors: of every PREFIX-word sequence of a text its hash is taken, and of each run of them that a window
   can hold the least is an anchor. So equal windows have an anchor at the same place, and only anchors
   need be followed. Documents with the same words are one: the one with the least id stands for all.
2. The first PREFIX words of the suffix at an anchor are its prefix. Prefixes found in one document only are
   done with. The suffixes of the others are cut at WINDOW words and carry the words before them, as hashes;
   equal ones are one row with the least id.
3. Prefixes go into groups of about GROUP suffixes. A group builds its subtrees: suffixes in order, common
   prefix lengths of neighbours, and from these the internal nodes at each depth, split by the words before
   the suffix. A node whose left and right extension reach WINDOW words is a repeat; its least id
   settles every window through it.
4. A prefix with more than GROUP suffixes is replaced by longer ones, step by step until they fit. The windows
   through an anchor start 0 to WINDOW - PREFIX words before it; dividing that range (STEPS) gives suffixes
   with longer prefixes that all windows of a part share (25 words, then 38, 47, 50), and each fitting prefix
   gets its own subtree. At 50 words the prefix is the window, its subtree is one node, and Spark's aggregation
   takes its least id. So no group grows with the input. Keys of prefixes that don't fit are broadcast up to FEW.

Null texts have no words. Rows without an id take no part and lose nothing. Rows with the same id count as
one document's texts and don't remove each other's words. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import grams, mix, saved, small_batches, text_bytes, word_blocks
from opsframe.session import cut_lineage

WINDOW = 50
PREFIX = 25
GROUP = 20_000
STEPS = (13, 4, 1)
FEW = 1_000_000
_U = np.uint64


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op (minimum or maximum) of each n consecutive values, by doubling."""
    width = 1
    while 2 * width <= n:
        x = op(x[:-width], x[width:])
        width *= 2
    return op(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def anchors(h: np.ndarray, window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray]:
    """(positions, prefix hashes) of the anchors of a text's word hashes; ties all count."""
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    g, run = grams(h, prefix), window - prefix + 1
    least = _sliding(g, run, np.minimum)
    pad = np.zeros(run - 1, _U)
    most = _sliding(np.concatenate([pad, least, pad]), run, np.maximum)
    at = np.flatnonzero(most == g)
    return at, g[at]


def words_key(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a word sequence."""
    if not len(h):
        return 0, 0
    n = np.arange(1, len(h) + 1, dtype=_U)
    x, y = mix(h + n * _U(0x9E3779B97F4A7C15)), mix(h ^ mix(n.copy()))
    return int(x.sum(dtype=_U).view(np.int64)), int(y.sum(dtype=_U).view(np.int64))


def _contexts(h: np.ndarray, at: np.ndarray, left: int, right: int) -> np.ndarray:
    """left words before and right words from each position, 0 where there are none."""
    wide = np.concatenate([np.zeros(left, _U), h, np.zeros(right, _U)])
    return np.lib.stride_tricks.sliding_window_view(wide, left + right)[at]


def _key(rows: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of each row of words."""
    out = np.full(len(rows), _U(salt))
    for c in range(rows.shape[1]):
        out = mix((out ^ rows[:, c]) * _U(0xD6E8FEB86659FD93))
    return out


def subtree_repeats(context: np.ndarray, least_id: np.ndarray, left: int, window: int) -> np.ndarray:
    """For each suffix (a row: left words, then window words), a bit for each offset a = 0..left: whether the
    window that starts a words before the suffix is on a node with an id below the row's own."""
    n = len(context)
    suffix = np.ascontiguousarray(context[:, left:].astype(">u8"))
    order = np.argsort(suffix.view(f"V{suffix.shape[1] * 8}").ravel(), kind="stable")
    s = suffix[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(1), differ.argmax(1), window)  # longest common prefix with the row before
    ids, before = least_id[order], context[order, :left]
    mask, way = np.zeros(n, np.int64), np.zeros(n, _U)
    for a in range(left + 1):
        if a:
            way = mix((way ^ before[:, left - a]) * _U(0xA0761D6478BD642F))
        node = np.zeros(n, np.int64)
        np.cumsum(common < window - a, out=node[1:])
        path = np.lexsort((ids, way, node))
        new = np.ones(n, bool)
        new[1:] = (node[path][1:] != node[path][:-1]) | (way[path][1:] != way[path][:-1])
        lowest = ids[path][np.flatnonzero(new)][np.cumsum(new) - 1]
        mask[order[path]] |= (lowest < ids[path]).astype(np.int64) << a
    return mask


def _spread(mask: np.ndarray, at: np.ndarray, n_words: int, window: int, left: int) -> np.ndarray:
    """Words covered by the windows whose bits are set for suffixes at the given positions."""
    starts = np.zeros(n_words + 1, np.int64)
    for a in range(left + 1):
        i = at[(mask >> a) & 1 == 1] - a
        i = np.unique(i[(i >= 0) & (i + window <= n_words)])
        starts[i] = 1
    i = np.flatnonzero(starts)
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, i, 1)
    np.add.at(edge, i + window, -1)
    return np.cumsum(edge)[:n_words] > 0


def few(keys: DataFrame) -> DataFrame:
    """The keys, broadcast if they are at most FEW."""
    return F.broadcast(keys) if keys.count() <= FEW else keys


def longer_prefixes(hot: DataFrame, left: int, window: int, group: int) -> Iterator[DataFrame]:
    """hot: c0, c1, low, context of the suffixes whose prefix has too many. Divides the range of offsets, which
    makes prefixes longer, and yields the answers (c0, c1, low, mask) of the prefixes that fit, until the prefixes
    are whole windows. The words are read from hot at each step, and only what fits is shuffled with words."""

    def prefixes(ranges: list[tuple[int, int, int, int]], with_words: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches, 2048):
                context = np.frombuffer(b"".join(b.column("context").to_pylist()), _U).reshape(b.num_rows, left + window)
                for lo, hi, up_lo, up_hi in ranges:
                    out = [b.column("c0"), b.column("c1"), b.column("low"), pa.array(np.full(b.num_rows, lo, np.int32)), pa.array(np.full(b.num_rows, up_lo, np.int32))]
                    for x, y in ((lo, hi), (up_lo, up_hi)):  # the words that all windows of a range share
                        out += [pa.array(_key(context[:, left - x : left + window - y], salt).view(np.int64)) for salt in (7, 11)]
                    names = ["c0", "c1", "low", "a0", "b0", "p0", "p1", "q0", "q1"]
                    if with_words:
                        out.append(pa.array([w.tobytes() for w in context[:, left - hi : left + window - lo]], pa.binary()))
                        names.append("words")
                    yield pa.RecordBatch.from_arrays(out, names)

        return hot.mapInArrow(run, "c0 long, c1 long, low long, a0 int, b0 int, p0 long, p1 long, q0 long, q1 long" + (", words binary" if with_words else ""))

    def grown(key: tuple, t: pa.Table) -> pa.Table:
        words = np.frombuffer(b"".join(t.column("words").to_pylist()), _U).reshape(t.num_rows, -1)
        mask = subtree_repeats(words, t.column("low").to_numpy(), words.shape[1] - window, window) << key[1].as_py()
        return pa.table({"c0": t.column("c0"), "c1": t.column("c1"), "low": t.column("low"), "mask": pa.array(mask)})

    key, parents, large = ["a0", "p0", "p1"], [(0, left)], None
    for width in STEPS:
        ranges = [(x, min(x + width - 1, hi), lo, hi) for lo, hi in parents for x in range(lo, hi + 1, width)]
        parents = [r[:2] for r in ranges]
        asked = [prefixes(ranges, False), prefixes(ranges, True)]
        if large is not None:  # only parts of prefixes that didn't fit
            up = few(large.toDF("b0", "q0", "q1"))
            asked = [x.join(up, ["b0", "q0", "q1"], "left_semi") for x in asked]
        rows, worded = asked
        if width == 1:
            lowest = rows.groupBy(*key).agg(F.min("low").alias("lowest"))
            yield rows.select("c0", "c1", "low", *key).join(lowest, key).where("lowest < low").select("c0", "c1", "low", F.expr("shiftleft(1L, a0)").alias("mask"))
            return
        sizes = saved(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size")), "sizes")
        large = sizes.where(F.col("size") > group).select(*key)
        fitting = sizes.where(F.col("size") <= group).agg(F.sum("size")).first()[0] or 0
        groups = max(1, -(-fitting // (group * len(ranges))))
        yield (worded.join(few(large), key, "left_anti").select(F.pmod(F.xxhash64(*key), F.lit(groups)).alias("grp"), "a0", "c0", "c1", "low", "words")
               .groupBy("grp", "a0").applyInArrow(grown, "c0 long, c1 long, low long, mask long"))
        if large.isEmpty():
            return


def repeated_suffixes(docs: DataFrame, window: int, prefix: int, group: int) -> tuple[DataFrame, DataFrame]:
    """docs: id, textkey, text. Returns (texts that are copies: id, textkey) and (id, textkey, list of
    (position, mask)): windows that also start in a document with a smaller id."""
    left = window - prefix

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            n_words, k0, k1, grams_of = [], [], [], []
            for i, j, h, at in word_blocks(text_bytes(b.column("text"))):
                for k in range(j - i):
                    w = h[at[k] : at[k + 1]]
                    n_words.append(len(w))
                    x, y = words_key(w)
                    k0.append(x)
                    k1.append(y)
                    grams_of.append(np.unique(anchors(w, window, prefix)[1]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("textkey"), pa.array(n_words, pa.int64()), pa.array(k0, pa.int64()), pa.array(k1, pa.int64()), pa.array(grams_of, pa.list_(pa.int64()))],
                ["id", "textkey", "n_words", "k0", "k1", "prefixes"])

    scan = saved(docs.where("id is not null").mapInArrow(scanned, "id long, textkey long, n_words long, k0 long, k1 long, prefixes array<long>")
                 .where(f"n_words >= {window}"), "scan")
    first = scan.groupBy("k0", "k1", "n_words").agg(F.min("id").alias("first"))
    whole = saved(scan.join(first, ["k0", "k1", "n_words"]).select("id", "textkey", "prefixes", (F.col("id") > F.col("first")).alias("copy")), "whole")
    copies = whole.where("copy").select("id", "textkey").distinct()
    # anchors' prefixes that two documents share, told to the documents that hold them
    held = whole.where("not copy").select("id", "textkey", F.explode("prefixes").alias("prefix"))
    shared = held.groupBy("prefix").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("prefix")
    followed = held.join(shared, "prefix").groupBy("id", "textkey").agg(F.collect_set("prefix").alias("prefixes"))

    def followed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # a context's words are sent once by a task, now and then again
        for b in small_batches(batches):
            out: list[list] = [[] for _ in range(7)]
            wanted = b.column("prefixes").to_pylist()
            ids, keys = b.column("id").to_pylist(), b.column("textkey").to_pylist()
            for i, j, h, at in word_blocks(text_bytes(b.column("text"))):
                for k in range(j - i):
                    w = h[at[k] : at[k + 1]]
                    pos, g = anchors(w, window, prefix)
                    yes = np.isin(g.view(np.int64), np.array(wanted[i + k], np.int64))
                    pos, g = pos[yes], g[yes]
                    for c0 in range(0, len(pos), 4096):
                        p = pos[c0 : c0 + 4096]
                        context = _contexts(w, p, left, window)
                        x, y = _key(context, 3).view(np.int64).tolist(), _key(context, 5).view(np.int64).tolist()
                        for n in range(len(p)):
                            new = x[n] not in sent
                            if new:
                                sent.add(x[n])
                            values = (ids[i + k], keys[i + k], int(p[n]), int(g[c0 + n].view(np.int64)), x[n], y[n], context[n].tobytes() if new else None)
                            for column, v in zip(out, values):
                                column.append(v)
            if len(sent) > 500_000:
                sent.clear()
            names = ["id", "textkey", "at", "prefix", "c0", "c1", "context"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "context" else pa.int64()) for c, n in zip(out, names)], names)

    met = saved(docs.join(followed, ["id", "textkey"]).select("id", "textkey", "text", "prefixes")
                .mapInArrow(followed_up, "id long, textkey long, at long, prefix long, c0 long, c1 long, context binary"), "suffixes")
    # the suffixes without their words are written; the words go from the scan to the groups' tasks
    least = saved(met.groupBy("prefix", "c0", "c1").agg(F.min("id").alias("low")), "least")
    contexts = met.where("context is not null").select("prefix", "c0", "c1", "context")
    sizes = least.groupBy("prefix").agg(F.count(F.lit(1)).alias("size"))
    total = least.count()
    large = cut_lineage(sizes.where(F.col("size") > group).select("prefix"))
    groups = max(1, -(-total // group))

    def grown(key: tuple, t: pa.Table) -> pa.Table:
        context = np.frombuffer(b"".join(t.column("context").to_pylist()), _U).reshape(t.num_rows, -1)
        mask = subtree_repeats(context, t.column("low").to_numpy(), left, window)
        return pa.table({"c0": t.column("c0"), "c1": t.column("c1"), "low": t.column("low"), "mask": pa.array(mask)})

    answer = "c0 long, c1 long, low long, mask long"
    many = few(large)
    found = (contexts.join(many, "prefix", "left_anti").dropDuplicates(["c0", "c1"]).drop("prefix").join(least.join(many, "prefix", "left_anti"), ["c0", "c1"]).withColumn("grp", F.pmod(F.xxhash64("prefix"), F.lit(groups)))
             .select("grp", "c0", "c1", "low", "context").groupBy("grp").applyInArrow(grown, answer))

    answers = found
    if not large.isEmpty():
        hot = saved(contexts.join(many, "prefix", "left_semi").dropDuplicates(["c0", "c1"]).drop("prefix")
                    .join(least.join(many, "prefix", "left_semi"), ["c0", "c1"]).select("c0", "c1", "low", "context"), "hot")
        for part in longer_prefixes(hot, left, window, group):
            answers = answers.unionByName(part)
        answers = answers.groupBy("c0", "c1", "low").agg(F.bit_or("mask").alias("mask"))
    every = (1 << (left + 1)) - 1
    spans = (met.select("id", "textkey", "at", "c0", "c1").join(answers, ["c0", "c1"])
             .withColumn("mask", F.when(F.col("id") > F.col("low"), F.lit(every)).otherwise(F.col("mask"))).where("mask <> 0")
             .groupBy("id", "textkey").agg(F.collect_list(F.struct("at", "mask")).alias("spans")))
    return copies, spans


def remove_repeats(documents: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: the words kept, joined by one space."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("textkey"), F.col(text_col).alias("text"))
    copies, spans = repeated_suffixes(docs, window, prefix, group)
    left = window - prefix
    marked = (docs.join(spans, ["id", "textkey"], "left").join(copies.withColumn("copy", F.lit(True)), ["id", "textkey"], "left")
              .select("id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), F.col("spans.at").alias("at"), F.col("spans.mask").alias("mask")))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            copy, at, mask = (b.column(c).to_pylist() for c in ("copy", "at", "mask"))
            n_words, n_removed, texts = [], [], []
            for k, text in enumerate(text_bytes(b.column("text"))):
                words = (text or b"").split()
                gone = 0
                if copy[k]:
                    gone, words_kept = len(words), []
                elif at[k]:
                    cover = _spread(np.array(mask[k], np.int64), np.array(at[k], np.int64), len(words), window, left)
                    gone = int(cover.sum())
                    words_kept = [w for w, c in zip(words, cover.tolist()) if not c]
                else:
                    words_kept = words
                n_words.append(len(words))
                n_removed.append(gone)
                texts.append(b" ".join(words_kept))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept_text"])

    return marked.mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept_text string")


def repeats_digest(documents: DataFrame) -> DataFrame:
    out = remove_repeats(documents)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
