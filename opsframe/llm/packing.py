"""Packing token sequences: bounded-space online best fit, then merging of leftovers.

Texts are tokenised in whole, with an end token. In each partition at most ``open_windows`` windows are
open. A piece goes to the open window it fits most tightly; when it fits none, the fullest is emitted -
first topped up with the piece's head if at least ``min_cut`` tokens fit - and the rest is placed again.
Documents longer than a window give full windows first. What is still open at a partition's end is
merged by the same rule in rounds over groups of partitions, so no task sees more than a fixed number
of open windows, and pieces are never cut again there.

Null and empty texts are one end token. Rows that share an id are packed as separate documents. An empty
table gives no rows. Only the id and text columns are read.

The tokenizer drops white space, so a run without spaces, tabs or line ends is tokenised by itself, once for
a batch of texts, and its ids are remembered per worker (at most about 2 * CACHE_WORDS runs).
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.common import saved, small_batches

TOKENIZER = "word_bpe_49k.json"
END = 2
WINDOW = 4096
OPEN_WINDOWS = 32
MIN_CUT = 16
MERGE = 16
CACHE_WORDS = 400_000
LONG_RUN = 64
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20
TOGETHER = 64
WORD_END = "</w>"
MARKS = frozenset(".,;:!?")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokens:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.encode = tokenizer.encode_batch_fast
        vocab = tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for x, i in vocab.items() if x.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        for c in "\n\t\r":
            column = pc.replace_substring(column, c, " ")
        runs = pc.split_pattern(column, " ")
        coded = runs.flatten().dictionary_encode()  # a run is looked up once for all texts
        ids, places, at = self.looked_up(coded.dictionary.to_pylist()), coded.indices.to_numpy(), 0
        for n in pc.list_value_length(runs).to_pylist():
            yield b"".join(map(ids.__getitem__, places[at : at + n].tolist()))
            at += n

    def looked_up(self, runs: list[str]) -> list[bytes]:
        """The ids of each of these different runs."""
        if len(self.known) > CACHE_WORDS:  # a new generation; runs met again move over from the old one
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        ids = list(map(known.get, runs))
        new = [w for w, i in zip(runs, ids) if i is None]
        now = {w: older[w] for w in new if w in older} if older else {}
        # letters and one mark after them are tokenised apart by the tokenizer too
        # (if what its normalisation makes of them are letters)
        stems = {w: w[:-1].lower() if w.isascii() else w[:-1] for w in new
                 if w not in now and w[-1:] in MARKS and w[:-1].isalpha() and (w.isascii() or unicodedata.normalize("NFC", w[:-1]).lower().isalpha())}
        ask = {w for w in new if w not in stems}.union(stems.values(), (w[-1] for w in stems))
        now.update([(w, known[w]) for w in ask if w in known])
        now |= self.encoded([w for w in ask if w not in now])
        now.update([(w, now[x] + now[w[-1]]) for w, x in stems.items()])
        known.update([(w, i) for w, i in now.items() if len(w) <= LONG_RUN + 1])
        return [now[w] if i is None else i for w, i in zip(runs, ids)]

    def encoded(self, runs: list[str]) -> dict[str, bytes]:
        """Runs of letters are encoded many at a time: to the tokenizer each is one word, of whose tokens only the last
        ends a word. Where the ends don't tell them apart, and with other characters, each is encoded by itself."""
        out: dict[str, bytes] = {}
        letters = [w for w in runs if w.isalpha()]
        parts = [letters[i : i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        for part, e in zip(parts, self.encode([" ".join(x) for x in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.is_end[ids]) + 1)).tolist()
            data = ids.tobytes()
            if len(ends) == len(part) and ends[-1] == len(data):
                out.update((w, data[a:b]) for w, a, b in zip(part, [0, *ends], ends))
        rest = [w for w in runs if w not in out]
        out.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(rest, self.encode(rest, add_special_tokens=False)))
        return out


def even_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most BATCH_ROWS rows and about BATCH_BYTES bytes of text in the second column, a text at least."""
    for b in small_batches(batches, BATCH_ROWS):
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH_BYTES, "right")))
            yield b.slice(at, end - at)
            at = end


_tokens: dict[str, Tokens] = {}


def tokens(name: str) -> Tokens:
    if name not in _tokens:
        _tokens[name] = Tokens(name)
    return _tokens[name]


class Packer:
    """Open windows of one partition; closed ones are handed to ``out`` as lists of pieces."""

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most
        self.open: dict[int, list] = {}
        self.used: dict[int, int] = {}
        self.made = 0

    def fit(self, length: int) -> int | None:
        best, room = None, self.window + 1
        for k, u in self.used.items():
            r = self.window - u
            if length <= r < room:
                best, room = k, r
        return best

    def start(self) -> int:
        self.made += 1
        self.open[self.made], self.used[self.made] = [], 0
        return self.made

    def put(self, k: int, piece: tuple, length: int) -> list | None:
        self.open[k].append(piece)
        self.used[k] += length
        return self.close(k) if self.used[k] == self.window else None

    def fullest(self) -> int:
        return max(self.used, key=lambda k: (self.used[k], -k))

    def close(self, k: int) -> list:
        del self.used[k]
        return self.open.pop(k)

    def place(self, length: int) -> tuple[int, list | None]:
        """The window for a piece that is not cut, and the window emitted for it."""
        k, gone = self.fit(length), None
        if k is None:
            if len(self.used) >= self.most:
                gone = self.close(self.fullest())
            k = self.start()
        return k, gone


def _rows(windows: list[tuple[int, bool, list]]) -> pa.RecordBatch:
    """windows: (sequence id, still open, pieces of (doc_id, start, length, crc, doc_tokens))."""
    cols: list[list] = [[] for _ in range(8)]
    for sid, is_open, pieces in windows:
        at = 0
        for p in pieces:
            for c, v in zip(cols, (*p, sid, at, is_open)):
                c.append(v)
            at += p[2]
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n == "open" else pa.int64()) for c, n in zip(cols, names)], list(names))


def pack_tokens(docs: Iterator[tuple[int, bytes]], base: int, window: int, most: int, min_cut: int) -> Iterator[tuple[int, bool, list]]:
    packer, serial = Packer(window, most), 0

    def emit(pieces: list) -> tuple[int, bool, list]:
        nonlocal serial
        serial += 1
        return base + serial, False, pieces

    for doc_id, data in docs:
        total, at = len(data) // 4, 0

        def piece(n: int):
            return doc_id, at, n, zlib.crc32(data[4 * at : 4 * (at + n)]), total

        while at < total:
            rest = total - at
            if rest >= window:
                yield emit([piece(window)])
                at += window
                continue
            k = packer.fit(rest)
            if k is None and len(packer.used) >= packer.most:
                full = packer.fullest()
                room = window - packer.used[full]
                if room >= min_cut:
                    packer.open[full].append(piece(room))
                    at += room
                yield emit(packer.close(full))
                continue
            k = packer.start() if k is None else k
            if gone := packer.put(k, piece(rest), rest):
                yield emit(gone)
            at = total
    for k in list(packer.open):
        serial += 1
        yield base + serial, True, packer.close(k)


def merge_pieces(pieces: list[tuple], base: int, window: int, most: int) -> Iterator[tuple[int, bool, list]]:
    """Leftover pieces, longest first, by the same rule without cutting."""
    packer, serial = Packer(window, most), 0
    for p in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0], p[1], p[3])):
        k, gone = packer.place(p[2])
        full = packer.put(k, p, p[2])
        for g in (gone, full):
            if g:
                serial += 1
                yield base + serial, False, g
    for k in list(packer.open):
        serial += 1
        yield base + serial, True, packer.close(k)


def pack(documents: DataFrame, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT,
         tokenizer: str = TOKENIZER, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tail = np.array([end], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokens(tokenizer)

        def docs():
            for b in even_batches(batches):
                for i, data in zip(b.column(0).to_pylist(), encode(b.column(1))):
                    yield i, data + tail

        held: list = []
        for w in pack_tokens(docs(), (TaskContext.get().partitionId() + 1) << 40, window, open_windows, min_cut):
            held.append(w)
            if len(held) >= 200:
                yield _rows(held)
                held = []
        yield _rows(held)

    def merger(level: int):
        def merged(key: tuple, rows: pa.Table) -> pa.Table:
            cols = [rows.column(c).to_pylist() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            # ids of merged sequences lie below those of the first round, by level and group
            base = (key[0].as_py() + 1 - (level << 18)) << 40
            return pa.Table.from_batches([_rows(list(merge_pieces(list(zip(*cols)), base, window, open_windows)))])

        return merged

    first = saved(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                  .mapInArrow(packed, f"{PIECES}, open boolean"), "packed")
    done, left, level = [first.where("not open").drop("open")], first.where("open"), 0
    groups = left.agg(F.countDistinct(F.shiftright("sequence_id", 40))).first()[0]
    while groups:  # each round joins MERGE groups of at most open_windows windows
        level += 1
        one = groups <= MERGE
        part = F.pmod(F.shiftright("sequence_id", 40), F.lit(-(-groups // MERGE))).cast("int")
        grouped = left.withColumn("grp", F.lit(0) if one else part)

        after = saved(grouped.groupBy("grp").applyInArrow(merger(level), f"{PIECES}, open boolean"), "merged")
        done.append((after if one else after.where("not open")).drop("open"))
        left = after.where("open")
        groups = 0 if one else -(-groups // MERGE)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
