"""File-backed sources: listings, ordered log lines, whole small text files.

* ``list_files`` (S-6, S-8, S-9): ``binaryFile`` with only path / length /
  modificationTime selected — the content column is pruned, so nothing is read
  but file metadata.
* ``read_lines`` (S-7): ``read.text`` with the file identity and an order key
  that needs no global numbering: (``_metadata.file_block_start``,
  ``monotonically_increasing_id``) — rows of one split are produced in file
  order and splits of one file are ordered by their start offset. Large logs
  are split across partitions like any text input.
* ``write_ordered_text`` / ``read_ordered_text`` (S-18, S-7): a text file too large
  for one task as a folder of part files, whose names are in row order.
* ``write_text_folders`` / ``read_text_folders`` (S-18, S-7): the same where there are
  very many folders: tasks write, list and open them, not the driver.
* ``read_whole`` (S-10, S-13, S-17): whole small config files (``binaryFile`` content).
"""

from __future__ import annotations

import itertools
import os
import re
import shutil
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, parent, length, mod_time seconds as double, mod_dt) of every file."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path).select("path", "length", "modificationTime")
    return df.select(
        F.regexp_replace("path", "^file:", "").alias("path"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.element_at(F.split("path", "/"), -2).alias("parent"),
        F.col("length"),
        (F.unix_micros("modificationTime") / F.lit(1e6)).alias("mod_time"),
        F.col("modificationTime").alias("mod_dt"))


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, block_start, seq, line): ``orderBy(block_start, seq)`` within a
    path is file order."""
    df = spark.read.text(paths)
    return df.select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:", "").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"))


def write_ordered_text(rows: DataFrame, path: str, keys: list[str], order: list[str], line: str = "line", partitions: int | None = None) -> None:
    """S-18: rows as text, one folder per ``keys``, lines in ``order``.

    Rows are range-partitioned by (keys, order) and sorted there, so a folder's part
    files taken by number are its lines in order. A folder that holds a large share of
    all lines is written by several tasks; small folders share one. ``keys`` are not
    null or empty; a line may hold line feeds and is then several lines of the file."""
    (_in_file_order(rows, keys, order, partitions).select(*keys, line)
     .write.partitionBy(*keys).option("lineSep", "\n").text(path))


def _in_file_order(rows: DataFrame, keys: list[str], order: list[str], partitions: int | None) -> DataFrame:
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)


FILE_ORDER = ["part", "block_start", "seq"]


def read_ordered_text(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """S-7: the lines of ``write_ordered_text`` folders: keys, FILE_ORDER, line.

    Files are split like any text input. Within a folder, ordering by FILE_ORDER - number
    of the part file, start of the split, row of the split - is file order. The keys are
    folder names, so a filter or join on them skips the other folders' files."""
    schema = ", ".join(["value string", *(f"`{k}` string" for k in keys)])
    df = spark.read.schema(schema).option("lineSep", "\n").text(path)
    return df.select(
        *keys, F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint").alias("part"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"      # Spark's folder name of a null or empty value
ESCAPED = r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""  # characters that Spark writes as %XX in a folder's name
READ_BYTES = 1 << 22
BATCH_LINES = 1 << 16


def _local(path: str) -> str:
    return "/" + path.removeprefix("file:").strip("/")


def write_text_folders(rows: DataFrame, path: str, keys: list[str], order: list[str], line: str = "line", partitions: int | None = None) -> None:
    """S-18: the folders of ``write_ordered_text``, where there are very many.

    Under a ``file:`` path each task writes its part files itself: Spark's committer moves every folder more than once,
    one after the other on the driver, and its local files need a process each for their rights. A part file gets
    its name when it is whole, so an attempt that fails or runs twice spoils nothing; the folder gets its own when all
    tasks are done. Other paths are written by Spark."""
    if not path.startswith("file:"):
        return write_ordered_text(rows, path, keys, order, line, partitions)
    target = _local(path)
    staged = os.path.join(os.path.dirname(target), f".{os.path.basename(target)}-{uuid.uuid4().hex}")
    if os.path.exists(target):
        raise FileExistsError(target)
    os.makedirs(staged)

    def name(key: str, value: str) -> str:
        return f"{key}={re.sub(ESCAPED, lambda c: f'%{ord(c[0]):02X}', value) if value else NO_VALUE}"

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, draft = f"part-{task.partitionId():05d}.txt", f".part-{task.partitionId():05d}-{task.taskAttemptId()}"
        folder, out, n = None, None, 0

        def done() -> None:
            if out:
                out.close()
                os.rename(f"{folder}/{draft}", f"{folder}/{part}")

        for b in batches:
            if not b.num_rows:
                continue
            *values, lines = [pc.fill_null(c.cast(pa.large_string()), "") for c in b.columns]
            text = pc.binary_join_element_wise(lines, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
            at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
            data = memoryview(text.buffers()[2])
            new = np.ones(b.num_rows, bool)
            new[1:] = False
            for v in values:
                new[1:] |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(new)
            for value, i, j in zip(zip(*[v.take(pa.array(first)).to_pylist() for v in values]), at[first].tolist(), at[[*first[1:], b.num_rows]].tolist()):
                at_value = "/".join([staged, *map(name, keys, value)])
                if at_value != folder:
                    done()
                    folder, n = at_value, n + 1
                    try:
                        os.mkdir(folder)
                    except OSError:  # another task made it, or the folder above isn't there
                        os.makedirs(folder, exist_ok=True)
                    out = open(f"{folder}/{draft}", "wb", buffering=0)
                left = data[i:j]
                while left:
                    left = left[out.write(left) :]
        done()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    for k in keys:  # one order for what shares a folder
        rows = rows.withColumn(k, F.when(~F.col(k).isin("", NO_VALUE), F.col(k)))
    placed = _in_file_order(rows, keys, order, partitions).select(*[F.col(c).cast("string") for c in (*keys, line)])
    try:
        placed.mapInArrow(written, "files long").agg(F.sum("files")).collect()
        open(f"{staged}/_SUCCESS", "w").close()
        os.rename(staged, target)
    except BaseException:
        shutil.rmtree(staged, ignore_errors=True)
        raise


def read_text_folders(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """S-7: the rows of ``read_ordered_text``, where there are very many folders.

    Under a ``file:`` path one task lists the names of the first key, and tasks list and read their share of the
    folders; Spark would hold all folders and files on the driver. A part file is read by one task, piece by piece, and
    all folders are read whatever is filtered. Other paths are read by Spark."""
    if not path.startswith("file:"):
        return read_ordered_text(spark, path, keys)
    root, n = _local(path), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder in b.column(0).to_pylist():
                with os.scandir(folder) as found:
                    paths = (e.path for e in found if not e.name.startswith(("_", ".")))
                    while some := [*itertools.islice(paths, BATCH_LINES)]:
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["path"])

    def pieces(file: str) -> Iterator[tuple[int, list[bytes]]]:
        """(where it begins, lines) of a file's pieces of about READ_BYTES."""
        with open(file, "rb", buffering=0) as f:
            at, rest = 0, b""
            while data := f.read(READ_BYTES):
                data = rest + data
                *some, rest = data.split(b"\n")
                if some:
                    yield at, some
                at += len(data) - len(rest)
            if rest:
                yield at, [rest]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, counts, starts, lines = [], [], [], []  # of each piece: key values and part, number of lines, begin

        def batch() -> pa.RecordBatch:
            k = np.array(counts, np.int64)
            again = np.repeat(np.arange(len(k)), k)
            columns = [pa.array([x[i] for x in of], pa.string()).take(pa.array(again)) for i in range(len(keys))]
            columns += [pa.array([x[-1] for x in of], pa.int64()).take(pa.array(again)), pa.array(np.array(starts, np.int64)[again]),
                        pa.array(np.arange(len(lines)) - (np.cumsum(k) - k)[again])]
            as_text = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
            return pa.RecordBatch.from_arrays([*columns, pc.cast(pa.array(lines, pa.binary()), options=as_text)], [*keys, *FILE_ORDER, "line"])

        for b in batches:
            for file in b.column(0).to_pylist():
                *folders, file_name = file[len(root) + 1 :].split("/")
                part = re.match(r"part-(\d+)", file_name)
                values = [None if v == NO_VALUE else unquote(v) for v in (f.partition("=")[2] for f in folders)]
                for at, some in pieces(file):
                    of.append((*values, int(part[1]) if part else None))
                    counts.append(len(some))
                    starts.append(at)
                    lines += some
                    if len(lines) >= BATCH_LINES:
                        yield batch()
                        for x in (of, counts, starts, lines):
                            x.clear()
        if lines:
            yield batch()

    paths = spark.createDataFrame([(root,)], "path string").coalesce(1).mapInArrow(listed, "path string").repartition(n, "path")
    for _ in keys:  # the folders of the next key, at last the files
        paths = paths.mapInArrow(listed, "path string")
    return paths.mapInArrow(read, ", ".join([*(f"`{k}` string" for k in keys), "part long, block_start long, seq long, line string"]))


def list_ordered_text(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """S-6: keys, filesize and mod_time (newest part) of every ``write_ordered_text``
    folder, from file metadata alone."""
    of = lambda k: F.url_decode(F.replace(F.regexp_extract("path", f"/{k}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    return (list_files(spark, path, recursive=True).select(*[of(k).alias(k) for k in keys], "length", "mod_time")
            .groupBy(*keys).agg(F.sum("length").alias("filesize"), F.max("mod_time").alias("mod_time")))


def read_whole(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, name, text) — one row per (small) file, byte-exact (``binaryFile``
    content decoded as UTF-8; ``wholetext`` would drop a final newline)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    p = F.regexp_replace("path", "^file:", "")
    return df.select(p.alias("path"), F.element_at(F.split(p, "/"), -1).alias("name"),
                     F.decode("content", "UTF-8").alias("text"))
