"""Packing, sharding, the queries and the pipeline."""

import collections
import os
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa

import __spark_entry__ as entry
import corpus_pipeline
from opsframe.llm import packing, queries, shard
from tests.conftest import SF
from tests.llm import cases


def check_packed(out, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.defaultdict(list)
    for d, x in docs:
        want[d].append(np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4"))
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    for d, texts in want.items():
        assert sum(p[1] for p in pieces[d]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for start, length, crc, total in sorted(pieces[d]):
                assert start == at and total == len(texts[0]) and crc == zlib.crc32(texts[0][at : at + length].tobytes())
                at += length
    assert set(want) == set(pieces)
    return sequences


def test_packing(spark):
    docs = cases.documents(spark)
    out = packing.pack(docs.repartition(7)).collect()
    sequences = check_packed(out, [(r.doc_id, r.text) for r in docs.collect()])
    total = sum(r.length for r in out)
    assert total > 0.97 * packing.WINDOW * (len(sequences) - 1)


def test_packing_many_partitions(spark):
    """Leftovers of more partitions than one merge takes are merged in rounds."""
    docs = cases.documents(spark)
    out = packing.pack(docs.repartition(40), open_windows=4).collect()
    sequences = check_packed(out, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.length for r in out) > 0.95 * packing.WINDOW * (len(sequences) - 1)


def test_packing_edges(spark):
    check_packed(packing.pack(cases.edges(spark)).collect(), [e[:2] for e in cases.EDGES])
    assert packing.pack(cases.empty(spark)).count() == 0


def test_runs_tokenise_like_whole_texts():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    rng, marks = random.Random(1), "aAbé'sS.,!? \n\t\r\x0b\x1ćİßΣς<|endoftext|>1²　中\U0001f600"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(60))) for _ in range(1500)] + [None, "", "x" * 300 + ". y"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = list(packing.Tokens("word_bpe_49k.json")(texts))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_letters_are_tokenised_many_together():
    import random

    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcdeéßñσя") for _ in range(rng.randrange(1, 9))) for _ in range(6000)})
    t = packing.Tokens("word_bpe_49k.json")
    encode, asked = t.encode, []
    t.encode = lambda runs, **k: asked.extend(runs) or encode(runs, **k)
    got = list(t([" ".join(words), None, " ".join(reversed(words)), "x" * 100]))
    assert len(asked) < len(words) / 16
    one = {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(words, encode(words, add_special_tokens=False))}
    assert got[:3] == [b"".join(one[w] for w in words), b"", b"".join(one[w] for w in reversed(words))]
    assert len(got[3]) > 0 and "x" * 100 not in t.known  # long runs are not remembered


def test_texts_come_in_batches_of_bounded_size():
    texts = ["a" * n for n in (3 * packing.BATCH_BYTES // 4, packing.BATCH_BYTES // 2, 2 * packing.BATCH_BYTES, 1, 0)] + [None] * packing.BATCH_ROWS
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    parts = list(packing.even_batches(iter([batch.slice(0, 0), batch])))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert [p.num_rows for p in parts][:3] == [1, 1, 1] and max(p.num_rows for p in parts) <= packing.BATCH_ROWS


def test_sharding(spark):
    for df in (cases.documents(spark), cases.edges(spark)):
        out = shard.shard_digest(df).collect()
        want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
        slots = collections.defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        counts = [len(slots[s]) for s in range(24)]
        assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(24))
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert shard.shard_digest(cases.empty(spark)).count() == 0


def test_shuffle_is_repeatable_and_even(spark):
    docs = cases.documents(spark)
    a, b = (cases.rows(shard.two_pass_shuffle(docs.repartition(n), 4, bucket_mb=1).select("doc_id", "shard", "slot")) for n in (3, 5))
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(cases.rows(shard.two_pass_shuffle(docs, 4, seed=1).select("doc_id", "shard", "slot")))
    order = [d for d, _, _ in sorted(a, key=lambda r: r[1:])]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.25
    counts = np.zeros((6, 6))
    for seed in range(3000):
        for i, x in enumerate(shard._swaps(6, np.random.default_rng(seed))):
            counts[i, x] += 1
    assert counts.min() > 400 and counts.max() < 600


def test_written_shards(spark, tmp_path):
    out = shard.two_pass_shuffle(cases.edges(spark), 3)
    assert set(cases.edges(spark).columns) | {"slot"} == set(out.columns)
    shard.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(cases.EDGES) and back.select("shard").distinct().count() == 3


def test_pipeline(spark):
    docs = cases.documents(spark).unionByName(spark.createDataFrame(cases.EDGES, cases.SCHEMA))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "personal_data", "packing"]
    before, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, SF).collect(), cases.SCHEMA)
        assert after.columns == docs.columns and 0 < after.count() <= before.count()
        kept.append(after.count())
        before = after
    texts = {r.doc_id: r.text for r in before.collect()}
    assert 1001 not in texts and 1011 not in texts and 1009 not in texts and 1008 in texts
    assert not any("@mail" in t for t in texts.values())
    assert all(r.n_chars == len(r.text) for r in before.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in last.collect()} == set(texts)


def test_stages_judge_rows(spark, tmp_path):
    """Without labels texts stay; leaks go by row, also without an id or beside a clean text of the same id."""
    docs = cases.documents(spark)
    plain = docs.withColumn("lang", cases.F.lit(None).cast("string"))
    letters = sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())
    assert corpus_pipeline.language(spark, plain, SF).count() == letters > 0
    assert corpus_pipeline.language(spark, cases.empty(spark), SF).count() == 0
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, item, "en", "s", 0), (7, item, "en", "s", 0), (7, "clean words " * 30, "en", "s", 0), (None, "other clean words " * 20, "en", "s", 0), (8, None, "en", "s", 0)]
    both = docs.unionByName(spark.createDataFrame(rows, cases.SCHEMA))
    left = corpus_pipeline.benchmark(spark, both, SF)
    assert left.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert all((r[0], r[1]) not in kept for r in rows[:2]) and all((r[0], r[1]) in kept for r in rows[2:])


def test_queries_run(spark):
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, len(queries.QUERIES) + 1))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_entry_without_the_folder(tmp_path):
    """The rest still imports and registers its queries when this part is deleted."""
    import shutil

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "opsframe"), tmp_path / "opsframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 60 and not any(x.startswith('op') and x[2].isdigit() or x == 'pipeline' for x in n); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
