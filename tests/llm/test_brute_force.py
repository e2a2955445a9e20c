"""Decontamination against whole alignment tables, encoding on Spark against the library, operators whose workers
can't import the package."""

import os
import random
import subprocess
import sys
import tracemalloc

import numpy as np

from matchbook.llm import decontaminate, sentencepiece

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def edits(item, text, anywhere):
    """Edit distance of ``item`` to ``text``, or to its nearest region."""
    row = np.zeros(len(text) + 1, int) if anywhere else np.arange(len(text) + 1)
    for i, c in enumerate(item):
        best = np.concatenate([[row[0] if anywhere else i], np.minimum(row[:-1] + (text != c), row[1:] + 1)])
        best[0] = i + 1
        row = np.minimum.accumulate(best - np.arange(len(row))) + np.arange(len(row))
    return int(row.min() if anywhere else row[-1])


def regions(text, items):
    data = np.frombuffer(text.encode(), np.uint8)
    found = decontaminate.opened(decontaminate.indexes(items, decontaminate.EDIT_RATE))
    return {i: got for _, i, *got in decontaminate.scan(data, np.array([0, len(data)]), found)}


def check(text, items):
    plain = decontaminate.normal(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
    got = regions(text, items)
    for i, item in items:
        target = decontaminate.normal_text(item)
        best = edits(target, plain, True)
        assert (best <= int(decontaminate.EDIT_RATE * len(target))) == (i in got), (item, text)
        if i in got:
            assert got[i][0] == best == edits(target, plain[got[i][1] : got[i][2]], False)


def test_decontamination_of_a_whole_table(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rng = random.Random(4)
    for text in rng.sample([t for t in texts if len(t) < 4000], 60):
        check(text, rng.sample(items, 8))
    assert sum(len(regions(t, items)) for t in texts) > 0


def test_decontamination_of_random_and_periodic_texts(monkeypatch):
    rng = random.Random(1)
    for trial in range(200):
        letters = rng.choice(["ab", "abc d", "abcdefgh "])
        unit = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        item = (unit * 60)[: rng.randint(12, 60)] if trial % 2 else "".join(rng.choice(letters) for _ in range(rng.randint(12, 60)))
        text = list((unit * 60)[: rng.randint(10, 150)] if trial % 3 else "x" * rng.randint(0, 30) + item + "y" * rng.randint(0, 30))
        for _ in range(rng.randint(0, 8)):
            text[rng.randrange(len(text))] = rng.choice(letters)
        if len(decontaminate.normal_text(item)) >= decontaminate.MIN_CHARS:
            monkeypatch.setattr(decontaminate, "PAIRS", rng.choice([7, 1 << 20]))
            check("".join(text), [(1, item)])


def test_decontamination_of_long_periodic_texts_is_bounded():
    item = list("abcdefghij" * 40)
    item[::40] = "Z" * 10
    tracemalloc.start()
    got = regions("abcdefghij" * 12_000, [(1, "".join(item)), (2, "-" * 400)])
    assert got == {1: [10, 0, 400]} or got[1][0] == 10 and 2 not in got
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()


def test_short_items_stand_word_for_word():
    items = [(1, "Tiny one"), (2, "42"), (3, " "), (4, "é")]
    assert set(regions("a tiny  ONE, 142 42x é", items)) == {1, 4}
    assert set(regions("42", items)) == {2}
    assert set(regions("tiny oneself", items)) == set()


def test_encoding_on_spark_equals_the_library(spark, docs):
    import sentencepiece as library

    whole = library.SentencePieceProcessor(model_file=sentencepiece.default_model())
    rng = random.Random(2)
    odd = ["x" * 3000, "漢字" * 700, " " * 900, "no" + " spaces" * 600 + "\n" * 40, "".join(rng.choice("abc é\n") for _ in range(5000)), "▁own ▁▁marks▁" * 90]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(700 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    want = {}
    for i, t in ((r.doc_id, r.text) for r in frame.collect()):
        if "▁" not in (t or ""):  # the library takes such a marker for a space
            want.setdefault(i, []).append(whole.encode(t or ""))
    got = {}
    for r in sentencepiece.encode(frame, size=256, giant=512).filter("doc_id <> 705 or doc_id is null").collect():
        got.setdefault(r.doc_id, []).append(list(r.ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    back = {r.doc_id: r.text for r in sentencepiece.decode(sentencepiece.encode(frame, size=256, giant=512)).collect() if r.doc_id and r.doc_id >= 700}
    assert back == {700 + i: t for i, t in enumerate(odd)}


FOREIGN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).config("spark.executorEnv.PYTHONPATH", "").getOrCreate()
from matchbook.llm import queries
from matchbook.llm.common import table
docs = spark.read.parquet({data!r} + "/documents.parquet").limit(40)
from matchbook.llm import alignment, decontaminate, lexical_search, sentencepiece, simhash
bench = table(spark, {data!r}, "benchmark")
print("ROWS", sentencepiece.encoded_digests(docs).count(), decontaminate.keep_clean(docs, bench).count() > 0, decontaminate.matches(docs, bench).count() >= 0,
      alignment.align(docs).count(), simhash.simhash_dedup(docs).count(), lexical_search.lexical_search(docs, bench).count() > 0)
spark.stop()
"""


def test_workers_need_no_installed_package(tmp_path):
    """Started from another folder, with executors whose Python path is empty."""
    script = tmp_path / "job.py"
    script.write_text(FOREIGN.format(root=ROOT, folder=str(tmp_path / "shared"), data=SMALL))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert "ROWS 40 True True 40 40 True" in done.stdout, done.stderr[-3000:]
