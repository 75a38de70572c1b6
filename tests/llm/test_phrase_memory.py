"""What a task of phrase mining holds."""

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from tillroll.llm import phrase_mining
from tillroll.llm.common import shared_folder

MERGE = """
import resource
import numpy as np, pyarrow as pa
from tillroll.llm import phrase_mining

rng, tables, n = np.random.default_rng(1), [], 1 << 15
for k in range(9):
    phrases = pa.array([f"word{a} word{b}" for a, b in rng.integers(0, 60000, (n, 2))])
    sides = pa.array(np.where(rng.random(n) < 0.5, "", "beside").tolist())
    columns = [pa.array(["en"] * n), pa.array(np.full(n, 2, np.int32)), phrases, pa.array(np.ones(n, np.int64)), sides, sides]
    tables.append(pa.table(columns, names=["lang", "size", "phrase", "n", "left", "right"]))
phrase_mining._merged([t.slice(0, 10) for t in tables])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert phrase_mining._merged(tables)["n"].to_numpy().sum() == 9 * n
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""


def test_adding_up_phrases_takes_little_more_than_the_phrases():
    root = str(Path(phrase_mining.__file__).parents[2])
    said = subprocess.run([sys.executable, "-c", MERGE], cwd=root, capture_output=True, text=True, check=True, timeout=120)
    # 20 MB of phrases: over 150 MB with one text a side, phrase and thread, whatever the number of threads.
    assert float(said.stdout) < 110


def test_sides_of_phrases_that_are_added_up():
    def table(phrase, n, left, right):
        return pa.table(
            [["en"], pa.array([2], pa.int32()), [phrase], pa.array([n]), [left], [right]],
            names=["lang", "size", "phrase", "n", "left", "right"],
        )

    tables = [table("a b", 1, "x", ""), table("a b", 2, "x", "y"), table("c d", 5, "x", "z"), table("c d", 1, "w", "z")]
    rows = {r["phrase"]: r for r in phrase_mining._merged(tables).to_pylist()}
    assert rows["a b"] == {"lang": "en", "size": 2, "phrase": "a b", "n": 3, "left": "x", "right": ""}
    assert rows["c d"] == {"lang": "en", "size": 2, "phrase": "c d", "n": 6, "left": "", "right": "z"}


def test_phrases_come_in_slices(spark, monkeypatch):
    docs = [(f"a b c d{i % 7} e f", "en") for i in range(300)] + [("g h g h i", None)] * 20
    df = spark.createDataFrame(docs, "text string, lang string")
    shards = phrase_mining.pack(df, shard_words=400).toArrow().to_batches(max_chunksize=1)
    everything = [type("Field", (), {"value": bytes_of_ones})() for bytes_of_ones in [phrase_mining.np.full(1 << 12, 255, "u1")] * 3]

    def found():
        batches = list(phrase_mining._phrases(everything, 5)(iter(shards)))
        rows = phrase_mining._merged([pa.Table.from_batches(batches)]).to_pylist()
        return sorted(map(repr, rows)), max(b.num_rows for b in batches)

    whole, _ = found()
    monkeypatch.setattr(phrase_mining, "SLICE_PHRASES", 3)
    monkeypatch.setattr(phrase_mining, "HELD_PHRASES", 8)
    sliced, most = found()
    assert sliced == whole and most <= 3


def test_shards_lie_in_row_groups_of_a_few(spark):
    docs = spark.range(400).selectExpr("concat('some words of text ', id) AS text", "'en' AS lang").coalesce(1)
    shards = phrase_mining.pack(docs, shard_words=50)
    groups = []
    for file in shards.inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        groups += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert shared_folder(spark) and sum(groups) > 20 and max(groups) <= phrase_mining.GROUP_SHARDS


def test_many_languages_do_not_hold_a_shard_each():
    langs = [f"l{i}" for i in range(200)]
    given = []

    def batches():
        for k in range(10):
            given.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array([b"one two three"] * 200, pa.binary())], ["lang", "text"])

    words = 0
    for row in phrase_mining._pack(100)(batches()):
        words += len(row.column("tokens")[0].as_py()) // 4
        # Four words a text with its cut; what is open stays below four shards and one text.
        assert given[-1] == 9 or 4 * 200 * len(given) - words <= 4 * 200 + (4 * 100 + 4)
    assert words == 10 * 200 * 4
