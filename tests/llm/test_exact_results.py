"""Measurements, budgets, tokens and archives against plain versions, libraries and round trips."""

import hashlib
import itertools
import random
import tracemalloc
import zipfile

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import bpe, mixing, quality_rules, warc_zip
from tillroll.llm.common import scratch, staged


def test_measurements(docs, messy, no_docs):
    ledger = quality_rules.ledger(docs)
    got = ledger.select("doc_id", *quality_rules.MEASURES[:5]).collect()
    assert brute.ordered(got) == brute.ordered((d, *brute.measures(t)) for d, t in messy)
    assert quality_rules.ledger(no_docs).count() == 0


def test_policies_and_ablation(docs):
    ledger = staged(quality_rules.ledger(docs), "ledger")
    rows = ledger.collect()
    for policy, rules in quality_rules.POLICIES.items():
        mask = quality_rules.mask(policy)
        kept = sum(r.fail_bits & mask == 0 for r in rows)
        assert quality_rules.apply_policy(ledger, policy).filter("kept").count() == kept
        for found in quality_rules.ablation(ledger, policy).collect():
            bit = quality_rules.BITS[found.rule]
            assert found.kept == kept and found.failed == sum(bool(r.fail_bits & bit) for r in rows)
            assert found.failed_alone == sum(r.fail_bits & mask == bit for r in rows)
        assert {r.rule for r in quality_rules.ablation(ledger, policy).collect()} == set(rules)


def test_subset_sum_is_the_best_reachable():
    rng = np.random.default_rng(4)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 30, 5))
        available = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(0, 120))
        sums = {sum(k * x for k, x in zip(ks, lengths)) for ks in itertools.product(*[range(a + 1) for a in available])}
        taken = mixing.subset_sum(lengths, available, budget)
        assert (taken <= available).all() and (taken >= 0).all()
        assert int((taken * lengths).sum()) == max(s for s in sums if s <= budget)


def test_mix(docs, messy, no_docs):
    rows = mixing.mix(docs).toPandas()
    assert len(rows) == len(messy)
    rows["source"] = rows["source"].astype(object).where(rows["source"].notna(), None)
    sizes = rows.groupby("source", dropna=False)["size"].sum()
    wanted = brute.targets({None if pd.isna(s) else s: int(n) for s, n in sizes.items()})
    for name, part in rows.groupby("source", dropna=False):
        target = wanted[None if pd.isna(name) else name]
        assert np.allclose(part.target, target) and (part.source_size == part["size"].sum()).all()
        assert abs(part.taken.sum() - target) <= max(3, 0.01 * target)
        assert (part.taken <= 3 * part["size"]).all()
    columns = ["body", "size", "taken"]
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert sorted(again[columns].values.tolist()) == sorted(rows[columns].values.tolist())
    assert mixing.mix(no_docs).count() == 0
    repeated = mixing.mixed_rows(docs)
    assert repeated.columns == docs.columns
    total = repeated.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert total == rows.taken.sum()


@pytest.mark.parametrize("case", ["capped", "empty", "one"])
def test_targets_stop_at_the_cap(spark, case):
    sizes = {"capped": {"a": 1000, "b": 1, "c": 5, None: 2}, "empty": {"a": 0, "b": 0}, "one": {None: 7}}[case]
    table = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    wanted = brute.targets(sizes)
    assert got.keys() == wanted.keys() and all(abs(got[s] - wanted[s]) < 1e-6 for s in got)


def test_large_groups_of_one_length_split_exactly(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    docs = spark.createDataFrame([(i, "a b c", "s" if i < 600 else "t") for i in range(1000)], "doc_id long, text string, source string")
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 3 for r in got)


def test_tokens_equal_the_library(spark, docs, messy, no_docs):
    path = public_tokenizers.path(bpe.VOCABULARY)
    library = Tokenizer.from_file(path)
    odd = ["<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "Σίσυφος ΣΑΣ İstanbul ß ﬁ ǅ", "it's we'll I'D 1234 ½ ٣", "a\x1cb\x85c　d​e", "aaaaaaa aaa 🙂🙂 漢字", "x" * 5000]
    table = docs.select("doc_id", "text", "whole").union(spark.createDataFrame([(i, t, "") for i, t in enumerate(odd)], "doc_id long, text string, whole string"))
    got = bpe.encode(table, path, with_text=True).select("whole.text", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded").collect()
    assert len(got) == len(messy) + len(odd)
    for text, n, id_hash, text_hash, ids, decoded in got:
        wanted = library.encode(text or "", add_special_tokens=False).ids
        assert ids == wanted and n == len(wanted)
        assert id_hash == hashlib.sha256(np.array(wanted, "<u4").tobytes()).hexdigest()
        assert decoded == library.decode(wanted, skip_special_tokens=False)
        assert text_hash == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode(no_docs, path).count() == 0


PAGES = [(3, "u", "<p>same</p>"), (1, "v", "<p>same</p>"), (2, None, None), (None, "u", ""), (4, "a\r\nb", "é" * 50), (None, "u", "alone"), (9, "u", "x" * 100_000), (9, "u", "x" * 100_000)]


@pytest.mark.parametrize("min_bytes", [0, 11, 12, 1000])
def test_archive_round_trip(spark, min_bytes):
    pages = spark.createDataFrame([(*r, "extra") for r in PAGES], "page_id long, url string, html string, payload string")
    got = warc_zip.round_trip(spark, pages.repartition(2), min_bytes).collect()
    assert brute.ordered(got) == brute.ordered(brute.warc([(p, h) for p, _, h in PAGES], min_bytes))
    assert warc_zip.round_trip(spark, pages.limit(0)).count() == 0


def test_payloads_come_back(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    manifest = warc_zip.write_packages(pages, scratch(spark, "warc-test"), package_bytes=300)
    assert manifest.count() > 1
    records = warc_zip.read_packages(manifest).filter("record_type = 'response'").collect()
    assert {bytes(r.payload).decode() for r in records} == {h or "" for _, _, h in PAGES}


@pytest.mark.parametrize("wide", [False, True])
def test_directories(tmp_path, monkeypatch, wide):
    """Both directory forms; with small limits the writer turns to ZIP64 records."""
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as file:
        file.writestr("one.txt", b"first" * 20)
        file.writestr("two.txt", b"second" * 9)
        file.writestr("packed.txt", b"z" * 500, zipfile.ZIP_DEFLATED)
        file.comment = b"a comment PK\x05\x06 with a mark"
    system, local = pyarrow.fs.FileSystem.from_uri(str(path))
    with system.open_input_file(local) as file:
        one, two, packed = warc_zip.read_directory(file)
        assert [m.name for m in (one, two, packed)] == ["one.txt", "two.txt", "packed.txt"]
        assert file.read_at(one.size, one.start(file)) == b"first" * 20
        assert file.read_at(two.size, two.start(file)) == b"second" * 9
        with pytest.raises(ValueError, match="not stored"):
            packed.start(file)


def test_broken_packages(tmp_path):
    path = tmp_path / "b.zip"
    path.write_bytes(b"no archive at all")
    system, local = pyarrow.fs.FileSystem.from_uri(str(path))
    with system.open_input_file(local) as file, pytest.raises(ValueError, match="no end of central directory"):
        warc_zip.read_directory(file)


def test_bpe_holds_one_batch_and_a_bounded_block():
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(500)) for _ in range(900)]
    coder = bpe.load(public_tokenizers.path(bpe.VOCABULARY))
    start = pa.total_allocated_bytes()
    before, rows = [], 0

    def batches():
        for _ in range(2):
            before.append(pa.total_allocated_bytes() - start)
            yield pa.RecordBatch.from_pylist([{"whole": {"d": i}, "body": t} for i, t in enumerate(texts)])

    tracemalloc.start()
    for batch in bpe.encoded(coder, batches(), list("wnabi"), True, False):
        rows += batch.num_rows
        del batch
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2 * len(texts) and before == [0, 0]
    # Over three million characters a batch: 306 MB in blocks of eight million, 127 MB in blocks of one.
    assert peak < 250e6, peak
