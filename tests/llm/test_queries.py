"""The registered queries: their SQL where they have one, the contract's columns, and the pipeline against brute force."""

import __spark_entry__
import brute
import corpus_pipeline
import oracle_compare
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, key):
    rows, problems = oracle_compare.compare(spark, oracle_compare.connect(SF), queries.QUERIES[key], queries.ORACLE_SQL[key], SF)
    assert not problems and rows > 0


def test_one_query_per_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def documents():
    table = pd.read_parquet(f"{SF}/documents.parquet")
    return list(zip(table.doc_id.tolist(), table.text.tolist()))


def test_whole_tables_against_brute_force(spark):
    rows = documents()
    got = queries.QUERIES["op7_substring_dedup"](spark, SF).collect()
    assert brute.ordered(got) == brute.ordered(brute.repeats(rows))
    got = queries.QUERIES["op10_jaccard_join"](spark, SF).collect()
    assert brute.ordered(got) == brute.ordered(brute.near(rows))
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    got = queries.QUERIES["op1_warc_zip"](spark, SF).collect()
    assert brute.ordered(got) == brute.ordered(brute.warc(list(zip(pages.page_id.tolist(), pages.html.tolist()))))


def test_pipeline(spark):
    rows = [(d, t) for d, t in documents() if any(c.isalpha() for c in t or "")]
    text = dict(rows)
    kept = [r[0] for r in brute.exact(rows) if r[3]]
    kept = [d for d, _, c in brute.near([(d, text[d]) for d in kept]) if d == c]
    table = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    sizes = {}
    for d in kept:
        name = table.source[d]
        sizes[name] = sizes.get(name, 0) + len(brute.WORD.findall(text[d]))
    wanted = brute.targets(sizes)

    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got.doc_id) <= set(kept)
    assert got.groupby("doc_id").size().max() <= 3
    words = got.assign(words=[len(brute.WORD.findall(text[d])) for d in got.doc_id]).groupby("source").words.sum()
    for name, target in wanted.items():
        longest = max(len(brute.WORD.findall(text[d])) for d in kept if table.source[d] == name)
        assert abs(words.get(name, 0) - target) <= longest
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for d, ids in zip(got.doc_id, got.ids):
        assert list(ids) == library.encode(text[d], add_special_tokens=False).ids


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_jaccard_join", "mixing", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, name, stage):
    assert stage(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(0), SF).count() == 0


def test_language_stage_keeps_texts_where_nothing_has_a_label(spark):
    rows = [(1, "some words", None), (2, "1 2 3", None), (3, None, None), (4, "", None), (5, "été", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.known_language(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5]
