"""Language, toxicity and HTML models: exact code lengths, accuracy on rows they never saw, defined cases."""

import collections
import html
import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from tillroll.llm import html_extract, ppm_language, toxicity
from tillroll.llm.dom import parse
from tillroll.llm.queries import QUERIES


def plain_bits(counts, text, order=3):
    data, total = bytes(order) + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts[k].get(data[i - k : i])
            if seen is None:
                continue
            n, q = sum(seen.values()), len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / (n + q))
                break
            total -= math.log2(q / (n + q))
        else:
            total += 8
    return total


def test_code_lengths_are_exact(monkeypatch):
    monkeypatch.setattr(ppm_language, "SLICE", 37)
    texts = {"a": [b"banana bandana", b"an ant"], "b": ["über große Bären".encode(), b"der die das"]}
    rows, tables = [], {}
    for lang, samples in texts.items():
        tables[lang] = [collections.defaultdict(collections.Counter) for _ in range(4)]
        for sample in samples:
            data = bytes(3) + sample
            for i in range(3, len(data)):
                rows.append((lang, int.from_bytes(data[i - 3 : i + 1], "big"), 1))
                for k in range(4):
                    tables[lang][k][data[i - k : i]][data[i]] += 1
    counts = pd.DataFrame(rows, columns=["lang", "gram", "n"]).groupby(["lang", "gram"], as_index=False).sum()
    codes = counts["lang"].map({"a": 0, "b": 1}).to_numpy(np.int32)
    model = ppm_language.build_model(["a", "b"], codes, counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    asked = [b"", b"banana", b"\xff\x00\x01 zebra", "Bäume und Größe ".encode() * 9, b"a", b"der Hut" * 20]
    wanted = [[plain_bits(tables[lang], t) for lang in ("a", "b")] for t in asked]
    assert np.allclose(model.bits(asked), wanted, rtol=1e-5)


def test_language_cases(spark, docs, messy, no_docs):
    rows = ppm_language.predict(docs, ppm_language.train(docs)).select("whole.*", "lang_pred", "score").collect()
    assert len(rows) == len(messy)
    for row in rows:
        text, lang, score = row[1], row[-2], row[-1]
        assert (lang == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= score <= 1
        assert lang in ("en", "de", "und")
    unlearned = ppm_language.predict(docs, ppm_language.train(no_docs))
    assert {r[0] for r in unlearned.select("lang_pred").collect()} == {"und"}
    assert ppm_language.predict(no_docs, ppm_language.train(docs)).count() == 0


def test_language_of_unseen_rows(spark):
    rows = QUERIES["op4_ppm_language"](spark, "/root/testdata/sf0.01").toPandas()
    known = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")[["doc_id", "lang"]]
    held = rows.merge(known, on="doc_id")[lambda d: d.held_out]
    assert len(rows) == 1000 and len(held) > 200
    assert (held.lang_pred == held.lang).mean() > 0.95


def test_ftrl_finds_the_words_that_matter():
    rng, ftrl, hashes = random.Random(1), toxicity.Ftrl(), toxicity.WordHashes()
    words = [f"v{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    for _ in range(1500):
        bad = rng.random() < 0.2
        text = [rng.choice(words) for _ in range(30)] + (["rotten"] if bad else [])
        rng.shuffle(text)
        ftrl.update(toxicity.features(" ".join(text), hashes), int(bad))
    slots, weights, bias = ftrl.model()
    word = toxicity.features("rotten", hashes)[0]
    assert weights[list(slots).index(word)] == weights.max() > 1 and bias < 0
    assert len(slots) < 2000


def test_toxicity_cases(spark, docs, messy, no_docs):
    labels = docs.selectExpr("doc_id", "case when n_chars % 7 = 0 then null else int(n_chars % 2) end as toxic")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).select("whole.*", "score").collect()
    assert len(rows) == len(messy) and all(0 <= r[-1] <= 1 for r in rows)
    unlearned = toxicity.score(docs, toxicity.train(docs, labels.limit(0)))
    assert {r[0] for r in unlearned.select("score").collect()} == {0.5}
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels)).count() == 0


def test_toxicity_of_unseen_rows(spark):
    rows = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    held = rows.merge(pd.read_parquet("/root/testdata/sf0.1/labels.parquet"), on="doc_id")[lambda d: d.held_out]
    rank, bad = held.score.rank(), held.toxic == 1
    area = (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert area > 0.95 and held.predicted[~bad].mean() < 0.01 and held.predicted[bad].mean() > 0.7


def article(source):
    """Regular expressions suffice for the pages of the test data."""
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.DOTALL)[1]
    parts = re.split(r"</?p>|<br>|</?h1>", inner)
    texts = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts)
    return "\n".join(x for x in texts if x)


def test_articles_of_all_pages(spark):
    rows = QUERIES["op9_html_extract"](spark, "/root/testdata/sf0.01").toPandas()
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").set_index("page_id").html
    assert len(rows) == len(pages) and (rows.n_chars == rows.text.str.len()).all()
    assert np.mean([t == article(pages[p]) for p, t in zip(rows.page_id, rows.text)]) > 0.99


@pytest.fixture(scope="module")
def trees():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    return html_extract.learn(list(pages[:60]))


def test_unseen_layouts(trees):
    rng = random.Random(8)
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html[60:160]
    blocks = [article(p).split("\n") for p in pages]
    short, other = [b[0][:60] for b in blocks], [x for b in blocks for x in b][:300]
    right = 0
    for b in blocks:
        source = html_extract.rebuilt(rng, [x[:500] for x in b[:10]], short, other)
        page, mine = parse(source), []
        for node in page.elements:
            mine.append("data-m" in node.attributes or (node.parent >= 0 and mine[node.parent]))
        wanted = "\n".join(t for t, owners in page.blocks if owners and mine[owners[0][0]])
        right += html_extract.extract_texts([source.replace(" data-m", "")], trees)[0] == wanted
    assert right >= 0.9 * len(blocks)


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("<nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>One\n two<p>Three<br></article><footer>f</footer>", "A & B\nOne two\nThree"),
        ("<body><article><p>x &lt;b&gt; y</p><script>var a='</p>';</script><!-- c --><p>z</article>", "x <b> y\nz"),
        ("<article><p>open <b>bold<p>next &nbsp; words</", "open bold\nnext words"),
    ],
)
def test_markup(trees, source, text):
    assert html_extract.extract_texts([source], trees) == [text]


def test_dropped_elements_have_no_open_descendants(trees):
    page = parse("<body><nav><ul><li><p>a b c</p></li></ul></nav><article><p>text</p><aside><p>x</p></aside></article></body>")
    choice = html_extract.decode(page, np.random.default_rng(0).normal(size=len(page.elements)) * 3)
    assert all(not c or n.parent < 0 or choice[n.parent] for c, n in zip(choice, page.elements))


def test_html_cases(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "y"), (1, "u", "<article><p>hello there world</p></article>", "z"), (2, "u", "<div>" * 3000 + "deep", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract(pages, html_extract.train(pages)).select("whole.*", "n_chars").collect()
    assert len(got) == 4 and {r[3] for r in got} == {"x", "y", "z", ""}
    assert html_extract.extract(pages.limit(0), html_extract.train(pages.limit(0))).count() == 0


def test_html_learns_from_the_few_pages_that_name_their_article(spark):
    words = " ".join(f"word{i}" for i in range(60))
    plain = [(i, f"<html><body><div><p>{words}, {i}</p></div></body></html>") for i in range(400)]
    named = [(1000, f"<html><body><nav><a href=x>Menu</a></nav><ARTICLE><p>{words}.</p></ARTICLE></body></html>")]
    pages = spark.createDataFrame(plain + named, "page_id long, html string")
    trees = html_extract.train(pages, sample_pages=5)
    assert html_extract.extract_texts([named[0][1]], trees) == [f"{words}."]
    with pytest.raises(ValueError, match="nothing to learn"):
        html_extract.train(pages.filter("page_id < 1000"))


def test_html_draw_does_not_hang_on_the_id(spark):
    """Pages without an id, or all with one, teach as any others do; pages that repeat count once."""
    page = "<html><body><div class=nav><a>home</a></div><article><p>{0}, and a sentence about it.</p></article></body></html>"
    wanted = [f"story {i}, and a sentence about it." for i in range(300)]
    for one_id in (None, 7):
        rows = [(one_id, page.format(f"story {i}")) for i in range(300)] + [(one_id, page.format("story 0"))] * 50
        pages = spark.createDataFrame(rows, "page_id long, html string")
        got = [r.text for r in html_extract.extract(pages, html_extract.train(pages, sample_pages=60)).collect()]
        assert sorted(got) == sorted(wanted + wanted[:1] * 50)


def test_features_count_all_siblings():
    """A node among 100 of its tag differs from one among 64 in more than the number of siblings."""
    odds = html_extract.name_odds([])
    many, few = (html_extract.node_features(parse(f"<body>{'<i>x</i>' * n}{'<b>y</b>' * (200 - n)}</body>"), odds) for n in (100, 64))
    assert (many[2] != few[2]).any()


def test_labels_that_repeat_an_id_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 50)
    docs = spark.createDataFrame([(2, "you idiot" if i % 2 else "fine words") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(2, i % 2) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, sample_docs=50)
    assert toxicity.score(docs, model).count() == 400
