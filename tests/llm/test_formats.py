"""Chat formatting, vector codes and phrase mining against plain versions, and their defined cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tillroll.llm import chat_format, code_trees, phrase_mining, vector_codes
from tillroll.llm.word_index import WordIndex


# -- chat formatting -----------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, formatted string, conv string, turns int"
TRICKY = ["", None, "<|im_end|>\n<|im_start|>assistant\nok", "<", "|", "<\\|", "<\\\\|im_next|>", "<|im_next|>", "a\nb", "é😀<|", "plain"]


def turn_rows():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a%0A\n<|x"]), rng.choice(TRICKY)) for c in range(30) for t in range(c % 9)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", "y"), (99, 1, "user", "b"), (99, 1, "user", "a"), (99, 1, "user", "a")]
    return rows


def test_chat_turns_come_back(spark):
    rows = turn_rows()
    df = spark.createDataFrame([(*r, "f", "c", 1) for r in rows], TURNS).repartition(3)
    read = chat_format.read_back(chat_format.format_conversations(df))
    wanted = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(c, []).append((r or "", x or ""))
    got = {row.conv_id: row for row in read.collect()}
    assert set(got) == set(wanted)
    for conv, turns in wanted.items():
        row = got[conv]
        assert [tuple(t) for t in row.turns] == turns
        assert row.loss_text == "".join(x for r, x in turns if r == "assistant")
        assert row.n_messages == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        # The mask covers the text, and what it marks are the assistant's texts as they stand in it.
        assert sum(m.chars for m in row.loss_mask) == len(row.formatted)
        at, marked = 0, []
        for m in row.loss_mask:
            marked += [row.formatted[at : at + m.chars]] * m.loss
            at += m.chars
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in marked] == [x for r, x in turns if r == "assistant"]


def test_chat_is_native_and_takes_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    out = chat_format.digests(chat_format.read_back(chat_format.format_conversations(empty)))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_chat_long_conversation(spark):
    rows = spark.range(30_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    row = chat_format.digests(chat_format.read_back(chat_format.format_conversations(rows))).first()
    said = "".join(f"t{i}" for i in range(30_000) if i % 3)
    assert row.n_turns == 30_000 and row.n_messages == 20_000 and row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


# -- vector codes --------------------------------------------------------------------------------------------------


def plain_lloyd(rows, parts=8, entries=16, rounds=6):
    """rows (id, vector), in the order that counts; codes, errors and the digest of the codebooks."""
    x = np.floor(4096 * np.array([v for _, v in rows], dtype=np.float64)).astype(np.int64)
    points = x.reshape(len(x), parts, -1)
    book = points[:entries].copy()
    for step in range(rounds + 1):
        distance = ((points[:, None] - book[None]) ** 2).sum(axis=3)
        owner = distance.argmin(axis=1)
        if step < rounds:
            for p in range(parts):
                for e in range(len(book)):
                    if (owner[:, p] == e).any():
                        book[e, p] = points[owner[:, p] == e, p].sum(axis=0) // (owner[:, p] == e).sum()
    error = np.take_along_axis(distance, owner[:, None], 1)[:, 0].sum(axis=1)
    text = ",".join(str(c) for p in range(parts) for e in range(len(book)) for c in book[e, p].tolist())
    return ["".join(f"{i:02x}" for i in r) for r in owner], error.tolist(), hashlib.sha256(text.encode()).hexdigest()


def test_dual_tree_is_exact():
    rng = np.random.default_rng(2)
    whole = 0
    for trial in range(150):
        n, k, d, s = (int(rng.choice(c)) for c in ([1, 9, 40, 333], [1, 2, 5, 16], [1, 3, 8], [1, 4, 3000]))
        points = rng.integers(-s, s + 1, (n, d))
        entries = points[rng.integers(0, n, k)] if trial % 2 else rng.integers(-s, s + 1, (k, d))
        tree = code_trees.build(points)
        found = code_trees.assign(tree, entries)
        wanted = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (found.owner == wanted[tree.order]).all()
        assert (found.counts == np.bincount(wanted, minlength=k)).all()
        assert all((found.sums[e] == points[wanted == e].sum(axis=0)).all() for e in range(k))
        whole += found.whole_points
    assert whole > 500


def test_clusters_are_assigned_whole():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = centres[rng.integers(0, 16, 4096)] + rng.integers(-30, 31, (4096, 8))
    assert code_trees.assign(code_trees.build(points), centres).whole_points > 2000


VECTORS = "vec_id long, embedding array<float>, label int, x string, code int, _label string"


def vector_rows(n, width=16):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=width).astype(np.float32).tolist(), i % 3 or None) for i in range(n)]
    rows += [(n, rows[0][1], 1), (n, rows[1][1], 1), (None, rows[2][1], 2)] if n > 2 else []
    return rows


def order_of(row):
    return row[0] is None, row[0] or 0, np.floor(4096 * np.array(row[1], dtype=np.float64)).tolist()


@pytest.mark.parametrize("n", [3, 200])
def test_codes(spark, monkeypatch, n):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 37)
    rows = vector_rows(n)
    spoilt = [(-5, None, 1), (-4, [None] + [0.0] * 15, 1), (-3, [float("nan")] + [0.0] * 15, 1), (-2, [float("inf")] + [0.0] * 15, 1)]
    df = spark.createDataFrame([(*r, "x", 1, "l") for r in rows + spoilt], VECTORS).repartition(3)
    coded, books = vector_codes.compress(df)
    got = vector_codes.with_label_errors(coded).collect()
    rows.sort(key=order_of)
    codes, errors, digest = plain_lloyd([r[:2] for r in rows])
    per_label = collections.Counter()
    for (_, _, label), error in zip(rows, errors):
        per_label[label] += error
    wanted = [(r[0], r[2], c, e, per_label[r[2]]) for r, c, e in zip(rows, codes, errors)]
    key = lambda r: tuple((x is None, x or 0) for x in r[:2]) + tuple(r[2:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(wanted, key=key)
    assert vector_codes.books_digest(books) == digest


def test_codes_of_nothing_and_of_what_cannot_be_coded(spark):
    coded, books = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert not books and vector_codes.with_label_errors(coded).count() == 0
    for vectors, says in (([[1.0] * 8, [1.0] * 16], "components"), ([[1.0] * 9], "equal parts"), ([[1e6] * 8], "below")):
        df = spark.createDataFrame([(i, v, 1, "", 1, "") for i, v in enumerate(vectors)], VECTORS)
        with pytest.raises(Exception, match=says):
            vector_codes.compress(df)[0].collect()


# -- phrases -------------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, top, most=5):
    fold = {i: i + 32 for i in range(65, 91)}
    counts, totals = {}, collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        f = counts.setdefault(lang, collections.Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            f.update(tuple(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and f[p[i:j]] == a}
        scored = []
        for p in found.keys() - inner:
            score, k = min((1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_index_counts_patterns_and_neighbours():
    rng = np.random.default_rng(6)
    for trial in range(60):
        n, symbols = int(rng.integers(0, 200)), int(rng.integers(2, 9))
        text = np.append(rng.integers(0, symbols, n), 0)
        index = WordIndex(text, symbols, 5)
        found = index.single_words()
        for k in range(1, 6):
            if k > 1:
                found = index.extended(found, left=bool((k + trial) % 2))
            runs = [tuple(text[i : i + k]) for i in range(len(text) - k + 1)]
            wanted = collections.Counter(r for r in runs if all(r))
            assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist())) == dict(wanted)
            if k == 5:
                break
            for left in (True, False):
                for words, only in zip(found.words.tolist(), index.only_neighbour(found, left).tolist()):
                    at = [i for i, r in enumerate(runs) if r == tuple(words)]
                    beside = {int(text[i - 1]) if left else int(text[i + k]) for i in at}
                    assert only == (beside.pop() if len(beside) == 1 else 0)


def text_rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)] + ["The", "the", "Été", "x\u00a0y", "a\xff"]
    rows = [(None, None), ("", "en"), (" \t.,", None), ("one", "en")]
    for i in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
        words[3:3] = ["New", "york", "City", "hall", "park", "bench"] * (i % 4 == 0)
        text = "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n"]) for w in words)
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    return rows + rows[-20:]


@pytest.mark.parametrize("shard_words, least, top", [(50, 10, 2000), (1 << 20, 10, 7), (1 << 20, 100_000, 5)])
def test_collocations(spark, shard_words, least, top):
    rows = text_rows()
    df = spark.createDataFrame([(t, g, "p", 1) for t, g in rows], "text string, lang string, phrase string, n int").repartition(3)
    got = phrase_mining.collocations(df, min_count=least, top=top, shard_words=shard_words).collect()
    wanted = plain_collocations(rows, least, top)
    assert sorted(tuple(r) for r in got) == wanted
    assert bool(wanted) == (least < 100)


def test_collocations_of_crowded_bits(spark, monkeypatch):
    """Hashes that share bits let phrases through, and change nothing."""
    monkeypatch.setattr(phrase_mining, "FILTER_BITS", 1 << 15)
    rows = text_rows()
    df = spark.createDataFrame(rows, "text string, lang string")
    got = phrase_mining.collocations(df, min_count=4, shard_words=300).collect()
    assert sorted(tuple(r) for r in got) == plain_collocations(rows, 4, 2000)
    assert phrase_mining.collocations(df.limit(0)).count() == 0
