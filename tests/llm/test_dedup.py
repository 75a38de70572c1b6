"""Exact copies, repeated runs of words, and near copies against plain versions."""

import random
import types

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tillroll.llm import count_tree, exact_dedup, jaccard_join, substring_dedup
from tillroll.llm.components import components


def test_exact_decisions(docs, messy):
    assert brute.ordered(exact_dedup.decisions(docs).collect()) == brute.ordered(brute.exact(messy))


def test_exact_rows(docs, messy):
    kept = exact_dedup.keep_first_copies(docs)
    assert kept.columns == docs.columns
    wanted = [(r[0], r[4]) for r in brute.exact(messy) if r[3]]
    got = [(r[0], brute.exact([(r[0], r[1])])[0][4]) for r in kept.select("doc_id", "text").collect()]
    assert brute.ordered(got) == brute.ordered(wanted)


def test_repeats(docs, messy):
    got = substring_dedup.remove_repeats(docs)
    assert brute.ordered(got.drop("kept").collect()) == brute.ordered(brute.repeats(messy))


def test_repeats_over_many_small_batches(spark, docs, messy):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = substring_dedup.remove_repeats(docs).drop("kept").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert brute.ordered(got) == brute.ordered(brute.repeats(messy))


def found_ranges(rows, batch_rows=10_000):
    """(doc, word) at which a repeated window starts, by the steps of `repeated_ranges` in this process."""
    docs, texts = zip(*rows)
    batch = pa.record_batch([pa.array(docs), pa.array([0] * len(rows), pa.int64()), pa.array(texts, pa.binary())], ["doc", "body", "bytes"])
    every_seed = types.SimpleNamespace(value=np.full(1 << 13, 255, np.uint8))
    occurrences = substring_dedup._occurrences(every_seed)(iter([batch]))
    met = pa.Table.from_batches(occurrences).sort_by([("seed", "ascending"), ("doc", "ascending")])
    found = set()
    for part in substring_dedup._extended(iter(met.to_batches(max_chunksize=batch_rows))):
        for doc, _, start, covered, earlier in zip(*part.to_pydict().values()):
            assert earlier < doc
            found |= {(doc, start + i) for i in range(13) if covered >> i & 1}
    return found


@pytest.mark.parametrize("batch_rows", [3, 10_000])
def test_windows_that_agree_in_half_a_fingerprint(batch_rows, monkeypatch):
    """A short frequent line with differing neighbours, and one passage that does repeat."""
    rng = random.Random(4)
    line, passage = [f"l{i}" for i in range(9)], [f"p{i}" for i in range(20)]

    def text(i):
        around = [f"x{rng.randrange(10**9)}" for _ in range(60)]
        return b" ".join(w.encode() for w in around[:30] + line + around[30:] + passage * (i % 7 == 3))

    rows = [(i, text(i)) for i in range(40)]
    exact = substring_dedup.gram_hashes
    for half in (0xFFFFFFFF, 0xFFFFFFFF00000000):
        cut = lambda words, size, half=half: exact(words, size) & np.uint64(half if size == 13 else 2**64 - 1)
        monkeypatch.setattr(substring_dedup, "gram_hashes", cut)
        assert found_ranges(rows, batch_rows) == {(i, 69 + k) for i in range(4, 40) if i % 7 == 3 for k in range(8)}


@pytest.mark.parametrize("shared_id", [None, 7])
def test_rows_of_one_id_whose_hashes_agree_in_half(spark, shared_id):
    passage = " ".join(f"p{i}" for i in range(20))
    clean = " ".join(f"c{i}" for i in range(20))
    by_half = {xxhash.xxh64_intdigest(f"{passage} a{i}".encode(), 42) >> 32: i for i in range(200_000)}
    found = ((by_half.get(xxhash.xxh64_intdigest(f"{clean} b{j}".encode(), 42) >> 32), j) for j in range(200_000))
    i, j = next((i, j) for i, j in found if i is not None)
    rows = [(1, passage), (shared_id, f"{passage} a{i}"), (shared_id, f"{clean} b{j}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs).drop("kept").collect()
    assert brute.ordered(got) == brute.ordered(brute.repeats(rows)) and {r.n_removed for r in got} == {0, 20}


def covered_spans(rows, least):
    """(doc, start, length) of maximal runs of repeated windows, overlapping or touching."""
    split = [(brute.LAST if d is None else d, brute.WORD.findall(t or "")) for d, t in rows]
    first, out = {}, set()
    for doc, words in split:
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            first[key] = min(first.get(key, doc), doc)
    for doc, words in split:
        spans = []
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < doc:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + 13
                else:
                    spans.append([i, i + 13])
        out |= {(None if doc == brute.LAST else doc, a, b - a) for a, b in spans if b - a >= least}
    return out


@pytest.mark.parametrize("least", [13, 60])
def test_spans(docs, messy, least):
    got = substring_dedup.repeated_spans(docs, least=least).collect()
    assert {(r.doc_id, r.start, r.length) for r in got} == covered_spans(messy, least) and got
    assert all(r.earlier < (brute.LAST if r.doc_id is None else r.doc_id) for r in got)


def test_equal_windows_pick_equal_seeds():
    rng = np.random.default_rng(1)
    run = rng.integers(0, 1 << 60, 13).astype(np.uint64)
    words = np.concatenate([rng.integers(0, 1 << 60, 40).astype(np.uint64), run, rng.integers(0, 9, 30).astype(np.uint64), run])
    text, start, lead, count, seed, _ = substring_dedup.seeds(words, np.array([60, len(words)]))
    first = [s for t, a, n, s in zip(text, start, count, seed) if t == 0 and a <= 40 < a + n]
    other = [s for t, a, n, s in zip(text, start, count, seed) if t == 1 and a <= len(words) - 60 - 13 < a + n]
    assert first == other and len(first) == 1


@pytest.mark.parametrize("small_parts", [False, True])
def test_near(docs, messy, small_parts, monkeypatch):
    if small_parts:  # every block goes through trees, cut into parts
        monkeypatch.setattr(jaccard_join, "PART_ROWS", 4)
        monkeypatch.setattr(jaccard_join, "LEAF_ROWS", 1)
        monkeypatch.setattr(jaccard_join, "FREQUENT_IN_SAMPLE", 10_000)
    assert brute.ordered(jaccard_join.join(docs).collect()) == brute.ordered(brute.near(messy))


def test_rows_of_one_id_and_text_bring_it_once(spark):
    """Hundreds of rows without an id, of two near texts: each text once, one component."""
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words), " ".join([*words[:-1], "end"])]
    rows = [(None, t) for t in texts for _ in range(300)] + [(5, texts[0]), (5, "nothing like the others here")] * 2 + [(6, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert brute.ordered(jaccard_join.join(docs).collect()) == brute.ordered(brute.near(rows))
    keyed = jaccard_join._keyed(docs, "doc_id", "text")
    assert jaccard_join.texts_of(keyed, keyed.select("doc", "body")).count() == 5


def test_texts_of_no_pair_stay_out_of_the_shuffle(spark):
    """Of 2,000 texts those of 30 pairs come along, all of them and few others; a full table of bits loses none."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    keyed = jaccard_join._keyed(docs, "doc_id", "text").cache()
    sides = [keyed.filter(f"doc % 50 = {k}").selectExpr("doc DIV 50 AS at", f"doc AS {s}_doc", f"body AS {s}_body") for k, s in enumerate("ab")]
    close = sides[0].join(sides[1], "at").filter("at < 30")
    named = {50 * k + side for k in range(30) for side in (0, 1)}
    got = {r.doc for r in jaccard_join.wanted_texts(close, keyed).collect()}
    assert named <= got and len(got) < 400
    assert jaccard_join.wanted_texts(close.limit(0), keyed).count() == 0


def test_a_full_table_of_bits_loses_no_text(spark, docs, messy, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MOST_BITS", 64)
    assert brute.ordered(jaccard_join.join(docs).collect()) == brute.ordered(brute.near(messy))


def test_sets_of_texts_that_come_again_are_kept(monkeypatch):
    """Three texts in 300 pairs are hashed three times, and as often as they come when nothing may be kept."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(w).encode() for w in (words, [*words[:-2], "x", "y"], [*words[50:], *words[:50], "z"])]
    pairs = [(i % 3, (i + 1) % 3) for i in range(300)]
    batch = pa.RecordBatch.from_pydict(
        {"a": [a for a, _ in pairs], "b": [b for _, b in pairs], "x": [texts[a] for a, _ in pairs], "y": [texts[b] for _, b in pairs]}
    )
    made, plain = [], jaccard_join.shingle_sets
    monkeypatch.setattr(jaccard_join, "shingle_sets", lambda texts, hashes: made.append(1) or plain(texts, hashes))
    (got,) = jaccard_join._verified(iter([batch]))
    sets = [brute.shingles(t.decode()) for t in texts]
    linked = [p for p in pairs if 100 * len(sets[p[0]] & sets[p[1]]) >= 80 * len(sets[p[0]] | sets[p[1]])]
    assert list(zip(*(c.to_pylist() for c in got.columns))) == linked and linked
    assert len(made) == 3
    monkeypatch.setattr(jaccard_join, "KNOWN_BYTES", -1)
    assert list(jaccard_join._verified(iter([batch]))) == [got]


def test_bounds_of_many_pairs():
    """The bounds are those of the plain counts, a count of MANY or more taken as the set's largest, for any numbers of groups."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (1, 3, 40, 60, 70, 130, 500, 520, 900)]
    sets += [sets[6] >> np.uint64(9), np.arange(400, dtype=np.uint64), sets[4] >> np.uint64(2)]  # large counts, also above a byte

    def plain(a, b):
        points = []
        for s in (a, b):
            bits = jaccard_join.groups_for(len(s)).bit_length() - 1
            counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
            points.append(np.where(counts >= jaccard_join.MANY, counts.max(), counts))
        groups = min(map(len, points))
        return np.minimum(*(p.reshape(groups, -1).sum(axis=1) for p in points)).sum()

    counts = jaccard_join.PackedCounts([jaccard_join.group_counts(s) for s in sets])
    x, y = (i.ravel() for i in np.indices((len(sets), len(sets))))
    got = counts.overlap_bounds(x, y)
    assert got.tolist() == [plain(sets[i], sets[j]) for i, j in zip(x, y)]
    assert all(k >= len(np.intersect1d(sets[i], sets[j])) for i, j, k in zip(x, y, got))


def test_tree_join_of_large_counts():
    rng = np.random.default_rng(5)
    points = rng.choice([0, 1, 2, 40, 41, 900], (60, 36)) + np.zeros((60, 1), np.int32)
    points[20:40] = points[:20] + rng.integers(0, 2, (20, 36))
    sizes = points.sum(axis=1)
    wanted = {
        (i, j)
        for i in range(60)
        for j in range(i + 1, 60)
        if count_tree.can_overlap(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j])
        and count_tree.sizes_fit(sizes[i], sizes[i], sizes[j], sizes[j])
    }
    got = [(min(i, j), max(i, j)) for x, y in count_tree.CountTree(points, sizes).join() for i, j in zip(x.tolist(), y.tolist())]
    assert set(got) == wanted and len(got) == len(wanted) >= 20


def test_near_rows(docs, messy):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    # No two kept rows are linked, and every component with words is represented.
    with_words = [(r[0], r[1]) for r in rows if brute.shingles(r[1])]
    linked = brute.near([(i, t) for i, (_, t) in enumerate(with_words)])
    assert all(i == c for i, _, c in linked)
    assert len(with_words) == len(set(brute.union_find_roots(messy)))


def test_tree_join_misses_nothing():
    rng = np.random.default_rng(2)
    centres = rng.poisson(4, (30, 32))
    points = np.clip(centres[rng.integers(0, 30, 400)] + rng.integers(-1, 2, (400, 32)), 0, None).astype(np.int32)
    sizes = points.sum(axis=1).astype(np.int64)

    def wanted(a, b, own):
        return {
            (i, j)
            for i in range(len(a[0]))
            for j in range(i + 1 if own else 0, len(b[0]))
            if count_tree.can_overlap(np.minimum(a[0][i], b[0][j]).sum(), a[1][i], b[1][j])
            and count_tree.sizes_fit(a[1][i], a[1][i], b[1][j], b[1][j])
        }

    whole = count_tree.CountTree(points, sizes)
    got = {(min(i, j), max(i, j)) for x, y in whole.join() for i, j in zip(x.tolist(), y.tolist())}
    assert got == wanted((points, sizes), (points, sizes), True)
    left, right = count_tree.CountTree(points[:7], sizes[:7]), count_tree.CountTree(points[7:], sizes[7:])
    got = {(i, j) for x, y in left.join(right) for i, j in zip(x.tolist(), y.tolist())}
    assert got == wanted((points[:7], sizes[:7]), (points[7:], sizes[7:]), False)


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)]
    links += [(500, x) for x in range(501, 540)] + [(700, 700)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    root = brute.union_find(800, links)
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert got == {i: least[r] for i, r in enumerate(root) if least[r] != i}


def test_empty_tables(no_docs):
    assert exact_dedup.decisions(no_docs).count() == 0
    assert exact_dedup.keep_first_copies(no_docs).count() == 0
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    assert jaccard_join.join(no_docs).count() == 0


def test_rows_that_differ_elsewhere_are_chosen_alike(spark):
    """Of rows that share id and text, reruns keep the same one, however the table is dealt."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, s, None) for s in ("s1", "s2", "s3", None)] + [(2, "other " + text, "s1", s) for s in ("x", None, "y")]
    for keep in (exact_dedup.keep_first_copies, jaccard_join.keep_one):
        found = set()
        for parts in (1, 2, 5):
            docs = spark.createDataFrame(rows[::-1] if parts == 2 else rows, "doc_id long, text string, source string, lang string")
            found.add(tuple(sorted(map(str, keep(docs.repartition(parts)).collect()))))
        assert len(found) == 1
