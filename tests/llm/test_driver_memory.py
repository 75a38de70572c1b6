"""What the driver holds, and a task of the language stage."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tillroll.llm import components, jaccard_join, ppm_language
from tillroll.llm.common import staged


def test_links_do_not_pass_through_the_driver(spark):
    links = staged(spark.createDataFrame([(i + 1, i) for i in range(50)], "u long, v long"), "few-links")
    for star in (components._large_star, components._small_star):
        rows = star(links)
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_candidates_do_not_pass_through_the_driver(spark):
    live = staged(spark.createDataFrame([(t, s, 9) for t in range(20) for s in range(t, t + 3)], "token long, sid long, n int"), "few-live")
    roots = staged(spark.createDataFrame([(1, 0)], "node long, root long"), "few-roots")
    rows = [(s, s, s, 9, jaccard_join.group_counts(np.arange(9, dtype=np.uint64))) for s in range(23)]
    classes = staged(spark.createDataFrame(rows, "sid long, doc long, body long, n int, counts binary"), "few-classes")
    pairs = jaccard_join._with_classes(jaccard_join._open_pairs(live, roots, classes), classes)
    assert pairs.count()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_building_the_model_takes_little_more_than_the_model():
    rng = np.random.default_rng(4)
    grams = rng.integers(0, 1 << 32, 60_000) & 0x3F1F1F3F
    langs, counts = rng.integers(0, 2, len(grams)).astype(np.int32), rng.integers(1, 9, len(grams))
    tracemalloc.start()
    model = ppm_language.build_model(["a", "b"], langs, grams, counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.cost.nbytes > 20e6
    assert peak < 1.5 * (model.step.nbytes + model.cost.nbytes)


def test_texts_are_scored_block_by_block():
    codes = np.array([97, 97 << 8 | 98, 98], np.int64)
    model = ppm_language.build_model(["a", "b"], np.array([0, 0, 1], np.int32), codes, np.array([5, 3, 4]))
    bodies = [None if i % 7 == 0 else b"ab" * (i % 3000) for i in range(8000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8000)), pa.array(bodies, pa.binary())], ["whole", "body"])
    rows = [i for i, b in enumerate(bodies) if b is not None]
    best, scores = model.predict([bodies[i] for i in rows])
    tracemalloc.start()
    found = [pa.Table.from_batches([x]) for x in ppm_language.scored(model, iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    table = pa.concat_tables(found)
    assert table["whole"].to_pylist() == list(range(8000))
    assert [table["lang_pred"][i].as_py() for i in rows] == [model.languages[k] for k in best]
    assert np.allclose(table["score"].to_numpy()[rows], scores, rtol=1e-9) and table["lang_pred"][0].as_py() == "und"
    assert len(found) > 5 and peak < 2 * batch.nbytes
