"""Where intermediate tables go, and archives read side by side."""

import types

from tillroll.llm import warc_zip
from tillroll.llm.common import scratch, shared_folder


def session(**settings):
    conf = {"spark.sql.warehouse.dir": "file:/warehouse/"} | settings
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, *other: conf.get(key, *other)))


def test_folder_of_the_session():
    assert shared_folder(session(**{"spark.checkpoint.dir": "hdfs://a/b/"})) == "hdfs://a/b"
    assert shared_folder(session()) == "file:/warehouse/tillroll-shared"
    assert scratch(session(), "x") != scratch(session(), "x")


def test_packages_are_read_by_several_tasks(spark):
    rows = [(i, f"http://h/{i}", "x" * 4000 + str(i)) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc_zip.write_packages(pages, scratch(spark, "many"), package_bytes=100)
    assert manifest.count() >= 200
    records = warc_zip.read_packages(manifest)
    assert records.rdd.getNumPartitions() == manifest.count()
    assert records.select("record_id").distinct().count() == 400
