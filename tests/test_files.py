"""Exports as files by the data source writer, and counts taken while writing."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pagemill.operators.media import counted, counted_report, run_report
from pagemill.session import written
from pagemill.sinks.files import publish_files, published_files
from pagemill.sinks.stores import published

SCHEMA = ("yyyymm string, uuid string, meta_json string, formatted_content_html string, ori_content_html string, "
          "formatted_text_txt string, status_file string, status_body string")


def rows(n, tag=""):
    full = [("202401", f"u{i}", "{}", f"<p>é{i}{tag}</p>", "", f"t{i}", "status.downloaded", "ok\n") for i in range(0, n, 2)]
    return full + [("202402", f"u{i}", "{}", None, None, None, "status.downloaded_error", "bad\n") for i in range(1, n, 2)]


def listed(df):
    return sorted((r["yyyymm"], r["uuid"], r["name"], bytes(r["content"]).decode()) for r in df.collect())


def expected(n, tag=""):
    names = ("meta.json", "formatted_content.html", "ori_content.html", "formatted_text.txt")
    return sorted((r[0], r[1], f, t) for r in rows(n, tag) for f, t in [*zip(names, r[2:6]), (r[6], r[7])] if t)


def test_files_are_published_read_back_and_replaced(spark, tmp_path):
    root = str(tmp_path / "out")
    publish_files(spark.createDataFrame(rows(9), SCHEMA).repartition(3), root, 7)
    assert listed(published_files(spark, root, 7)) == expected(9)
    assert len(glob.glob(f"{root}/files/*/*/*/*/202401/u4/ori_content.html")) == 1          # empty, so not read back
    old = published_files(spark, root, 7)
    publish_files(spark.createDataFrame(rows(4, "x"), SCHEMA), root, 7)
    assert listed(published_files(spark, root, 7)) == expected(4, "x") and listed(old) == expected(9)
    publish_files(spark.createDataFrame([], SCHEMA), root, 8)
    assert published_files(spark, root, 8).collect() == []
    with pytest.raises(LookupError):
        published_files(spark, root, 9)
    with pytest.raises(LookupError):
        published(spark, root, 9)


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame(rows(8), SCHEMA).coalesce(1)
    broken = df.withColumn("meta_json", F.when(F.col("uuid") == "u5", F.raise_error(F.lit("broken"))).otherwise(F.col("meta_json")))
    with pytest.raises(Exception, match="broken"):
        publish_files(broken, root, 7)
    with pytest.raises(LookupError):
        published_files(spark, root, 7)
    assert [p for p in glob.glob(f"{root}/**", recursive=True) if os.path.isfile(p)] == []


def test_counts_of_a_write_equal_the_group_by(spark):
    schema = "batch_id long, spider string, status string"
    plain = [(1, s, t) for i, s in enumerate("ab") for t in ("done", "packed_failed") for _ in range(3 + i)]
    for data in (plain, plain + [(2, "a", "done")], plain + [(1, None, "done")], plain + [(1, "c", "done")], plain + [(1, "a", "odd")],
                 plain + [(None, "a", "done")], []):
        df, seen = counted(spark.createDataFrame(data, schema).repartition(3), ["a", "b"])
        stored = written(df, "counted")
        got = counted_report(stored, seen, ["a", "b"])
        assert sorted(map(str, got.collect())) == sorted(map(str, run_report(stored).collect())) and got.columns == run_report(stored).columns
        if data is plain:
            assert "FileScan" not in got._jdf.queryExecution().toString()
