"""Arrays read by byte ranges, and the store that only a commit makes visible."""

from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import etl
from tallyloom.plans.inputs import typed_records
from tallyloom.sources.files import read_json_array
from tallyloom.sources.json_arrays import Scanner, read_json_array_ranges
from tallyloom.sources.plugins import Folder, register_stores

SCHEMA = "id bigint, text string, parts array<struct<n: int, note: string>>"


def odd_items(count: int) -> list[dict | None]:
    """Items whose strings look like structure and end in backslashes and quotes, with nested arrays and nulls among them."""
    dice = random.Random(5)
    signs = ["\\", '"', "{", "}", "[", "]", ",", "é", "\n", "word", "},{", '\\"', "\\\\"]
    items: list[dict | None] = []
    for i in range(count):
        text = "".join(dice.choices(signs, k=dice.randrange(12)))
        parts = [{"n": n, "note": dice.choice(signs) + text} for n in range(dice.randrange(3))]
        items.append(None if i % 7 == 3 else {"id": i, "text": text, "parts": parts})
    return items


def rows_of_items(frame):
    return sorted((row["id"], row["text"], [tuple(part) for part in row["parts"]]) for row in frame.collect())


@pytest.mark.parametrize("indent", [None, 1])
def test_ranges_of_every_size_give_the_items_of_the_whole_file(spark, tmp_path, indent):
    items = odd_items(60)
    folder = tmp_path / "arrays"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(items, ensure_ascii=indent is None, indent=indent), encoding="utf-8")
    (folder / "b.json").write_text("[ ]\n")
    (folder / "c.json").write_text("")
    (folder / "d.json").write_text(' [ {"id": 1000, "text": "x", "parts": []} ] ')
    wanted = sorted(
        [(i["id"], i["text"], [(p["n"], p["note"]) for p in i["parts"]]) for i in items if i] + [(1000, "x", [])]
    )
    for size in (7, 64, 1001, 1 << 20):
        assert rows_of_items(read_json_array_ranges(spark, str(folder), SCHEMA, size)) == wanted
    assert rows_of_items(read_json_array(spark, str(folder), SCHEMA)) == wanted


def test_an_item_may_span_blocks():
    text = json.dumps([{"id": i, "text": "\\" * (i % 5) + '"' * (i % 3), "parts": []} for i in range(40)]).encode()
    whole = Scanner(False, 0).bounds(np.frombuffer(text, np.uint8)).tolist()
    for size in (1, 2, 3, 50):
        scanner, found = Scanner(False, 0), []
        for start in range(0, len(text), size):
            found += [start + place for place in scanner.bounds(np.frombuffer(text[start : start + size], np.uint8)).tolist()]
        assert found == whole and len(found) == 41


def test_one_large_array_is_read_by_several_tasks(spark, tmp_path):
    """A file of 100 MB in one line."""
    path = tmp_path / "large.json"
    note = "}, {[" * 20
    with path.open("w") as out:
        out.write("[")
        out.writelines((", " if i else "") + json.dumps({"id": i, "text": note, "parts": []}) for i in range(720_000))
        out.write("]")
    assert path.stat().st_size > 100_000_000
    rows = read_json_array_ranges(spark, str(path), SCHEMA, 8 << 20).withColumn("task", F.spark_partition_id())
    found = rows.agg(F.count("id"), F.sum("id"), F.countDistinct("id"), F.countDistinct("task"), F.min("text"), F.max("text")).first()
    assert tuple(found)[:3] == (720_000, 719_999 * 360_000, 720_000)
    assert found[3] > 4 and found[4] == found[5] == note


def stored(spark, folder):
    return sorted(row["id"] for row in spark.read.format("committed").load(folder).select("id").collect())


def test_only_commits_are_visible(spark, tmp_path):
    folder = str(tmp_path / "store")
    register_stores(spark)
    with pytest.raises(Exception, match="nothing was committed"):
        spark.read.format("committed").load(folder)
    rows = spark.range(0, 10, 1, 4).select("id", F.struct(F.col("id").alias("n")).alias("payload"))
    rows.write.format("committed").option("load", "first").mode("append").save(folder)
    assert stored(spark, folder) == list(range(10))

    bad = rows.where(F.when(F.col("id") == 9, F.raise_error(F.lit("bad row"))).otherwise(F.lit(True)))
    with pytest.raises(Exception):
        bad.write.format("committed").option("load", "broken").mode("append").save(folder)
    assert stored(spark, folder) == list(range(10))
    assert [manifest["load"] for manifest in Folder(folder).visible()] == ["first"]

    # A load that is repeated under its name replaces itself; an overwriting one hides what was before.
    rows.where("id < 3").write.format("committed").option("load", "first").mode("append").save(folder)
    assert stored(spark, folder) == [0, 1, 2]
    rows.where("id > 7").write.format("committed").option("load", "second").mode("append").save(folder)
    assert stored(spark, folder) == [0, 1, 2, 8, 9]
    rows.where("id = 5").write.format("committed").option("load", "third").mode("overwrite").save(folder)
    assert stored(spark, folder) == [5]
    rows.where("id > 100").write.format("committed").option("load", "none").mode("append").save(folder)
    assert stored(spark, folder) == [5]
    assert spark.read.format("committed").load(folder).select("payload.n").collect() == [(5,)]


def test_jobs_load_through_a_plug_in(spark, tmp_path):
    folder = str(tmp_path / "job")
    register_stores(spark)

    def load(rows):
        rows.select("id").write.format("committed").mode("append").save(folder)

    def broken(rows):
        load(rows.where(F.when(F.col("id") == "part-1", F.raise_error(F.lit("bad row"))).otherwise(F.lit(True))))

    source = lambda: typed_records(spark, "/root/testdata/sf0.001")
    whole = etl.run_with_stats(etl.EtlJob(source=source, load=load)).first()
    assert whole["status"] == "Completed" and len(stored(spark, folder)) == whole["extracted_count"]
    assert etl.run_with_stats(etl.EtlJob(source=source, load=broken)).first()["status"] == "Failed"
    assert len(stored(spark, folder)) == whole["extracted_count"]
