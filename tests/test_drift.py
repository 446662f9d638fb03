"""Ingestion of lines whose fields come and change type: nothing is lost, nothing counts twice."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from millrace.sources import drift


class Ingest:
    def __init__(self, spark, folder):
        self.spark, self.parts = spark, [str(folder / name) for name in ("in", "rows", "checkpoint", "schemas")]
        self.files = 0
        os.makedirs(self.parts[0])

    def put(self, *lines):
        with open(os.path.join(self.parts[0], f"file-{self.files:03}.txt"), "w") as out:
            out.writelines(f"{line if isinstance(line, str) else json.dumps(line)}\n" for line in lines)
        self.files += 1

    def start(self, **options):
        drift.start_ingest(self.spark, *self.parts, **options).awaitTermination()

    def versions(self):
        return drift.schema_versions(self.spark, self.parts[3])

    def rows(self):
        return drift.read_ingested(self.spark, self.parts[1], self.parts[3])


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_fields_and_types_that_come_later(spark, tmp_path):
    job = Ingest(spark, tmp_path)
    job.put({"id": 1, "a": 5}, {"id": 2, "a": None}, "", "   ")
    job.start()
    assert job.versions() == {1: {"a": "bigint", "id": "bigint"}}
    job.put({"id": 3, "a": 1.5, "b": True}, {"id": 4, "a": 7, "b": None, "c": {"x": [1]}}, {"id": 5, "d": None})
    job.start()
    assert set(job.versions()) == {1}
    found = rows(job.rows(), "id", "a", "rescued", drift.VERSION)
    assert found == [
        (1, 5, None, 1), (2, None, None, 1), (3, None, '{"a":1.5,"b":true}', 1), (4, 7, '{"b":null,"c":{"x":[1]}}', 1),
        (5, None, '{"d":null}', 1),
    ]
    job.put({"id": 6, "a": "many", "b": 0, "c": "text"})
    job.start()
    assert job.versions()[2] == {"a": "double", "id": "bigint", "b": "boolean", "c": "string"}
    found = rows(job.rows(), "id", "a", "b", "c", "rescued", drift.VERSION)
    assert found == [
        (1, 5.0, None, None, None, 1), (2, None, None, None, None, 1), (3, 1.5, True, None, None, 1),
        (4, 7.0, None, '{"x":[1]}', None, 1), (5, None, None, None, '{"d":null}', 1),
        (6, None, None, "text", '{"a":"many","b":0}', 2),
    ]
    job.start()  # no new file, but what was rescued widens the schema
    job.start()  # nothing left to widen
    assert job.versions()[3] == {"a": "string", "id": "bigint", "b": "string", "c": "string"}
    assert set(job.versions()) == {1, 2, 3}
    found = rows(job.rows(), "id", "a", "b", "c", "rescued")
    assert found[0] == (1, "5", None, None, None) and found[2] == (3, "1.5", "true", None, None)
    assert found[5] == (6, "many", "0", "text", None)


def test_broken_lines_and_odd_names(spark, tmp_path):
    job = Ingest(spark, tmp_path)
    odd = {"a b": 1, "x.y": 2, "it's": 3, "back`tick": 4, "Name": 5, "name": 6, "rescued": 7, "\\": 8}
    broken = ['{"id": 1', "[1, 2]", "17", '{"id": 1, "id": 2}', "no json"]
    job.put(odd, *broken)
    job.start()
    schema = job.versions()[1]
    assert set(schema) == {"a b", "x.y", "it's", "back`tick", "Name", "\\"}
    found = job.rows()
    assert sorted(r["broken"] for r in found.where("broken IS NOT NULL").collect()) == sorted(broken)
    kept = found.where("broken IS NULL").first()
    assert [kept[name] for name in ("a b", "x.y", "it's", "back`tick", "Name", "\\")] == [1, 2, 3, 4, 5, 8]
    assert json.loads(kept["rescued"]) == {"name": 6, "rescued": 7}
    assert kept["source_file"].endswith("file-000.txt") and kept["processing_time"] is not None


def test_rare_fields_beyond_the_limit_stay_rescued(spark, tmp_path):
    job = Ingest(spark, tmp_path)
    job.put({"id": 1, "once": 1}, {"id": 2, "b": 1}, {"id": 3, "b": 1})
    job.start(most_fields=2)
    assert set(job.versions()[1]) == {"id", "b"}
    assert rows(job.rows(), "id", "rescued") == [(1, '{"once":1}'), (2, None), (3, None)]
    job.start(most_fields=2)
    assert set(job.versions()) == {1}
    job.start(most_fields=3)
    assert set(job.versions()[2]) == {"id", "b", "once"}
    assert rows(job.rows(), "id", "once", "rescued") == [(1, 1, None), (2, None, None), (3, None, None)]


def test_nothing_and_the_same_field_everywhere(spark, tmp_path):
    job = Ingest(spark, tmp_path)
    job.put("")
    job.start()
    assert job.rows().count() == 0
    job.put(*({"k": i} for i in range(50)))
    job.start()
    job.start()
    assert job.rows().agg(F.sum("k")).first()[0] == sum(range(50)) and job.rows().count() == 50


def test_types_widen_step_by_step():
    assert drift.merged_type({"BIGINT"}) == "bigint"
    assert drift.merged_type({"BIGINT", "DECIMAL"}) == "double"
    assert drift.merged_type({"BOOLEAN", "BIGINT"}) == "string"
    assert drift.merged_type({"OBJECT"}) == drift.merged_type({"ARRAY", "STRING"}) == "string"
