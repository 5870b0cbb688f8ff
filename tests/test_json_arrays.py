"""JSON arrays read by byte ranges: equal to the multiLine reader wherever the cuts fall."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.errors import PythonException

from strata.sources import files as SF
from strata.sources.json_arrays import _passes, json_array_elements, read_json_array_split

NASTY = ['[', ']', '{', '}', '"', '\\', '\\\\', '\\"', ',', '\n', 'é', '}{', '"]', 'a' * 90, '\\' * 33, '']


def _document(seed: int, rows: int = 60) -> list[dict]:
    r = random.Random(seed)
    text = lambda: "".join(r.choices(NASTY, k=r.randint(0, 6)))
    return [{"n": k, "s": text(), "inner": {"list": [text(), text()], "deep": {"x": text()}}} for k in range(rows)]


def _written(tmp_path, name: str, text: str) -> str:
    (tmp_path / name).write_text(text, encoding="utf-8")
    return f"file://{tmp_path}/{name}"


def _cut(path: str, size: int, unit: int, block: int) -> list[tuple[int, str]]:
    """The two passes without Spark: what the units of a file emit."""
    summaries, elements = _passes(block)
    starts = range(0, size, unit)
    told = [(path, k, at, min(size, at + unit)) for k, at in enumerate(starts)]
    rows = next(summaries([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*told)], ["f", "u", "a", "b"])])).to_pylist()
    base = int(next(r["first"] for r in rows if r["first"] is not None) == ord("["))
    out, odd, depth = [], 0, 0
    for r in rows:
        place = [pa.array([v]) for v in (path, r["start"], r["end"], odd, depth, base)]
        for got in elements([pa.RecordBatch.from_arrays(place, list("abcdef"))]):
            out += zip(got["offset"].to_pylist(), got["value"].to_pylist(), strict=True)
        depth += r["inner"] if odd else r["outer"]
        odd = (odd + r["odd"]) % 2
    return out


@pytest.mark.parametrize("unit,block,indent", [(3, 2, None), (7, 3, None), (64, 17, 2), (257, 1000, None)])
def test_every_element_once_wherever_the_cuts_fall(tmp_path, unit, block, indent):
    rows = _document(unit)
    text = " \n" + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n "
    path = _written(tmp_path, "a.json", text)
    out = _cut(path, len(text.encode()), unit, block)
    assert [json.loads(v) for _, v in out] == rows
    assert [a for a, _ in out] == sorted(a for a, _ in out)


@pytest.mark.parametrize("text", ['[{"a": 1}, 2]', '[{"a": 1}, "x"]', '[{"a": 1}', '[{"a": "x', '[{"a": 1}] junk', '[[1]]', ']'])
@pytest.mark.parametrize("unit", [5, 1000])
def test_other_documents_are_refused(tmp_path, text, unit):
    with pytest.raises(ValueError):
        _cut(_written(tmp_path, "bad.json", text), len(text), unit, 8)


def test_equal_to_the_multiline_reader(spark, tmp_path):
    path = _written(tmp_path, "a.json", json.dumps(_document(5), indent=1, ensure_ascii=False))
    whole = SF.read_json_array(spark, path)
    split = read_json_array_split(spark, path, whole.schema, unit_bytes=1500, block_bytes=100)
    assert split.schema == whole.schema
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_one_document_takes_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = _document(3, 400)
    path = _written(tmp_path, "big.json", json.dumps(rows))
    found = json_array_elements(spark, path, unit_bytes=8192)
    used = {r[0] for r in found.select(F.spark_partition_id()).distinct().collect()}
    assert len(used) > 4
    assert found.count() == 400


def test_folder_of_documents_inferred_schema_and_place(spark, tmp_path):
    for k in range(3):
        _written(tmp_path, f"{k}.json", json.dumps([{"a": k * 10 + j, "b": "x\ny"} for j in range(k * 2)]))
    _written(tmp_path, "single.json", '﻿{"a": 99, "b": null}')
    _written(tmp_path, "empty.json", "")
    _written(tmp_path, "with space.json", '[{"a": 7}]')
    got = read_json_array_split(spark, f"file://{tmp_path}", place=("_f", "_o"), unit_bytes=40).orderBy("_f", "_o").collect()
    assert [(r.a, r.b) for r in got] == [(10, "x\ny"), (11, "x\ny"), (20, "x\ny"), (21, "x\ny"), (22, "x\ny"), (23, "x\ny"),
                                         (99, None), (7, None)]


def test_element_larger_than_units(spark, tmp_path):
    rows = [{"s": "a"}, {"s": "[{" * 5000}, {"s": "\\" * 4001}, {"s": "z"}]
    path = _written(tmp_path, "wide.json", json.dumps(rows))
    got = json_array_elements(spark, path, unit_bytes=3000, block_bytes=64).orderBy("offset").collect()
    assert [json.loads(r.value) for r in got] == rows


def test_a_refused_document_fails_the_job(spark, tmp_path):
    path = _written(tmp_path, "bad.json", '[{"a": 1}, 2]')
    with pytest.raises(PythonException, match="no array of JSON objects at byte 11"):
        json_array_elements(spark, path).collect()


def test_empty_arrays(spark, tmp_path):
    _written(tmp_path, "none.json", "[ ]")
    assert json_array_elements(spark, f"file://{tmp_path}").count() == 0
    assert read_json_array_split(spark, f"file://{tmp_path}").count() == 0
