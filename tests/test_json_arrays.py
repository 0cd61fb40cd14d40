"""Large JSON arrays against Spark's own reader of whole documents."""

import json
import random

import pytest

from strata.sources import json_arrays, read_source

ODD = ["", ",", '"', "\\", '\\"', "],[", "{}", "[1,2]", "ä€😀", "a,b\\,c", "\\\\", "\n", " ", "x" * 300]


def element(draw):
    made = {"id": draw.randrange(10**6), "text": "".join(draw.choice(ODD) for _ in range(draw.randrange(6)))}
    if draw.random() < 0.5:
        made["more"] = {"k": [draw.choice(ODD) for _ in range(draw.randrange(4))], "d": {"e,": draw.random()}}
    if draw.random() < 0.2:
        made["maybe"] = draw.choice([None, 1, 2.5])
    return made


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, so that strings and elements lie across their ends."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    for key, value in zip(keys, ("400", "1", "1")):
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def plain(spark, path):
    return spark.read.json(str(path), multiLine=True)


def same(one, other):
    assert one.schema == other.schema
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(one) == rows(other)


@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_in_many_ranges(spark, small_ranges, tmp_path, indent):
    draw = random.Random(1)
    for n in range(3):
        items = [element(draw) for _ in range(60)] + [{"id": 1, "text": "long " * 400}]
        draw.shuffle(items)
        text = json.dumps(items, indent=indent, ensure_ascii=bool(n))
        (tmp_path / f"{n}.json").write_text(text, encoding="utf-8")
    assert json_arrays._fragments(spark, [f"file:{tmp_path}/0.json"]).rdd.getNumPartitions() > 20
    same(read_source(spark, str(tmp_path), "json"), plain(spark, tmp_path))


def test_with_documents_and_small_files(spark, small_ranges, tmp_path):
    draw = random.Random(2)
    (tmp_path / "a.json").write_text(" \n [ " + ",\n".join(json.dumps(element(draw)) for _ in range(40)) + " ] \n")
    (tmp_path / "b.json").write_text(json.dumps(element(draw), indent=2))
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("﻿" + json.dumps([element(draw) for _ in range(30)]))
    (tmp_path / "e.json").write_text("[\n]")
    same(read_source(spark, str(tmp_path), "json"), plain(spark, tmp_path))


def test_small_files_are_read_as_before(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    monkeypatch.setattr(json_arrays, "as_lines", None)
    same(read_source(spark, str(tmp_path), "json"), plain(spark, tmp_path))


def test_other_encodings_are_left_to_spark(spark, small_ranges, tmp_path):
    items = [{"a": n, "text": "wörter" * 20} for n in range(20)]
    (tmp_path / "a.json").write_bytes(json.dumps(items, ensure_ascii=False).encode("utf-16"))
    same(read_source(spark, str(tmp_path), "json"), plain(spark, tmp_path))


def test_structure_knows_escapes():
    piece = rb'{"a\"b,": ["\\", {"c": "]\\\","}]}, 1'
    found = json_arrays.structure(piece)
    assert found.quotes == 8
    assert [piece[n : n + 1] for n in found.outside[0]] == [b"{", b"[", b",", b"{", b"}", b"]", b"}", b","]
    assert found.outside[1].sum() == 0
