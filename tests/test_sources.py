import json

import pytest

from strata import read_source

PEOPLE = 'id,name,age,joined\n1,"Doe, Jane",41,2024-01-05\n2,NA,,2024-02-06\n'


def test_csv_header_quotes_and_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text(PEOPLE)
    df = read_source(spark, f" {tmp_path}/a.csv ", " CSV ")
    assert dict(df.dtypes) == {"id": "int", "name": "string", "age": "int", "joined": "date"}
    assert [tuple(r)[:3] for r in df.orderBy("id").collect()] == [(1, "Doe, Jane", 41), (2, "NA", None)]


@pytest.mark.parametrize(
    "written, given",
    [("|", "|"), ("|", " | "), ("\t", "\t"), ("\t", "\\t"), (",", ""), (",", None), (",", "  ")],
)
def test_csv_separator(spark, tmp_path, written, given):
    (tmp_path / "a.csv").write_text(f"a{written}b\n1{written}x\n")
    df = read_source(spark, str(tmp_path / "a.csv"), "csv", given)
    assert [tuple(r) for r in df.collect()] == [(1, "x")]
    assert df.columns == ["a", "b"]


def test_format_defaults_to_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    assert read_source(spark, str(tmp_path / "a.csv"), None).columns == ["a", "b"]


def test_json_array_document_with_nested_values(spark, tmp_path):
    todos = [
        {"id": 1, "title": "x", "done": True, "meta": {"k": [1, 2]}, "created_at": "2024-01-01"},
        {"id": 2, "title": "y", "done": False, "meta": None, "created_at": "2024-01-02"},
    ]
    (tmp_path / "todos.json").write_text(json.dumps(todos, indent=2))
    df = read_source(spark, str(tmp_path), "json")
    assert df.columns == ["created_at", "done", "id", "meta", "title"]
    assert dict(df.dtypes)["meta"] == "struct<k:array<bigint>>"
    assert dict(df.dtypes)["created_at"] == "string"
    assert [r.k for r in df.orderBy("id").select("meta.k").collect()] == [[1, 2], None]


def test_parquet_directory_and_glob(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(5).write.parquet(str(tmp_path / name))
    assert read_source(spark, f"{tmp_path}/*", "parquet").count() == 10


@pytest.mark.parametrize("path", ["", "  ", None])
def test_empty_path(spark, path):
    with pytest.raises(ValueError, match="SOURCE_URL is blank"):
        read_source(spark, path)


def test_unsupported_formats_name_the_supported_ones(spark):
    for fmt in ("excel", "xlsx", "avro"):
        with pytest.raises(ValueError, match=f"'{fmt}'.*csv, json, parquet, delta"):
            read_source(spark, "/landing/a", fmt)


def test_remote_files_must_be_landed(spark):
    with pytest.raises(ValueError, match="landed"):
        read_source(spark, "HTTPS://example.org/a.csv")


def test_csv_with_a_given_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,\n")
    (tmp_path / "b.csv").write_text("v,k\nx,1\n")
    given = "k long, v string"
    got = read_source(spark, str(tmp_path / "a.csv"), "csv", ",", given)
    assert got.dtypes == [("k", "bigint"), ("v", "string")]
    assert [tuple(r) for r in got.collect()] == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_source(spark, str(tmp_path / "b.csv"), "csv", ",", given).collect()
