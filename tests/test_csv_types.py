"""CSV types against Spark's own inference."""

import csv
import random

import pytest

from strata.sources import read_source

# Each is one column: its values mixed in one order.
COLUMNS = [
    ["1", "+5", "-3", ""], ["1", "2147483648"], ["-2147483649", "7"], ["007", "1"], [" 5", "1"], ["5 "],
    ["9223372036854775808", "1"], ["1" * 38], ["1" * 39, "2"], ["1."], ["1.", "2.5"], ["1", "2.5"], [".5"], ["1e5", "1"],
    ["1d"], ["0x1p3"], ["NaN", "1"], ["nan", "1"], ["Inf", "-Inf"], ["+Inf"], ["Infinity", "-Infinity"], ["infinity"],
    ["2020", "2021"], ["2020-01"], ["2020-1-1"], ["2020-01-01", ""], ["2020-01-01 "], ["2020-01-01T00:00:00"],
    ["2020-01-01 10:11:12.123456"], ["2020-01-01T10:11:12+02:00"], ["2020-01-01", "2020-01-01 10:11:12"],
    ["2020-13-01"], ["2020-02-30"], ["20200101"], ["true", "FALSE"], [" false"], ["yes"], ["t", "f"], ["abc", "1"],
    ["", ""], ["12020-01-01"], ["0000-01-01"], ["2020-01-01x"], ["1,000"], ["$5"], ["1e400"], ["true", "1"],
    ["2020-01-01", "x"], ["1", "2020-01-01"], ["1.5", "true"], ["1", "", "9999999999", "1.25"], ["a,b", 'q"q', "l\nl"],
]


@pytest.mark.parametrize("seed", [0, 1])
def test_same_types_and_values_as_inference(spark, tmp_path, seed):
    draw, rows = random.Random(seed), 12
    columns = [[*values, *draw.choices(values, k=rows)][:rows] for values in COLUMNS]
    with open(tmp_path / "x.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow([f"c {n};" for n in range(len(columns))])
        writer.writerows(zip(*columns))
    got = read_source(spark, str(tmp_path), "csv")
    expected = spark.read.csv(str(tmp_path), header=True, inferSchema=True)
    assert got.dtypes == expected.dtypes
    texts = [[c if t == "string" else f"CAST(`{c}` AS STRING)" for c, t in df.dtypes] for df in (got, expected)]
    assert len(texts[0]) == len(COLUMNS)
    show = lambda df: df.select([df[f"`{c}`"].cast("string").alias(f"x{n}") for n, c in enumerate(df.columns)]).collect()
    assert show(got) == show(expected)


def test_text_is_read_once(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a|b\n1|x\n2|y\n")
    scratch = str(tmp_path / "scratch")
    got = read_source(spark, str(tmp_path / "x.csv"), "csv", "|", scratch=scratch)
    assert [tuple(row) for row in got.collect()] == [(1, "x"), (2, "y")]
    assert all("scratch" in file for file in got.inputFiles())


def test_odd_files(spark, tmp_path):
    (tmp_path / "head.csv").write_text("a,b\n")
    (tmp_path / "short.csv").write_text("a,b,a\n1,2\n3,4,5,6\n")
    for name in ("head", "short"):
        got = read_source(spark, str(tmp_path / f"{name}.csv"), "csv")
        expected = spark.read.csv(str(tmp_path / f"{name}.csv"), header=True, inferSchema=True)
        assert (got.dtypes, got.collect()) == (expected.dtypes, expected.collect())
