"""Readers and writers on awkward input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tastemill.sources import readers as r
from tastemill.sources import writers as w


@pytest.fixture
def put(tmp_path):
    def write(text: str, encoding: str = "utf-8") -> str:
        path = tmp_path / "in.txt"
        path.write_bytes(text.encode(encoding))
        return str(path)

    return write


def test_csv_with_header(spark, put):
    path = put("user,item,score\nu1,i1,2.5\nu2,,\n")
    got = [tuple(x) for x in r.read_csv(spark, path, r.CLICKS).collect()]
    assert got == [("u1", "i1", 2.5), ("u2", None, None)]


def test_titles_with_commas_and_quotes(spark, put):
    path = put('1,Heat (1995),Action\n2,"American President, The (1995)",Comedy|Drama\n3,short\n2,again,Other\n')
    got = {x.itemid: (x.title, x.genres) for x in r.read_items_with_commas(spark, path).collect()}
    assert got == {"1": ("Heat (1995)", "Action"), "2": ("American President, The (1995)", "Comedy|Drama")}


def test_double_colon_and_minimum(spark, put):
    path = put("1::10::5::978300760\n1::11::2::978300761\n", "latin-1")
    got = [tuple(x) for x in r.read_ratings_1m(spark, path, 3.0).collect()]
    assert got == [(1, 10, 5.0, 978300760)]


def test_malformed_lines_leave(spark, put):
    path = put("id;place;age\n1;Köln;30\n2;Bonn;old\n3;Ulm;40\n", "latin-1")
    got = r.read_dropping_malformed(spark, path, ["id", "place", "age"], ["long", "string", "int"]).collect()
    assert [tuple(x) for x in got] == [(1, "Köln", 30), (3, "Ulm", 40)]


def test_question_marks(spark, put):
    path = put("39, State-gov, 77516, <=50K\n50, ?, 83311, >50K\n")
    schema = "age int, work string, weight int, label string"
    got = r.read_complete_rows(spark, path, schema, drop=["weight"]).collect()
    assert [tuple(x) for x in got] == [(39, "State-gov", "<=50K")]
    kept = r.read_lines_with_defaults(spark, path, schema, {"age": 0, "work": ""}).collect()
    assert len(kept) == 1 and kept[0].age == 39


def test_matrix_round_trip_keeps_its_width(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 1.5])], "id long, features array<double>")
    path = w.write_matrix(df, str(tmp_path / "m"), "features", 2)
    assert w.matrix_width(spark.read.parquet(path), "features") == 2


def test_lists_with_context_and_back(spark):
    rows = [("q", 2, "b", 1.0), ("q", 1, "a", 0.0), ("p", 1, "c", 2.0)]
    df = spark.createDataFrame(rows, "query string, place int, doc string, label double")
    nested = w.list_with_context(df, ["query"], "place", ["doc", "label"])
    assert {x.query: [e.doc for e in x.examples] for x in nested.collect()} == {"q": ["a", "b"], "p": ["c"]}
    assert w.examples_of(nested, ["query"]).select(*df.columns).exceptAll(df).count() == 0


def test_defaults_on_reading(spark):
    df = spark.createDataFrame([(None,), (["x"],)], "g array<string>")
    got = [x.g for x in r.with_defaults(df, {"g": F.array(F.lit("UNK"))}).collect()]
    assert got == [["UNK"], ["x"]]
