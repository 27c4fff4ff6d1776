"""What a sink writes, a source reads back."""

from pathlib import Path

import pytest

from amity import sinks, sources
from catalog.shared import fresh_path

from graphs import edges, random_arcs


def test_tab_text_and_adjacency(spark, tmp_path):
    arcs = sorted({(x, y) for x, y in random_arcs(3, 50, 200) if x != y})
    path = str(tmp_path / "edges")
    sinks.write_tab_text(edges(spark, arcs), path)
    assert sorted(map(tuple, sources.read_adjacency(spark, path).collect())) == arcs


def test_null_and_number_as_text(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    assert sinks.tab_lines(df).first().value == "1\tnull\t2.5"
    assert sinks.tab_lines(df, null_text="").first().value == "1\t\t2.5"


def test_csv_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"'), (2, None)], "x bigint, y string")
    path = str(tmp_path / "csv")
    sinks.write_csv_header(df, path)
    back = spark.read.csv(path, header=True, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, 'a,"b"'), (2, None)]


def test_single_file(spark, tmp_path):
    df = spark.range(100).repartition(5)
    many, one = tmp_path / "many", tmp_path / "one"
    sinks.write_tab_text(df, str(many))
    sinks.write_tab_text(df, str(one), single_file=True)
    assert len(list(many.glob("part-*"))) == 5
    assert len(list(one.glob("part-*"))) == 1
    assert sources.read_lines(spark, str(one)).count() == 100


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://somewhere:7077"

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        sparkContext = Context
        conf = Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        fresh_path(Session, "x")
    Context.master = "local[2]"
    first, second = fresh_path(Session, "x"), fresh_path(Session, "x")
    assert first != second and Path(first).parent == Path(second).parent
