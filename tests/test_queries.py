"""Every registered query against its DuckDB SQL at the smallest scale."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

from pyspark.sql import functions as F

from pagewright import registry
from pagewright.operators import chunk, flatten
from pagewright.plans import adapters

from .conftest import SF

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def flat(value) -> str:
    return f"{value:.9g}" if isinstance(value, float) else repr(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(tuple(flat(r[c]) for c in columns) for r in df.collect())
    expected = duck.sql(registry.oracle_sql()[name])
    at = [expected.columns.index(c) for c in sorted(expected.columns)]
    assert columns == sorted(expected.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert found == sorted(tuple(flat(r[i]) for i in at) for r in expected.fetchall())
    assert found


ODD = (
    "",
    "\n",
    "first line of it\n\nthird   line\n \t \n\u00a0\n1. numbered\n* starred\n2. two | cells\nabc\t\n\u2003wide\u3000\nends\r\n7.\n8.\n9. \n10.  x\n11. \t|\n",
    "* one\n2.\n* three\n4. four\n5. five\n* six\n* seven\n\t8. eight",
    "a\n \nbcde\n" * 6,
)


def check_odd(spark, folder, name):
    rows = [(i, text, "source") for i, text in enumerate((*ODD, None, *("words\n" * i + "12. end" for i in range(30))))]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet/*.parquet'")
    expected = con.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](spark, str(folder)).select(*[f"`{c}`" for c in expected.columns]).collect()
    assert sorted(tuple(map(flat, r)) for r in found) == sorted(tuple(map(flat, r)) for r in expected.fetchall())


@pytest.mark.parametrize("name", ["block_classify", "page_texts", "heading_rank", "body_font_size", "document_summary"])
def test_blocks_of_odd_texts(spark, tmp_path, name):
    check_odd(spark, tmp_path, name)


@pytest.mark.parametrize("name", ["chunk_sections", "chunk_pages"])
def test_places_of_chunks_need_no_texts(spark, tmp_path, name):
    check_odd(spark, tmp_path, "chunk_pages")
    odd = adapters.elements(spark, str(tmp_path)).withColumn("section_id", F.when(F.col("seq") % 4 == 1, F.col("seq").cast("string")))
    whole, places = chunk.chunks(odd, 20, 5), chunk.chunk_places(chunk.counted_units(odd), 20)
    assert sorted(map(str, whole.drop("text", "prev_chunk_tail").collect())) == sorted(map(str, places.collect()))
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "prev_chunk_tail" not in plan and "collect_list(struct(seq" in plan and not re.search(r"collect_list\(struct\(seq, [^)]*\btext\b", plan)


def test_flattened_columns_are_those_asked_for(spark, tmp_path):
    check_odd(spark, tmp_path, "reading_order")
    layouts = adapters.layouts(spark, str(tmp_path))
    whole = flatten.flatten_layouts(layouts)
    for columns in (["doc_id", "order", "source_ref", "bbox"], ["order", "text", "doc_id", "rows", "marker"]):
        some = flatten.flatten_layouts(layouts, columns)
        assert set(some.columns) == set(columns) and some.count() == whole.count()
        assert sorted(map(str, some.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
    with pytest.raises(ValueError):
        flatten.flatten_layouts(layouts, ["nothing"])
    assert "raw_text" not in registry.queries()["reading_order"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_list_markers_of_odd_texts(spark, tmp_path):
    check_odd(spark, tmp_path, "list_markers")


def test_word_joins_of_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "plain words " * 20 + "Misintroduced here")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [r.samples for r in registry.queries()["word_join_samples"](spark, str(tmp_path)).collect()] == ["misintroduced"]


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
