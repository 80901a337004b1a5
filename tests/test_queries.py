"""Each query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from glyphloom.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(map(repr, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    ours, theirs = QUERIES[name](spark, DIR).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def against_sql(spark, name, folder, table, frame):
    """Rows of a query and of its SQL over one table that holds this frame."""
    frame.write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return rows(QUERIES[name](spark, str(folder)).toPandas()), rows(con.execute(ORACLES[name]).df())


def test_cut_entities(spark, tmp_path):
    html = ["<title>a&amp</title>b", "&am<p>x</p>", "&ampx; &copy &copy; &lt;b&gt; &#65; &amp;copy; & && &amp;", "&middot<br>&middot;&quot", None]
    ours, theirs = against_sql(spark, "html_to_text", tmp_path, "pages", spark.createDataFrame(list(enumerate(html)), "page_id long, html string"))
    assert ours == theirs


@pytest.mark.parametrize("name", ["matroska_packets", "matroska_cues"])
def test_files_are_made_where_they_are_read(spark, name):
    """Two steps in Python would each hold batches, those of the second of whole files."""
    import __spark_entry__ as e
    from glyphloom.llm import media

    plan = e.queries()[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    texts = spark.createDataFrame([(1, "a" * 5000), (2, None), (3, "")], "doc_id long, text string")
    table = media.packets if name == "matroska_packets" else media.cues
    there = lambda df: sorted(map(tuple, df.collect()))
    assert there(table(texts, "doc_id", "text", texts=True)) == there(table(media.files(texts), "doc_id", "content")) != []


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
