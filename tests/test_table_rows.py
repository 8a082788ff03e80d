from pyspark.sql import functions as F

from rollcall.plans import cube_queries


def test_every_place_has_a_row(spark, monkeypatch):
    places = [(f"p{i:02}", "s" if k % 3 else "t") for i in range(12) for k in range(i + 1)]
    rows = spark.createDataFrame(places, "place string, sector string").withColumn("cluster", F.monotonically_increasing_id())
    monkeypatch.setattr(cube_queries, "rows_of", lambda *_: rows)
    got = cube_queries.q_table_rows(spark, "").collect()
    assert [(r.place, r.total) for r in got] == [(f"p{i:02}", i + 1) for i in reversed(range(12))]
