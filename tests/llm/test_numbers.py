"""Row numbers hold in every pass, also where the files are split otherwise from one pass to the next, as when executors are lost or join."""

import random
from itertools import count

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from rollcall.llm import decontaminate, exact, simhash, substring, suffix

SPLITS = [{"maxPartitionBytes": "64k", "openCostInBytes": "64k"}, {"maxPartitionBytes": "128m", "openCostInBytes": "0"}]


@pytest.fixture
def docs(spark, monkeypatch):
    """A table of eight files that is split otherwise after every table that is written."""
    rng = random.Random(7)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    passage = prose(60)
    rows = [(i, f"{prose(90)} {passage}" if i % 7 == 0 else prose(rng.randrange(30, 150))) for i in range(160)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 160, 5)]
    path = f"{spark.conf.get('spark.checkpoint.dir')}/numbers"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.mode("overwrite").parquet(path)
    turn, write = count(), DataFrameWriter.parquet

    def parquet(self, *a, **k):
        write(self, *a, **k)
        for key, value in SPLITS[next(turn) % 2].items():
            spark.conf.set(f"spark.sql.files.{key}", value)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    yield spark.read.parquet(path), dict(rows), passage
    for key in SPLITS[0]:
        spark.conf.unset(f"spark.sql.files.{key}")


def test_drop_rows(spark, docs):
    table, texts, passage = docs
    once = {i for i in texts if i < 1000}
    assert sorted(r.doc_id for r in exact.drop_exact_copies(table).collect()) == sorted(once)
    assert {r.doc_id for r in simhash.drop_near_copies(table).collect()} == once
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.drop_contaminated(table, benchmark).collect()} == {i for i, t in texts.items() if passage not in t}


def test_repeats(docs):
    table, texts, passage = docs
    words = {r.doc_id: r for r in substring.remove_repeated_words(table, {"n": "n_items", "gone": "n_removed"}).collect()}
    for i, t in texts.items():
        n = len(t.split())
        assert (words[i].n, words[i].gone) == (n, n if i >= 1000 else 60 if passage in t and i else 0)
    size = len(passage)
    for r in suffix.remove_repeated_bytes(table, {"n": "n_items", "gone": "n_removed"}).collect():
        t = texts[r.doc_id]
        copied = r.doc_id >= 1000 or r.doc_id % 5 == 0
        assert r.n == len(t) and (r.gone == len(t) if copied else size <= r.gone <= size + 3 if passage in t else r.gone == 0)
