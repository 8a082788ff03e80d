"""Exact grouping of raw rows into entities, with representatives, surrogate keys and back-links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import canonical

KEY = ("key_name", "key_phone", "key_email")


def keyed(raw: DataFrame) -> DataFrame:
    """raw with the three parts of its key; null and empty are the same there."""
    return raw.withColumns({"key_name": canonical(F.col("name")), "key_phone": F.coalesce("phone_raw", F.lit("")), "key_email": F.coalesce("email_norm", F.lit(""))})


def filled(value: Column) -> Column:
    """value, with empty as null."""
    return F.when(value != "", value)


def first_filled(value: Column, order: Column) -> Column:
    return F.min(F.when(filled(value).isNotNull(), F.struct(order.alias("o"), value.alias("v"))))["v"]


def distinct_filled(value: Column) -> Column:
    return F.array_sort(F.collect_set(filled(value)))


def groups(raw: DataFrame) -> DataFrame:
    """One row for each key: first id, representatives, sorted distinct places and sheets, number of rows.

    The name is the longest (the first of several, by id); the number and its status come from the first row that
    has a number, else the status is the first one. A partial aggregation precedes the only shuffle.
    """
    i = F.col("id")
    name = F.max(F.when(F.col("name").isNotNull(), F.struct(F.length("name").alias("l"), (-i).alias("o"), F.col("name").alias("v"))))["v"]
    number = F.min(F.when(F.col("phone_e164").isNotNull(), F.struct(i.alias("o"), F.col("phone_e164").alias("e"), F.col("phone_status").alias("s"))))
    status = F.min(F.when(F.col("phone_status").isNotNull(), F.struct(i.alias("o"), F.col("phone_status").alias("v"))))["v"]
    return keyed(raw).groupBy(*KEY).agg(
        F.min("id").alias("first_id"), F.coalesce(name, F.lit("")).alias("name"), first_filled(F.col("phone_raw"), i).alias("phone_raw"), number["e"].alias("phone_e164"),
        F.coalesce(number["s"], status).alias("phone_status"), first_filled(F.col("email_norm"), i).alias("email_norm"),
        distinct_filled(F.col("commune")).alias("communes"), distinct_filled(F.col("quartier")).alias("quartiers"), distinct_filled(F.col("segment")).alias("segments"),
        distinct_filled(F.col("sheet")).alias("sheets"), F.count("*").alias("member_rows"))


def numbered(df: DataFrame, order: str, into: str = "id") -> DataFrame:
    """df with 1, 2, ... by order, without bringing all rows together: ranges are sorted apart and offset by the sizes of those before."""
    spark = df.sparkSession
    from rollcall.storage import materialise

    ranged = materialise(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"), F.min("__i").alias("low")).orderBy("__p").collect()  # one row for each partition
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["__p"], total - r["low"] + 1))
        total += r["n"]
    if not offsets:
        return ranged.withColumn(into, F.col("__i")).drop("__p", "__i")
    shift = spark.createDataFrame(offsets, "__p int, __shift long")
    return ranged.join(F.broadcast(shift), "__p").withColumn(into, F.col("__i") + F.col("__shift")).drop("__p", "__i", "__shift")


def entities(raw: DataFrame) -> DataFrame:
    """groups numbered by the first row of each; name_norm is the key's name."""
    return numbered(groups(raw), "first_id").withColumn("name_norm", F.col("key_name"))


def members(raw: DataFrame, found: DataFrame) -> DataFrame:
    """raw with the entity_id of each row."""
    return keyed(raw).join(found.select(*KEY, F.col("id").alias("entity_id")), list(KEY)).drop(*KEY)
