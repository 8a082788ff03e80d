"""CSV and GeoJSON in, CSV and JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the byte-order mark that spreadsheet programs look for.
BOM = "﻿"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with header; columns by position of schema, quotes doubled."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', enforceSchema=True)


def checked_population(rows: DataFrame, expected: int | None = None) -> DataFrame:
    """name and pop, one row for each name (the largest of several values); if expected is given another number of names fails the query."""
    one = rows.groupBy("name").agg(F.max("pop").alias("pop"))
    if expected is None:
        return one
    n = one.agg(F.count("*").alias("n"))
    wrong = F.raise_error(F.concat(F.lit(f"expected {expected} names, found "), F.col("n").cast("string"))).cast("long")
    return one.join(F.broadcast(n)).withColumn("pop", F.when(F.col("n") == expected, F.col("pop")).otherwise(wrong)).drop("n")


def read_features(spark: SparkSession, path: str, name: str = "shapeName") -> DataFrame:
    """shape_name and coordinates of a GeoJSON collection; a Polygon becomes a MultiPolygon of one."""
    shape = f"struct<features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", shape)["features"].alias("f"))
    rows = text.select(F.explode("f").alias("f")).select(F.try_element_at("f.properties", F.lit(name)).alias("shape_name"), F.col("f.geometry.type").alias("t"), F.col("f.geometry.coordinates").alias("c"))
    multi = "array<array<array<array<double>>>>"
    return rows.select("shape_name", F.when(F.col("t") == "Polygon", F.array(F.from_json("c", "array<array<array<double>>>"))).otherwise(F.from_json("c", multi)).alias("coordinates"))


def csv_line(*columns: Column, sep: str = ";") -> Column:
    """A line of CSV: fields with the separator, a quote or a line break are quoted."""
    def field(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(text.rlike(f'[{sep}"\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(sep, *map(field, columns))


def write_csv(df: DataFrame, path: str, sep: str = ";", line_sep: str = "\r\n", bom: bool = True) -> None:
    """df as CSV files of sep and line_sep; bom goes before the header of each file."""
    header = [(BOM if bom else "") + df.columns[0], *df.columns[1:]]
    df.toDF(*header).write.mode("overwrite").csv(path, header=True, sep=sep, lineSep=line_sep, escape='"')


def overwrite(df: DataFrame, path: str) -> None:
    """Drop and create: a second run leaves the same table."""
    df.write.mode("overwrite").parquet(path)


def updated(df: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with columns taken from changes where changes has the key; a new frame instead of updates in place."""
    new = changes.select(key, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = df.join(new, key, "left")
    return joined.withColumns({c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c in columns}).select(*df.columns, *[c for c in columns if c not in df.columns])


def page(json: DataFrame, template: str, built: Column | None = None) -> DataFrame:
    """One row `html`: template with __PAYLOAD__ and __DATE__ filled in. json has one row and column."""
    body = F.replace(F.lit(template), F.lit("__PAYLOAD__"), F.replace(F.col(json.columns[0]), F.lit("</"), F.lit("<\\/")))
    return json.select(F.replace(body, F.lit("__DATE__"), F.date_format(built if built is not None else F.current_date(), "yyyy-MM-dd")).alias("html"))
