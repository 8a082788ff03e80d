"""Precision, recall and score bands against labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scoring import MERGE

# Labels, and the bounds of score bands.
YES, NO, UNSURE = "oui", "non", "incertain"
BANDS = ((0.0, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 1.01))


def checked_labels(gold: DataFrame, column: str = "same_business") -> DataFrame:
    """gold with trimmed lower-case labels and DOUBLE scores; a row with any other label fails the query."""
    label = F.lower(F.trim(F.col(column)))
    bad = F.concat(F.lit("not a label: "), F.coalesce(F.col(column), F.lit("null")))
    return gold.withColumn(column, F.when(label.isin(YES, NO, UNSURE), label).otherwise(F.raise_error(bad).cast("string"))).withColumn("score", F.col("score").cast("double"))


def contingency(gold: DataFrame) -> DataFrame:
    """Rows of each zone by label, unsure ones too."""
    return gold.groupBy("zone").pivot("same_business", [YES, NO, UNSURE]).count().na.fill(0, [YES, NO, UNSURE])


def precision_recall(gold: DataFrame) -> DataFrame:
    """Of pairs with a sure label: precision of the merge zone, and the share of true pairs in it; null where there is nothing to divide by."""
    sure = gold.where(F.col("same_business") != UNSURE)
    merged, same = F.col("zone") == MERGE, F.col("same_business") == YES
    both = F.count_if(merged & same)
    return sure.agg(F.try_divide(both, F.count_if(merged)).alias("precision"), F.try_divide(both, F.count_if(same)).alias("recall"))


def band_rates(gold: DataFrame, bands=BANDS) -> DataFrame:
    """low, high, positives, total of every band of scores, empty bands too; a row falls in the band that low <= score < high."""
    rows = gold.sparkSession.createDataFrame([(float(a), float(b)) for a, b in bands], "low double, high double")
    counted = gold.where(F.col("same_business") != UNSURE)
    joined = rows.join(_banded(counted, bands), ["low", "high"], "left")
    return joined.select("low", "high", F.coalesce("positives", F.lit(0)).alias("positives"), F.coalesce("total", F.lit(0)).alias("total"))


def _banded(counted: DataFrame, bands) -> DataFrame:
    band = F.lit(None).cast("struct<low:double,high:double>")
    for low, high in bands:
        band = F.when((F.col("score") >= low) & (F.col("score") < high), F.struct(F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))).otherwise(band)
    return counted.select(band.alias("b"), "same_business").where("b is not null").groupBy("b.low", "b.high").agg(F.count_if(F.col("same_business") == YES).alias("positives"), F.count("*").alias("total"))


def confusion(judged: DataFrame) -> DataFrame:
    """true and false positives, misses and rejections, precision and recall of verdicts (`meme`, `diff`, `incertain`) on pairs with a sure label; unsure verdicts on true pairs are misses."""
    sure = judged.where(F.col("same_business") != UNSURE)
    yes, said = F.col("same_business") == YES, F.col("verdict") == "meme"
    tp, fp, fn = F.count_if(yes & said), F.count_if(~yes & said), F.count_if(yes & ~said)
    return sure.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.count_if(~yes & ~said).alias("tn"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"))
