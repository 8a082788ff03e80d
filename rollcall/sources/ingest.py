"""From workbook rows to clean raw rows, and reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.contacts import best_phone, email, phones
from rollcall.functions.text import cell_text, phone_text

# The order of a sheet's columns.
FIELDS = ("name", "activity", "commune", "quartier", "phone_raw", "email_raw", "segment")


def raw_contacts(workbook: DataFrame) -> DataFrame:
    """The xlsx source's rows as raw contacts: trimmed texts, one number of each phone cell and how many more it holds, an e-mail, and their statuses. id comes from numbered(df, "position")."""
    cell = lambda i: F.get(F.col("cells"), i)
    found = phones(phone_text(cell(4), F.coalesce(F.get(F.col("is_numeric"), 4), F.lit(False))))
    texts = workbook.select(F.struct("sheet_order", "row_index").alias("position"), "sheet", "row_index", *[cell_text(cell(i)).alias(n) for i, n in enumerate(FIELDS)], found.alias("phones"))
    texts = texts.withColumns({"p": best_phone(F.col("phones")), "e": email(F.col("email_raw"))})
    return texts.select("position", "sheet", "row_index", *FIELDS, F.col("p.e164").alias("phone_e164"), F.col("p.status").alias("phone_status"), (F.size("phones") - 1).alias("phone_extra"), F.col("e.normalized").alias("email_norm"), F.col("e.status").alias("email_status"))


def report(raw: DataFrame, column: str) -> DataFrame:
    return raw.groupBy(column).count().orderBy(F.desc("count"), column)
