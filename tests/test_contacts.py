import pytest
from pyspark.sql import functions as F

from rollcall.functions import contacts, text

PHONES = [
    ("97000001", "+2290197000001", "migre"), ("21304050", "+2290121304050", "migre"), ("0197000001", "+2290197000001", "deja_migre"), ("97 00 00 01", "+2290197000001", "migre"),
    ("97-00.00(01)", "+2290197000001", "migre"), ("+229 97000001", "+2290197000001", "migre"), ("0022997000001", "+2290197000001", "migre"), ("2290197000001", "+2290197000001", "deja_migre"),
    ("22997000", "+2290122997000", "migre"), ("197000001", "+2290197000001", "zero_restaure"), ("01970000", None, "suspect_01_court"), ("17000001", None, "invalide"), ("0137000001", None, "invalide"),
    ("137000001", None, "invalide"), ("9700", None, "invalide"), ("abc", None, "invalide"), ("0297000001", None, "invalide"), ("97000001/96000002", None, "invalide"), ("", None, "vide"), (None, None, "vide"), ("  ", None, "vide"), (" ", None, "vide"),
    ("97 000001", "+2290197000001", "migre"),
]


def test_single(spark):
    rows = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(PHONES)], "i int, raw string")
    got = {r.i: (r.p.e164, r.p.status) for r in rows.select("i", contacts.phone(F.col("raw")).alias("p")).collect()}
    assert got == {i: (e, s) for i, (_, e, s) in enumerate(PHONES)}


@pytest.mark.parametrize(("raw", "statuses", "best"), [
    ("97000001/96000002", ["migre", "migre"], "+2290197000001"), ("01970000, 96000002", ["suspect_01_court", "migre"], "+2290196000002"), ("97000001 96000002", ["invalide"], None), (None, ["vide"], None), ("none", ["invalide"], None),
])
def test_several(spark, raw, statuses, best):
    r = spark.createDataFrame([(raw,)], "raw string").select(contacts.phones(F.col("raw")).alias("p")).select("p", contacts.best_phone(F.col("p")).alias("b")).first()
    assert [p.status for p in r.p] == statuses and r.b.e164 == best


def test_numeric_cells(spark):
    rows = spark.createDataFrame([("97000001.0", True), ("97000001.0", False)], "c string, n boolean")
    got = [r.p.status for r in rows.select(contacts.phone(text.phone_text(F.col("c"), F.col("n"))).alias("p")).collect()]
    assert got[0] == "migre"
    assert [r.t for r in rows.select(text.cell_text(F.col("c")).alias("t")).collect()] == ["97000001.0"] * 2


@pytest.mark.parametrize(("raw", "normalized", "status"), [
    ("A.B@Example.COM", "a.b@example.com", "valide"), (" a@b.co ", "a@b.co", "valide"), ("a b@c.org", "ab@c.org", "valide"), ("97000001", None, "invalide"), ("a@b", None, "invalide"), ("@b.co", None, "invalide"),
    ("a@.co", None, "invalide"), ("a@b.c", None, "invalide"), (".a@b.co", None, "invalide"), ("", None, "vide"), (None, None, "vide"), ("x@y.co\n", "x@y.co", "valide"),
])
def test_email(spark, raw, normalized, status):
    r = spark.createDataFrame([(raw,)], "raw string").select(contacts.email(F.col("raw")).alias("e")).first().e
    assert (r.normalized, r.status) == (normalized, status)


def test_names(spark):
    rows = spark.createDataFrame([(0, "  Éts  KOFFI & Fils (2) "), (1, "Œuvre Ñandú-42"), (2, None), (3, "SARL de la 123 ab")], "i int, n string")
    got = {r.i: r for r in rows.select("i", text.canonical(F.col("n")).alias("c"), text.tokens(F.col("n")).alias("t"), text.blocking_tokens(F.col("n")).alias("b")).collect()}
    assert got[0].c == "ETS KOFFI FILS 2" and got[0].b == ["KOFFI"]
    assert got[1].c == "UVRE NANDU 42" and got[1].b == ["UVRE", "NANDU"]
    assert got[2].c == "" and got[2].t == [] and got[3].b == []


def test_fold_table_is_the_unicode_decomposition(spark):
    import unicodedata

    chars = [chr(c) for c in range(0x80, 0x2100) if unicodedata.category(chr(c))[0] == "L"]
    rows = spark.createDataFrame(list(enumerate(chars)), "i int, c string").select("i", text.unaccented(F.col("c")).alias("f")).collect()
    for r in rows:
        want = "".join(x for x in unicodedata.normalize("NFD", chars[r.i]) if not unicodedata.combining(x))
        if len(want) == 1:
            assert r.f == want
