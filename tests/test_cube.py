import json
import zipfile

import pytest
from pyspark.sql import functions as F

from rollcall.operators import classify, cube, geo
from rollcall.operators.exact import numbered
from rollcall.plans import questions
from rollcall.plans.questions import Intent, checked, interpreted, parse
from rollcall.sources import files, ingest, xlsx


def test_classify(spark):
    raw = spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (3, 1, "b"), (4, 2, "zzz"), (5, 3, "b"), (6, 3, "a"), (7, 4, None)], "id long, entity_id long, activity string")
    entities = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    mapping = classify.checked_mapping(spark.createDataFrame([(" a ", "immobilier"), ("b", "energie-eau")], "activity string, sector string"))
    got = {r.id: (r.activity_main, r.sector) for r in classify.classified(raw, entities, mapping).collect()}
    assert got == {1: ("a", "immobilier"), 2: ("zzz", None), 3: ("a", "immobilier"), 4: (None, None), 5: (None, None)}
    for rows in ([("", "immobilier")], [("a", "immobilier"), ("a", "immobilier")], [("a", "nope")]):
        with pytest.raises(Exception, match="activity|sector"):
            classify.checked_mapping(spark.createDataFrame(rows, "activity string, sector string")).collect()
    assert len(classify.SECTORS) == 25
    assert classify.add_columns(entities, {"sector": "string", "id": "long"}).columns == ["id", "sector"]


def test_lexicon(spark):
    labels = spark.createDataFrame([("Vente de boissons", "food"), ("Boissons et vins", "food"), ("Transport de vins", "move"), ("Transport", "move")], "label string, sector string")
    assert {r.keyword: r.sector for r in classify.lexicon(labels).collect()} == {"boissons": "food", "transport": "move"}


def test_cluster_rows_and_grid(spark):
    entities = spark.createDataFrame([(1, "s", 1, 1), (2, "t", 1, 3), (3, "s", None, 1), (4, None, 4, 9)], "id long, sector string, cluster_id long, member_rows int")
    raw = spark.createDataFrame([(1, 1, "A", "q"), (2, 1, "B", "q"), (3, 2, "B", "r"), (4, 3, None, None), (5, None, "A", "q"), (6, 2, "B", "r")], "id long, entity_id long, commune string, quartier string")
    rows = cube.cluster_rows(entities, raw)
    assert {r.cluster: (r.sector, r.place) for r in rows.collect()} == {1: ("t", "B"), 3: ("s", None)}
    levels = {(r.level, r.place, r.sector): r.n for r in cube.grouping_sets(rows).collect()}
    assert levels[("total", None, None)] == 2 and levels[("place", "B", None)] == 1 and levels[("sector", None, "s")] == 1
    grid = {(r.place, r.sector): (r.n, r.sector_total, r.total) for r in cube.dense(rows).collect()}
    assert grid == {("B", "s"): (0, 1, 2), ("B", "t"): (1, 1, 2)}
    assert cube.excluded(entities).first().excluded == 1
    assert [(r.commune, r.quartier, r.n) for r in cube.top_districts(raw, "commune", "quartier", "entity_id").orderBy("commune", "quartier").collect()] == [("A", "q", 1), ("B", "q", 1), ("B", "r", 1)]


def test_classes(spark):
    rows = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    cuts = rows.agg(cube.class_cuts(F.col("v")).alias("c")).first().c
    values = list(range(1, 11))
    assert cuts == [float(values[min(9, int((i + 1) / 7 * 10))]) for i in range(6)]
    assert rows.limit(0).agg(cube.class_cuts(F.col("v")).alias("c")).first().c is None
    got = rows.select(cube.class_of(F.when(F.col("v") > 0, F.col("v")), F.array(*map(F.lit, cuts))).alias("k")).collect()
    assert [r.k for r in got][:2] == [-1, 0] and max(r.k for r in got) == 6
    assert spark.range(1).select(cube.rounded_share(F.lit(1), F.lit(8)).alias("s")).first().s == 13


def test_geometry(spark):
    multi = "array<array<array<array<double>>>>"
    square = [[[[0.12349, 0.0], [1.0, 0.0], [1.0, 2.0], [0.12349, 0.0]]]]
    shapes = spark.createDataFrame([("Séme-Kpodji", square), ("Other", square)], f"shape_name string, coordinates {multi}")
    found = geo.matched(spark.createDataFrame([("SEME-PODJI",)], "name string"), shapes).select(geo.bounds(F.col("coordinates")).alias("b"), geo.rounded(F.col("coordinates")).alias("r"), geo.mask(F.col("coordinates")).alias("m"), geo.feature(F.col("name"), F.col("coordinates")).alias("f")).first()
    assert found.b.asDict() == {"west": 0.12349, "south": 0.0, "east": 1.0, "north": 2.0} and found.r[0][0][0][0] == 0.123 and len(found.m) == 2
    assert json.loads(found.f)["properties"] == {"name": "SEME-PODJI"}
    with pytest.raises(Exception, match="no shape for"):
        geo.matched(spark.createDataFrame([("Nowhere",)], "name string"), shapes).collect()


def test_geojson_file(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    features = [{"type": "Feature", "properties": {"shapeName": n}, "geometry": {"type": t, "coordinates": c}} for n, t, c in [("a", "Polygon", [ring]), ("b", "MultiPolygon", [[ring], [ring]])]]
    (tmp_path / "x.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    assert {r.shape_name: len(r.coordinates) for r in files.read_features(spark, str(tmp_path / "x.geojson")).collect()} == {"a": 1, "b": 2}


PLACES, LABELS, LEXICON = ["ZE", "COTONOU", "ABOMEY-CALAVI"], {"food": "Alimentation", "move": "Transport"}, {"boisson": "food", "camion": "move"}
QUESTIONS = {
    "Combien de boissons à Cotonou ?": Intent("count", "food", ("COTONOU",)), "azerty": None, "Où le plus de camions": Intent("top", "move"), "densité de ZE": Intent("density", None, ("ZE",)), "abomey calavi ?": Intent("profile", None, ("ABOMEY-CALAVI",)),
    "Alimentation hors de Cotonou": None, "ZE et Cotonou": None, "camionneurs": Intent("count", "move"), "spécialisé en transport": Intent("spec", "move"), "le plus grand": None, "profil": Intent("density"), "treize": None, "": None,
}


def test_grammar(spark):
    places = spark.createDataFrame([(p,) for p in PLACES], "name string")
    lexicon = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(LEXICON.items())], "keyword string, sector string, ord int")
    asked = spark.createDataFrame([*enumerate(QUESTIONS)], "question_id int, text string")
    got = {r.question_id: r.action and Intent(r.action, r.sector, (r.place,) if r.place else ()) for r in interpreted(asked, places, LABELS, lexicon).collect()}
    assert [got[i] for i in range(len(QUESTIONS))] == [*QUESTIONS.values()]
    assert parse(spark, "camionneurs", places, LABELS, lexicon) == Intent("count", "move") and parse(spark, "azerty", places, LABELS, lexicon) is None


def test_checked_intents():
    assert checked({"action": "top", "sector": "food", "communes": [], "exclure": ["cotonou", "x", "ze"]}, {"food"}, set(PLACES)) == Intent("top", "food", (), ("COTONOU",))
    assert checked({"action": "drop"}, set(), set()) is None and checked({"action": "top", "sector": "nope"}, {"food"}, set()) is None
    assert [questions.accepts(*a, ("o",)) for a in [("POST", "o", "q"), ("GET", "o", "q"), ("POST", "x", "q"), ("POST", "o", "q" * 301), ("POST", "o", " ")]] == [200, 405, 403, 400, 400]


def workbook(path):
    sheet = lambda rows: '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + rows + "</sheetData></worksheet>"
    text = lambda ref, t: f'<c r="{ref}" t="inlineStr"><is><t>{t}</t></is></c>'
    one = '<row r="1">' + text("A1", "name") + "</row>" + '<row r="2">' + '<c r="A2" t="s"><v>0</v></c>' + text("C2", " COTONOU ") + '<c r="E2"><v>97000001.0</v></c>' + text("F2", "A@B.co") + text("H2", "ninth") + "</row><row r=\"3\"/>" + '<row r="4">' + text("A4", "Second") + text("E4", "01970000/96000002") + "</row>"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Board" sheetId="1" r:id="r1"/><sheet name="One" sheetId="2" r:id="r2"/><sheet name="Two" sheetId="3" r:id="r3"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in (1, 2, 3)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><r><t>Éts </t></r><r><t>Koffi</t></r></si></sst>')
        for i, rows in ((1, ""), (2, one), (3, '<row r="1"/><row r="2">' + text("A2", "Third") + "</row>")):
            z.writestr(f"xl/worksheets/s{i}.xml", sheet(rows))


def test_workbook(spark, tmp_path):
    workbook(tmp_path / "b.xlsx")
    xlsx.register(spark)
    book = spark.read.format("xlsx").option("path", str(tmp_path / "b.xlsx")).option("skip", "Board").load()
    rows = numbered(ingest.raw_contacts(book), "position").orderBy("id").collect()
    assert [(r.id, r.sheet, r.row_index, r.name) for r in rows] == [(1, "One", 1, "Éts Koffi"), (2, "One", 3, "Second"), (3, "Two", 1, "Third")]
    assert rows[0].commune == "COTONOU" and rows[0].phone_raw == "97000001.0" and rows[0].phone_status == "migre" and rows[0].email_norm == "a@b.co" and rows[0].segment is None
    assert rows[1].phone_e164 == "+2290196000002" and rows[1].phone_extra == 1 and rows[2].phone_status == "vide"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 1), ("é", None)], "x string, y int").coalesce(1)
    files.write_csv(df, str(tmp_path / "out"))
    data = next((tmp_path / "out").glob("*.csv")).read_bytes().decode()
    assert data.startswith("﻿x;y\r\n") and '"a;b";1\r\n' in data
    pop = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, pop long")
    assert sorted((r.name, r.pop) for r in files.checked_population(pop, 2).collect()) == [("a", 2), ("b", 3)]
    with pytest.raises(Exception, match="expected 77"):
        files.checked_population(pop, 77).collect()
    for _ in range(2):
        files.overwrite(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    page = files.page(spark.createDataFrame([('{"a":"</x>"}',)], "j string"), "<p>__PAYLOAD__ __DATE__</p>", F.lit("2024-05-06").cast("date")).first().html
    assert page == '<p>{"a":"<\\/x>"} 2024-05-06</p>'
