"""Queries on classification, the cube, its metrics, questions, geometry and rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import text
from rollcall.operators import classify, cube, geo
from rollcall.plans import questions
from rollcall.plans.catalogue import query
from rollcall.plans.questions import Intent
from rollcall.sources import files
from rollcall.storage import table
from rollcall.streaming import limiter

_ROWS = "cr AS (SELECT n_name AS place, c_mktsegment AS sector FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_POP = "pop AS (SELECT n_name AS place, count(s_suppkey) AS pop FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1)"
_GRID = f"""{_ROWS}, p AS (SELECT place, count(*) AS place_total FROM cr GROUP BY 1), s AS (SELECT sector, count(*) AS sector_total FROM cr GROUP BY 1), c AS (SELECT place, sector, count(*) AS n FROM cr GROUP BY 1, 2),
grid AS (SELECT p.place, s.sector, coalesce(c.n, 0) AS n, place_total, sector_total, (SELECT count(*) FROM cr) AS total FROM p CROSS JOIN s LEFT JOIN c ON c.place = p.place AND c.sector = s.sector)"""
_LQ = "(n::DOUBLE / place_total) / (sector_total::DOUBLE / total)"


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation and segment; the nations are a short dimension table and are broadcast if they are small."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("place"))
    return table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_mktsegment").alias("sector")).join(nation, "c_nationkey").select("place", "sector")


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("pop"))
    return table(spark, sf_dir, "nation").join(suppliers, "n_nationkey", "left").select(F.col("n_name").alias("place"), F.coalesce("pop", F.lit(0)).alias("pop"))


@query(f"WITH {_GRID} SELECT place, sector, n, round({_LQ}, 6) AS lq FROM grid")
def q_location_quotient(spark, sf_dir):
    lq = cube.quotient(F.col("n"), F.col("place_total"), F.col("sector_total"), F.col("total"))
    return cube.dense(rows_of(spark, sf_dir)).select("place", "sector", "n", F.round(lq, 6).alias("lq"))


@query("SELECT n_name AS place, c_mktsegment AS sector, CASE grouping(n_name, c_mktsegment) WHEN 3 THEN 'total' WHEN 2 THEN 'sector' WHEN 1 THEN 'place' ELSE 'cell' END AS level, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((), (c_mktsegment), (n_name), (n_name, c_mktsegment))")
def q_cube(spark, sf_dir):
    return cube.grouping_sets(rows_of(spark, sf_dir))


@query(f"WITH {_GRID} SELECT place, sector, n FROM grid")
def q_volume(spark, sf_dir):
    return cube.dense(rows_of(spark, sf_dir)).select("place", "sector", "n")


@query(f"WITH {_ROWS}, {_POP}, t AS (SELECT place, count(*) AS n FROM cr GROUP BY 1) SELECT t.place, n, pop, round(CASE WHEN pop > 0 THEN n::DOUBLE / pop * 1000 ELSE 0 END, 6) AS density FROM t JOIN pop ON t.place = pop.place")
def q_density(spark, sf_dir):
    totals = rows_of(spark, sf_dir).groupBy("place").agg(F.count("*").alias("n")).join(population(spark, sf_dir), "place")
    return totals.select("place", "n", "pop", F.round(cube.per_thousand(F.col("n"), F.col("pop")), 6).alias("density"))


@query(f"WITH {_GRID}, v AS (SELECT place, sector, CASE WHEN place_total >= 60 THEN {_LQ} ELSE 0.0 END AS lq FROM grid), r AS (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY lq DESC, place) AS rank FROM v) SELECT sector, place, rank, round(lq, 6) AS lq FROM r WHERE rank <= 3")
def q_lq_top3(spark, sf_dir):
    lq = cube.quotient_or_zero(cube.quotient(F.col("n"), F.col("place_total"), F.col("sector_total"), F.col("total")), F.col("place_total"), 60)
    ranked = cube.rank_places(cube.dense(rows_of(spark, sf_dir)).withColumn("lq", lq), "lq", within=("sector",)).where("rank <= 3")
    return ranked.select("sector", "place", F.col("rank").cast("long").alias("rank"), F.round("lq", 6).alias("lq"))


@query(f"""WITH {_GRID}, l AS (SELECT sector, list_sort(list(n::DOUBLE) FILTER (n > 0)) AS v FROM grid GROUP BY 1), k AS (SELECT sector, list_transform(range(0, 6), lambda i: v[least(len(v) - 1, CAST(floor((i + 1)::DOUBLE / 7.0::DOUBLE * len(v)) AS INT)) + 1]) AS cuts FROM l)
SELECT g.place, g.sector, len(list_filter(cuts, lambda x: g.n >= x)) AS class, array_to_string(list_transform(cuts, lambda x: CAST(CAST(x AS INT) AS VARCHAR)), ',') AS cuts FROM grid g JOIN k ON g.sector = k.sector""")
def q_quantile_classes(spark, sf_dir):
    grid = cube.dense(rows_of(spark, sf_dir))
    cuts = grid.groupBy("sector").agg(cube.class_cuts(F.col("n")).alias("cuts"))
    return grid.join(cuts, "sector").select("place", "sector", cube.class_of(F.col("n"), F.col("cuts")).cast("long").alias("class"), F.array_join(F.transform("cuts", lambda c: c.cast("int").cast("string")), ",").alias("cuts"))


@query(f"WITH {_GRID} SELECT place, sector, CASE WHEN {_LQ} IS NULL THEN -1 ELSE len(list_filter([0.33, 0.5, 0.8, 1.25, 2.0, 3.0], lambda x: {_LQ} >= x)) END AS class FROM grid")
def q_lq_classes(spark, sf_dir):
    lq = cube.quotient(F.col("n"), F.col("place_total"), F.col("sector_total"), F.col("total"))
    return cube.dense(rows_of(spark, sf_dir)).select("place", "sector", cube.class_of(lq, F.array(*map(F.lit, cube.LQ_CUTS))).cast("long").alias("class"))


@query(f"""WITH {_GRID}, l AS (SELECT sector, list_sort(list(n::DOUBLE) FILTER (n > 0)) AS v FROM grid GROUP BY 1), k AS (SELECT sector, list_transform(range(0, 6), lambda i: v[least(len(v) - 1, CAST(floor((i + 1)::DOUBLE / 7.0::DOUBLE * len(v)) AS INT)) + 1]) AS cuts FROM l)
SELECT sector, unnest(range(0, 7)) AS class, unnest(list_concat([1.0::DOUBLE], cuts)) AS low, unnest(list_concat(cuts, [NULL])) AS high FROM k""")
def q_legend(spark, sf_dir):
    cuts = cube.dense(rows_of(spark, sf_dir)).groupBy("sector").agg(cube.class_cuts(F.col("n")).alias("cuts"))
    return cuts.select("sector", F.posexplode(cube.legend(F.col("cuts"), 1.0)).alias("class", "z")).select("sector", F.col("class").cast("long").alias("class"), "z.low", "z.high")


@query(f"WITH {_ROWS} SELECT place, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, place) AS rank FROM cr GROUP BY 1")
def q_rank_place(spark, sf_dir):
    totals = rows_of(spark, sf_dir).groupBy("place").agg(F.count("*").alias("n"))
    return cube.rank_places(totals, "n").withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {_GRID} SELECT place, sector, n, row_number() OVER (PARTITION BY sector ORDER BY n DESC, place) AS rank FROM grid")
def q_rank_in_segment(spark, sf_dir):
    return cube.rank_places(cube.dense(rows_of(spark, sf_dir)), "n", within=("sector",)).select("place", "sector", "n", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, sector) AS r FROM grid) SELECT place, sector AS dominant, CAST(floor(100.0 * n / place_total + 0.5) AS BIGINT) AS share FROM r WHERE r = 1")
def q_dominant_share(spark, sf_dir):
    return cube.dominant(cube.dense(rows_of(spark, sf_dir)))


@query(f"WITH {_GRID}, b AS (SELECT sector, max(CASE WHEN place = 'NATION_3' THEN n ELSE 0 END) AS first_n, max(CASE WHEN place = 'NATION_7' THEN n ELSE 0 END) AS second_n FROM grid WHERE place IN ('NATION_3', 'NATION_7') GROUP BY 1) SELECT * FROM b WHERE first_n > 0 OR second_n > 0 ORDER BY (sector <> 'MACHINERY')::INT, greatest(first_n, second_n) DESC, sector LIMIT 4")
def q_compare_two(spark, sf_dir):
    return cube.compared(cube.dense(rows_of(spark, sf_dir)), "NATION_3", "NATION_7", "MACHINERY", 4)


@query("SELECT count(*) AS total, count(n_name) AS located, count(DISTINCT n_name) AS places, count(DISTINCT c_mktsegment) AS sectors FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 > 0")
def q_tiles(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 5 > 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("place"))
    return cube.tiles(table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left").select("place", F.col("c_mktsegment").alias("sector")))


@query("SELECT o_orderpriority AS place, o_orderstatus AS district, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) AS r FROM (SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1, 2)) WHERE r <= 2")
def q_top_districts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("place"), F.col("o_orderstatus").alias("district"), "o_custkey")
    return cube.top_districts(orders, "place", "district", "o_custkey", 2)


@query("SELECT l_suppkey AS supplier, p_type AS main FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, p_type) AS r FROM (SELECT l_suppkey, p_type, count(*) AS c FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE r = 1")
def q_majority_type(spark, sf_dir):
    return classify.majority(_sold(spark, sf_dir), "supplier", "kind", "main")


@query("SELECT l_suppkey AS supplier, p_type AS main FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY w DESC, o, p_type) AS r FROM (SELECT l_suppkey, p_type, sum(CAST(l_quantity AS BIGINT)) AS w, min(l_orderkey) AS o FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE r = 1")
def q_majority_weighted(spark, sf_dir):
    return classify.weighted_majority(_sold(spark, sf_dir), "supplier", "kind", F.col("quantity"), F.col("l_orderkey"), "main")


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kind"), "p_brand")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_suppkey").alias("supplier"), "l_orderkey", F.col("l_quantity").cast("long").alias("quantity"))
    return lines.join(part, "l_partkey")


_MAIN = "m AS (SELECT l_suppkey AS id, p_brand AS activity_main FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, p_brand) AS r FROM (SELECT l_suppkey, p_brand, count(*) AS c FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE r = 1), map AS (SELECT 'Brand#' || i AS activity, 'sector' || (i % 4) AS sector FROM range(0, 15) t(i))"


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = spark.range(15).select(F.concat(F.lit(" Brand#"), "id").alias("activity"), F.concat(F.lit("sector"), F.col("id") % 4).alias("sector"))
    mapping = classify.checked_mapping(mapping, [f"sector{i}" for i in range(4)])
    raw = _sold(spark, sf_dir).select(F.col("supplier").alias("entity_id"), F.col("p_brand").alias("activity"))
    return classify.classified(raw, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), mapping)


@query(f"WITH {_MAIN} SELECT s_suppkey AS id, activity_main, sector FROM supplier LEFT JOIN m ON m.id = s_suppkey LEFT JOIN map ON activity = activity_main")
def q_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("id", "activity_main", "sector")


@query(f"WITH {_MAIN} SELECT sector, count(*) AS count FROM supplier LEFT JOIN m ON m.id = s_suppkey LEFT JOIN map ON activity = activity_main GROUP BY 1")
def q_sector_distribution(spark, sf_dir):
    return classify.distribution(_classified(spark, sf_dir))


@query(f"WITH {_MAIN} SELECT activity_main, count(*) AS count FROM m LEFT JOIN map ON activity = activity_main WHERE sector IS NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def q_unknown_lookup(spark, sf_dir):
    return classify.unknown_activities(_classified(spark, sf_dir))


_CLUSTERED = """ent AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS sector, c_custkey % 3 + 1 AS member_rows, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey - c_custkey % 3 END AS cluster_id FROM customer),
rw AS (SELECT o_custkey AS entity_id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS commune FROM orders)"""


@query(f"""WITH {_CLUSTERED}, k AS (SELECT id, sector, member_rows, coalesce(cluster_id, id) AS cluster FROM ent WHERE sector IS NOT NULL),
s AS (SELECT cluster, sector FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY w DESC, o, sector) AS r FROM (SELECT cluster, sector, sum(member_rows) AS w, min(id) AS o FROM k GROUP BY 1, 2)) WHERE r = 1),
p AS (SELECT cluster, place FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY w DESC, o, place) AS r FROM (SELECT cluster, commune AS place, sum(n) AS w, min(k.id) AS o FROM k JOIN (SELECT entity_id, commune, count(*) AS n FROM rw WHERE commune IS NOT NULL GROUP BY 1, 2) c ON c.entity_id = k.id GROUP BY 1, 2)) WHERE r = 1)
SELECT s.cluster, s.sector, p.place FROM s LEFT JOIN p ON s.cluster = p.cluster""")
def q_cluster_cube_rows(spark, sf_dir):
    return cube.cluster_rows(*_clustered(spark, sf_dir)).select("cluster", "sector", "place")


@query(f"WITH {_CLUSTERED} SELECT count(*) AS excluded FROM ent WHERE sector IS NULL")
def q_excluded(spark, sf_dir):
    return cube.excluded(_clustered(spark, sf_dir)[0])


def _clustered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    for name in ("customer", "orders"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    both = f"WITH {_CLUSTERED} SELECT * FROM "
    return spark.sql(both + "ent"), spark.sql(both + "rw")


_LINKING = ", ".join(f"'{w}'" for w in ("achat", "vente", "exercice", "toutes", "tous", "autres", "divers", "diverses", "activites", "prestations", "dans", "pour", "avec", "sans", "liees", "connexes", "generale", "general", "detail", "gros", "des", "les", "aux", "une", "ses", "sur", "via"))


@query(f"""WITH t AS (SELECT lang AS sector, unnest(list_distinct(list_filter(regexp_extract_all(strip_accents(lower(text)), '[a-z]+'), lambda x: length(x) >= 3 AND x NOT IN ({_LINKING})))) AS keyword FROM documents),
c AS (SELECT keyword, sector, count(*) AS n FROM t GROUP BY 1, 2), m AS (SELECT keyword, sum(n) AS total, max(n) AS top, arg_min(sector, (-n, sector)) AS sector FROM c GROUP BY 1) SELECT keyword, sector FROM m WHERE top >= 0.8::DOUBLE * total""")
def q_dominant_keywords(spark, sf_dir):
    return classify.lexicon(table(spark, sf_dir, "documents").select(F.col("text").alias("label"), F.col("lang").alias("sector")))


_ASKED = """SELECT c_custkey AS question_id, CASE c_custkey % 6 WHEN 0 THEN 'Combien dans NATION_' || CAST(c_custkey % 25 AS STRING) || ' ?' WHEN 1 THEN 'Classement des secteurs, hors de nation_' || CAST(c_custkey % 25 AS STRING)
 WHEN 2 THEN 'Où est la densité xNATION_1' WHEN 3 THEN 'Quelle commune est spécialisée : NATION_' || CAST(c_custkey % 30 AS STRING) || ', NATION_2' WHEN 4 THEN 'sauf profil' ELSE 'azerty le plus de 1 000 habitants' END AS text FROM customer"""


@query(f"WITH q AS ({_ASKED}), f AS (SELECT question_id, strip_accents(lower(text)) AS t FROM q) SELECT question_id, n_name AS place, length(n_name) AS length FROM f JOIN nation ON regexp_matches(t, '(^|[^a-z0-9])' || lower(n_name) || '($|[^a-z0-9])')")
def q_place_match(spark, sf_dir):
    return questions.place_hits(_asked(spark, sf_dir), table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))).withColumn("length", F.col("length").cast("long"))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return spark.sql(_ASKED)


@query(f"""WITH q AS ({_ASKED}), f AS (SELECT question_id, strip_accents(lower(text)) AS t FROM q) SELECT question_id, regexp_matches(t, 'hors de|en dehors|sauf |excepte|a part ') AS excludes, regexp_matches(t, 'densit|1 ?000|habitant') AS density,
 regexp_matches(t, 'specialis|represent|concentr') AS special, regexp_matches(t, 'le plus|plus de|quelle commune|classement|top |^ou\\b|\\bou\\b') AS ranking, regexp_matches(t, 'que fait|secteurs|profil|principales? activit') AS profile FROM f""")
def q_intent_flags(spark, sf_dir):
    rows = _asked(spark, sf_dir)
    return rows.select("question_id", *[c.alias(n) for n, c in questions.intent_flags(F.col("text")).items()])


LABELS = {"AUTOMOBILE": "Automobile", "BUILDING": "Building", "FURNITURE": "Furniture", "HOUSEHOLD": "Household", "MACHINERY": "Machinery"}
_LEXICON = "VALUES ('voiture', 'AUTOMOBILE', 0), ('maison', 'HOUSEHOLD', 1), ('machine', 'MACHINERY', 2), ('meuble', 'FURNITURE', 3), ('mur', 'BUILDING', 4), ('meublier', 'HOUSEHOLD', 5)"


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str], DataFrame]:
    """What questions may name: places, labels of sectors, keywords."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")), LABELS, spark.sql(f"SELECT * FROM {_LEXICON} AS l(keyword, sector, ord)")


def _ask(spark: SparkSession, sf_dir: str, question: str) -> DataFrame:
    """The answer to a plain sentence."""
    return questions.execute(questions.parse(spark, question, *_names(spark, sf_dir)), rows_of(spark, sf_dir), population(spark, sf_dir))


_PLAIN = """SELECT c_custkey AS question_id, CASE c_custkey % 12 WHEN 0 THEN 'Combien de maisons à NATION_' || CAST(c_custkey % 25 AS STRING) || ' ?' WHEN 1 THEN 'Où le plus de machines'
 WHEN 2 THEN 'automobile, hors de nation_3' WHEN 3 THEN 'Les meubliers et les murs de nation_' || CAST(c_custkey % 28 AS STRING) WHEN 4 THEN 'spécialisé : machinerie' WHEN 5 THEN 'meub machines'
 WHEN 6 THEN 'nation_4 et nation_5' WHEN 7 THEN 'Densité de nation_' || CAST(c_custkey % 26 AS STRING) WHEN 8 THEN 'nation_' || CAST(c_custkey % 26 AS STRING) WHEN 9 THEN 'profil' WHEN 10 THEN 'furnitures ou maisons ?' ELSE 'maisonnette, voiture et meublier' END AS text FROM customer"""


@query(f"""WITH q AS ({_PLAIN}), f AS (SELECT question_id, strip_accents(lower(text)) AS t FROM q), lex(keyword, sector, ord) AS ({_LEXICON}),
w AS (SELECT question_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM (SELECT question_id, regexp_extract_all(t, '[a-z]{{3,}}') AS ws FROM f)),
h AS (SELECT question_id, p, 0 AS kind, keyword, sector, ord FROM w JOIN lex ON keyword = word OR keyword = regexp_replace(word, 's$', '')
 UNION ALL SELECT question_id, p, 1, keyword, sector, ord FROM w JOIN lex ON length(word) >= 5 AND (starts_with(keyword, word) OR starts_with(word, keyword))),
o AS (SELECT question_id, min(2 * p + kind) AS o FROM h GROUP BY 1),
m AS (SELECT question_id, arg_max(sector, 1000000 * length(keyword) - 1000 * p - ord) AS met FROM h JOIN o USING (question_id) WHERE kind = 0 OR o % 2 = 1 AND 2 * p + 1 = o GROUP BY 1),
n AS (SELECT question_id, count(*) AS n, min(n_name) AS place FROM f JOIN nation ON regexp_matches(t, '(^|[^a-z0-9])' || lower(n_name) || '($|[^a-z0-9])') GROUP BY 1),
x AS (SELECT question_id, n, place, coalesce(CASE WHEN contains(t, 'automobile') THEN 'AUTOMOBILE' WHEN contains(t, 'building') THEN 'BUILDING' WHEN contains(t, 'furniture') THEN 'FURNITURE' WHEN contains(t, 'household') THEN 'HOUSEHOLD' WHEN contains(t, 'machinery') THEN 'MACHINERY' END, met) AS sector,
 regexp_matches(t, 'hors de|en dehors|sauf |excepte|a part ') AS excludes, regexp_matches(t, 'densit|1 ?000|habitant') AS density, regexp_matches(t, 'specialis|represent|concentr') AS special,
 regexp_matches(t, 'le plus|plus de|quelle commune|classement|top |^ou\\b|\\bou\\b') AS ranking, regexp_matches(t, 'que fait|secteurs|profil|principales? activit') AS profile FROM f LEFT JOIN m USING (question_id) LEFT JOIN n USING (question_id)),
y AS (SELECT question_id, sector, place, CASE WHEN n > 1 OR excludes OR sector IS NULL AND (special OR ranking) AND place IS NULL OR place IS NULL AND sector IS NULL AND NOT density AND NOT profile THEN NULL
 WHEN sector IS NOT NULL AND special THEN 'spec' WHEN sector IS NOT NULL AND (place IS NOT NULL OR NOT ranking) THEN 'count' WHEN sector IS NOT NULL THEN 'top' WHEN density OR place IS NULL THEN 'density' ELSE 'profile' END AS action FROM x)
SELECT question_id, action, CASE WHEN action IS NOT NULL THEN sector END AS sector, CASE WHEN action IN ('count', 'density', 'profile') THEN place END AS place FROM y""")
def q_interpreted(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return questions.interpreted(spark.sql(_PLAIN), *_names(spark, sf_dir))


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (ORDER BY n DESC, place) AS rank FROM grid WHERE sector = 'HOUSEHOLD') SELECT rank, place, sector, n::DOUBLE AS value FROM r WHERE place = 'NATION_7'")
def q_ask_count(spark, sf_dir):
    return _ask(spark, sf_dir, "Combien de maisons à NATION_7 ?")


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (ORDER BY n DESC, place) AS rank FROM grid WHERE sector = 'MACHINERY') SELECT rank, place, sector, n::DOUBLE AS value FROM r WHERE rank <= 3")
def q_ask_top(spark, sf_dir):
    return _ask(spark, sf_dir, "Où trouve-t-on le plus de machines ?")


@query(f"WITH {_GRID}, v AS (SELECT place, sector, CASE WHEN place_total >= 200 THEN {_LQ} ELSE 0.0 END AS lq FROM grid WHERE sector = 'FURNITURE'), r AS (SELECT *, row_number() OVER (ORDER BY lq DESC, place) AS rank FROM v) SELECT rank, place, sector, round(lq, 6) AS value FROM r WHERE rank <= 3")
def q_ask_specialised(spark, sf_dir):
    return _ask(spark, sf_dir, "Qui est spécialisé dans les meubles ?").withColumn("value", F.round("value", 6))


@query(f"WITH {_ROWS}, {_POP} SELECT CAST(NULL AS INT) AS rank, cr.place, CAST(NULL AS VARCHAR) AS sector, round(CASE WHEN max(pop) > 0 THEN count(*)::DOUBLE / max(pop) * 1000 ELSE 0 END, 6) AS value FROM cr JOIN pop ON cr.place = pop.place WHERE cr.place = 'NATION_4' GROUP BY cr.place")
def q_ask_density(spark, sf_dir):
    return _ask(spark, sf_dir, "Densité de NATION_4").withColumn("value", F.round("value", 6))


@query(f"WITH {_GRID}, t AS (SELECT place, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, place) AS rank FROM cr GROUP BY 1), b AS (SELECT *, row_number() OVER (ORDER BY n DESC, sector) AS rank FROM grid WHERE place = 'NATION_9' AND n > 0) SELECT rank, place, CAST(NULL AS VARCHAR) AS sector, n::DOUBLE AS value FROM t WHERE place = 'NATION_9' UNION ALL SELECT rank, place, sector, n::DOUBLE FROM b WHERE rank <= 3")
def q_ask_profile(spark, sf_dir):
    return _ask(spark, sf_dir, "Que fait NATION_9 ?")


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (ORDER BY n DESC, place) AS rank FROM grid WHERE sector = 'BUILDING' AND place NOT IN ('NATION_1', 'NATION_2')) SELECT rank, place, sector, n::DOUBLE AS value FROM r WHERE rank <= 3")
def q_ask_top_excluding(spark, sf_dir):
    return questions.execute(Intent("top", "BUILDING", (), ("NATION_1", "NATION_2")), rows_of(spark, sf_dir))


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (ORDER BY n DESC, place) AS rank FROM grid WHERE sector = 'BUILDING' AND place IN ('NATION_5', 'NATION_6')) SELECT rank, place, sector, n::DOUBLE AS value FROM r")
def q_ask_compare(spark, sf_dir):
    return questions.execute(Intent("compare", "BUILDING", ("NATION_5", "NATION_6")), rows_of(spark, sf_dir))


def _shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quadrilateral for each nation, from its key."""
    vertex = lambda x, y: F.array(F.expr(x).cast("double"), F.expr(y).cast("double"))
    ring = F.array(vertex("n_nationkey / 7.0D", "n_nationkey / 3.0D"), vertex("n_nationkey / 7.0D + 1.23456D", "n_nationkey / 3.0D"), vertex("n_nationkey / 7.0D + 1", "n_nationkey / 3.0D + 2"), vertex("n_nationkey / 7.0D", "n_nationkey / 3.0D"))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("shape_name"), F.array(F.array(ring)).alias("coordinates"))


_RING = "r AS (SELECT n_name, unnest([n_nationkey / 7.0::DOUBLE, n_nationkey / 7.0::DOUBLE + 1.23456::DOUBLE, n_nationkey / 7.0::DOUBLE + 1, n_nationkey / 7.0::DOUBLE]) AS x, unnest([n_nationkey / 3.0::DOUBLE, n_nationkey / 3.0::DOUBLE, n_nationkey / 3.0::DOUBLE + 2, n_nationkey / 3.0::DOUBLE]) AS y, unnest([0, 1, 2, 3]) AS i FROM nation)"


@query(f"WITH {_RING} SELECT n_name AS name, min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north FROM r GROUP BY 1")
def q_bounds(spark, sf_dir):
    found = geo.matched(table(spark, sf_dir, "nation").select(F.lower("n_name").alias("name"), F.col("n_name").alias("n")).select(F.col("n").alias("name")), _shapes(spark, sf_dir), {})
    return found.select("name", geo.bounds(F.col("coordinates")).alias("b")).select("name", "b.west", "b.south", "b.east", "b.north")


@query(f"WITH {_RING} SELECT min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north FROM r")
def q_envelope(spark, sf_dir):
    return geo.envelope(_shapes(spark, sf_dir).select(geo.bounds(F.col("coordinates")).alias("bounds")))


@query(f"WITH {_RING} SELECT n_name AS name, i, round(x, 3) AS x, round(y, 3) AS y FROM r")
def q_ring_round(spark, sf_dir):
    rings = _shapes(spark, sf_dir).select(F.col("shape_name").alias("name"), F.explode(geo.rings(geo.rounded(F.col("coordinates")))).alias("r"))
    return rings.select("name", F.posexplode("r").alias("i", "v")).select("name", "i", F.get("v", F.lit(0)).alias("x"), F.get("v", F.lit(1)).alias("y"))


@query(f"""WITH {_RING}, b AS (SELECT min(x) AS w, min(y) AS s, max(x) AS e, max(y) AS n FROM r), q AS (SELECT *, cos(radians((s + n) / 2)) AS c FROM b)
SELECT n_name AS name, i, round((x - w) * c / greatest((e - w) * c, n - s), 6) AS x, round((n - y) / greatest((e - w) * c, n - s), 6) AS y FROM r CROSS JOIN q""")
def q_unit_square(spark, sf_dir):
    shapes = _shapes(spark, sf_dir)
    box = geo.envelope(shapes.select(geo.bounds(F.col("coordinates")).alias("bounds"))).select(F.struct("west", "south", "east", "north").alias("box"))
    rings = shapes.join(F.broadcast(box)).select(F.col("shape_name").alias("name"), F.explode(geo.unit_square(F.col("coordinates"), F.col("box"))).alias("r"))
    return rings.select("name", F.posexplode("r").alias("i", "v")).select("name", "i", F.round(F.get("v", F.lit(0)), 6).alias("x"), F.round(F.get("v", F.lit(1)), 6).alias("y"))


@query("""WITH RECURSIVE o AS (SELECT CAST(user_id AS VARCHAR) AS key, event_id, epoch_ms(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
w AS (SELECT key, event_id, r, t + 86400000 AS reset, 1 AS c FROM o WHERE r = 1 UNION ALL SELECT o.key, o.event_id, o.r, CASE WHEN o.t > w.reset THEN o.t + 86400000 ELSE w.reset END, CASE WHEN o.t > w.reset THEN 1 ELSE w.c + 1 END FROM w JOIN o ON o.key = w.key AND o.r = w.r + 1)
SELECT key, event_id, c AS count, c > 3 AS denied FROM w""")
def q_rate_limit(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", "event_id")
    return limiter.limited(events, 3, 86_400_000).select("key", "event_id", "count", "denied")


@query(f"WITH {_GRID}, {_POP} SELECT grid.place || ';' || pop || ';' || place_total || ';' || sector || ';' || n AS line FROM grid JOIN pop ON pop.place = grid.place WHERE n > 0")
def q_csv_export(spark, sf_dir):
    cells = cube.dense(rows_of(spark, sf_dir)).where("n > 0").join(population(spark, sf_dir), "place")
    return cells.select(files.csv_line(F.col("place"), F.col("pop"), F.col("place_total"), F.col("sector"), F.col("n")).alias("line"))


@query(f"""WITH {_GRID}, {_POP} SELECT grid.place, '{{"total":' || max(place_total) || ',"pop":' || max(pop) || ',"sectors":[' || string_agg('{{"id":"' || sector || '","label":"' || CASE sector WHEN 'BUILDING' THEN 'Bâti' ELSE '?' END || '","n":' || n || '}}', ',' ORDER BY sector) FILTER (n > 0) || '],"quartiers":[]}}' AS json
FROM grid JOIN pop ON pop.place = grid.place GROUP BY 1""")
def q_json_payload(spark, sf_dir):
    none = table(spark, sf_dir, "nation").where("false").select(F.col("n_name").alias("place"), F.array("n_name").alias("quartiers"))
    return cube.payload(cube.dense(rows_of(spark, sf_dir)), population(spark, sf_dir), none, {"BUILDING": "Bâti"})


@query(f"WITH {_GRID}, r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY n DESC, sector) AS r FROM grid) SELECT place, sector AS dominant, CAST(floor(100.0 * n / place_total + 0.5) AS BIGINT) AS share, place_total AS total FROM r WHERE r = 1")
def q_table_rows(spark, sf_dir):
    return cube.table_rows(cube.dense(rows_of(spark, sf_dir)), "total").select("place", "dominant", "share", "total")


@query(f"WITH {_ROWS} SELECT place FROM (SELECT DISTINCT place FROM cr) WHERE place <> 'NATION_3' ORDER BY md5('7:' || place), place LIMIT 1")
def q_any_place(spark, sf_dir):
    return cube.any_place(cube.dense(rows_of(spark, sf_dir)), "NATION_3", 7)


@query("SELECT n_name AS name, 2 AS rings, 5 AS world_vertices FROM nation")
def q_mask(spark, sf_dir):
    return _shapes(spark, sf_dir).select(F.col("shape_name").alias("name"), geo.mask(F.col("coordinates")).alias("m")).select("name", F.size("m").alias("rings"), F.size(F.get("m", F.lit(0))).alias("world_vertices"))


@query("""SELECT n_name AS name, '{"type":"Feature","properties":{"name":"' || n_name || '"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0.5,' || n_nationkey || '.0],[1.0,0.0]]]]}}' AS feature FROM nation""")
def q_feature(spark, sf_dir):
    ring = F.array(F.array(F.lit(0.50001), F.col("n_nationkey").cast("double")), F.array(F.lit(1.0), F.lit(0.0)))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), geo.feature(F.col("n_name"), F.array(F.array(ring))).alias("feature"))


@query("""WITH v AS (SELECT c_custkey, c_acctbal * 997 AS x FROM customer), r AS (SELECT c_custkey, x, CAST(round(abs(CAST(x AS DECIMAL(38, 6))), 1) AS DECIMAL(38, 1)) AS t FROM v), w AS (SELECT *, CAST(floor(t) AS BIGINT) AS i, CAST((t - floor(t)) * 10 AS BIGINT) AS d FROM r)
SELECT c_custkey AS id, CASE WHEN x < 0 AND t <> 0 THEN '-' ELSE '' END || replace(format('{:,}', i), ',', '\u202f') || CASE WHEN d = 0 THEN '' ELSE ',' || d END AS shown, c_custkey || CASE WHEN c_custkey = 1 THEN '\u02b3\u1d49' ELSE '\u1d49' END AS place FROM w""")
def q_french_format(spark, sf_dir):
    value = (F.col("c_acctbal") * 997).cast("decimal(38,6)")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), text.french_number(value).alias("shown"), text.ordinal(F.col("c_custkey")).alias("place"))


@query("""WITH f AS (SELECT n_name, '{"type":"Feature","properties":{"name":"' || n_name || '"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0.5,' || n_nationkey || '.0],[1.0,0.0]]]]}}' AS f FROM nation)
SELECT '{"type":"FeatureCollection","features":[' || string_agg(f, ',' ORDER BY n_name) || ',{"type":"Feature","properties":{"name":"__mask__"},"geometry":{"type":"Polygon","coordinates":[[[-180.0,-85.0],[180.0,-85.0],[180.0,85.0],[-180.0,85.0],[-180.0,-85.0]],[[0.5,7.0],[1.0,0.0]]]}}]}' AS geojson FROM f""")
def q_collection(spark, sf_dir):
    ring = lambda y: F.array(F.array(F.array(F.array(F.lit(0.50001), y), F.array(F.lit(1.0), F.lit(0.0)))))
    nation = table(spark, sf_dir, "nation")
    shapes = nation.select(F.col("n_name").alias("name"), ring(F.col("n_nationkey").cast("double")).alias("coordinates"))
    return geo.collection(shapes, nation.where("n_nationkey = 7").select(ring(F.lit(7.0)).alias("coordinates")))
