"""Queries on exact grouping, blocking, similarity, scoring, clustering and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import scoring, similarity
from rollcall.functions.text import GENERIC_WORDS, blocking_tokens, canonical
from rollcall.operators import blocking, clustering, evaluation, exact, judging, linkage
from rollcall.operators.components import components
from rollcall.plans.catalogue import query
from rollcall.storage import table

#: Orders as raw rows: spellings of one name, partly missing contacts, places; reads alike in both engines.
RAW = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN lower(o_orderpriority) WHEN 2 THEN 'É ' || o_orderpriority ELSE o_orderpriority || '!' END AS name,
 CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 90 AS STRING) END AS phone_raw, CASE WHEN o_orderkey % 5 = 0 THEN '+22901' || lpad(CAST(o_custkey % 90 AS STRING), 8, '9') END AS phone_e164,
 CASE WHEN o_orderkey % 5 = 0 THEN 'migre' ELSE 'invalide' END AS phone_status, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE 'a' || CAST(o_custkey % 4 AS STRING) || '@x.org' END AS email_norm,
 o_orderstatus AS commune, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'q' || CAST(o_orderkey % 3 AS STRING) END AS quartier, 's' || CAST(o_custkey % 2 AS STRING) AS segment, 'sheet' || CAST(o_orderkey % 9 AS STRING) AS sheet FROM orders"""
_KEYS = "trim(regexp_replace(upper(strip_accents(coalesce(name, ''))), '[^A-Z0-9]+', ' ', 'g')) AS kn, coalesce(phone_raw, '') AS kp, coalesce(email_norm, '') AS ke"
_GROUPS = f"""WITH raw AS ({RAW}), k AS (SELECT *, {_KEYS} FROM raw), g AS (SELECT kn, kp, ke, min(id) AS first_id, arg_max(name, length(name) * 1000000000 - id) AS name, min_by(nullif(phone_raw, ''), id) FILTER (nullif(phone_raw, '') IS NOT NULL) AS phone_raw,
 min_by(phone_e164, id) FILTER (phone_e164 IS NOT NULL) AS phone_e164, coalesce(min_by(phone_status, id) FILTER (phone_e164 IS NOT NULL), min_by(phone_status, id)) AS phone_status, min_by(nullif(email_norm, ''), id) FILTER (nullif(email_norm, '') IS NOT NULL) AS email_norm,
 array_to_string(list_sort(list(DISTINCT nullif(commune, '')) FILTER (nullif(commune, '') IS NOT NULL)), '|') AS communes, coalesce(array_to_string(list_sort(list(DISTINCT nullif(quartier, '')) FILTER (nullif(quartier, '') IS NOT NULL)), '|'), '') AS quartiers,
 array_to_string(list_sort(list(DISTINCT sheet)), '|') AS sheets, count(*) AS member_rows FROM k GROUP BY 1, 2, 3), e AS (SELECT *, row_number() OVER (ORDER BY first_id) AS id FROM g)"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(RAW)


@query(_GROUPS + " SELECT id, name, phone_raw, phone_e164, phone_status, email_norm, communes, quartiers, sheets, member_rows FROM e")
def q_exact_dedup(spark, sf_dir):
    found = exact.entities(_raw(spark, sf_dir))
    return found.select("id", "name", "phone_raw", "phone_e164", "phone_status", "email_norm", *[F.array_join(c, "|").alias(c) for c in ("communes", "quartiers", "sheets")], "member_rows")


@query(_GROUPS + " SELECT k.id, e.id AS entity_id FROM k JOIN e ON k.kn = e.kn AND k.kp = e.kp AND k.ke = e.ke")
def q_exact_members(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return exact.members(raw, exact.entities(raw)).select("id", "entity_id")


#: Parts as entities: phones shared by about three, e-mails by one or two, a telling token by about five.
PARTS = """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' ' || p_type ELSE 'house n' || CAST(p_partkey * 31 % 700 AS STRING) END || ' lot' || CAST(p_partkey % 400 AS STRING) AS name, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '+229' || CAST(p_partkey * 31 % 700 AS STRING) END AS phone_e164,
 CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'm' || CAST(p_partkey % 1500 AS STRING) END AS email_norm, 'p' || CAST(p_partkey * 31 % 700 % 3 AS STRING) AS place FROM part"""
_TOKENS = "list_distinct(list_filter(string_split(trim(regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]+', ' ', 'g')), ' '), lambda x: length(x) >= 3 AND x NOT IN ('PLUS', 'SERVICE') AND NOT regexp_full_match(x, '[0-9]+')))"
_BLOCKS = f"""WITH ent AS ({PARTS}), ky AS (SELECT 'phone' AS channel, phone_e164 AS key, id FROM ent WHERE phone_e164 IS NOT NULL UNION ALL SELECT 'email', email_norm, id FROM ent WHERE email_norm <> '' UNION ALL SELECT 'name', unnest({_TOKENS}), id FROM ent),
bl AS (SELECT channel, key, count(*) AS size, count(*) <= CASE channel WHEN 'name' THEN 15 ELSE 10 END AS kept FROM ky GROUP BY 1, 2 HAVING count(*) >= 2),
em AS (SELECT x.channel, x.key, x.id AS a, y.id AS b FROM ky x JOIN ky y ON x.channel = y.channel AND x.key = y.key AND x.id < y.id JOIN bl ON bl.channel = x.channel AND bl.key = x.key AND kept),
pr AS (SELECT a, b, array_to_string(list_sort(list(DISTINCT channel)), ',') AS channels FROM em GROUP BY 1, 2)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    rows = spark.sql(PARTS)
    return rows.select("id", canonical(F.col("name")).alias("name_norm"), blocking_tokens(F.col("name")).alias("tokens"), "phone_e164", "email_norm", F.array("place").alias("communes"))


@query(f"""WITH ent AS ({PARTS}) SELECT id, CASE WHEN phone_e164 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY phone_e164) END AS phone_degree, CASE WHEN email_norm = '' THEN 0 ELSE count(*) OVER (PARTITION BY email_norm) END AS email_degree FROM ent""")
def q_contact_degree(spark, sf_dir):
    return linkage.prepared(_parts(spark, sf_dir)).select("id", "phone_degree", "email_degree")


@query(_BLOCKS + " SELECT channel, key, size, kept FROM bl")
def q_blocks(spark, sf_dir):
    return blocking.blocks(_parts(spark, sf_dir))


@query(_BLOCKS + " SELECT channel, count(*) AS oversized FROM bl WHERE NOT kept GROUP BY 1")
def q_oversized_blocks(spark, sf_dir):
    return blocking.blocks(_parts(spark, sf_dir)).where("not kept").groupBy("channel").agg(F.count("*").alias("oversized"))


@query(_BLOCKS + " SELECT a, b, channels FROM pr")
def q_candidate_pairs(spark, sf_dir):
    return blocking.candidate_pairs(blocking.emissions(_parts(spark, sf_dir))).withColumn("channels", F.array_join("channels", ","))


@query(_BLOCKS + """ SELECT b.channel, coalesce(e.n, 0) AS emitted, b.oversized FROM (SELECT channel, count(*) FILTER (NOT kept) AS oversized FROM bl GROUP BY 1) b LEFT JOIN (SELECT channel, count(*) AS n FROM em GROUP BY 1) e ON b.channel = e.channel
UNION ALL SELECT 'total', count(*), 0 FROM pr""")
def q_pair_stats(spark, sf_dir):
    return blocking.pair_stats(_parts(spark, sf_dir))


_NAMES = _BLOCKS + f""", nm AS (SELECT id, trim(regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]+', ' ', 'g')) AS nn, phone_e164, email_norm, place, CASE WHEN phone_e164 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY phone_e164) END AS pd,
 CASE WHEN email_norm = '' THEN 0 ELSE count(*) OVER (PARTITION BY email_norm) END AS ed FROM ent),
pn AS (SELECT a, b, channels, x.nn AS name_a, y.nn AS name_b, jaro_winkler_similarity(x.nn, y.nn) AS jw, CASE WHEN x.phone_e164 = y.phone_e164 THEN x.pd ELSE 0 END AS pd, CASE WHEN x.email_norm = y.email_norm THEN x.ed ELSE 0 END AS ed, x.place = y.place AS same FROM pr JOIN nm x ON x.id = a JOIN nm y ON y.id = b)"""
_RARITY = "CASE WHEN {d} <= 2 THEN 1.0 WHEN {d} <= 5 THEN 0.5 WHEN {d} <= 9 THEN 0.25 ELSE 0.0 END"
_SCORED = _NAMES + f""", sc AS (SELECT a, b, channels, jw, greatest(CASE WHEN channels LIKE '%phone%' THEN {_RARITY.format(d='pd')} ELSE 0.0 END, CASE WHEN channels LIKE '%email%' THEN 0.8::DOUBLE * ({_RARITY.format(d='ed')}) ELSE 0.0 END)::DOUBLE AS contact, CASE WHEN same THEN 1.0 ELSE 0.0 END::DOUBLE AS geo FROM pn),
sz AS (SELECT *, (0.65::DOUBLE * jw + 0.2::DOUBLE * contact) + 0.15::DOUBLE * geo AS score FROM sc), zz AS (SELECT *, CASE WHEN score >= 0.9 AND jw >= 0.7 THEN 'fusion' WHEN score <= 0.6 OR jw < 0.6 THEN 'rejet' ELSE 'zone_grise' END AS zone FROM sz)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = linkage.prepared(_parts(spark, sf_dir))
    return blocking.with_sides(blocking.candidate_pairs(blocking.emissions(ready)), ready)


@query(_NAMES + " SELECT a, b, round(jw, 6) AS jw FROM pn")
def q_jaro_winkler(spark, sf_dir):
    return _pairs(spark, sf_dir).select("a", "b", F.round(similarity.jaro_winkler_udf(F.col("a_side.name_norm"), F.col("b_side.name_norm")), 6).alias("jw"))


def _ratio(a: str, b: str) -> str:
    """Twice the common subsequence over both lengths, as SQL: the subsequence by one machine word for each pair, a bit for each letter of b (120 at most)."""
    full = f"((1::HUGEINT << length({b})::INT) - 1)"
    masks = f"list_transform(string_split({a}, ''), lambda c: list_sum(list_transform(range(length({b})), lambda j: CASE WHEN substr({b}, j + 1, 1) = c THEN 1::HUGEINT << j::INT ELSE 0::HUGEINT END))::HUGEINT)"
    zeros = f"length({b}) - bit_count(list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * ({zeros}) / (length({a}) + length({b})) END"


_WORDS = "list_filter(string_split(name_{s}, ' '), lambda x: x <> '')"
_PARTS_OF = "list_sort(list_distinct(list_filter({x}, lambda w: {n} list_contains({y}, w))))"


@query(_NAMES + f""", w AS (SELECT a, b, {_WORDS.format(s="a")} AS wa, {_WORDS.format(s="b")} AS wb FROM pn),
p AS (SELECT a, b, array_to_string({_PARTS_OF.format(x="wa", y="wb", n="")}, ' ') AS c, array_to_string({_PARTS_OF.format(x="wa", y="wb", n="NOT")}, ' ') AS l, array_to_string({_PARTS_OF.format(x="wb", y="wa", n="NOT")}, ' ') AS r FROM w),
j AS (SELECT *, trim(c || ' ' || l) AS cl, trim(c || ' ' || r) AS cr FROM p)
SELECT a, b, round(CASE WHEN c <> '' AND (l = '' OR r = '') THEN 1.0::DOUBLE ELSE greatest({_ratio("cl", "cr")}, {_ratio("c", "cl")}, {_ratio("c", "cr")}) END, 6) AS token_set FROM j""")
def q_token_set(spark, sf_dir):
    return _pairs(spark, sf_dir).select("a", "b", F.round(similarity.token_set_udf(F.col("a_side.name_norm"), F.col("b_side.name_norm")), 6).alias("token_set"))


@query(_NAMES + f""", w AS (SELECT a, b, array_to_string(list_sort({_WORDS.format(s="a")}), ' ') AS sa, array_to_string(list_sort({_WORDS.format(s="b")}), ' ') AS sb FROM pn) SELECT a, b, round({_ratio("sa", "sb")}, 6) AS token_sort FROM w""")
def q_token_sort(spark, sf_dir):
    return _pairs(spark, sf_dir).select("a", "b", F.round(similarity.token_sort_udf(F.col("a_side.name_norm"), F.col("b_side.name_norm")), 6).alias("token_sort"))


@query(f"SELECT s_suppkey, s_suppkey % 12 AS degree, CAST({_RARITY.format(d='s_suppkey % 12')} AS DOUBLE) AS rarity FROM supplier")
def q_contact_rarity(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 12).alias("degree"), scoring.contact_rarity(F.col("s_suppkey") % 12).alias("rarity"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN l_partkey % 5 = 0 OR l_suppkey % 5 = 0 THEN 0.5 WHEN l_partkey % 4 = l_suppkey % 4 OR l_partkey % 4 = 3 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS geo FROM lineitem""")
def q_geo_agreement(spark, sf_dir):
    empty = "cast(array() as array<string>)"
    a = F.expr(f"case when l_partkey % 5 = 0 then {empty} else array(cast(l_partkey % 4 as string), 'z') end")
    b = F.expr(f"case when l_suppkey % 5 = 0 then {empty} when l_partkey % 4 = 3 then array('z') else array(cast(l_suppkey % 4 as string)) end")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", scoring.geo_agreement(a, b).alias("geo"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _pairs(spark, sf_dir).withColumn("name_sim", similarity.jaro_winkler_udf(F.col("a_side.name_norm"), F.col("b_side.name_norm")))
    return linkage._flat(named)


@query(_SCORED + " SELECT a AS entity_a, b AS entity_b, channels, round(contact, 4) AS contact, geo, round(score, 6) AS score, zone FROM zz")
def q_pair_score(spark, sf_dir):
    name = similarity.jaro_winkler_udf(F.col("a_side.name_norm"), F.col("b_side.name_norm"))
    pairs = _pairs(spark, sf_dir).withColumn("name_sim", name)
    contact, geo = scoring.contact_score(F.col("channels"), F.col("phone_degree"), F.col("email_degree")), scoring.geo_agreement(F.col("a_side.communes"), F.col("b_side.communes"))
    score = scoring.weighted(F.col("name_sim"), contact, geo)
    return pairs.select(F.col("a").alias("entity_a"), F.col("b").alias("entity_b"), F.array_join("channels", ",").alias("channels"), F.round(contact, 4).alias("contact"), geo.alias("geo"), F.round(score, 6).alias("score"), scoring.zone(score, F.col("name_sim")).alias("zone"))


@query(_SCORED + " SELECT zone, count(*) AS n FROM zz GROUP BY 1")
def q_zone_counts(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy("zone").agg(F.count("*").alias("n"))


@query(_SCORED + ", rk AS (SELECT a AS entity_a, b AS entity_b, zone, row_number() OVER (PARTITION BY zone ORDER BY md5('42:' || a || ':' || b), a, b) AS r FROM zz) SELECT entity_a, entity_b, zone FROM rk WHERE r <= 140")
def q_stratified_sample(spark, sf_dir):
    return blocking.sample_by_zone(_scored(spark, sf_dir)).select("entity_a", "entity_b", "zone")


_GENERIC = ", ".join(f"'{w}'" for w in GENERIC_WORDS)
_CORE = "array_to_string(list_sort(list_filter({w}, lambda x: length(x) >= 3 AND x NOT IN (" + _GENERIC + ") AND NOT regexp_full_match(x, '[0-9]+'))), ' ')"
_FULL = _NAMES + f""", w AS (SELECT *, {_WORDS.format(s="a")} AS wa, {_WORDS.format(s="b")} AS wb FROM pn),
p AS (SELECT *, array_to_string({_PARTS_OF.format(x="wa", y="wb", n="")}, ' ') AS c, array_to_string({_PARTS_OF.format(x="wa", y="wb", n="NOT")}, ' ') AS l, array_to_string({_PARTS_OF.format(x="wb", y="wa", n="NOT")}, ' ') AS r, {_CORE.format(w="wa")} AS ka, {_CORE.format(w="wb")} AS kb FROM w),
j AS (SELECT *, trim(c || ' ' || l) AS cl, trim(c || ' ' || r) AS cr FROM p),
n AS (SELECT *, greatest(jw, CASE WHEN c <> '' AND (l = '' OR r = '') THEN 1.0::DOUBLE ELSE greatest({_ratio("cl", "cr")}, {_ratio("c", "cl")}, {_ratio("c", "cr")}) END, {_ratio("ka", "kb")}) AS name,
 greatest(CASE WHEN channels LIKE '%phone%' THEN {_RARITY.format(d='pd')} ELSE 0.0 END, CASE WHEN channels LIKE '%email%' THEN 0.8::DOUBLE * ({_RARITY.format(d='ed')}) ELSE 0.0 END)::DOUBLE AS contact, CASE WHEN same THEN 1.0 ELSE 0.0 END::DOUBLE AS geo FROM j),
f AS (SELECT *, (0.65::DOUBLE * name + 0.2::DOUBLE * contact) + 0.15::DOUBLE * geo AS score FROM n),
scored AS (SELECT a AS entity_a, b AS entity_b, channels, round_even(name, 4) AS name_sim, round_even(contact, 4) AS contact, geo, round_even(score, 4) AS score, CASE WHEN score >= 0.9 AND name >= 0.7 THEN 'fusion' WHEN score <= 0.6 OR name < 0.6 THEN 'rejet' ELSE 'zone_grise' END AS zone FROM f)"""


@query(_FULL + " SELECT * FROM scored")
def q_scored_pairs(spark, sf_dir):
    return linkage.scored_pairs(_parts(spark, sf_dir)).withColumn("channels", F.array_join("channels", ","))


@query(_FULL + " SELECT entity_a, entity_b, score FROM scored WHERE zone = 'fusion'")
def q_merge_edges(spark, sf_dir):
    return linkage.merge_edges(_parts(spark, sf_dir)).select("entity_a", "entity_b", "score")


_CHAIN = "SELECT c_custkey AS a, c_custkey + 37 AS b, (c_custkey * 13 % 20 + 80) / 100.0 AS score FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey + 37 <= (SELECT max(c_custkey) FROM customer)"


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return spark.sql(_CHAIN).withColumn("score", F.col("score").cast("double"))


@query(f"""WITH RECURSIVE e AS ({_CHAIN}), w AS (SELECT c_custkey AS node, c_custkey AS root FROM customer WHERE c_custkey NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, w.root FROM w JOIN e ON e.a = w.node) SELECT node AS id, root FROM w""")
def q_components(spark, sf_dir):
    roots = components(_chain(spark, sf_dir).select(F.col("a").alias("u"), F.col("b").alias("v")))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).join(roots, F.col("id") == F.col("node"), "left").select("id", F.coalesce("root", "id").alias("root"))


@query(f"""WITH RECURSIVE e AS ({_CHAIN}), w AS (SELECT c_custkey AS node, c_custkey AS root FROM customer WHERE c_custkey NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, w.root FROM w JOIN e ON e.a = w.node),
s AS (SELECT root, count(*) AS n FROM w GROUP BY 1) SELECT n AS size, count(*) AS clusters FROM s GROUP BY 1""")
def q_cluster_sizes(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    found, _ = clustering.clusters(_chain(spark, sf_dir).withColumn("score", F.lit(1.0)), ids)
    return found.groupBy("cluster_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


@query()
def q_guarded_clusters(spark, sf_dir):
    edges = _chain(spark, sf_dir).unionByName(_chain(spark, sf_dir).select("a", (F.col("b") + 37).alias("b"), (F.col("score") - 0.05).alias("score")).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("b")), "b", "left_semi"))
    return clustering.clusters(edges, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))[0]


_GOLD = """SELECT d.doc_id AS entity_a, d.doc_id + 1 AS entity_b, (n_chars % 1000) / 1000.0 AS score, CASE WHEN n_chars % 1000 >= 900 THEN 'fusion' WHEN n_chars % 1000 <= 600 THEN 'rejet' ELSE 'zone_grise' END AS zone,
 CASE WHEN d.doc_id % 11 = 0 THEN 'incertain' WHEN quality = 1 THEN 'oui' ELSE 'non' END AS same_business, CASE WHEN toxic = 1 THEN 'meme' WHEN d.doc_id % 7 = 0 THEN 'incertain' ELSE 'diff' END AS verdict FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("documents", "labels"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return evaluation.checked_labels(spark.sql(_GOLD).withColumn("same_business", F.initcap("same_business")))


@query(f"""WITH g AS ({_GOLD}), s AS (SELECT * FROM g WHERE same_business <> 'incertain'), c AS (SELECT count(*) FILTER (zone = 'fusion' AND same_business = 'oui') AS tp, count(*) FILTER (zone = 'fusion') AS p, count(*) FILTER (same_business = 'oui') AS t FROM s)
SELECT CASE WHEN p > 0 THEN tp / p END AS precision, CASE WHEN t > 0 THEN tp / t END AS recall FROM c""")
def q_gold_metrics(spark, sf_dir):
    return evaluation.precision_recall(_gold(spark, sf_dir))


@query(f"WITH g AS ({_GOLD}) SELECT zone, count(*) FILTER (same_business = 'oui') AS oui, count(*) FILTER (same_business = 'non') AS non, count(*) FILTER (same_business = 'incertain') AS incertain FROM g GROUP BY 1")
def q_contingency(spark, sf_dir):
    return evaluation.contingency(_gold(spark, sf_dir))


@query(f"""WITH g AS ({_GOLD}), b(low, high) AS (VALUES (0.0::DOUBLE, 0.6::DOUBLE), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 1.01))
SELECT low, high, count(*) FILTER (same_business = 'oui') AS positives, count(same_business) AS total FROM b LEFT JOIN (SELECT * FROM g WHERE same_business <> 'incertain') g ON CAST(score AS DOUBLE) >= low AND CAST(score AS DOUBLE) < high GROUP BY 1, 2""")
def q_score_bands(spark, sf_dir):
    return evaluation.band_rates(_gold(spark, sf_dir))


@query(f"""WITH g AS ({_GOLD}), s AS (SELECT same_business = 'oui' AS y, verdict = 'meme' AS m FROM g WHERE same_business <> 'incertain'), c AS (SELECT count(*) FILTER (y AND m) AS tp, count(*) FILTER (NOT y AND m) AS fp, count(*) FILTER (y AND NOT m) AS fn, count(*) FILTER (NOT y AND NOT m) AS tn FROM s)
SELECT tp, fp, fn, tn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall FROM c""")
def q_confusion(spark, sf_dir):
    return evaluation.confusion(_gold(spark, sf_dir))


@query(f"""WITH RECURSIVE e AS ({_CHAIN}), w AS (SELECT c_custkey AS node, c_custkey AS root FROM customer WHERE c_custkey NOT IN (SELECT b FROM e) UNION ALL SELECT e.b, w.root FROM w JOIN e ON e.a = w.node),
s AS (SELECT root, count(*) AS n FROM w GROUP BY 1) SELECT (SELECT count(*) FROM s) AS clusters, string_agg(n, ',' ORDER BY n DESC) AS largest FROM (SELECT n FROM s ORDER BY n DESC LIMIT 5)""")
def q_cluster_profile(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    found, _ = clustering.clusters(_chain(spark, sf_dir).withColumn("score", F.lit(1.0)), ids)
    return clustering.profile(found).select("clusters", F.array_join("largest", ",").alias("largest"))


_VERDICTS = "SELECT doc_id AS entity_a, doc_id + 1 AS entity_b, CASE WHEN toxic = 1 THEN 'meme' ELSE 'diff' END AS verdict FROM labels"


@query(f"""WITH g AS ({_GOLD}), v AS ({_VERDICTS}) SELECT entity_a AS a, entity_b AS b, CAST(score AS DOUBLE) AS score FROM g WHERE zone = 'fusion' UNION ALL SELECT g.entity_a, g.entity_b, CAST(score AS DOUBLE) FROM g JOIN v ON g.entity_a = v.entity_a AND g.entity_b = v.entity_b WHERE v.verdict = 'meme'""")
def q_final_edges(spark, sf_dir):
    return judging.final_edges(_gold(spark, sf_dir), spark.sql(_VERDICTS))


@query(f"""WITH g AS ({_GOLD}) SELECT g.entity_a, g.entity_b, CASE WHEN g.entity_a % 2 = 0 THEN 'name,phone' ELSE '' END AS channels, CASE WHEN g.entity_a % 2 = 0 THEN CAST(g.score AS DOUBLE) ELSE 0.0::DOUBLE END AS name_sim FROM g""")
def q_gold_context(spark, sf_dir):
    gold = _gold(spark, sf_dir)
    pairs = gold.where("entity_a % 2 = 0").select("entity_a", "entity_b", F.array(F.lit("name"), F.lit("phone")).alias("channels"), F.col("score").alias("name_sim"))
    return judging.with_gold_context(gold, pairs).select("entity_a", "entity_b", F.array_join("channels", ",").alias("channels"), "name_sim")


@query(_SCORED + """, l AS (SELECT row_number() OVER (ORDER BY a, b) AS k, * FROM zz) SELECT a AS entity_a, b AS entity_b, '1. A: "' || x.nn || '" (' || x.place || '; ?) | B: "' || y.nn || '" (' || y.place || '; ?) | names 0.50 | ' ||
CASE WHEN channels LIKE '%phone%' AND channels LIKE '%email%' THEN 'same phone, same e-mail' WHEN channels LIKE '%phone%' THEN 'same phone' WHEN channels LIKE '%email%' THEN 'same e-mail' ELSE 'no contact known to be shared' END AS line FROM l JOIN nm x ON x.id = a JOIN nm y ON y.id = b""")
def q_pair_lines(spark, sf_dir):
    side = lambda x: F.struct(F.col(f"{x}_side.name_norm").alias("name"), F.col(f"{x}_side.communes").alias("communes"), F.array().cast("array<string>").alias("quartiers"), F.lit(None).cast("string").alias("sector_label")).alias(f"{x}_side")
    p = F.struct(side("a"), side("b"), "channels", F.lit(0.5).alias("name_sim"))
    return _pairs(spark, sf_dir).select(F.col("a").alias("entity_a"), F.col("b").alias("entity_b"), p.alias("p")).select("entity_a", "entity_b", judging.described(F.lit(1)).alias("line"))


@query(f"""WITH g AS ({_GOLD}), v AS ({_VERDICTS}), e AS (SELECT entity_a AS a FROM g WHERE zone = 'fusion' UNION SELECT g.entity_a FROM g JOIN v USING (entity_a, entity_b) WHERE v.verdict = 'meme'),
ids AS (SELECT DISTINCT doc_id AS id FROM documents), r AS (SELECT id, max(CASE WHEN a IS NULL THEN id END) OVER (ORDER BY id) AS top FROM (SELECT ids.id, e.a FROM ids LEFT JOIN e ON ids.id = e.a + 1)) SELECT id, top AS cluster_id FROM r""")
def q_reclustered(spark, sf_dir):
    return judging.reclustered(_gold(spark, sf_dir), spark.sql(_VERDICTS), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))


@query("SELECT c_custkey AS entity_a, c_custkey + 1 AS entity_b, 'name ' || c_custkey AS name_a, 'name ' || (c_custkey + 1) AS name_b, 'A / P' || (c_custkey % 9) AS communes_a, 'A / P' || ((c_custkey + 1) % 9) AS communes_b, 0.5::DOUBLE AS score, 'rejet' AS zone, '' AS same_business FROM customer WHERE c_custkey + 1 IN (SELECT c_custkey FROM customer)")
def q_gold_rows(spark, sf_dir):
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    entities = ids.select("id", F.concat(F.lit("name "), "id").alias("name"), F.array(F.concat(F.lit("P"), F.col("id") % 9), F.lit("A")).alias("communes"))
    return judging.gold_rows(ids.select(F.col("id").alias("entity_a"), (F.col("id") + 1).alias("entity_b"), F.lit(0.5).cast("double").alias("score"), F.lit("rejet").alias("zone")), entities)
