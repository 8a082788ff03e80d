"""Queries on phone numbers, addresses, texts, judging and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import contacts, text
from rollcall.operators import judging
from rollcall.plans.catalogue import query
from rollcall.plans.questions import fragment
from rollcall.sources import files, ingest
from rollcall.storage import table

_B8 = "lpad(CAST(c_custkey * 7919 % 100000000 AS STRING), 8, '0')"
#: One spelling of a phone cell for each remainder; reads alike in Spark SQL and DuckDB.
PHONE = f"""CASE c_custkey % 13
 WHEN 0 THEN {_B8} WHEN 1 THEN '01' || {_B8} WHEN 2 THEN '+229 ' || {_B8} WHEN 3 THEN '0022901' || {_B8}
 WHEN 4 THEN substr({_B8}, 1, 2) || ' ' || substr({_B8}, 3, 2) || '.' || substr({_B8}, 5, 4) WHEN 5 THEN '1' || {_B8} WHEN 6 THEN '01' || substr({_B8}, 1, 6)
 WHEN 7 THEN {_B8} || '/' || '97' || substr({_B8}, 3, 6) WHEN 8 THEN NULL WHEN 9 THEN 'abc' WHEN 10 THEN '  ' WHEN 11 THEN '9' || substr({_B8}, 2, 7) || ', 01' || {_B8} ELSE '(229)' || '6' || substr({_B8}, 2, 7) END"""
EMAIL = """CASE c_custkey % 6 WHEN 0 THEN upper(replace(c_name, '#', '.')) || '@Example.COM' WHEN 1 THEN ' ' || lower(replace(c_name, '#', '_')) || ' @mail.co ' WHEN 2 THEN NULL
 WHEN 3 THEN 'none' WHEN 4 THEN CAST(c_custkey AS STRING) || '@x' ELSE c_name || '@x.org' END"""


def _classify_sql(source: str) -> str:
    """DuckDB: adds e164 and status for a column d of digits to source."""
    return f"""SELECT *, CASE
  WHEN length(n) = 10 AND n LIKE '01%' THEN CASE WHEN substr(n, 3, 1) IN ('2','4','5','6','9') THEN 'deja_migre' ELSE 'invalide' END
  WHEN length(n) = 9 AND n LIKE '1%' THEN CASE WHEN substr(n, 2, 1) IN ('2','4','5','6','9') THEN 'zero_restaure' ELSE 'invalide' END
  WHEN length(n) = 8 AND n LIKE '01%' THEN 'suspect_01_court'
  WHEN length(n) = 8 AND substr(n, 1, 1) IN ('2','4','5','6','9') THEN 'migre' ELSE 'invalide' END AS st
FROM (SELECT *, CASE WHEN d LIKE '00229%' THEN substr(d, 6) WHEN d LIKE '229%' AND length(d) > 10 THEN substr(d, 4) ELSE d END AS n FROM ({source}))"""


_E164 = "CASE st WHEN 'deja_migre' THEN '+229' || n WHEN 'zero_restaure' THEN '+2290' || n WHEN 'migre' THEN '+22901' || n END"
_RUNS = r"regexp_extract_all(regexp_replace(coalesce(raw, ''), '[\s.\-()]', '', 'g'), '\d+')"
_SINGLE = f"""WITH r AS (SELECT c_custkey, {PHONE} AS raw FROM customer), u AS (SELECT *, trim(coalesce(raw, '')) AS t, {_RUNS} AS runs FROM r),
c AS ({_classify_sql('SELECT *, runs[1] AS d FROM u')}),
p AS (SELECT c_custkey, raw, CASE WHEN t = '' THEN 'vide' WHEN len(runs) <> 1 THEN 'invalide' ELSE st END AS status, CASE WHEN t <> '' AND len(runs) = 1 THEN {_E164} END AS e164 FROM c)"""


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr(PHONE).alias("raw"), F.expr(EMAIL).alias("email_raw"))


@query(_SINGLE + " SELECT c_custkey, raw, e164, status FROM p")
def q_phone_normalize(spark, sf_dir):
    return _customers(spark, sf_dir).select("c_custkey", "raw", contacts.phone(F.col("raw")).alias("p")).select("c_custkey", "raw", "p.e164", "p.status")


@query(_SINGLE + " SELECT status AS phone_status, count(*) AS count FROM p GROUP BY 1")
def q_phone_status_report(spark, sf_dir):
    return ingest.report(_customers(spark, sf_dir).select(contacts.phone(F.col("raw"))["status"].alias("phone_status")), "phone_status")


@query(f"""WITH r AS (SELECT c_custkey, {PHONE} AS raw FROM customer), u AS (SELECT *, trim(coalesce(raw, '')) AS t, {_RUNS} AS runs FROM r),
x AS (SELECT c_custkey, t, unnest(CASE WHEN len(runs) = 0 THEN [NULL] ELSE runs END) AS d, unnest(range(1, greatest(len(runs), 1) + 1)) AS i FROM u),
c AS ({_classify_sql('SELECT * FROM x')}), f AS (SELECT c_custkey, i, CASE WHEN t = '' THEN 'vide' WHEN d IS NULL THEN 'invalide' ELSE st END AS status, CASE WHEN d IS NOT NULL THEN {_E164} END AS e164 FROM c)
SELECT c_custkey, string_agg(status, ',' ORDER BY i) AS statuses, count(*) - 1 AS extra, coalesce(min_by(e164, i) FILTER (status IN ('migre', 'deja_migre', 'zero_restaure')), NULL) AS best,
 coalesce(min_by(status, i) FILTER (status IN ('migre', 'deja_migre', 'zero_restaure')), min_by(status, i)) AS best_status FROM f GROUP BY 1""")
def q_phone_multi(spark, sf_dir):
    rows = _customers(spark, sf_dir).select("c_custkey", contacts.phones(F.col("raw")).alias("p")).withColumn("b", contacts.best_phone(F.col("p")))
    return rows.select("c_custkey", F.array_join("p.status", ",").alias("statuses"), (F.size("p") - 1).cast("long").alias("extra"), F.col("b.e164").alias("best"), F.col("b.status").alias("best_status"))


@query(_SINGLE + " SELECT status, substr(e164, 5) AS national, count(*) AS n FROM p WHERE status IN ('migre', 'deja_migre', 'zero_restaure') GROUP BY 1, 2")
def q_phone_valid(spark, sf_dir):
    found = _customers(spark, sf_dir).select(contacts.phone(F.col("raw")).alias("p")).where(contacts.is_valid(F.col("p.status")))
    return found.groupBy(F.col("p.status").alias("status"), contacts.national(F.col("p.e164")).alias("national")).agg(F.count("*").alias("n"))


@query(f"""WITH r AS (SELECT c_custkey, {EMAIL} AS raw FROM customer), t AS (SELECT c_custkey, trim(coalesce(raw, '')) AS t, replace(lower(trim(coalesce(raw, ''))), ' ', '') AS c FROM r)
SELECT c_custkey, CASE WHEN t <> '' AND regexp_full_match(c, '[a-z0-9][a-z0-9._%+\\-]*@[a-z0-9][a-z0-9.\\-]*\\.[a-z]{{2,}}') THEN c END AS normalized,
 CASE WHEN t = '' THEN 'vide' WHEN regexp_full_match(c, '[a-z0-9][a-z0-9._%+\\-]*@[a-z0-9][a-z0-9.\\-]*\\.[a-z]{{2,}}') THEN 'valide' ELSE 'invalide' END AS status FROM t""")
def q_email_normalize(spark, sf_dir):
    return _customers(spark, sf_dir).select("c_custkey", contacts.email(F.col("email_raw")).alias("e")).select("c_custkey", "e.normalized", "e.status")


_CANON = "trim(regexp_replace(upper(strip_accents(replace(text, 'ß', 'ss'))), '[^A-Z0-9]+', ' ', 'g'))"
_GENERIC = ", ".join(f"'{w}'" for w in text.GENERIC_WORDS)
_LINKING = ", ".join(f"'{w}'" for w in text.LINKING_WORDS)


@query(f"SELECT doc_id, {_CANON} AS canonical FROM documents")
def q_canonical_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.canonical(F.col("text")).alias("canonical"))


@query(f"SELECT doc_id, len(t) AS n_tokens, len(c) AS n_core, array_to_string(c, ' ') AS core FROM (SELECT doc_id, t, list_filter(t, lambda x: x NOT IN ({_GENERIC}) AND length(x) >= 3 AND NOT regexp_full_match(x, '[0-9]+')) AS c FROM (SELECT doc_id, list_filter(string_split({_CANON}, ' '), lambda x: x <> '') AS t FROM documents))")
def q_blocking_tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.tokens(F.col("text")).alias("t")).select("doc_id", "t", text.core_of(F.col("t")).alias("c"))
    return rows.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size("c").cast("long").alias("n_core"), F.array_join("c", " ").alias("core"))


@query(f"SELECT doc_id, array_to_string(list_filter(regexp_extract_all(strip_accents(lower(text)), '[a-z]+'), lambda x: length(x) >= 3 AND x NOT IN ({_LINKING})), ' ') AS tokens FROM documents")
def q_label_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.label_tokens(F.col("text")), " ").alias("tokens"))


@query("SELECT n_nationkey, regexp_replace(strip_accents(upper('É-' || n_name || ' (ç)')), '[^\\p{L}\\p{N}]', '', 'g') AS place_key FROM nation")
def q_place_key(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", text.place_key(F.expr("'É-' || n_name || ' (ç)'")).alias("place_key"))


@query("""WITH p AS (SELECT page_id, url, CASE WHEN contains(url, '?') THEN split_part(split_part(url, '?', 2), '#', 1) ELSE '' END AS f FROM pages),
kv AS (SELECT page_id, split_part(x, '=', 1) AS k, split_part(x, '=', 2) AS v FROM (SELECT page_id, unnest(string_split(f, '&')) AS x FROM p) WHERE contains(x, '='))
SELECT p.page_id, max(CASE WHEN k = 'page' THEN v END) AS page, max(CASE WHEN k = 'id' THEN v END) AS id FROM p LEFT JOIN kv ON p.page_id = kv.page_id GROUP BY 1""")
def q_fragment_parse(spark, sf_dir):
    found = fragment(F.regexp_extract("url", r"\?([^#]*)", 1), ["page", "id"])
    return table(spark, sf_dir, "pages").select("page_id", found.alias("f")).select("page_id", F.try_element_at("f", F.lit("page")).alias("page"), F.try_element_at("f", F.lit("id")).alias("id"))


_ANSWER = """CASE item_id % 5 WHEN 0 THEN 'Sure: [{"i": 1, "v": "meme"}, {"i": "2", "v": " DIFF "}, {"i": 9, "v": "meme"}] done'
 WHEN 1 THEN 'no json here' WHEN 2 THEN '[{"i": 3, "v": "meme"}, {"i": 3, "v": "diff"}, {"x": 1}, 7]' WHEN 3 THEN '[{"i": 1, "v": "maybe"}, {"i": 2, "v": "meme"}]' ELSE '[broken' END"""


@query(f"""WITH a AS (SELECT item_id, {_ANSWER} AS t FROM benchmark), s AS (SELECT item_id, regexp_extract(t, '(?s)\\[.*\\]') AS j FROM a),
x AS (SELECT item_id, unnest(CAST(CASE WHEN json_valid(j) THEN j ELSE '[]' END AS JSON[])) AS e, unnest(range(0, 50)) AS o FROM s),
y AS (SELECT item_id, o, TRY_CAST(e->>'$.i' AS INT) AS i, lower(trim(e->>'$.v')) AS v FROM x WHERE e IS NOT NULL),
z AS (SELECT item_id, i, arg_max(v, o) AS v FROM y WHERE i BETWEEN 1 AND 3 AND v IN ('meme', 'diff', 'incertain') GROUP BY 1, 2)
SELECT a.item_id, string_agg(coalesce(z.v, 'incertain'), ',' ORDER BY n) AS verdicts FROM a CROSS JOIN (SELECT unnest([1, 2, 3]) AS n) LEFT JOIN z ON z.item_id = a.item_id AND z.i = n GROUP BY 1""")
def q_verdict_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.expr(_ANSWER).alias("t"))
    return rows.select("item_id", F.array_join(judging.verdicts(F.col("t"), F.lit(3)), ",").alias("verdicts"))


@query("SELECT item_id AS entity_a, item_id + 1 AS entity_b, CASE WHEN length(text) % 2 = 1 THEN 'diff' WHEN length(text) % 3 = 0 THEN 'meme' ELSE 'incertain' END AS verdict FROM benchmark")
def q_two_pass_judging(spark, sf_dir):
    """A stand-in judge finds pairs the same whose line has an even length, and confirms every third of them."""
    def answer(said):
        def judge(lines):
            return "[" + ",".join(f'{{"i": {i + 1}, "v": "{said(line)}"}}' for i, line in enumerate(lines)) + "]"

        return judge

    pairs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("entity_a"), (F.col("item_id") + 1).alias("entity_b"), F.col("text").alias("line"))
    return judging.two_passes(pairs, answer(lambda t: "meme" if len(t) % 2 == 0 else "diff"), answer(lambda t: "confirme" if len(t) % 3 == 0 else "incertain")).drop("line")


@query("""SELECT o_orderkey AS entity_a, o_custkey AS entity_b, (o_orderkey * 37 % 1000) / 1000.0 AS score FROM orders o
WHERE o_orderstatus = 'O' AND (o_orderkey * 37 % 1000) / 1000.0 >= 0.72 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) ORDER BY score DESC, entity_a, entity_b LIMIT 200""")
def q_anti_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity_a"), F.col("o_custkey").alias("entity_b"), ((F.col("o_orderkey") * 37 % 1000) / F.lit(1000.0)).alias("score"), F.when(F.col("o_orderstatus") == "O", "zone_grise").otherwise("rejet").alias("zone"))
    done = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("entity_a")).distinct().join(orders.select("entity_a", "entity_b"), "entity_a")
    return judging.queue(orders, done, 0.72, 200).select("entity_a", "entity_b", "score")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def q_upsert_latest(spark, sf_dir):
    return judging.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("""SELECT n_name, n_regionkey, '"' || replace(n_name || ';x', '"', '""') || '";' || CAST(n_regionkey AS VARCHAR) || ';plain' AS line FROM nation""")
def q_csv_line(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name", "n_regionkey", files.csv_line(F.expr("n_name || ';x'"), F.col("n_regionkey"), F.lit("plain")).alias("line"))


@query("SELECT c.c_custkey, CASE WHEN s.s_suppkey IS NULL THEN c.c_acctbal ELSE s.s_acctbal END AS c_acctbal FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey")
def q_keyed_update(spark, sf_dir):
    changes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return files.updated(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), changes, "c_custkey", ["c_acctbal"])
