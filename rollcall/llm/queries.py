"""The corpus operators' queries and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import bpe, chat, decontaminate, exact, langid, quality, simhash, substring, suffix, toxicity
from rollcall.llm.common import ROW, table
from rollcall.llm.sampling import in_fold


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~in_fold("doc_id", 5, 0)))
    scored = toxicity.score(docs.withColumn("held_out", in_fold("doc_id", 5, 0)), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(~in_fold("doc_id", 5, 0)))
    scored = quality.score(docs.withColumn("held_out", in_fold("doc_id", 5, 0)), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.remove_repeated_words(docs, {"n_words": "n_items", "n_removed": "n_removed", "kept_sha256": "kept_sha256"})
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~in_fold("doc_id", 4, 2)))
    found = langid.predict(docs.select("doc_id", "text", in_fold("doc_id", 4, 2).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _reply_calls(rows: DataFrame, role: str, text: str) -> DataFrame:
    """The table has no tool calls, so the turns that are no assistant's are taken as calls.

    A user turn's first line is a call of `reply`. What stands below that line is the material for it, a call of `read`
    that comes after `reply` in the text and before it in time. Any other turn is one call of `instruct`. Calls of turn 1
    come after the call of turn 0, as a rule the system's. A message has two calls at most, whatever its text.
    """
    name = lambda t: F.concat_ws("-", "conv", t)
    first = F.when(F.col("turn") == 1, F.array(name(F.lit(0)))).otherwise(F.array().cast("array<string>"))
    own, read = name("turn"), F.concat(name("turn"), F.lit(":read"))
    request, material = F.substring_index(text, "\n", 1), F.col(text).substr(F.instr(text, "\n") + 1, F.length(text))
    has_material = F.coalesce(F.contains(text, F.lit("\n")) & (material != ""), F.lit(False))

    def call(i: Column, tool: str, words: Column, after: Column) -> Column:
        return F.struct(i.alias("call_id"), F.lit(tool).alias("name"), F.to_json(F.struct("turn", words.alias("text"))).alias("arguments"), after.alias("after"))

    asked = F.when(has_material, F.array(call(own, "reply", request, F.concat(first, F.array(read))), call(read, "read", material, first))).otherwise(F.array(call(own, "reply", request, first)))
    calls = F.when(F.col(role) == "user", asked).otherwise(F.array(call(own, "instruct", F.col(text), first)))
    return rows.where(F.col(role) != "assistant").select(ROW, "conv", "turn", F.posexplode(calls).alias("seq", "c")).select(ROW, "conv", "turn", "seq", "c.*")


def _reply_results(rows: DataFrame, role: str, text: str) -> DataFrame:
    """Each assistant turn is taken as the result of the turn before it."""
    return rows.where(F.col(role) == "assistant").select(ROW, "conv", "turn", F.concat_ws("-", "conv", F.col("turn") - 1).alias("call_id"), F.col(text).alias("content"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [(tool, field, kind, True) for tool in ("instruct", "read", "reply") for field, kind in (("text", "string"), ("turn", "integer"))]
    schemas = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{n}', '{f}', '{k}', {r})" for n, f, k, r in fields) + " AS s(name, field, kind, required)")
    return chat.format_messages(table(spark, sf_dir, "conversations"), schemas, _reply_calls, _reply_results)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    groups = exact.exact_groups(docs, carry={"text_sha256": F.sha2(exact.normalised(F.col("text")), 256)})
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix.remove_repeated_bytes(docs, {"n_bytes": "n_items", "n_removed": "n_removed", "n_spans": "n_spans", "kept_sha256": "kept_sha256"})
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_quality, op3_simhash_near_dedup, op4_substring_dedup, op5_language_id, op6_bpe_codec, op7_chat_formatting, op8_benchmark_decontamination, op9_exact_dedup, op10_suffix_array_dedup)}

ORACLES = {
    "op4_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
least_id AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least_id USING (t) WHERE m < doc_id),
kept AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM kept ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op8_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS l, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, l, array_to_string(w[i : i + l - 1], ' ') AS t
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT l FROM bw))),
hit AS (SELECT doc_id, item_id, i, dw.l AS l FROM dw JOIN bw ON dw.t = bw.t AND dw.l = bw.l),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op9_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_suffix_array_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
win AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM d)),
hit AS (SELECT r, i FROM win SEMI JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
run AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM hit)),
gone AS (SELECT r, min(i) AS b, max(i) + 200 AS e FROM run GROUP BY r, g),
k AS (SELECT r, string_agg(substr(h, 2 * p + 1, 2 * (b - p)), '' ORDER BY b) AS head, max(e) AS last, count(*) AS n_spans, sum(e - b) AS n_removed
      FROM (SELECT gone.*, h, lag(e, 1, 0) OVER (PARTITION BY r ORDER BY b) AS p FROM gone JOIN d USING (r)) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (r)""",
}
