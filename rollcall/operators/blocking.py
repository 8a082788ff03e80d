"""Candidate pairs: entities that share a phone, an e-mail or a telling word, in blocks of capped size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The caps of blocks.
CONTACT_CAP, TOKEN_CAP = 10, 15


def degrees(entities: DataFrame, column: str, into: str) -> DataFrame:
    """entities with the number of entities that share the column's value; 0 for null or empty."""
    counts = entities.where(F.col(column) != "").groupBy(column).agg(F.count("*").alias(into))
    return entities.join(counts, column, "left").withColumn(into, F.coalesce(into, F.lit(0)))


def keys(entities: DataFrame) -> DataFrame:
    """channel, key, id: one row for each phone, e-mail and distinct token (column tokens) of an entity."""
    tokens = F.transform(F.array_distinct("tokens"), lambda t: F.struct(F.lit("name").alias("channel"), t.alias("key")))
    contacts = F.array(F.struct(F.lit("phone").alias("channel"), F.col("phone_e164").alias("key")), F.struct(F.lit("email").alias("channel"), F.col("email_norm").alias("key")))
    all_keys = F.concat(contacts, F.coalesce(tokens, F.array().cast("array<struct<channel:string,key:string>>")))
    return entities.select("id", F.explode(all_keys).alias("k")).select("k.channel", "k.key", "id").where("key <> ''")


def blocks(entities: DataFrame, contact_cap: int = CONTACT_CAP, token_cap: int = TOKEN_CAP) -> DataFrame:
    """channel, key, size, kept of every block of two or more; a block over its channel's cap is not kept.

    Sizes come from partial counts; no block's members are gathered before its size is known.
    """
    sized = keys(entities).groupBy("channel", "key").agg(F.count("*").alias("size")).where("size >= 2")
    return sized.withColumn("kept", F.col("size") <= F.when(F.col("channel") == "name", token_cap).otherwise(contact_cap))


def emissions(entities: DataFrame, contact_cap: int = CONTACT_CAP, token_cap: int = TOKEN_CAP) -> DataFrame:
    """channel, key, a, b for every pair a < b of every kept block: at most cap x (cap - 1) / 2 rows for each."""
    kept = blocks(entities, contact_cap, token_cap).where("kept").select("channel", "key")
    members = keys(entities).join(kept, ["channel", "key"])
    held = members.groupBy("channel", "key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    left = held.select("channel", "key", F.posexplode("ids").alias("i", "a"), "ids")
    return left.select("channel", "key", "a", F.explode(F.slice("ids", F.col("i") + 2, F.size("ids"))).alias("b"))


def candidate_pairs(emitted: DataFrame) -> DataFrame:
    """a, b, channels (sorted, distinct)."""
    return emitted.groupBy("a", "b").agg(F.array_sort(F.collect_set("channel")).alias("channels"))


def pair_stats(entities: DataFrame, contact_cap: int = CONTACT_CAP, token_cap: int = TOKEN_CAP) -> DataFrame:
    """channel, emitted (pairs, once for each key they share), oversized (blocks dropped); the row `total` has the distinct pairs."""
    emitted = emissions(entities, contact_cap, token_cap)
    by_channel = emitted.groupBy("channel").agg(F.count("*").alias("emitted"))
    dropped = blocks(entities, contact_cap, token_cap).groupBy("channel").agg(F.count_if(~F.col("kept")).alias("oversized"))
    rows = dropped.join(by_channel, "channel", "left").select("channel", F.coalesce("emitted", F.lit(0)).alias("emitted"), "oversized")
    total = emitted.select("a", "b").distinct().agg(F.lit("total").alias("channel"), F.count("*").alias("emitted"), F.lit(0).cast("long").alias("oversized"))
    return rows.unionByName(total)


def with_sides(pairs: DataFrame, entities: DataFrame) -> DataFrame:
    """pairs with both entities as structs a_side and b_side, and the degrees of contacts that both share."""
    a = entities.select(F.col("id").alias("a"), F.struct(*entities.columns).alias("a_side"))
    b = entities.select(F.col("id").alias("b"), F.struct(*entities.columns).alias("b_side"))
    joined = pairs.join(a, "a").join(b, "b")
    shared = lambda c, d: F.when(F.col(f"a_side.{c}") == F.col(f"b_side.{c}"), F.col(f"a_side.{d}")).otherwise(F.lit(0))
    return joined.withColumns({"phone_degree": shared("phone_e164", "phone_degree"), "email_degree": shared("email_norm", "email_degree")})


def sample_by_zone(pairs: DataFrame, per_zone: int = 140, seed: int = 42) -> DataFrame:
    """per_zone pairs of each zone, chosen by a hash of seed and pair."""
    order = F.md5(F.concat_ws(":", F.lit(seed), "entity_a", "entity_b"))
    rank = F.row_number().over(Window.partitionBy("zone").orderBy(order, "entity_a", "entity_b"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= per_zone).drop("rank")
