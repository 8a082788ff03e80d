"""Scoring of candidate pairs: the full table, and the shorter way to merge edges alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import scoring
from rollcall.functions.similarity import name_similarity_udf
from rollcall.operators.blocking import candidate_pairs, degrees, emissions, with_sides


def prepared(entities: DataFrame) -> DataFrame:
    """entities (id, name_norm, tokens, communes, phone_e164, email_norm) with contact degrees."""
    return degrees(degrees(entities, "phone_e164", "phone_degree"), "email_norm", "email_degree")


def _named(pairs: DataFrame) -> DataFrame:
    """pairs with name_sim; each two names are compared once."""
    names = pairs.select(F.col("a_side.name_norm").alias("x"), F.col("b_side.name_norm").alias("y")).distinct()
    names = names.withColumn("name_sim", name_similarity_udf(F.col("x"), F.col("y")))
    return pairs.join(names, (F.col("a_side.name_norm") == F.col("x")) & (F.col("b_side.name_norm") == F.col("y"))).drop("x", "y")


def _flat(pairs: DataFrame) -> DataFrame:
    s = scoring.scored(F.col("name_sim"), F.col("channels"), F.col("phone_degree"), F.col("email_degree"), F.col("a_side.communes"), F.col("b_side.communes"))
    return pairs.select(F.col("a").alias("entity_a"), F.col("b").alias("entity_b"), "channels", s.alias("s")).select("entity_a", "entity_b", "channels", "s.name_sim", "s.contact", "s.geo", "s.score", "s.zone")


def scored_pairs(entities: DataFrame, **caps: int) -> DataFrame:
    """Every candidate pair with its parts, score and zone."""
    ready = prepared(entities)
    return _flat(_named(with_sides(candidate_pairs(emissions(ready, **caps)), ready)))


def merge_edges(entities: DataFrame, **caps: int) -> DataFrame:
    """The rows of scored_pairs in the merge zone. Names are compared only where the contact and places leave the threshold in reach."""
    ready = prepared(entities)
    pairs = with_sides(candidate_pairs(emissions(ready, **caps)), ready)
    best = scoring.weighted(F.lit(1.0), scoring.contact_score(F.col("channels"), F.col("phone_degree"), F.col("email_degree")), scoring.geo_agreement(F.col("a_side.communes"), F.col("b_side.communes")))
    return _flat(_named(pairs.where(best >= scoring.MERGE_AT))).where(F.col("zone") == scoring.MERGE)
