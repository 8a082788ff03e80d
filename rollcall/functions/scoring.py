"""Pair scores: contact rarity, place agreement, weighted score, zone. Native DOUBLE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights, thresholds and the names of zones.
NAME_WEIGHT, CONTACT_WEIGHT, GEO_WEIGHT, EMAIL_FACTOR = 0.65, 0.20, 0.15, 0.8
MERGE_AT, MERGE_NAME, REJECT_AT, REJECT_NAME = 0.90, 0.70, 0.60, 0.60
MERGE, GRAY, REJECT = "fusion", "zone_grise", "rejet"


def contact_rarity(degree: Column) -> Column:
    return F.when(degree <= 2, F.lit(1.0)).when(degree <= 5, F.lit(0.5)).when(degree <= 9, F.lit(0.25)).otherwise(F.lit(0.0))


def contact_score(channels: Column, phone_degree: Column, email_degree: Column) -> Column:
    by_phone = F.when(F.array_contains(channels, "phone"), contact_rarity(phone_degree)).otherwise(F.lit(0.0))
    by_email = F.when(F.array_contains(channels, "email"), F.lit(EMAIL_FACTOR) * contact_rarity(email_degree)).otherwise(F.lit(0.0))
    return F.greatest(by_phone, by_email)


def geo_agreement(a: Column, b: Column) -> Column:
    """Whether sets of places meet: 1, 0, or one half if either is empty or null."""
    empty = (F.coalesce(F.size(a), F.lit(0)) <= 0) | (F.coalesce(F.size(b), F.lit(0)) <= 0)
    return F.when(empty, F.lit(0.5)).when(F.arrays_overlap(a, b), F.lit(1.0)).otherwise(F.lit(0.0))


def weighted(name: Column, contact: Column, geo: Column) -> Column:
    """In this order of DOUBLE operations: exact threshold cases depend on it."""
    return (F.lit(NAME_WEIGHT) * name + F.lit(CONTACT_WEIGHT) * contact) + F.lit(GEO_WEIGHT) * geo


def zone(score: Column, name: Column) -> Column:
    return F.when((score >= MERGE_AT) & (name >= MERGE_NAME), MERGE).when((score <= REJECT_AT) | (name < REJECT_NAME), REJECT).otherwise(GRAY)


def scored(name: Column, channels: Column, phone_degree: Column, email_degree: Column, places_a: Column, places_b: Column) -> Column:
    """struct(name_sim, contact, geo, score, zone); the zone is decided on the score before rounding to 4 decimals."""
    contact, geo = contact_score(channels, phone_degree, email_degree), geo_agreement(places_a, places_b)
    score = weighted(name, contact, geo)
    return F.struct(F.bround(name, 4).alias("name_sim"), F.bround(contact, 4).alias("contact"), geo.alias("geo"), F.bround(score, 4).alias("score"), zone(score, name).alias("zone"))
