"""Classification: majority value of an entity, then a closed lookup; keyword dominance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.text import label_tokens
from rollcall.storage import small

# Sector ids and their labels.
SECTORS = {
    "finance-mobile-money": "Transfert d'argent (mobile money)",
    "commerce-telephonie-electronique": "Commerce : téléphonie et électronique",
    "commerce-alimentaire": "Commerce : alimentation et boissons",
    "commerce-mode-beaute": "Commerce : mode, textile et beauté",
    "commerce-agricole": "Commerce : produits agricoles et forestiers",
    "commerce-construction-quincaillerie": "Commerce : quincaillerie et matériaux",
    "commerce-maison-loisirs": "Commerce : maison, bureau et loisirs",
    "commerce-auto-moto": "Commerce : automobile et moto",
    "commerce-divers": "Commerce : divers",
    "energie-eau": "Énergie et eau",
    "informatique-numerique": "Informatique et numérique",
    "btp-construction": "BTP et construction",
    "industrie-transformation": "Industrie et transformation",
    "agriculture-elevage-peche": "Agriculture, élevage et pêche",
    "transport-logistique": "Transport et logistique",
    "restauration-hotellerie-tourisme": "Restauration, hôtellerie et tourisme",
    "immobilier": "Immobilier",
    "services-professionnels": "Services professionnels (conseil, juridique, comptable)",
    "services-beaute": "Coiffure et esthétique",
    "services-location": "Location de matériel et d'espaces",
    "services-divers": "Services divers (entretien, pressing, réparation)",
    "medias-communication": "Médias, édition et audiovisuel",
    "education-formation": "Éducation et formation",
    "sante-medical": "Santé et médical",
    "assurance-finance": "Assurance",
}


def majority(rows: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """key and its most frequent value; of several the smallest. Null keys and values do not count."""
    counts = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).count()
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("count")).alias("c"), F.col(value).alias("v")))["v"].alias(into))


def weighted_majority(rows: DataFrame, key: str, value: str, weight: Column, order: Column, into: str) -> DataFrame:
    """key and the value of the largest total weight; of several the one with the smallest order, then the smallest."""
    sums = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight).alias("w"), F.min(order).alias("o"))
    return sums.groupBy(key).agg(F.min(F.struct((-F.col("w")).alias("w"), "o", F.col(value).alias("v")))["v"].alias(into))


def checked_mapping(mapping: DataFrame, known: list[str] | None = None) -> DataFrame:
    """activity and sector, trimmed; an empty or repeated activity, or an unknown sector, fails the query. The table is a small closed vocabulary."""
    known = list(SECTORS) if known is None else known
    rows = mapping.select(F.trim("activity").alias("activity"), F.trim("sector").alias("sector"))
    times = F.count("*").over(Window.partitionBy("activity"))
    problem = F.when(F.coalesce(F.col("activity"), F.lit("")) == "", F.lit("empty activity")).when(F.col("times") > 1, F.concat(F.lit("repeated activity: "), "activity")).when(
        F.col("sector").isNull() | ~F.col("sector").isin(*known), F.concat(F.lit("unknown sector: "), F.coalesce("sector", F.lit("null"))))
    return rows.withColumn("times", times).select(F.when(problem.isNull(), F.col("activity")).otherwise(F.raise_error(problem).cast("string")).alias("activity"), "sector")


def classified(raw: DataFrame, entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """entities with activity_main and sector, both null where not known. The mapping is a closed vocabulary, broadcast if it is counted as small."""
    main = majority(raw, "entity_id", "activity", "activity_main").withColumnRenamed("entity_id", "id")
    return entities.drop("activity_main", "sector").join(main, "id", "left").join(small(mapping.withColumnRenamed("activity", "activity_main")), "activity_main", "left")


def distribution(found: DataFrame) -> DataFrame:
    return found.groupBy("sector").count().orderBy(F.desc("count"), "sector")


def unknown_activities(found: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent activities without sector."""
    return found.where("sector is null and activity_main is not null").groupBy("activity_main").count().orderBy(F.desc("count"), "activity_main").limit(top)


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with each of columns (name: type) that it lacks, as null."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns})


def lexicon(labels: DataFrame, dominance: float = 0.8) -> DataFrame:
    """keyword and sector: tokens of labels (label, sector) of which one sector has dominance or more; a token counts once for each label."""
    counts = labels.select("sector", F.explode(F.array_distinct(label_tokens(F.col("label")))).alias("keyword")).groupBy("keyword", "sector").count()
    best = counts.groupBy("keyword").agg(F.sum("count").alias("total"), F.min(F.struct((-F.col("count")).alias("c"), "sector")).alias("b"))
    return best.where(-F.col("b.c") >= dominance * F.col("total")).select("keyword", F.col("b.sector").alias("sector"))
