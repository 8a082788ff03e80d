"""The place x sector cube and its metrics, ranks and classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.classify import weighted_majority
from rollcall.storage import small

# Class bounds of the location quotient, classes, districts listed, least total of a place that is ranked by quotient.
LQ_CUTS = (0.33, 0.5, 0.8, 1.25, 2.0, 3.0)
CLASSES, DISTRICTS, LEAST_TOTAL = 7, 8, 200


def cluster_rows(entities: DataFrame, raw: DataFrame) -> DataFrame:
    """cluster, sector, place: one row for each cluster of classified entities; place null where no row has one.

    The sector weighs member_rows, the place raw rows; ties go to the smallest entity id, then the smallest place.
    A null cluster_id stands for the entity's own id. Entities without sector are left out (see excluded).
    """
    known = entities.where(F.col("sector").isNotNull()).select("id", "sector", "member_rows", F.coalesce("cluster_id", "id").alias("cluster"))
    sectors = weighted_majority(known, "cluster", "sector", F.col("member_rows"), F.col("id"), "sector")
    counts = raw.where(F.col("entity_id").isNotNull() & F.col("commune").isNotNull()).groupBy(F.col("entity_id").alias("id"), F.col("commune").alias("place")).agg(F.count("*").alias("n"))
    places = weighted_majority(known.join(counts, "id"), "cluster", "place", F.col("n"), F.col("id"), "place")
    return sectors.join(places, "cluster", "left")


def excluded(entities: DataFrame) -> DataFrame:
    """How many entities have no sector and are in no count."""
    return entities.agg(F.count_if(F.col("sector").isNull()).alias("excluded"))


def grouping_sets(rows: DataFrame, place: str = "place", sector: str = "sector") -> DataFrame:
    """place, sector, level, n: the grand total, each sector, each place and each cell, from one pass. A null place is a place of its own (level tells it from a total)."""
    sets = rows.groupingSets([[], [F.col(sector)], [F.col(place)], [F.col(place), F.col(sector)]], F.col(place), F.col(sector))
    level = F.grouping_id(F.col(place), F.col(sector))
    name = F.when(level == 3, "total").when(level == 2, "sector").when(level == 1, "place").otherwise("cell")
    return sets.agg(name.alias("level"), F.count("*").alias("n")).select(place, sector, "level", "n")


def top_districts(raw: DataFrame, place: str, district: str, entity: str, top: int = DISTRICTS) -> DataFrame:
    """place, district, n: the districts with the most distinct entities of each place, top of them; ties by name."""
    n = raw.where(F.col(place).isNotNull() & F.col(district).isNotNull() & F.col(entity).isNotNull()).groupBy(place, district).agg(F.count_distinct(entity).alias("n"))
    rank = F.row_number().over(Window.partitionBy(place).orderBy(F.desc("n"), district))
    return n.withColumn("r", rank).where(F.col("r") <= top).drop("r")


def dense(rows: DataFrame, place: str = "place", sector: str = "sector") -> DataFrame:
    """place, sector, n, place_total, sector_total, total over every pair of a located place and a sector, n 0 where there is none.

    The cells are counted once (partial sums before the shuffle); all else is made from these few counts. Sector
    and grand totals include rows without place. The grid has a row for each place and sector, not for each row.
    """
    cells = rows.groupBy(place, sector).agg(F.count("*").alias("n"))
    places = cells.where(F.col(place).isNotNull()).groupBy(place).agg(F.sum("n").alias("place_total"))
    sectors = cells.groupBy(sector).agg(F.sum("n").alias("sector_total")).withColumn("total", F.sum("sector_total").over(Window.partitionBy()))
    # sectors are a closed vocabulary: one short row; places stay distributed
    listed = sectors.groupBy().agg(F.collect_list(F.struct(sector, "sector_total", "total")).alias("s"))
    grid = places.join(F.broadcast(listed)).select(place, "place_total", F.explode("s").alias("s")).select(place, "place_total", f"s.{sector}", "s.sector_total", "s.total")
    return grid.join(cells, [place, sector], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def per_thousand(n: Column, population: Column) -> Column:
    return F.when(population > 0, n / population * 1000).otherwise(F.lit(0.0))


def quotient(n: Column, place_total: Column, sector_total: Column, total: Column) -> Column:
    """The share of a sector in a place over its share everywhere; null for an empty place or sector."""
    return F.when((place_total > 0) & (sector_total > 0), (n / place_total) / (sector_total / total))


def quotient_or_zero(lq: Column, place_total: Column, least: int = LEAST_TOTAL) -> Column:
    """Places under the least total stay, at 0."""
    return F.when(place_total >= least, lq).otherwise(F.lit(0.0))


def class_cuts(values: Column, classes: int = CLASSES) -> Column:
    """An aggregate: the bounds between classes of the positive values, by rank in their sorted list; null if there are none."""
    positive = F.array_sort(F.collect_list(F.when(values > 0, values.cast("double"))))
    n = F.size(positive)
    at = [F.least(n - 1, F.floor(F.lit(float(i + 1)) / F.lit(float(classes)) * n).cast("int")) for i in range(classes - 1)]
    return F.when(n > 0, F.array(*[F.get(positive, a) for a in at]))


def class_of(value: Column, cuts: Column) -> Column:
    """How many cuts the value reaches; -1 for null."""
    return F.when(value.isNull(), F.lit(-1)).otherwise(F.size(F.filter(cuts, lambda c: value >= c)))


def legend(cuts: Column, start: float) -> Column:
    """Ranges (low, high) of the classes; the last one is open."""
    lows = F.concat(F.array(F.lit(float(start))), cuts)
    return F.transform(F.arrays_zip(lows.alias("low"), F.concat(cuts, F.array(F.lit(None).cast("double"))).alias("high")), lambda z: z)


def rank_places(df: DataFrame, value: str, place: str = "place", within: tuple[str, ...] = (), into: str = "rank") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*within).orderBy(F.desc(value), place)))


def rounded_share(part: Column, whole: Column) -> Column:
    """Per cent, halves up."""
    return F.floor(part * F.lit(100.0) / whole + F.lit(0.5)).cast("long")


def dominant(grid: DataFrame, place: str = "place", sector: str = "sector") -> DataFrame:
    """Each place's largest sector (ties by name) and its share of the place in per cent."""
    best = grid.groupBy(place, "place_total").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(sector).alias("s"))).alias("b"))
    return best.select(place, F.col("b.s").alias("dominant"), rounded_share(-F.col("b.n"), F.col("place_total")).alias("share"))


def compared(grid: DataFrame, first: str, second: str, focus: str | None = None, top: int = 6, place: str = "place", sector: str = "sector") -> DataFrame:
    """sector, first_n, second_n: the sectors of two places by the larger of both counts, focus before all, top of them."""
    n = lambda p: F.max(F.when(F.col(place) == p, F.col("n")).otherwise(0))
    both = grid.where(F.col(place).isin(first, second)).groupBy(sector).agg(n(first).alias("first_n"), n(second).alias("second_n")).where((F.col("first_n") > 0) | (F.col("second_n") > 0))
    return both.orderBy((F.col(sector) != F.lit(focus or "")).cast("int"), F.desc(F.greatest("first_n", "second_n")), sector).limit(top)


def table_rows(grid: DataFrame, by: str, descending: bool = True, place: str = "place") -> DataFrame:
    """A row for each place with its total, dominant sector and share, ordered by a chosen column; null counts as -1 among numbers, names order as text."""
    rows = dominant(grid, place).join(grid.select(place, F.col("place_total").alias("total")).distinct(), place)
    key = F.col(by) if dict(rows.dtypes)[by] == "string" else F.coalesce(F.col(by), F.lit(-1))
    return rows.orderBy(key.desc() if descending else key.asc(), place)


def any_place(grid: DataFrame, current: str, seed: int, place: str = "place") -> DataFrame:
    """One place other than the current one, chosen by a hash of seed and name."""
    return grid.select(place).distinct().where(F.col(place) != current).orderBy(F.md5(F.concat_ws(":", F.lit(seed), place)), place).limit(1)


def tiles(rows: DataFrame, place: str = "place", sector: str = "sector") -> DataFrame:
    return rows.agg(F.count("*").alias("total"), F.count(place).alias("located"), F.count_distinct(place).alias("places"), F.count_distinct(sector).alias("sectors"))


def payload(grid: DataFrame, population: DataFrame, districts: DataFrame, labels: dict[str, str], place: str = "place", sector: str = "sector") -> DataFrame:
    """place and its json: total, sectors (label, count) that are not empty, population (0 if not known), districts. population: place, pop; districts: place, quartiers."""
    shown = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))]) if labels else F.create_map().cast("map<string,string>")
    by_place = grid.where("n > 0").groupBy(place, "place_total").agg(F.array_sort(F.collect_list(F.struct(F.col(sector).alias("id"), F.coalesce(F.try_element_at(shown, F.col(sector)), F.lit("?")).alias("label"), "n"))).alias("sectors"))
    joined = by_place.join(small(population), place, "left").join(districts, place, "left")
    return joined.select(place, F.to_json(F.struct(F.col("place_total").alias("total"), F.coalesce("pop", F.lit(0)).alias("pop"), "sectors", F.coalesce("quartiers", F.array().cast("array<string>")).alias("quartiers"))).alias("json"))
