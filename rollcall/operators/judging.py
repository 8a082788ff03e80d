"""A second opinion on gray pairs: description, batches for a pluggable judge, verdict parsing, a resumable queue."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.scoring import GRAY, MERGE
from rollcall.operators import clustering

# Verdicts, the confirming answer of the second pass, pairs in one request.
SAME, DIFFERENT, UNSURE, CONFIRMED = "meme", "diff", "incertain", "confirme"
BATCH = 25
# Requests for one answer at most, seconds before the first repetition (doubled each time) and between requests, and what is worth repeating.
ATTEMPTS, FIRST_DELAY, INTERVAL, PASSING = 4, 10.0, 7.0, (429, 500, 503)

#: Gets pair descriptions, returns the text of the answer.
Judge = Callable[[list[str]], str]


class Refused(Exception):
    """The remote model answered with an error code."""

    def __init__(self, code: int):
        super().__init__(f"refused with {code}")
        self.code = code


def patient(request: Callable[[list[str], dict], str | None], options: dict | None = None, optional: tuple[str, ...] = (), attempts: int = ATTEMPTS, delay: float = FIRST_DELAY, interval: float = INTERVAL, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> Judge:
    """A judge that asks request(lines, options) with patience.

    Two requests start interval seconds apart at least; codes that pass are asked again after a delay that doubles; the code 400
    with options that a model need not know is asked again without those. After the last attempt a refusal is raised. An
    answer that holds nothing is empty text. Each partition waits for itself, so a limit for all asks for one partition.
    """
    known, last = dict(options or {}), [float("-inf")]

    def judge(lines: list[str]) -> str:
        pause, left = delay, attempts
        while True:
            if (wait := last[0] + interval - clock()) > 0:
                sleep(wait)
            left, last[0] = left - 1, clock()
            try:
                return request(lines, dict(known)) or ""
            except Refused as error:
                droppable = [o for o in optional if o in known]
                if not left or not (error.code in PASSING or error.code == 400 and droppable):
                    raise
                if error.code == 400:
                    for o in droppable:
                        del known[o]
                else:
                    sleep(pause)
                    pause *= 2

    return judge


def described(index: Column, pair: str = "p") -> Column:
    """One line on a pair: its number; name, places, up to three districts and sector of both sides; name similarity; shared contacts."""
    def side(letter: str) -> Column:
        s = F.col(f"{pair}.{letter}_side")
        places, districts = F.array_join(s["communes"], ", "), F.array_join(F.slice(s["quartiers"], 1, 3), ", ")
        where = F.concat(F.when(places == "", F.lit("place not known")).otherwise(places), F.when(districts == "", F.lit("")).otherwise(F.concat(F.lit(", district "), districts)))
        return F.concat(F.lit(letter.upper() + ": \""), s["name"], F.lit("\" ("), where, F.lit("; "), F.coalesce(s["sector_label"], F.lit("?")), F.lit(")"))

    channels = F.array_join(F.col(f"{pair}.channels"), ",")
    shared = F.array_compact(F.array(F.when(channels.contains("phone"), F.lit("same phone")), F.when(channels.contains("email"), F.lit("same e-mail"))))
    contact = F.when(F.size(shared) == 0, F.lit("no contact known to be shared")).otherwise(F.array_join(shared, ", "))
    return F.concat(index.cast("string"), F.lit(". "), side("a"), F.lit(" | "), side("b"), F.lit(" | names "), F.format_number(F.col(f"{pair}.name_sim"), 2), F.lit(" | "), contact)


def verdicts(text: Column, expected: Column, valid: tuple[str, ...] = (SAME, DIFFERENT, UNSURE), fallback: str = UNSURE) -> Column:
    """The verdicts in an answer, one for each of expected pairs: from the first [ to the last ], JSON objects with i (from 1) and v.

    Whatever is missing, malformed, out of range or unknown is the fallback; of several verdicts on a pair the last one counts.
    """
    items = F.from_json(F.regexp_extract(text, r"(?s)\[.*\]", 0), "array<string>")
    parsed = F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.struct(
        F.expr("cast(null as int)").alias("none"), F.try_to_number(F.regexp_extract(F.get_json_object(x, "$.i"), r"^\s*(-?[0-9]{1,9})\s*$", 1), F.lit("S999999999")).cast("int").alias("i"), F.lower(F.trim(F.get_json_object(x, "$.v"))).alias("v")))
    good = F.filter(parsed, lambda p: p["i"].isNotNull() & (p["i"] >= 1) & (p["i"] <= expected) & p["v"].isin(*valid))
    last = lambda i: F.get(F.reverse(F.filter(good, lambda p: p["i"] == i)), 0)["v"]
    return F.when(expected > 0, F.transform(F.sequence(F.lit(1), F.greatest(expected, F.lit(1))), lambda i: F.coalesce(last(i), F.lit(fallback)))).otherwise(F.array().cast("array<string>"))


def judged(pairs: DataFrame, judge: Judge, batch: int = BATCH) -> DataFrame:
    """pairs (entity_a, entity_b, line) with answer, position and size of the request that each was in: one call of judge for each batch rows of a partition."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch].copy()
                part["answer"], part["position"], part["size"] = judge(part.line.tolist()), range(1, len(part) + 1), len(part)
                yield part

    columns = ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes)
    return pairs.mapInPandas(run, f"{columns}, answer string, position int, size int")


def two_passes(pairs: DataFrame, first: Judge, second: Judge, batch: int = BATCH) -> DataFrame:
    """pairs with a verdict: the first judge's; where that is `meme` and the second one does not confirm it, unsure."""
    once = judged(pairs, first, batch).withColumn("verdict", F.get(verdicts(F.col("answer"), F.col("size")), F.col("position") - 1)).select(*pairs.columns, "verdict")
    same = judged(once.where(F.col("verdict") == SAME).select(*pairs.columns), second, batch)
    said = F.get(verdicts(F.col("answer"), F.col("size"), (CONFIRMED, UNSURE)), F.col("position") - 1)
    again = same.select(*pairs.columns, F.when(said == CONFIRMED, F.lit(SAME)).otherwise(F.lit(UNSURE)).alias("verdict"))
    return once.where(F.col("verdict") != SAME).unionByName(again)


def queue(pairs: DataFrame, done: DataFrame, least_score: float, limit: int) -> DataFrame:
    """The gray pairs of least_score or more that nobody judged, the highest scores first, limit of them."""
    left = pairs.where((F.col("zone") == GRAY) & (F.col("score") >= least_score)).join(done.select("entity_a", "entity_b"), ["entity_a", "entity_b"], "left_anti")
    return left.orderBy(F.desc("score"), "entity_a", "entity_b").limit(limit)


def latest(rows: DataFrame, keys: list[str], order: str, tie: str) -> DataFrame:
    """Of the rows appended for each key, the last one by order, then tie: what an upsert would have left."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order), F.desc(tie)))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def final_edges(pairs: DataFrame, verdict_rows: DataFrame) -> DataFrame:
    """a, b, score of the merge zone's pairs and of the pairs judged the same, whatever their zone."""
    base = pairs.where(F.col("zone") == MERGE).select(F.col("entity_a").alias("a"), F.col("entity_b").alias("b"), "score")
    same = verdict_rows.where(F.col("verdict") == SAME).select("entity_a", "entity_b").join(pairs, ["entity_a", "entity_b"])
    return base.unionByName(same.select(F.col("entity_a").alias("a"), F.col("entity_b").alias("b"), "score"))


def with_gold_context(gold: DataFrame, pairs: DataFrame) -> DataFrame:
    """gold with channels and name_sim of its pairs; none and 0 where a pair is not a candidate."""
    return gold.join(pairs.select("entity_a", "entity_b", "channels", "name_sim"), ["entity_a", "entity_b"], "left").withColumns({"channels": F.coalesce("channels", F.array().cast("array<string>")), "name_sim": F.coalesce("name_sim", F.lit(0.0))})


def reclustered(pairs: DataFrame, verdict_rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, cluster_id) of every id, from the merge zone's pairs and those judged the same, under the guard against weak chains."""
    return clustering.clusters(final_edges(pairs, verdict_rows), ids)[0]


def gold_rows(sample: DataFrame, entities: DataFrame) -> DataFrame:
    """The table that people annotate, for each pair of sample (entity_a, entity_b, score, zone): names and places of both sides from entities (id, name, communes), and an empty column for the answer."""
    side = lambda s: entities.select(F.col("id").alias(f"entity_{s}"), F.col("name").alias(f"name_{s}"), F.array_join(F.array_sort("communes"), " / ").alias(f"communes_{s}"))
    joined = sample.join(side("a"), "entity_a").join(side("b"), "entity_b")
    return joined.select("entity_a", "entity_b", "name_a", "name_b", "communes_a", "communes_b", "score", "zone", F.lit("").alias("same_business"))
