import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollcall.functions import scoring, similarity
from rollcall.operators import blocking, clustering, evaluation, exact, judging, linkage


def raw(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, phone_raw string, phone_e164 string, phone_status string, email_norm string, commune string, quartier string, segment string, sheet string")


def test_exact_groups(spark):
    rows = [
        (1, "Éts Koffi", "97", None, "invalide", "a@b.co", "COTONOU", "q1", "s", "one"), (2, "ETS KOFFI", "97", "+2290197000001", "migre", "a@b.co", None, "", "s", "two"), (3, "ets  koffi!", "97", "+2290197000009", "migre", "a@b.co", "ABOMEY", "q1", None, "one"),
        (4, "ETS KOFFI", "98", None, None, None, None, None, None, "one"), (5, None, None, None, "vide", None, None, None, None, "one"), (6, "", "", None, "vide", "", None, None, None, "two"),
    ]
    found = {r.id: r for r in exact.entities(raw(spark, rows)).collect()}
    assert sorted(found) == [1, 2, 3]
    assert found[1]["name"] == "ets  koffi!" and found[1].phone_e164 == "+2290197000001" and found[1].phone_status == "migre" and found[1].member_rows == 3
    assert found[1].communes == ["ABOMEY", "COTONOU"] and found[1].quartiers == ["q1"] and found[1].sheets == ["one", "two"]
    assert found[3]["name"] == "" and found[3].member_rows == 2 and found[3].phone_raw is None
    back = {r.id: r.entity_id for r in exact.members(raw(spark, rows), exact.entities(raw(spark, rows))).collect()}
    assert back == {1: 1, 2: 1, 3: 1, 4: 2, 5: 3, 6: 3}
    assert exact.entities(raw(spark, [])).count() == 0


def test_numbering_over_many_partitions(spark):
    df = spark.range(0, 1000, 3).withColumn("x", (F.col("id") * 7919) % 10007).repartition(7)
    got = exact.numbered(df.drop("id"), "x").orderBy("x").collect()
    assert [r.id for r in got] == list(range(1, len(got) + 1))


def entities(spark, rows):
    return spark.createDataFrame(rows, "id long, tokens array<string>, phone_e164 string, email_norm string")


def test_blocking(spark):
    rows = [(1, ["KOFFI", "BAR"], "p", None), (2, ["KOFFI", "BAR"], "p", ""), (3, ["ADJA"], None, "m"), (4, ["ZOE"], None, "m"), *[(i, None, "hot", None) for i in range(10, 22)]]
    emitted = blocking.emissions(entities(spark, rows))
    pairs = {(r.a, r.b): r.channels for r in blocking.candidate_pairs(emitted).collect()}
    assert pairs == {(1, 2): ["name", "phone"], (3, 4): ["email"]}
    stats = {r.channel: (r.emitted, r.oversized) for r in blocking.pair_stats(entities(spark, rows)).collect()}
    assert stats == {"phone": (1, 1), "email": (1, 0), "name": (2, 0), "total": (2, 0)}


def score(spark, name, channels, pd_, ed, a, b):
    s = scoring.scored(F.lit(float(name)), F.array(*map(F.lit, channels)), F.lit(pd_), F.lit(ed), F.array(*map(F.lit, a)).cast("array<string>"), F.array(*map(F.lit, b)).cast("array<string>"))
    return spark.range(1).select(s.alias("s")).first().s


def test_scores_on_the_threshold(spark):
    assert score(spark, 1.0, ["phone"], 4, 0, ["x"], ["x"]).zone == scoring.MERGE  # exactly 0.90
    assert score(spark, 1.0, ["name"], 0, 0, ["x"], ["x"]).zone == scoring.GRAY
    assert score(spark, 0.3, ["phone"], 2, 0, ["x"], ["x"]).zone == scoring.REJECT
    assert score(spark, 1.0, ["email"], 0, 2, ["x"], ["x"]).score == 0.96
    assert score(spark, 1.0, ["phone"], 2, 0, ["x"], ["y"]).score == 0.85
    assert score(spark, 1.0, ["phone"], 2, 0, [], ["y"]).geo == 0.5
    got = [r.v for r in spark.createDataFrame([(d,) for d in (2, 5, 9, 10, 50)], "d int").select(scoring.contact_rarity(F.col("d")).alias("v")).collect()]
    assert got == [1.0, 0.5, 0.25, 0.0, 0.0]


def test_similarity():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, last = [0] * (len(b) + 1), row
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("ABC ") for _ in range(rng.randrange(80))) for _ in range(2))
        assert similarity.common_subsequence(a, b) == lcs(a, b)
    assert similarity.token_set("ETS KOFFI", "KOFFI") == 1.0 and similarity.token_set("", "A") == 0.0
    assert similarity.token_sort("KOFFI ETS", "ETS KOFFI") == 1.0
    assert round(similarity.jaro_winkler("MARTHA", "MARHTA"), 6) == 0.961111 and similarity.jaro_winkler("", "") == 0.0
    assert similarity.name_similarity("ETS KOFFI", "KOFFI BENIN") == 1.0


def test_the_short_way_to_merge_edges(spark):
    rng = random.Random(6)
    rows = [(i, f"SHOP {rng.choice('AB')}{i % 40}", [f"T{i % 60}"], [rng.choice(["x", "y"])], f"p{i % 45}" if i % 3 else None, f"m{i % 70}" if i % 4 else "") for i in range(150)]
    df = spark.createDataFrame(rows, "id long, name_norm string, tokens array<string>, communes array<string>, phone_e164 string, email_norm string")
    full = {(r.entity_a, r.entity_b, r.score) for r in linkage.scored_pairs(df).where(F.col("zone") == scoring.MERGE).collect()}
    assert full and {(r.entity_a, r.entity_b, r.score) for r in linkage.merge_edges(df).collect()} == full


def clusters(spark, edges, ids):
    found, refused = clustering.clusters(spark.createDataFrame(edges, "a long, b long, score double"), spark.createDataFrame([(i,) for i in ids], "id long"))
    return {r.id: r.cluster_id for r in found.collect()}, sum(r.refused for r in refused.collect())


def test_guard(spark):
    chain = [(i, i + 1, 0.85) for i in range(13)]
    got, refused = clusters(spark, chain, range(20))
    assert max(pd.Series(got).value_counts()) <= 12 and refused > 0 and got[19] == 19
    got, refused = clusters(spark, [(a, b, 0.92) for a, b, _ in chain], range(20))
    assert set(got[i] for i in range(14)) == {0} and refused == 0


def test_clusters_against_the_greedy_loop(spark):
    rng = random.Random(8)
    edges = list({(a, b): (a, b, round(rng.uniform(0.8, 1.0), 2)) for a, b in (sorted(rng.sample(range(120), 2)) for _ in range(110))}.values())
    label, refused = clustering.greedy(edges)
    assert clusters(spark, edges, range(120)) == ({i: label.get(i, i) for i in range(120)}, refused)


def test_evaluation(spark):
    rows = [(1, 2, "0.95", "fusion", " OUI "), (1, 3, "0.91", "fusion", "non"), (1, 4, "0.85", "zone_grise", "oui"), (1, 5, "0.5", "rejet", "non"), (1, 6, "0.99", "fusion", "incertain")]
    gold = evaluation.checked_labels(spark.createDataFrame(rows, "entity_a long, entity_b long, score string, zone string, same_business string"))
    assert evaluation.precision_recall(gold).first().asDict() == {"precision": 0.5, "recall": 0.5}
    assert evaluation.precision_recall(gold.limit(0)).first().asDict() == {"precision": None, "recall": None}
    assert sorted((r.low, r.positives, r.total) for r in evaluation.band_rates(gold).collect()) == [(0.0, 0, 1), (0.6, 0, 0), (0.7, 0, 0), (0.8, 1, 1), (0.9, 1, 2)]
    with pytest.raises(Exception, match="not a label"):
        evaluation.checked_labels(spark.createDataFrame([(1, 2, "1", "fusion", "yes")], "entity_a long, entity_b long, score string, zone string, same_business string")).collect()


def test_verdicts(spark):
    cases = [('ok [{"i": 1, "v": "MEME"}, {"i": 2, "v": "diff"}] end', ["meme", "diff"]), ("nothing", ["incertain"] * 2), ('[{"i": 9, "v": "meme"}, 5, {"i": 2, "v": "meme"}, {"i": 2, "v": "diff"}]', ["incertain", "diff"]), ("[oops", ["incertain"] * 2), (None, ["incertain"] * 2)]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", judging.verdicts(F.col("t"), F.lit(2)).alias("v")).collect()
    assert {r.i: r.v for r in rows} == {i: v for i, (_, v) in enumerate(cases)}


def test_queue_and_final_edges(spark):
    pairs = spark.createDataFrame([(1, 2, 0.8, "zone_grise"), (1, 3, 0.75, "zone_grise"), (2, 3, 0.7, "zone_grise"), (4, 5, 0.95, "fusion")], "entity_a long, entity_b long, score double, zone string")
    done = spark.createDataFrame([(1, 2, "meme", "m", "2024-01-01")], "entity_a long, entity_b long, verdict string, model string, judged_at string")
    assert [(r.entity_a, r.entity_b) for r in judging.queue(pairs, done, 0.72, 5).collect()] == [(1, 3)]
    assert sorted((r.a, r.b) for r in judging.final_edges(pairs, done).collect()) == [(1, 2), (4, 5)]


def test_pair_lines(spark):
    side = "struct<name:string,communes:array<string>,quartiers:array<string>,sector_label:string>"
    row = (("KOFFI", ["X"], ["a", "b", "c", "d"], "Bar"), ("ADJA", [], [], None), ["name", "phone"], 0.876)
    df = spark.createDataFrame([(row,)], f"p struct<a_side:{side},b_side:{side},channels:array<string>,name_sim:double>")
    assert df.select(judging.described(F.lit(3)).alias("l")).first().l == '3. A: "KOFFI" (X, district a, b, c; Bar) | B: "ADJA" (place not known; ?) | names 0.88 | same phone'


def test_judges_wait_and_ask_again():
    now, slept, asked = [0.0], [], []
    answers = iter([judging.Refused(400), judging.Refused(429), judging.Refused(503), "[]", None, judging.Refused(404)])

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    def request(lines, options):
        asked.append(options)
        if isinstance(answer := next(answers), Exception):
            raise answer
        return answer

    judge = judging.patient(request, {"thinking": 0, "temperature": 0}, ("thinking",), sleep=sleep, clock=lambda: now[0])
    assert judge(["1. a | b"]) == "[]" and judge(["1. c | d"]) == ""
    assert asked[0] == {"thinking": 0, "temperature": 0} and asked[1:] == [{"temperature": 0}] * 4
    assert slept == [7.0, 10.0, 20.0, 7.0]
    with pytest.raises(judging.Refused, match="404"):
        judge(["1. e | f"])
    tired = judging.patient(lambda *_: (_ for _ in ()).throw(judging.Refused(500)), sleep=sleep, clock=lambda: now[0])
    with pytest.raises(judging.Refused, match="500"):
        tired(["x"])
