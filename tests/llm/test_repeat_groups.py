import random
from collections import defaultdict
from dataclasses import replace

from rollcall.llm.suffix import BYTES, repeat_groups


def test_hot_anchors_are_listed_like_any_other(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(n))
    passages = [words(50) for _ in range(3)]
    texts = {i: " ".join([words(rng.randrange(8)), passages[i % 3][rng.randrange(3) * 30 :], words(rng.randrange(8))]) for i in range(40)}
    texts |= {100 + i: texts[i] for i in range(5)}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(3)

    def listed(hot):
        members = defaultdict(set)
        for r in repeat_groups(docs, spec=replace(BYTES, hot=hot)).collect():
            members[r.repeat, r.length].add((r.doc_id, r.start))
        return sorted((length, sorted(m)) for (_, length), m in members.items())

    want = listed(8192)
    assert want and listed(1) == want
    for length, members in want:
        parts = {texts[i][start : start + length] for i, start in members}
        assert len(members) > 1 and len(parts) == 1 and len(*parts) == length >= 200
        everywhere = {(i, start) for i, t in texts.items() for start in range(len(t) - length + 1) if t[start : start + length] in parts}
        assert everywhere == set(members)
