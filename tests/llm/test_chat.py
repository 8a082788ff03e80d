import json

import pytest
from pyspark.sql import functions as F

from rollcall.llm import chat
from rollcall.llm.chat import format_messages, with_depth, with_problems
from rollcall.llm.common import ROW
from rollcall.llm.queries import op7_chat_formatting

SCHEMAS = [("get", "city", "string", True), ("get", "days", "integer", False), ("sum", "xs", "array", True)]


def call(i, name, arguments, after=()):
    return {"id": i, "name": name, "arguments": arguments if isinstance(arguments, str) else json.dumps(arguments), "after": list(after)}


def run(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, name int")
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, kind string, required boolean")
    return format_messages(messages, schemas).collect()


def test_links_orders_and_validates(spark):
    calls = [
        call("c", "sum", {"xs": [2, 1], "z": 1}, ["b"]), call("b", "get", {"days": 2, "city": "Lomé \"x\""}, ["a"]), call("a", "get", {"city": "Abc"}),
        call("d", "get", {"days": "two"}), call("e", "nope", {}), call("f", "get", "not json"), call("g", "get", {"city": "x"}, ["h"]), call("h", "get", {"city": "x"}, ["g"]), call(None, "get", {"city": "y"}),
    ]
    rows = [
        (1, 0, "user", "hi\n\u0001\"q\"", "n", 1), (1, 1, "assistant", json.dumps({"tool_calls": calls}), "n", 1), (1, 2, "tool", json.dumps({"tool_call_id": "b", "content": "second"}), "n", 1),
        (1, 3, "tool", json.dumps({"tool_call_id": "b", "content": "late"}), "n", 1), (1, 4, "tool", json.dumps({"tool_call_id": "a", "content": "first"}), "n", 1),
        (2, 0, "tool", json.dumps({"tool_call_id": "c", "content": "other conversation"}), "n", 1), (None, None, None, None, None, None), (1, 0, "user", "hi\n\u0001\"q\"", "n", 1),
    ]
    got = run(spark, rows)
    assert len(got) == len(rows)
    main = next(r for r in got if (r.conv_id, r.turn) == (1, 1))
    assert (main.n_calls, main.n_linked, main.n_valid) == (9, 2, 5)
    body = json.loads(main.json)
    assert json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == main.json
    assert [c["id"] for c in body["calls"]] == ["a", "d", "e", "f", None, "b", "c", "g", "h"]
    by_id = {c["id"]: c for c in body["calls"]}
    assert by_id["b"]["result"] == "second" and by_id["a"]["result"] == "first" and by_id["c"]["result"] is None
    assert by_id["b"]["arguments"] == {"city": "Lomé \"x\"", "days": 2}
    assert by_id["c"]["problems"] == ["unknown z"] and by_id["d"]["problems"] == ["kind of days", "missing city"]
    assert by_id["e"]["problems"] == ["unknown tool"] and by_id["f"]["problems"] == ["not an object"] and by_id["f"]["arguments"] == "not json"
    assert json.loads(next(r for r in got if r.conv_id is None).json) == {"calls": [], "content": None, "role": None}
    assert json.loads(next(r for r in got if (r.conv_id, r.turn) == (1, 0)).json)["content"] == "hi\n\u0001\"q\""
    assert run(spark, [])  == []


def test_levels_in_rows_and_by_joins_agree(spark):
    chain = [(9, f"n{i}", [f"n{i - 1}"] if i else []) for i in range(6)]
    rows = [*chain, (9, "x", ["n5", "n2", "gone"]), (9, "y", ["z"]), (9, "z", ["y"]), (9, "w", ["z"]), (8, "p", []), (8, "q", ["p"]), (8, "q", ["p"]), (8, None, ["p"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{ROW} long, conv long, call_id string, after array<string>")
    want = {"n0": 0, "n1": 1, "n2": 2, "n3": 3, "n4": 4, "n5": 5, "x": 6, "y": None, "z": None, "w": None, "p": 0, "q": 1, None: 0}
    for limit in (256, 1):
        assert {r.call_id: r.depth for r in with_depth(df, limit).collect()} == want
        assert with_depth(df, limit).count() == len(rows)
    assert with_depth(df.where(F.lit(False))).count() == 0


def test_reused_identifiers_and_copies_pair_up(spark):
    asks = lambda turn, city: (3, turn, "assistant", json.dumps({"tool_calls": [call("a", "get", {"city": city})]}), "n", 1)
    tells = lambda turn, what: (3, turn, "tool", json.dumps({"tool_call_id": "a", "content": what}), "n", 1)
    rows = [asks(1, "x"), tells(2, "X"), asks(3, "y"), tells(4, "Y"), asks(5, "z")]
    got = {r.turn: json.loads(r.json)["calls"] for r in run(spark, rows)}
    assert [got[t][0]["result"] for t in (1, 3, 5)] == ["X", "Y", None]
    copies = [asks(1, "x")] * 200 + [tells(2, "X")] * 150
    got = run(spark, copies)
    assert len(got) == 350 and sum(r.n_linked for r in got) == 150 and sum(r.n_calls for r in got) == 200


def test_nested_schemas(spark):
    schemas = spark.createDataFrame([
        ("go", "to", "object", True, None, None), ("go", "to.city", "string", True, None, None), ("go", "to.zip", "integer", False, None, None),
        ("go", "days", "array", False, "integer", None), ("go", "mode", "string", False, None, ['"bus"', '"train"']),
    ], "name string, field string, kind string, required boolean, items string, allowed array<string>")
    wanted = {
        '{"to":{"city":"x","zip":1},"days":[1,2],"mode":"bus"}': [], '{"to":{}}': ["missing to.city"], '{"to":3}': ["kind of to"], "{}": ["missing to"],
        '{"to":{"city":1,"zip":"a","more":{"q":1}},"x.y":1}': ["kind of to.city", "kind of to.zip", "unknown to.more", "unknown x.y"], '{"to":{"city":"x"},"days":[1,"2"]}': ["items of days"],
        '{"to":{"city":"x"},"mode":"car","days":[]}': ["value of mode"], '{"to":{"city":null}}': ["kind of to.city"], "[1]": ["not an object"], "": ["not an object"],
    }
    calls = spark.createDataFrame([("go", a) for a in wanted] + [("go", None)], "name string, arguments string")
    got = {r.arguments: r.problems for r in with_problems(calls, schemas).collect()}
    assert got == wanted | {None: ["not an object"]}


def test_the_query_links_each_turn_to_its_reply(spark, tmp_path):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (2, 0, "user", None), (2, 1, "assistant", "what?"), (2, 2, "user", "x" * 300_000), (None, 0, "user", "lost"), (1, 1, "user", "hi")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((str(r.conv_id), r.turn, r.n_calls, r.n_linked, r.n_valid, len(json.loads(r.json)["calls"])) for r in op7_chat_formatting(spark, str(tmp_path)).collect())
    assert got == [("1", 0, 1, 0, 1, 1), ("1", 1, 1, 0, 1, 1), ("1", 1, 1, 1, 1, 1), ("1", 2, 0, 0, 0, 0), ("2", 0, 1, 1, 0, 1), ("2", 1, 0, 0, 0, 0), ("2", 2, 1, 0, 1, 1), ("None", 0, 1, 0, 1, 1)]


#: Turns with material below their first line, one-line ones, nulls, repeated and lost rows, turns out of order.
TURNS = [
    (1, 0, "system", "be kind\nand brief"), (1, 1, "user", "sum it up\none\n\n\"two\"\u0001"), (1, 2, "assistant", "three\nfour"), (1, 3, "user", "why?"), (1, 5, "user", "\nb"), (1, 4, "assistant", "so"),
    (2, 0, "user", "a\n"), (2, 1, "user", "c\nd"), (2, 2, "assistant", None), (3, 0, "user", None), (3, 1, "tool", "x\ny"), (4, 7, "user", "é\n\n"), (4, 7, "user", "é\n\n"), (4, 8, "assistant", "once"),
    (4, None, "user", "n\nm"), (None, 1, "user", "p\nq"), (5, 0, None, "r\ns"), (5, 1, "", ""),
]


def write_turns(spark, path, turns):
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(path / "conversations.parquet"))


def by_hand(turns):
    """What op7 returns, one message and one call at a time. Equal rows share what results there are for them in any order."""
    name = lambda *of: "-".join(str(x) for x in of if x is not None)
    messages = []
    for conv, turn, role, text in turns:
        first = [name(conv, 0)] if turn == 1 else []
        own, calls = name(conv, turn), []
        if role == "user":
            request, *material = [None] if text is None else text.split("\n", 1)
            material = [m for m in material if m]
            calls.append([own, "reply", request, first + [own + ":read"] * len(material)])
            calls += [[own + ":read", "read", m, first] for m in material]
        elif role not in ("assistant", None):
            calls.append([own, "instruct", text, first])
        messages.append((conv, turn, role, text, calls))
    known = {(m[0], c[0]): [] for m in messages for c in m[4] if m[0] is not None}
    for m in messages:
        for c in m[4]:
            if m[0] is not None:
                known[m[0], c[0]] += [(m[0], a) for a in c[3] if (m[0], a) in known]
    depth_of = lambda key: 1 + max(map(depth_of, known.get(key, ())), default=-1)
    answers = {}
    for conv, turn, role, text in turns:
        if role == "assistant" and conv is not None:
            answers.setdefault((conv, name(conv, None if turn is None else turn - 1)), []).append(text)
    rows = []
    for conv, turn, role, text, calls in messages:
        done = []
        for seq, (i, tool, words, _) in enumerate(calls):
            waiting, arguments = answers.get((conv, i), []), {k: v for k, v in (("text", words), ("turn", turn)) if v is not None}
            problems = [f"missing {k}" for k in ("text", "turn") if k not in arguments]
            done.append((depth_of((conv, i)), seq, {"id": i, "name": tool, "arguments": arguments, "problems": problems, "result": waiting.pop(0) if waiting else None}))
        done = [c | {"depth": d} for d, _, c in sorted(done, key=lambda c: c[:2])]
        body = json.dumps({"calls": done, "content": text, "role": role}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        rows.append((conv, turn, len(done), sum(c["result"] is not None for c in done), sum(not c["problems"] for c in done), body))
    return sorted(rows, key=str)


def test_the_query_orders_requests_behind_their_material(spark, tmp_path):
    long = [(6, t, "user" if t % 2 else "assistant", f"ask {t}\nabout {t}") for t in range(chat.ROW_CALLS + 8)] + [(6, 0, "system", "first")]
    write_turns(spark, tmp_path, TURNS + long)
    got = sorted(map(tuple, op7_chat_formatting(spark, str(tmp_path)).collect()), key=str)
    assert got == by_hand(TURNS + long)
    calls = next(json.loads(r[-1])["calls"] for r in got if r[:2] == (1, 1))
    assert [(c["name"], c["depth"], c["arguments"]["text"]) for c in calls] == [("read", 1, "one\n\n\"two\"\u0001"), ("reply", 2, "sum it up")]


@pytest.mark.parametrize("stage, idle", [
    ("link", lambda calls, results: calls.withColumn("result", F.lit(None).cast("string"))),
    ("with_problems", lambda calls, schemas: calls.withColumn("problems", F.array().cast("array<string>"))),
    ("with_depth", lambda calls: calls.withColumn("depth", F.lit(0))),
    ("canonical_object", lambda raw: raw),
])
def test_no_stage_of_the_query_is_idle(spark, tmp_path, monkeypatch, stage, idle):
    write_turns(spark, tmp_path, TURNS)
    result = lambda: sorted(map(tuple, op7_chat_formatting(spark, str(tmp_path)).collect()), key=str)
    whole = result()
    monkeypatch.setattr(chat, stage, idle)
    assert result() != whole
