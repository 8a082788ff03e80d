"""Chat formatting: tool calls linked to their results, ordered, validated, and written as canonical JSON. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ROW, materialise, numbered, small

#: The text of an assistant message with calls, and of a tool message with a result.
CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>>"
RESULT = "struct<tool_call_id:string,content:string>"
#: The kinds of schemas, as patterns of a JSON value.
KINDS = {
    "string": r'^".*"$', "integer": r"^-?[0-9]+$", "number": r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$",
    "boolean": r"^(true|false)$", "array": r"^\[.*\]$", "object": r"^\{.*\}$", "null": r"^null$",
}
#: Calls of a conversation that are ordered within one row; those of longer ones are ordered by joins.
ROW_CALLS = 256
#: Parts that the calls, or results, of one turn and identifier are numbered in.
SALTS = 32


def json_string(text: Column) -> Column:
    """text as a JSON string; null as null."""
    quoted = F.to_json(F.struct(text.alias("s")))  # {"s":"..."}
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substring(quoted, F.lit(6), F.length(quoted) - 6))


def canonical_object(raw: Column) -> Column:
    """A JSON object with the keys of every level sorted and no blanks; null if raw is no object, or repeats a key."""
    value = F.to_json(F.try_parse_json(raw))
    return F.when(value.startswith("{"), value)


def parsed_calls(messages: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """A row (ROW, conv, turn, seq, call_id, name, arguments, after) for each call of the assistant messages whose text is a JSON object with tool_calls."""
    found = messages.where((F.col(role) == "assistant") & F.col(text).contains("tool_calls")).select(ROW, "conv", "turn", F.posexplode(F.from_json(text, CALLS)["tool_calls"]).alias("seq", "c"))
    return found.select(ROW, "conv", "turn", "seq", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.coalesce("c.after", F.array().cast("array<string>")).alias("after"))


def parsed_results(messages: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """A row (ROW, conv, turn, call_id, content) for each tool message whose text is a JSON object with tool_call_id."""
    r = F.from_json(F.col(text), RESULT)
    return messages.where(F.col(role) == "tool").select(ROW, "conv", "turn", r["tool_call_id"].alias("call_id"), r["content"].alias("content")).where("call_id is not null")


def _numbered_within(rows: DataFrame, *order: str) -> DataFrame:
    """rows that have conv and call_id, with nth: their place among those of the same two, by turn, salt and order.

    Rows of one turn are dealt to SALTS parts, which are counted with partial aggregates and numbered apart, so copies
    of one message, however many, are not sorted in one task.
    """
    key = ["conv", "call_id"]
    rows = rows.where("conv is not null and call_id is not null").withColumn("salt", F.pmod(F.hash(*order), F.lit(SALTS)))
    before = F.sum("count").over(Window.partitionBy(*key).orderBy("turn", "salt").rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.groupBy(*key, "turn", "salt").count().select(*key, F.col("turn").alias("t"), F.col("salt").alias("s"), F.coalesce(before, F.lit(0)).alias("before"))
    inside = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key, "turn", "salt").orderBy(*order)))
    inside = inside.withColumnsRenamed({"conv": "c", "call_id": "i"})
    same = (F.col("c") == F.col("conv")) & (F.col("i") == F.col("call_id")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("salt") == F.col("s"))
    return inside.join(parts, same).withColumn("nth", F.col("nth") + F.col("before")).drop("c", "i", "t", "s", "salt", "before")


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """calls with result_turn and result: the nth call of a conversation and identifier gets their nth result.

    Calls and results are numbered by turn (see _numbered_within) and hash-joined on conversation, identifier and number,
    so a key that repeats multiplies nothing and loses nothing. Calls without conversation or identifier, and those
    that are more than the results, have none; results that are more than the calls belong to no call.
    """
    answers = _numbered_within(results, ROW).select("conv", "call_id", "nth", F.col("turn").alias("result_turn"), F.col("content").alias("result"))
    asked = _numbered_within(calls.select(ROW, "seq", "conv", "turn", "call_id"), ROW, "seq")
    return calls.join(asked.join(answers.hint("shuffle_hash"), ["conv", "call_id", "nth"]).select(ROW, "seq", "result_turn", "result"), [ROW, "seq"], "left")


def _at(value: Column, names: Column) -> Column:
    """What stands at a path of names in a variant; null if nothing does."""
    return F.try_variant_get(value, F.concat(F.lit("$"), F.array_join(F.transform(names, lambda n: F.concat(F.lit('["'), n, F.lit('"]'))), "")), "variant")


def _fits(json: Column, kind: Column) -> Column:
    fits = F.lit(False)
    for name, pattern in KINDS.items():
        fits = F.when(kind == name, json.rlike("(?s)" + pattern)).otherwise(fits)
    return fits


def with_problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls with problems: why the arguments do not fit the schema of the tool, sorted; an empty array if they do.

    schemas: name, field, kind (of KINDS), required, and, if wanted, items (the kind of an array's items) and allowed (the JSON
    values that may stand there). A field within objects is a path: names, without quotes, joined by dots; it is required
    where its object is there. Problems: `not an object`, `unknown tool`, `missing F`, `kind of F`, `items of F`, `value of F`,
    `unknown F`. Schemas become one row for each tool before the join on the name.
    """
    optional = {"items": "string", "allowed": "array<string>"}
    schemas = schemas.select("name", "kind", "required", F.split("field", r"\.").alias("names"), *[F.col(c) if c in schemas.columns else F.lit(None).cast(t).alias(c) for c, t in optional.items()])
    by_tool = schemas.groupBy("name").agg(F.collect_list(F.struct("names", "kind", "required", "items", "allowed")).alias("__rc_fields"))
    whole = F.try_parse_json("arguments")
    joined = calls.withColumn("__rc_value", F.when(F.to_json(whole).startswith("{"), whole)).join(by_tool, "name", "left")
    value, fields = F.col("__rc_value"), F.col("__rc_fields")

    def check(f: Column) -> Column:
        found, name = _at(value, f["names"]), F.array_join(f["names"], ".")
        json, owner = F.to_json(found), F.to_json(_at(value, F.slice(f["names"], 1, F.size(f["names"]) - 1)))
        items = F.from_json(F.when(json.startswith("["), json), "array<variant>")
        say = lambda problem: F.concat(F.lit(problem), name)
        return (
            F.when(found.isNull(), F.when(f["required"] & owner.startswith("{"), say("missing ")))
            .when(~_fits(F.coalesce(json, F.lit("null")), f["kind"]), say("kind of "))
            .when(f["items"].isNotNull() & F.exists(items, lambda x: ~_fits(F.coalesce(F.to_json(x), F.lit("null")), f["items"])), say("items of "))
            .when(f["allowed"].isNotNull() & ~F.array_contains(f["allowed"], F.coalesce(json, F.lit("null"))), say("value of "))
        )

    # every object for which fields are declared may hold those only
    owners = F.array_distinct(F.flatten(F.transform(fields, lambda f: F.transform(F.sequence(F.lit(0), F.size(f["names"]) - 1), lambda n: F.slice(f["names"], 1, n)))))

    def unknown(owner: Column) -> Column:
        json = F.to_json(_at(value, owner))
        keys = F.map_keys(F.from_json(F.when(json.startswith("{"), json), "map<string,variant>"))
        known = F.transform(F.filter(fields, lambda f: (F.size(f["names"]) > F.size(owner)) & (F.slice(f["names"], 1, F.size(owner)) == owner)), lambda f: F.get(f["names"], F.size(owner)))
        return F.transform(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), known), lambda k: F.concat(F.lit("unknown "), F.array_join(F.concat(owner, F.array(k)), ".")))

    wrong = F.filter(F.transform(fields, check), lambda p: p.isNotNull())
    all_problems = F.array_sort(F.concat(wrong, F.flatten(F.transform(owners, unknown))))
    problems = F.when(value.isNull(), F.array(F.lit("not an object"))).when(fields.isNull(), F.array(F.lit("unknown tool"))).otherwise(all_problems)
    return joined.withColumn("problems", problems).drop("__rc_fields", "__rc_value")


def _levels(ids: Column, afters: Column) -> Column:
    """For arrays of identifiers and of the existing identifiers each comes after: the level of each; null in or behind a cycle."""
    places = F.sequence(F.lit(1), F.size(ids))
    start = F.transform(ids, lambda _: F.lit(None).cast("int"))

    def level(done: Column, depth: Column) -> Column:
        def place(i: Column) -> Column:
            ready = F.forall(F.element_at(afters, i), lambda a: F.coalesce(F.element_at(done, F.array_position(ids, a).cast("int")) < depth, F.lit(False)))
            return F.coalesce(F.element_at(done, i), F.when(ready, depth))

        return F.transform(places, place)

    return F.aggregate(F.sequence(F.lit(0), F.size(ids) - 1), start, level)


def with_depth(calls: DataFrame, row_calls: int = ROW_CALLS) -> DataFrame:
    """calls with depth: the longest chain of calls of the same conversation that each comes after; null in or behind a cycle.

    Kahn's order by levels. Only calls that others wait for, or that wait, take part. Conversations with at most
    row_calls such calls are ordered within a row; longer ones by one join for each level, with no call collected.
    A call that names itself is a cycle; names that no call of the conversation has are ignored. Of calls that
    share an identifier each is waited for.
    """
    edges = calls.select("conv", "call_id", F.explode("after").alias("before")).where("call_id is not null").distinct()
    known = calls.select("conv", F.col("call_id").alias("before")).where("before is not null").distinct()
    edges = materialise(edges.join(known, ["conv", "before"]).select("conv", "call_id", "before"))
    if not edges.limit(1).count():
        return calls.withColumn("depth", F.lit(0))
    nodes = edges.select("conv", "call_id").union(edges.select("conv", "before")).distinct()
    sizes = small(materialise(nodes.groupBy("conv").count()))
    short = edges.join(sizes.where(F.col("count") <= row_calls), "conv")
    waits = short.groupBy("conv", "call_id").agg(F.collect_list("before").alias("after"))
    waits = nodes.join(sizes.where(F.col("count") <= row_calls).select("conv"), "conv").join(waits, ["conv", "call_id"], "left").select("conv", "call_id", F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    held = waits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("call_id", "after"))).alias("c"))
    held = held.select("conv", F.transform("c", lambda c: c["call_id"]).alias("ids"), F.transform("c", lambda c: c["after"]).alias("afters"))
    placed = held.select("conv", F.explode(F.arrays_zip("ids", _levels(F.col("ids"), F.col("afters")).alias("depth"))).alias("x")).select("conv", F.col("x.ids").alias("call_id"), F.col("x.depth").alias("depth"))

    long = materialise(edges.join(sizes.where(F.col("count") > row_calls).select("conv"), "conv"))
    waiting = nodes.join(sizes.where(F.col("count") > row_calls).select("conv"), "conv")
    level = 0
    while long.limit(1).count():
        ready = materialise(waiting.join(long.select("conv", "call_id").distinct(), ["conv", "call_id"], "left_anti"))
        if not ready.limit(1).count():
            break  # what is left is in or behind a cycle
        placed = placed.unionByName(ready.withColumn("depth", F.lit(level)))
        waiting = materialise(waiting.join(ready, ["conv", "call_id"], "left_anti"))
        long = materialise(long.join(ready.withColumnRenamed("call_id", "before"), ["conv", "before"], "left_anti"))
        level += 1
    last = F.lit(None).cast("int") if long.limit(1).count() else F.lit(level)
    placed = placed.unionByName(waiting.withColumn("depth", last))
    joined = calls.join(placed.select("conv", "call_id", "depth", F.lit(True).alias("__rc_ordered")), ["conv", "call_id"], "left")
    return joined.withColumn("depth", F.when(F.col("__rc_ordered"), F.col("depth")).otherwise(F.lit(0))).drop("__rc_ordered")


def format_messages(messages: DataFrame, schemas: DataFrame, calls=parsed_calls, results=parsed_results, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each message: conv, turn, n_calls, n_linked, n_valid, json.

    json is canonical: keys sorted, no blanks, control characters escaped; `calls` holds the message's calls
    with their results, in topological order (depth, seq; those of a cycle last), and with their depth, null in a
    cycle, which orders calls of different messages of a conversation too. calls and results are
    functions of (messages with ROW, conv, turn, role, text) that return what parsed_calls and parsed_results do. Nothing
    is gathered by conversation but the calls that wait for each other (see with_depth), so one conversation
    may hold any share of the rows. Null roles and texts are null in json; null conversations and turns, and
    repeated rows, are messages like any other. Empty tables give no rows.
    """
    rows = numbered(messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias(role), F.col(text).alias(text)))
    found = materialise(calls(rows, role, text))
    full = with_depth(with_problems(link(found, results(rows, role, text)), schemas))
    field = lambda key, value: F.concat(F.lit(f'"{key}":'), value)
    comma = F.lit(",")
    call = F.concat(
        F.lit("{"), field("arguments", F.coalesce(canonical_object(F.col("arguments")), json_string(F.col("arguments")))), comma, field("depth", F.coalesce(F.col("depth").cast("string"), F.lit("null"))), comma, field("id", json_string(F.col("call_id"))), comma,
        field("name", json_string(F.col("name"))), comma, field("problems", F.concat(F.lit("["), F.array_join(F.transform("problems", json_string), ","), F.lit("]"))), comma,
        field("result", json_string(F.col("result"))), F.lit("}"))
    by_message = full.groupBy(ROW).agg(
        F.count("*").alias("n_calls"), F.count("result").alias("n_linked"), F.count_if(F.size("problems") == 0).alias("n_valid"),
        F.array_sort(F.collect_list(F.struct(F.col("depth").isNull().alias("cycle"), "depth", "seq", call.alias("json")))).alias("c"))
    by_message = by_message.select(ROW, "n_calls", "n_linked", "n_valid", F.array_join(F.transform("c", lambda c: c["json"]), ",").alias("calls"))
    body = F.concat(F.lit('{"calls":['), F.coalesce("calls", F.lit("")), F.lit("],"), field("content", json_string(F.col(text))), comma, field("role", json_string(F.col(role))), F.lit("}"))
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_calls", "n_linked", "n_valid")]
    return rows.join(by_message, ROW, "left").select(F.col("conv").alias(conv), F.col("turn").alias(turn), *counts, body.alias("json"))
