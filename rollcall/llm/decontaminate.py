"""Benchmark decontamination: word windows of documents against a hash set of benchmark windows. DataFrame operations only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ROW, drop_rows, materialise, numbered, with_row

WINDOW = 13
#: Benchmark windows that may be broadcast: some 150 bytes each, so 75 MB at most.
BROADCAST_WINDOWS = 500_000
#: All but digits, letters and characters beyond ASCII; A-Z is lowered before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The text's words, with A-Z (and no other letter) lowered. Null has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _window_hash(hashes: str, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(hashes, start + k) for k in range(length)])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """item, length, hash and words (space-joined) of every window of every item; an item shorter than a window, but not empty, is one."""
    items = benchmark.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).withColumn("n", F.size("w")).where("n > 0")
    items = items.withColumn("length", F.least("n", F.lit(window)))
    each = items.select("item", "w", "length", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("length"))).alias("i"))
    each = each.select("item", "length", F.slice("w", F.col("i") + 1, F.col("length")).alias("part"))
    return each.select("item", "length", F.transform("part", lambda w: F.xxhash64(w)).alias("h"), F.array_join("part", " ").alias("window"))


def _windows(rows: DataFrame, lengths: list[int], first: int) -> DataFrame:
    """rows with h, i, length and key for each window of one of the lengths; if first is -1, also with i = -1 and no key once for each row."""
    rows = rows.withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    shortest = lengths[0]
    at = rows.select("*", F.explode(F.when(F.col("n") - shortest >= first, F.sequence(F.lit(first), F.col("n") - shortest)).otherwise(F.array(F.lit(first)) if first < 0 else F.array().cast("array<int>"))).alias("i"))
    if len(lengths) == 1:
        return at.withColumn("length", F.lit(shortest)).withColumn("key", _window_hash("h", F.col("i"), shortest))
    key = F.lit(None).cast("long")
    for length in lengths:
        key = F.when(F.col("length") == length, _window_hash("h", F.col("i"), length)).otherwise(key)
    at = at.select("*", F.explode(F.when(F.col("i") < 0, F.array(F.lit(shortest))).otherwise(F.array(*map(F.lit, lengths)))).alias("length"))
    return at.where((F.col("i") < 0) | (F.col("i") + F.col("length") <= F.col("n"))).withColumn("key", F.when(F.col("i") >= 0, key))


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("w", start + 1, length), " ")


def _looked_up(rows: DataFrame, distinct: DataFrame, lengths: list[int]) -> DataFrame:
    """ROW, __rc_id, n, i, length, wid of each verified hit, and once for each row with i = -1: the windows are broadcast, and one pass does it all."""
    same = (F.col("key") == F.col("hash")) & (F.col("i") >= 0) & (_part(F.greatest(F.col("i"), F.lit(0)), F.col("length")) == F.col("window"))
    return _windows(rows, lengths, -1).join(F.broadcast(distinct), same, "left").where("wid is not null or i < 0").select(ROW, "__rc_id", "n", "i", "length", "wid")


def _joined(rows: DataFrame, distinct: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by shuffle: of a document's windows only (row, place, length, key) is shuffled; those whose key is found meet their document once, and are verified there."""
    keys = _windows(rows, lengths, 0).select(ROW, "i", "length", "key")
    found = keys.join(distinct, F.col("key") == F.col("hash")).groupBy(ROW).agg(F.collect_list(F.struct("i", "length", "wid", "window")).alias("found"))
    right = F.filter("found", lambda f: _part(f["i"], f["length"]) == f["window"])
    none = F.struct(F.lit(-1).alias("i"), F.lit(lengths[0]).alias("length"), F.lit(None).cast("string").alias("wid"))
    each = F.concat(F.array(none), F.transform(F.coalesce(right, F.array().cast("array<struct<i:int,length:int,wid:string,window:string>>")), lambda f: F.struct(f["i"].alias("i"), f["length"].alias("length"), f["wid"].alias("wid"))))
    return rows.join(found, ROW, "left").select(ROW, "__rc_id", "n", F.inline(each))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row of docs: its number, id, n_words, n_hit, spans, item_ids, contaminated.

    Every window of a document is hashed from the hashes of its words and looked up in the set of benchmark
    windows; a hit is verified word by word. The set is broadcast if it was counted at BROADCAST_WINDOWS or
    fewer, else joined by shuffle, for which docs is read into a numbered copy. A document word in any occurrence of a window is hit; contaminated means at
    least one in twenty words. spans are the hit words as sorted [start, end) ranges; item_ids, sorted as
    strings, are those of items with an occurring window (items without id hit but are not listed).

    Null and empty texts have no words; empty tables give no rows, or no hits. Rows that repeat an id are told
    apart by their number.
    """
    wanted = materialise(benchmark_windows(benchmark, window=window))
    lengths = sorted(r.length for r in wanted.select("length").distinct().collect())  # at most `window` numbers
    # from the hashes of the words, as on the other side
    by_hash = F.lit(None).cast("long")
    for length in lengths:
        by_hash = F.when(F.col("length") == length, F.xxhash64(*[F.get("h", F.lit(k)) for k in range(length)])).otherwise(by_hash)
    distinct = materialise(wanted.select("length", "window", by_hash.alias("hash")).distinct().select("window", "hash", F.md5("window").alias("wid")))
    few = distinct.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    rows = with_row(docs if few else numbered(docs), F.col(id_col).alias("__rc_id"), words(F.col(text_col)).alias("w"))
    rows = rows.select(ROW, "__rc_id", "w", F.size("w").alias("n"))
    hits = materialise((_looked_up if few else _joined)(rows, distinct, lengths or [window]))

    spans = hits.groupBy(ROW).agg(F.first("__rc_id").alias(id_col), F.first("n").alias("n_words"), F.array_sort(F.collect_set(F.when(F.col("i") >= 0, F.struct("i", (F.col("i") + F.col("length")).alias("end"))))).alias("at"))
    spans = spans.withColumn("spans", merged("at"))
    found = hits.where("i >= 0").select(ROW, "wid").distinct().join(wanted.select(F.md5("window").alias("wid"), F.col("item").cast("string").alias("item")).distinct(), "wid")
    found = found.where("item is not null").select(ROW, "item").distinct().groupBy(ROW).agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    n_hit = F.aggregate("spans", F.lit(0), lambda s, x: s + x["end"] - x["i"])
    out = spans.join(found, ROW, "left").select(ROW, id_col, F.col("n_words").cast("long").alias("n_words"), n_hit.cast("long").alias("n_hit"), "spans", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def merged(spans: str) -> Column:
    """Sorted ranges (i, end) as ranges that do not touch."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["i"].alias("i"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["i"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.array().cast("array<struct<i:int,end:int>>"), add)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the contaminated rows; columns as they were."""
    docs = numbered(docs)
    return drop_rows(docs, contamination(docs, benchmark, id_col, text_col).where("contaminated"))
