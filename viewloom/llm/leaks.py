"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, met by every window of every training text.

Native: columns, one generator and one broadcast hash join.  Each text becomes its words (lower-cased A-Z, the runs of ``WORD``) and their 64-bit hashes.
A row goes out for each place, its key hashed from the next hashes of the array, so no window is written as text and none is shuffled; the join with the
set of windows verifies a hit by comparing the words themselves.  Only hits, and one row a text, reach the aggregation by text, in which
each task has already folded the hits of its own texts.

The set is broadcast in parts of at most ``MOST_WINDOWS`` windows and ``MOST_CHARACTERS`` characters, by their counts: a benchmark beyond that is met in several passes over the texts,
with the same result at every size.

Defined results: an item's windows are its runs of ``width`` words, or all its words if these are fewer; items and texts that are null, empty or without words have none; repeated
items are one item, an item without an id counts as one whose id is the empty text; repeated rows of texts are judged each on their own; an empty benchmark hits nothing; an
empty table gives no rows; texts of any length are scanned whole; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.text import kept

WIDTH = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: As WORD, before lower-casing.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MOST_WINDOWS, MOST_CHARACTERS = 200_000, 32_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, width: int = WIDTH, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: ``length``, ``window`` (its words, one space between them), ``key`` (hash of their hashes), ``items`` (ids of the items that hold it, sorted)."""
    own = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("words")).where("size(words) > 0")
    own = own.select("item", "words", F.least(F.size("words"), F.lit(width)).alias("length"))
    runs = own.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("i"))
    runs = runs.select("item", "length", F.slice("words", F.col("i"), F.col("length")).alias("run"))
    held = runs.groupBy("length", "run").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return held.select("length", F.array_join("run", " ").alias("window"), key([F.get("run", F.lit(k)) for k in range(width)], F.col("length"), hashed=False).alias("key"), "items")


def key(parts: list[Column], length: Column | int, hashed: bool = True) -> Column:
    """A window's key: the hash of the hashes of its words."""
    parts = parts if hashed else [F.when(p.isNotNull(), F.xxhash64(p)) for p in parts]
    if isinstance(length, int):
        return F.xxhash64(*parts[:length])
    out = F.lit(None).cast("long")
    for n in range(1, len(parts) + 1):
        out = F.when(length == n, F.xxhash64(*parts[:n])).otherwise(out)
    return out


def parts_of(held: DataFrame, most_windows: int, most_characters: int) -> tuple[int, list[int]]:
    """In how many parts the windows are broadcast, and which lengths there are."""
    size = F.length("window") + F.aggregate("items", F.lit(0), lambda a, x: a + F.length(x) + 8)
    n, characters, lengths = held.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0)), F.collect_set("length")).first()
    return max(1, -(-n // most_windows), -(-characters // most_characters)), sorted(lengths)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: list[str],
    width: int = WIDTH,
    item_id: str = "item_id",
    text: str = "text",
    most_windows: int = MOST_WINDOWS,
    most_characters: int = MOST_CHARACTERS,
) -> DataFrame:
    """A row for each text: ``carry``, ``n_words``, ``hits`` (begin and end of the merged runs of hit words, from 0) and ``items`` (ids of the items with windows in it, sorted as strings)."""
    held = kept(windows(benchmark, width, item_id, text))
    parts, lengths = parts_of(held, most_windows, most_characters)
    named = {f"_c{i}": F.col(c) for i, c in enumerate(carry)}
    texts = docs.select(*[c.alias(n) for n, c in named.items()], words(F.col(text)).alias("_words"))
    texts = texts.select(F.monotonically_increasing_id().alias("_row"), *named, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    if parts > 1:
        texts = kept(texts)  # all passes see the same row numbers
    out = None
    for part in range(parts):
        # -1 is the row of the text itself, which meets no window
        places = texts.select("*", F.size("_words").cast("long").alias("_n"), F.explode(F.sequence(F.lit(-1), F.size("_words") - 1)).alias("_at"))
        if len(lengths) == 1:
            places = places.withColumn("_length", F.lit(lengths[0]))
        elif lengths:
            places = places.withColumn("_length", F.explode(F.array(*map(F.lit, lengths))))
        else:
            places = places.withColumn("_length", F.lit(width))
        next_ones = [F.get("_hashes", F.col("_at") + k) for k in range(width)]
        inside = (F.col("_at") >= 0) & (F.col("_at") + F.col("_length") <= F.col("_n"))
        made = key(next_ones, lengths[0] if len(lengths) == 1 else F.col("_length"))
        places = places.withColumn("_key", F.when(inside, made))
        own = held.where(F.pmod("key", F.lit(parts)) == part) if parts > 1 else held
        own = F.broadcast(own.select(F.col("key").alias("_k"), "window", "items"))
        same = F.col("_key") == F.col("_k")  # a key alone, as a long is the cheapest to look up; equal words have equal lengths
        # not as an equality, which would become a second key, written for every place
        same &= F.array_join(F.slice("_words", F.col("_at") + 1, F.col("_length")), " ").between(F.col("window"), F.col("window"))
        met = places.join(own, same, "left").where("_at = -1 or window is not null")
        run = F.when(F.col("window").isNotNull(), F.struct(F.col("_at").alias("a"), (F.col("_at") + F.col("_length")).alias("b")))
        met = met.select("_row", *named, "_n", run.alias("_run"), F.when(F.col("window").isNotNull(), F.col("items")).alias("_items"))
        out = met if out is None else out.unionByName(met)
    return _folded(out, carry, 1 if len(lengths) < 2 else width * len(lengths))


def _folded(met: DataFrame, carry: list[str], near: int) -> DataFrame:
    """Rows of texts from the rows of their hits.  ``near``: the runs that begin at or before one's end are among so many next to it."""
    first = [F.first(f"_c{i}").alias(f"_c{i}") for i in range(len(carry))]
    turned = F.struct(F.col("_run.b").alias("b"), F.col("_run.a").alias("a"))
    by_text = met.groupBy("_row").agg(
        *first,
        F.first("_n").alias("n_words"),
        F.array_sort(F.collect_set("_run")).alias("_by_a"),
        F.array_sort(F.collect_set(F.when(F.col("_run").isNotNull(), turned))).alias("_by_b"),
        F.collect_set("_items").alias("_sets"),
    )
    # a merged run begins where no earlier run reaches, and ends where no later one has begun
    starts = F.filter("_by_a", lambda r, i: ~F.exists(F.slice("_by_a", F.greatest(i - near, F.lit(0)) + 1, F.least(i, F.lit(near))), lambda p: p["b"] >= r["a"]))
    ends = F.filter("_by_b", lambda r, i: ~F.exists(F.slice("_by_b", i + 2, F.lit(near)), lambda p: p["a"] <= r["b"]))
    hits = F.zip_with(starts, ends, lambda x, y: F.struct(x["a"].alias("a"), y["b"].alias("b")))
    return by_text.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        "n_words",
        hits.alias("hits"),
        F.array_sort(F.array_distinct(F.flatten("_sets"))).alias("items"),
    )


def n_hit(hits: Column) -> Column:
    """How many words are in merged runs."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])


def without(text: Column, hits: Column) -> Column:
    """A text without the words in ``hits`` and without what is between them and the words before."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*+{ANY_WORD}"), F.lit(0))
    tail = F.substring(text, F.aggregate(pieces, F.lit(1), lambda n, p: n + F.length(p)), F.length(text))
    begin = F.concat(F.array(F.lit(0)), F.transform(hits, lambda r: r["b"].cast("int")))
    end = F.concat(F.transform(hits, lambda r: r["a"].cast("int")), F.array(F.size(pieces)))
    left = F.zip_with(begin, end, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), ""))
    return F.concat(F.array_join(left, ""), tail)


def clean(docs: DataFrame, benchmark: DataFrame, spans: bool = True, doc_id: str = "doc_id", text: str = "text", **more: object) -> DataFrame:
    """Texts without what the benchmark holds: hit words go (``spans``), or whole rows that have any.  Other rows and columns stay as they are.

    Rows equal in id and text share their hits, by a 64-bit hash of the text; the join's side is the contaminated rows alone.
    """
    hashed = docs.withColumn("_leak_of", F.xxhash64(text))
    found = scan(hashed, benchmark, [doc_id, "_leak_of"], text=text, **more).where("size(hits) > 0")
    found = kept(found.select(F.col(doc_id).alias("_leak_id"), F.col("_leak_of").alias("_leak_hash"), F.col("hits").alias("_leak_hits")).dropDuplicates(["_leak_id", "_leak_hash"]))
    same = F.col(doc_id).eqNullSafe(F.col("_leak_id")) & (F.col("_leak_of") == F.col("_leak_hash"))
    if not spans:
        return hashed.join(found, same, "left_anti").select(docs.columns)
    cleaned = F.when(F.col("_leak_hits").isNotNull(), without(F.col(text), F.col("_leak_hits"))).otherwise(F.col(text))
    return hashed.join(found, same, "left").withColumn(text, cleaned).select(docs.columns)
