"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations.

1. Count the benchmark's terms in the corpus; each window of an item is
   represented by its two rarest terms.
2. Store the postings (term, document, position) of these terms.
3. Intersect the offset-adjusted lists, from the rarest term on: where both
   terms stand at their distance is a candidate diagonal of item and
   document; where they stand near each other is a proximity match.
4. Compare item and document word by word along each candidate diagonal, and
   mark the words of every whole window.

Defined results: null or empty texts have no words. Items without words or
with a null id take no part; rows that share an item id are one item.
Repeated documents each get their row, null doc_ids too; an empty corpus gives an empty
result, an empty benchmark no hits. Whole texts are indexed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import ascii_lower, small, stored, without

#: What parts words before A-Z are lower-cased.
PARTS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def places(text: Column) -> Column:
    """The words of a text in order, with an empty string before a leading and after a trailing separator."""
    return F.split(text, PARTS)


def word_count(text: Column) -> Column:
    return F.when(text.isNotNull(), F.size(F.array_remove(places(text), ""))).otherwise(0).cast("long")


def item_words(items: DataFrame) -> DataFrame:
    """item, item_id, words (distinct rows): the items that take part."""
    words = F.filter(places(ascii_lower(F.col("text"))), lambda x: x != "")
    return (
        items.where("item_id is not null and text is not null").select("item_id", words.alias("words"))
        .where(F.size("words") > 0).distinct()
        .withColumn("item", F.xxhash64("item_id", "words"))
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: how often each of `terms` stands in the corpus."""
    words = docs.select(F.explode(places(F.col("text"))).alias("word")).select(F.lower("word").alias("term"))
    return words.join(small(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """item, term1, at1, term2, at2: the two rarest terms of each window whose terms all occur (term2 null for one word)."""
    terms = items.select("item", F.size("words").alias("length"), F.posexplode("words").alias("at", "word")).withColumn("term", F.lower("word"))
    found = (
        terms.join(counts, "term").groupBy("item", "length")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n", "term"))).alias("terms"))
    )
    size = F.least(F.lit(window), F.col("length"))
    windows = found.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("length") - size)))
    inside = F.filter("terms", lambda t: (t["at"] >= F.col("first")) & (t["at"] < F.col("first") + size))
    rare = F.array_sort(F.transform(inside, lambda t: F.struct(t["n"], t["term"], t["at"])))
    return (
        windows.where(F.size(inside) == size).select("item", rare.alias("rare"))
        .select("item", F.col("rare")[0]["term"].alias("term1"), F.col("rare")[0]["at"].alias("at1"),
                F.get("rare", F.lit(1))["term"].alias("term2"), F.get("rare", F.lit(1))["at"].alias("at2"))
        .distinct()
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (term, doc_id, text_hash, pos) of `terms` over all documents."""
    words = (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(places(F.col("text"))).alias("pos", "word"))
        .select("doc_id", "text_hash", "pos", F.lower("word").alias("term"))
    )
    return stored(words.join(small(terms), "term", "left_semi").distinct(), "postings")


def near_matches(pairs: DataFrame, index: DataFrame, slop: int) -> DataFrame:
    """(item, doc_id, text_hash, diagonal, shift): the rarest term, and the second shifted by at most `slop` words.

    Places meet by stretches of slop + 1 words, a stretch and its neighbours, so a text that is full of
    both terms gives as many rows as it has places near each other, not all pairs of places.
    """
    stretch = lambda place: F.floor(place / F.lit(slop + 1))
    first = (
        pairs.join(index.withColumnRenamed("term", "term1"), "term1")
        .select("item", "term2", "doc_id", "text_hash", (F.col("pos") - F.col("at1")).alias("diagonal"), "at2")
    )
    about = stretch(F.col("diagonal") + F.col("at2"))
    asked = first.where("term2 is not null").withColumn("near", F.explode(F.sequence(about - 1, about + 1)))
    second = index.select(F.col("term").alias("t"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("pos").alias("p"), stretch(F.col("pos")).alias("s"))
    shift = F.col("p") - F.col("at2") - F.col("diagonal")
    both = asked.join(second, (F.col("term2") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
                      & (F.col("near") == F.col("s")) & (F.abs(shift) <= slop))
    alone = first.where("term2 is null").withColumn("shift", F.lit(0))
    columns = ["item", "doc_id", "text_hash", "diagonal", "shift"]
    return both.withColumn("shift", shift).select(columns).unionByName(alone.select(columns)).distinct()


def whole_windows(docs: DataFrame, items: DataFrame, candidates: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, item_id, hit positions) of the windows that really stand on a candidate diagonal."""
    asked = (
        candidates.join(items.select("item", F.size("words").alias("length")), "item").groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("item", "diagonal", "length")).alias("asked"))  # of one document
    )
    wanted = asked.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "asked")
    texts = (
        docs.withColumn("text_hash", F.xxhash64("text"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
        .dropDuplicates(["doc_id", "text_hash"])  # of the few that are left
        .select("doc_id", "text_hash", places(ascii_lower(F.col("text"))).alias("own"), "asked")  # split once, not for every diagonal
        .select("doc_id", "text_hash", "own", F.explode("asked").alias("c"))
    )
    start, skip = F.greatest(F.col("c.diagonal"), F.lit(0)), F.greatest(-F.col("c.diagonal"), F.lit(0))
    right = F.slice("own", start + 1, F.col("c.length") - skip)  # only the words beside the item's go on
    beside = texts.select("doc_id", "text_hash", F.col("c.item").alias("item"), start.alias("start"), skip.alias("skip"), right.alias("right")).join(items, "item")
    left = F.slice("words", F.col("skip") + 1, F.size("words"))
    alike = F.zip_with(left, "right", lambda a, b: F.when(a == b, "1").otherwise("0"))
    size = F.least(F.lit(window), F.size("words"))
    compared = beside.select("doc_id", "text_hash", "item_id", "start", size.alias("size"), F.array_join(alike, "").alias("alike"))
    firsts = F.filter(F.sequence(F.lit(0), F.length("alike") - F.col("size")), lambda i: F.substr("alike", i + 1, F.col("size")) == F.repeat(F.lit("1"), F.col("size")))
    hits = F.array_distinct(F.flatten(F.transform("firsts", lambda i: F.sequence(F.col("start") + i, F.col("start") + i + F.col("size") - 1))))
    return (
        compared.where(F.length("alike") >= F.col("size")).withColumn("firsts", firsts).where(F.size("firsts") > 0)
        .select("doc_id", "text_hash", "item_id", hits.alias("hits"))
    )


def find(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 5) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids (sorted as strings), n_near, text_hash. Input: doc_id, text; item_id, text.

    n_near counts the items of which some window's two rarest terms stand within `slop` words of their distance.
    """
    docs, items = docs.select("doc_id", "text"), stored(item_words(items), "items")
    terms = items.select(F.explode("words").alias("word")).select(F.lower("word").alias("term")).distinct()
    pairs = stored(anchors(items, term_counts(docs, terms), window), "anchors")
    rare = pairs.select(F.explode(F.array("term1", "term2")).alias("term")).where("term is not null").distinct()
    matches = stored(near_matches(pairs, build_index(docs, rare), slop), "matches")
    exact = whole_windows(docs, items, matches.where("shift = 0").select("item", "doc_id", "text_hash", "diagonal").distinct(), window)
    hit = exact.groupBy("doc_id", "text_hash").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )
    near = matches.join(items.select("item", "item_id"), "item").groupBy("doc_id", "text_hash").agg(F.count_distinct("item_id").alias("n_near"))
    found = near.join(hit, near["doc_id"].eqNullSafe(hit["doc_id"]) & (near["text_hash"] == hit["text_hash"]), "left").select(
        near["doc_id"].alias("d"), near["text_hash"].alias("h"), "n_near", "n_hit", "item_ids")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("n_words"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "text_hash")


def digest(found: DataFrame) -> DataFrame:
    """`find` with the items as count and SHA-256."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    return without(docs, find(docs, items, window).where("n_hit > 0").select("doc_id", "text_hash").distinct())
