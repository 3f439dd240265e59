"""Benchmark decontamination by a prefix-filtered set join on rare words.

A window is ``length`` consecutive words of an item (a shorter item is one window).
Containment is exact, so the necessary prefix of a window, its words ordered by rarity
in the corpus, is its rarest word alone: a document holds the window only where it
holds that word.  One pass counts the item words over all documents; a second keeps,
within each row, the positions of rarest words with the words around them (the
positional bound: at most ``length`` - 1 to each side); these candidates meet the
windows by an equal join on the word, and the words around verify exact containment.
The text is never shuffled, and a very common word costs candidates only if a window has
no rarer one.

Rarest words go to the filter in blocks of at most ``block`` words, one pass over the
corpus for each, so nothing sent to executors grows with the benchmark.

Defined results: null and empty texts have no words; an empty item has no window;
repeated rows get equal results; rows are told apart by doc_id and text, so equal ids with
different texts stay apart; an empty table gives no hit; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevlens.llm.common import WORD, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def windows(items: DataFrame, length: int) -> DataFrame:
    """Distinct (item_id, w): the windows of the items, as arrays of words."""
    n = F.size("all")
    starts = F.when(n <= length, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), n - length + 1))
    return (items.select("item_id", words().alias("all")).where(n > 0)
            .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("all", i, length))).alias("w")).distinct())


def anchored(w: DataFrame, docs: DataFrame, block: int) -> DataFrame:
    """Windows with their rarest word: (w, items, word, at); at is the word's place from 0."""
    vocabulary = stored(w.select(F.explode("w").alias("word")).distinct(), "item-words")
    n = vocabulary.count()
    parts = [vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(-(-n // block))) == i) for i in range(-(-n // block))]
    counts = None
    for part in parts:
        known = [r[0] for r in part.collect()]             # at most about `block` words
        held = docs.select(F.explode(F.filter(words(), lambda x: x.isin(known))).alias("word"))
        c = held.groupBy("word").agg(F.count("*").alias("n"))
        counts = c if counts is None else counts.unionByName(c)
    one = w.groupBy("w").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    places = one.select("w", "items", F.posexplode("w").alias("at", "word"))
    if counts is not None:
        places = places.join(counts, "word", "left")
    else:
        places = places.withColumn("n", F.lit(0))
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("b")
    return stored(places.groupBy("w").agg(F.first("items").alias("items"), best)
                  .where(F.col("b.n") > 0)        # a word that no document has: the window can't occur
                  .select("w", "items", F.col("b.word").alias("word"), F.col("b.at").alias("at")), "windows")


def occurrences(docs: DataFrame, items: DataFrame, length: int = 13, block: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): rows (doc_id, text_hash, n_words), hits (doc_id, text_hash, start, size, items)."""
    w = anchored(windows(items, length), docs, block)
    anchors = stored(w.select("word").distinct(), "anchors")
    n = anchors.count()
    blocks = max(1, -(-n // block))
    rows, hits = None, None
    for i in range(blocks):
        rare = [r[0] for r in anchors.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == i).collect()]
        d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words().alias("all"))
        place = F.filter(F.transform("all", lambda x, k: F.when(x.isin(rare), k)), lambda k: k.isNotNull())
        around = F.transform(place, lambda k: F.struct(
            F.element_at("all", k + 1).alias("word"), k.alias("k"),
            F.slice("all", F.greatest(k - length + 2, F.lit(1)), 2 * length - 1).alias("near")))
        found = stored(d.select("doc_id", "text_hash", F.size("all").cast("long").alias("n_words"), around.alias("c")), "candidates")
        rows = found.select("doc_id", "text_hash", "n_words") if rows is None else rows
        c = found.select("doc_id", "text_hash", "n_words", F.explode("c").alias("c")).select("doc_id", "text_hash", "n_words", "c.*")
        start, size = F.col("k") - F.col("at"), F.size("w")
        first = F.greatest(F.col("k") - length + 1, F.lit(0))          # place of the first word of `near`
        holds = (start >= 0) & (start + size <= F.col("n_words")) & (F.slice("near", F.greatest(start - first, F.lit(0)) + 1, size) == F.col("w"))
        h = c.join(w, "word").where(holds).select("doc_id", "text_hash", start.alias("start"), size.alias("size"), "items")
        hits = h if hits is None else hits.unionByName(h)
    return rows, hits


def contamination(docs: DataFrame, items: DataFrame, length: int = 13, share: int = 20) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (sorted item ids as text), contaminated."""
    rows, hits = occurrences(docs, items, length)
    runs = (hits.groupBy("doc_id", "text_hash")
            .agg(F.array_sort(F.collect_set(F.struct("start", "size"))).alias("runs"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    zero = F.struct(F.lit(0).cast("int").alias("n"), F.lit(0).cast("int").alias("end"))
    end = lambda r: r["start"] + r["size"]
    covered = F.aggregate("runs", zero, lambda s, r: F.struct(
        (s["n"] + F.greatest(end(r) - F.greatest(r["start"], s["end"]), F.lit(0))).alias("n"), F.greatest(end(r), s["end"]).alias("end")))
    hit = runs.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), covered["n"].cast("long").alias("n_hit"),
                      F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items"))
    j = rows.join(hit, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("text_hash").eqNullSafe(F.col("_t")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return j.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
