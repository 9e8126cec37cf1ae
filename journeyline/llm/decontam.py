"""Operator 8: benchmark decontamination by spaced-seed hashing, with DataFrame functions only.

Texts are lower-cased and cut in words. An item of MATCHED words or more is in a text if, on some diagonal (text position
less item position), MATCHED of some WINDOW consecutive item positions have the same word in the text; substitutions and
positions beyond the text's ends are the others. Of a shorter item all words must agree.

A seed is the hash of the words that a fixed mask selects from SPAN consecutive words at most. The three masks are chosen so
that, wherever WINDOW - MATCHED = 3 positions of a window differ, one mask lies on agreeing positions alone (the tests
go through all 286 cases), so no such pair is without a seed. The first mask spans six words: an item of six to nine words
that stands whole in a text has that seed. An item of one to five words is a common phrase; it is found where it
is the whole text, by a join on the hash of all words.

Seeds of all positions of all documents are joined with those of the benchmark. A hit names a text, an item and a diagonal,
and the windows on it are compared position by position. The benchmark's seeds are broadcast while they are at most
BROADCAST_SEEDS rows (counted); a larger benchmark is joined by shuffle. Hits are kept by text hash (two 64-bit hashes), so
copies of a text are verified once. A text's seeds are made BLOCK positions at a time.

Null and blank texts and items hold no word and are never found; a null doc_id is returned as it is. Repeated document rows
give repeated result rows. Other columns are ignored, or kept by ``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch

MASKS = ((0, 1, 2, 4, 5), (0, 1, 2, 5, 8), (0, 2, 6, 7, 8))
SPAN = 1 + max(p for mask in MASKS for p in mask)
WINDOW, MATCHED = 13, 10
WHOLE_TEXT = max(MASKS[0])  # items of so many words or fewer have to be the whole text
BLOCK = 4096
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased words; an empty array for null or blank texts."""
    bare = F.btrim(F.lower(text.cast("string")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) > 0, F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row: a lambda's argument is never inlined, a column's alias is."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def seeds(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., pos, seed) for every mask at every position of ``hashes``, an array of word hashes."""
    blocks = F.sequence(F.lit(0), F.size("hashes") - 1, F.lit(BLOCK))
    rows = rows.where(F.size("hashes") > 0).select(*keep, "hashes", F.explode(blocks).alias("start"))
    used = sorted({p for mask in MASKS for p in mask})
    # the block's words beside those that follow them at each distance; null beyond the text's end
    shifted = F.arrays_zip(*[F.slice("hashes", F.col("start") + 1 + p, F.lit(BLOCK)).alias(f"w{p}") for p in used])
    rows = rows.select(*keep, "start", F.posexplode(shifted).alias("nth", "w"))
    at = [F.when(F.col(f"w.w{mask[-1]}").isNotNull(), F.xxhash64(F.lit(k), *[F.col(f"w.w{p}") for p in mask])) for k, mask in enumerate(MASKS)]
    rows = rows.select(*keep, (F.col("start") + F.col("nth")).alias("pos"), F.explode(F.array(*at)).alias("seed"))
    return rows.where("seed is not null")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key0"), F.xxhash64(F.lit(1), text).alias("key1")]


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """(key0, key1, item_id, matched, text_start, item_start): the best window for each text and item."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("item_text"))
    keyed = items.select("item_id", _hashes(F.col("item_text")).alias("hashes"))
    known = seeds(keyed.where(F.size("hashes") > WHOLE_TEXT), ["item_id"]).withColumnRenamed("pos", "item_pos").distinct()
    short = keyed.where(F.size("hashes").between(1, WHOLE_TEXT)).select("item_id", F.xxhash64("hashes").alias("all_words")).distinct()
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    text = F.col(text_col).cast("string")
    rows = docs.select(*text_keys(text), _hashes(text).alias("hashes"))
    hits = (seeds(rows, ["key0", "key1"]).join(known, "seed")
            .select("key0", "key1", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    if not short.isEmpty():
        brief = docs.select(*text_keys(text), _hashes(text).alias("hashes"))
        brief = brief.where(F.size("hashes").between(1, WHOLE_TEXT)).select("key0", "key1", F.xxhash64("hashes").alias("all_words"))
        hits = hits.unionByName(brief.join(short, "all_words").select("key0", "key1", "item_id", F.lit(0).alias("diagonal")).distinct())
    hits = scratch.save(hits, "hits")
    hit_texts = docs.select(*text_keys(text), text.alias("text")).join(hits.select("key0", "key1").distinct(), ["key0", "key1"])
    hit_texts = hit_texts.groupBy("key0", "key1").agg(F.first("text").alias("text"))
    both = hits.join(hit_texts, ["key0", "key1"]).join(items, "item_id")

    def agreeing(pair: Column) -> Column:
        """1 for each item position whose word stands in the text on this diagonal."""
        own, theirs, shift = pair["own"], pair["theirs"], pair["diagonal"]
        return F.transform(F.sequence(F.lit(0), F.size(theirs) - 1), lambda i: F.when(
            (i + shift >= 0) & (F.get(own, F.greatest(i + shift, F.lit(0))) == F.get(theirs, i)), 1).otherwise(0))

    def windows(agree: Column) -> Column:
        width = F.least(F.lit(WINDOW), F.size(agree))
        return F.transform(F.sequence(F.lit(0), F.size(agree) - width), lambda s: F.struct(
            F.aggregate(F.slice(agree, s + 1, width), F.lit(0), lambda a, x: a + x).alias("matched"), (-s).alias("minus")))

    pair = F.struct(words(F.col("text")).alias("own"), words(F.col("item_text")).alias("theirs"), F.col("diagonal"))
    best = (both.select("key0", "key1", "item_id", "diagonal", F.size(words(F.col("item_text"))).alias("n_words"), let(pair, lambda p: let(agreeing(p), lambda a: F.array_max(windows(a)))).alias("best"))
            .where(F.col("best.matched") >= F.least(F.lit(MATCHED), F.col("n_words"))))
    top = best.groupBy("key0", "key1", "item_id").agg(
        F.max(F.struct(F.col("best.matched").alias("matched"), F.col("best.minus").alias("minus"), (-F.col("diagonal")).alias("less"))).alias("top"))
    return top.select("key0", "key1", "item_id", F.col("top.matched").cast("long").alias("matched"),
                      (-F.col("top.minus") - F.col("top.less")).cast("long").alias("text_start"), (-F.col("top.minus")).cast("long").alias("item_start"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, matched, text_start, item_start: one row for each contaminated document and item; word positions."""
    found = contaminated_texts(docs, benchmark, text_col, item_col, item_text_col)
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_keys(F.col(text_col).cast("string")))
    return ids.join(scratch.save(found, "contaminated"), ["key0", "key1"]).select("doc_id", "item_id", "matched", "text_start", "item_start")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark passage."""
    found = scratch.save(contaminated_texts(docs, benchmark, text_col).select("key0", "key1").distinct(), "contaminated")
    key0, key1 = text_keys(F.col(text_col).cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key0, key1)
    return rows.join(found, ["key0", "key1"], "left_anti").select("row.*")
