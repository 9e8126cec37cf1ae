"""Distinct visitors that merge across days (A2a, M6): exact bitmaps instead of sums of daily counts.

The campaign mart's ``total_unique_visitors`` adds daily distinct counts, so a visitor of three days counts three times. Here
each day stores, for every group of dimensions, which visitors it had: a visitor has a dense number, and the numbers of a
group are bitmaps of 32,768 bits, one for each block of numbers in use. A bitmap is sparse: an array of its words of 64 bits
that have a bit set (``word``, ``bits``), sorted. So a state is as large as what it holds, 16 bytes or so for one visitor
and at most 512 words for all of a block, where a dense bitmap (``bitmap_construct_agg``) takes 4 KB for one visitor too;
sorts and shuffles of the many small groups of a day then hold little more than their keys. States of any days, campaigns
or devices merge word by word (``bit_or``), so a week's or a month's true distinct count needs neither the sessions nor a
COUNT(DISTINCT) over them.

Numbers are dense so that blocks fill: ``extend_numbers`` gives visitors unknown so far the next numbers, in parallel
(by hash bucket: the visitors of earlier buckets, then the position in the bucket), and never changes a number.
Building and merging states aggregates by (group, word), partial aggregates first, so neither a large campaign nor a busy
visitor lands whole in one task. NULL visitors are no visitors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.channels import coalesce_campaign
from ..functions.numeric import idiv, long_lit

DIMENSIONS = ["traffic_source", "traffic_medium", "campaign_name", "device_category", "country"]
#: Hash buckets in which new visitors are numbered: one window over so many rows, one in each bucket.
BUCKETS = 4096
#: Bits of a word, the unit in which bitmaps are stored and merged (a bigint).
WORD = 64


def extend_numbers(sessions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """visitor_id, visitor_no: the ``known`` numbers and new ones for the other visitors of ``sessions``.

    A day can be numbered alone, later days extend it; store the result before extending it again."""
    new = sessions.select("visitor_id").where("visitor_id is not null").distinct()
    if known is not None:
        new = new.join(known.select("visitor_id"), "visitor_id", "left_anti")
    new = new.withColumn("_bucket", F.pmod(F.xxhash64("visitor_id"), F.lit(BUCKETS)).cast("int"))
    buckets = new.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    buckets = buckets.select("_bucket", F.coalesce(F.sum("_rows").over(earlier), long_lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("visitor_id"))
    numbered = new.withColumn("_place", place).join(buckets, "_bucket")
    numbered = numbered.select("visitor_id", (F.col("_before") + F.col("_place")).alias("visitor_no"))
    if known is None:
        return numbered
    last = known.agg(F.max("visitor_no")).first()[0] or 0  # one number
    return known.select("visitor_id", "visitor_no").unionByName(numbered.withColumn("visitor_no", F.col("visitor_no") + long_lit(last)))


def daily_states(sessions: DataFrame, numbers: DataFrame) -> DataFrame:
    """One row for each day, group of ``DIMENSIONS`` and block of visitor numbers: ``block`` and ``visitors`` (a sparse bitmap)."""
    groups = [c for c in DIMENSIONS if c != "campaign_name"]
    seen = sessions.where("visitor_id is not null").select("session_date", *groups, coalesce_campaign().alias("campaign_name"), "visitor_id").distinct()
    seen = seen.join(numbers, "visitor_id").withColumn("_bit", F.call_function("bitmap_bit_position", F.col("visitor_no")))
    bit = F.call_function("shiftleft", long_lit(1), (F.col("_bit") % WORD).cast("int"))
    words = seen.groupBy("session_date", *DIMENSIONS, F.call_function("bitmap_bucket_number", F.col("visitor_no")).alias("block"),
                         idiv("_bit", WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("session_date", *DIMENSIONS, "block").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("visitors"))


def distinct_visitors(states: DataFrame, by: dict[str, Column | str]) -> DataFrame:
    """True distinct visitors by any expressions (name: column) over the day and the dimensions of stored states."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in by.items()]
    words = states.select(*named, "block", F.inline("visitors").alias("_word", "_bits"))
    merged = words.groupBy(*by, "block", "_word").agg(F.bit_or("_bits").alias("_bits"))
    return merged.groupBy(*by).agg(F.sum(F.bit_count("_bits")).alias("visitors"))
