"""URL filters: allow and block rules by host and path, and a list of blocked URLs behind a blocked Bloom filter.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the longest fitting rule
decides (of two equally long ones, that with the longer host). A URL that no rule fits is blocked if its canonical
form is listed. The list may hold billions of URLs, and most URLs aren't on it, so a blocked Bloom filter comes first:
a listed URL sets one bit in each of the eight 64-bit words of one 512-bit block. The blocks are one small table,
aggregated with ``bit_or`` and broadcast; a URL whose eight bits aren't all set is not listed and never shuffled. The
others meet the list in a hash join on the whole canonical URL, which takes the false positives out: results are exact
whatever the filter's size. The filter has about ``BITS`` bits a listed URL, at most ``MAX_BLOCKS`` blocks (16 MB of
bits, below 30 MB broadcast); a longer list only lets more URLs through to the exact join.

A URL may fill a third of the table. The ``HOT`` commonest candidates, a proven bound, are looked up in the list first and
meet their rows by broadcast; no other URL has more than one in ``HOT`` of the candidates, so the shuffled join is even.

Canonical form: host in lower case without ``www.`` and default port, path without trailing slashes, query without
``utm_*`` parameters and sorted, no scheme, no fragment. Null URLs and URLs without ``://`` have empty host and path,
fit no rule and are never listed: they are allowed. Other columns of the table are ignored; repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journeyline.llm import scratch

#: (verdict, host, beginning of the path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
BITS = 16
WORDS = 8
MAX_BLOCKS = 1 << 18
HOT = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The form in which URLs are listed and compared; null if there is no host."""
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    asked = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    asked = F.array_join(F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    whole = F.concat(name, F.regexp_replace(path(url), "/+$", ""), F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(""))
    return F.when(name != "", whole)


def first_rule(rules) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits the columns ``host`` and ``path``, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, name, begin in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):  # a later one overrules
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(begin)
        text, verdict = F.when(fits, name + begin).otherwise(text), F.when(fits, act).otherwise(verdict)
    return text, verdict


def _bits() -> list[Column]:
    """For each word of a block, the bit that the URL's second hash chooses."""
    second = F.xxhash64("url_key", F.lit(1))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftright(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("url_key"), F.lit(blocks).cast("long")).cast("int")


def blocks_for(listed: int, bits: int = BITS, most: int = MAX_BLOCKS) -> int:
    """Blocks of the filter: the power of two that gives each listed URL ``bits`` bits, at most ``most``."""
    need = max(1, -(-listed * bits // (64 * WORDS)))
    return min(most, 1 << (need - 1).bit_length())


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The blocks that have a bit set (``block``, ``w0`` to ``w7``), of a table of distinct ``url_key``; at most ``blocks`` rows."""
    bits = listed.select(_block(blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits())])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def probe(rows: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``maybe``: false only if the row's ``url_key`` is not listed."""
    own = rows.withColumn("block", _block(blocks))
    met = own.join(F.broadcast(filter_), "block", "left")
    found = F.lit(True)
    for i, bit in enumerate(_bits()):
        found = found & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    return met.withColumn("maybe", F.coalesce(found & F.col("url_key").isNotNull(), F.lit(False))).select(*rows.columns, "maybe")


def listing(urls: DataFrame, column: str = "url") -> DataFrame:
    """A stored list: the distinct canonical forms of a table's URLs."""
    keys = urls.select(canonical(F.col(column)).alias("url_key")).where("url_key is not null").distinct()
    return scratch.save(keys, "listed-urls")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """page_id, host, path, rule, verdict and ``listed`` of every row; ``listed`` is a table of distinct ``url_key``."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("url_key"))
    rows = rows.select("page_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")], "url_key")
    text, verdict = first_rule(rules)
    rows = rows.withColumns({"rule": text, "ruled": verdict})
    # a rule decides without the list, so only the other URLs are looked up
    rows = rows.withColumn("url_key", F.when(F.col("ruled").isNull(), F.col("url_key")))
    blocks = blocks_for(listed.count(), most=max_blocks)
    rows = scratch.save(probe(rows, bloom(listed, blocks), blocks), "probed-urls")
    out, asked = rows.where("not maybe"), rows.where("maybe")
    common = asked.groupBy("url_key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "url_key").limit(HOT).select("url_key")
    common = scratch.save(common.join(listed.withColumn("hit", F.lit(True)), "url_key", "left"), "common-urls")
    hot = asked.join(F.broadcast(common), "url_key")  # HOT rows
    rest = asked.join(F.broadcast(common.select("url_key")), "url_key", "left_anti")
    rest = rest.join(listed.withColumn("hit", F.lit(True)), "url_key", "left")
    every = out.withColumn("hit", F.lit(False)).unionByName(hot).unionByName(rest)
    hit = F.coalesce("hit", F.lit(False))
    return every.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(hit, "block").otherwise("allow")).alias("verdict"),
                        hit.alias("listed"))


#: Words that mark a host as unwanted; the query lists all URLs of such hosts.
HOST_WORDS = ("casino", "pills", "bets", "adult", "spam", "ads")


def unwanted(pages: DataFrame, words=HOST_WORDS) -> DataFrame:
    """The rows whose host has one of ``words`` between dots or hyphens."""
    return pages.where(F.arrays_overlap(F.split(host(F.col("url")), r"[.\-]"), F.array(*[F.lit(w) for w in words])))
