"""URL filter: rules, then a blocked Bloom filter of listed URLs with an exact join behind it.

The list's canonical URLs set one bit in each of the eight 32-bit words of one
block.  The filter is a table of blocks; its size is bounded by ``MAX_BLOCKS``
whatever the list's length, so it is broadcast.  Rows whose bits are all set
are possible hits; only they are shuffled, to an exact join on the canonical
URL that removes the false positives.  A longer list only makes more false
positives for that join.  All of it is DataFrame functions.

Defined results.  A null URL, or one without ``://``, has empty host and path,
no rule and no canonical form: it is allowed.  Repeated rows are judged each;
the list may hold repeated and null entries.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: Blocks of 32 bytes of bits; the broadcast table holds at most so many rows.
MAX_BLOCKS = 1 << 17
BITS_PER_KEY = 16
#: Query parameters that don't tell pages apart. Fixed values.
TRACKING = r"^(utm_[^=]*|fbclid|gclid|ref)(=|$)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.when(F.coalesce(url, F.lit("")).contains("://"), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise(""))


def path_of(url: Column) -> Column:
    return F.when(F.coalesce(url, F.lit("")).contains("://"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def canonical(url: Column) -> Column:
    """Host without a default port and leading www, path without a closing slash, other parameters sorted; null without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"(\.?)(:80|:443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(url.contains("://"), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does.

    ``rules`` is a short parameter list of (verdict, host/path); long lists
    belong into the Bloom filter.
    """
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # longer rules are put around shorter ones
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(own_hash: str) -> list[Column]:
    """Of each word of a block, the bit that a key sets: five bits of its hash."""
    return [F.expr(f"shiftleft(1, cast(shiftright({own_hash}, {5 * i}) & 31 as int))") for i in range(8)]


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: a row for each block in use, its eight words in w0 to w7."""
    k = listed.select(_block(F.col(key), blocks).alias("block"), F.xxhash64(F.col(key), F.lit(1)).alias("own_hash"))
    k = k.select("block", *[m.alias(f"w{i}") for i, m in enumerate(_masks("own_hash"))])
    return k.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def mark_possible(rows: DataFrame, key: Column, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with boolean ``possible``: false only if the key is surely not in ``listed`` (one column)."""
    (name,) = listed.columns
    blocks = max(1, min(max_blocks, -(-listed.count() * BITS_PER_KEY // 256)))
    bloom = bloom_blocks(listed, name, blocks)
    probe = rows.withColumn("block", _block(key, blocks)).withColumn("own_hash", F.xxhash64(key, F.lit(1))).withColumn("known", key.isNotNull())
    probe = probe.join(F.broadcast(bloom), "block", "left")
    hit = F.col("known")
    for i, m in enumerate(_masks("own_hash")):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) != 0)
    probe = probe.withColumn("possible", F.coalesce(hit, F.lit(False)))
    return probe.drop("block", "own_hash", "known", *[f"w{i}" for i in range(8)])


def mark_listed(rows: DataFrame, key: str, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with boolean ``listed``: is the key one of ``listed`` (one column, distinct, no nulls)?"""
    (name,) = listed.columns
    probe = mark_possible(rows, F.col(key), listed, max_blocks)
    exact = probe.filter("possible").join(listed.select(F.col(name).alias("listed_key")), F.col(key) == F.col("listed_key"), "left")
    exact = exact.withColumn("listed", F.col("listed_key").isNotNull()).drop("listed_key", "possible")
    return exact.unionByName(probe.filter(~F.col("possible")).drop("possible").withColumn("listed", F.lit(False)))


def judge(pages: DataFrame, listed_urls: DataFrame, rules: list[tuple[str, str]], page: str = "page_id", url: str = "url") -> DataFrame:
    """page, host, path, rule, verdict and listed of every row; ``listed_urls`` is one column of URLs."""
    u = F.col(url)
    host, path = host_of(u), path_of(u)
    rows = pages.select(F.col(page).alias("page"), host.alias("host"), path.alias("path"), canonical(u).alias("canonical"))
    listed = listed_urls.select(canonical(F.col(listed_urls.columns[0])).alias("canonical")).filter("canonical is not null").distinct()
    rows = mark_listed(rows, "canonical", listed)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return rows.select(F.col("page").alias(page), "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise("allow")).alias("verdict"), "listed")
