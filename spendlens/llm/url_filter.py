"""URL filter: path rules, then a blocked Bloom filter over listed canonical URLs with an
exact hash join behind it. DataFrame functions only.

The Bloom filter is a table (block, 64-bit mask). Each listed URL sets ``HASHES`` bits in
the one block its hash picks; a page looks up one block. Pages whose bits are all set are
possible hits, and only they go through the exact join, which removes the false positives.
The mask table has 16 bytes for 4 listed URLs; it is broadcast while it is provably below
``broadcast_bytes`` and shuffled beyond that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import ascii_lower

#: (verdict, host, path): a rule fits its host and all subdomains.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
HASHES = 5
BITS_PER_URL = 16


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3, F.length(url) - at - 2)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without a final ``/`` or ``.html``;
    scheme, query and fragment don't count. Null for an empty host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    tail = F.regexp_replace(path, r"(\.html|/)$", "")
    return F.when(host != "", F.concat(bare, tail))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct (rule, verdict), or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fit = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                  F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
           for v, h, p in longest_first]
    return F.coalesce(*fit)


def bloom_block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_mask(key: Column) -> Column:
    h = F.xxhash64(key, F.lit(1))
    bits = [F.call_function(
        "shiftleft", F.lit(1).cast("long"),
        F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(HASHES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, mask): the filter as a table, or-ed together by a partial aggregation."""
    return (listed.groupBy(bloom_block(F.col(key), blocks).alias("block"))
            .agg(F.bit_or(bloom_mask(F.col(key))).alias("mask")))


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id",
                url_col: str = "url", rules=RULES, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, canonical, listed.

    ``listed`` has one string column of canonical URLs (repeats and nulls do no harm). A
    page with a fitting rule takes the rule's verdict; any other is blocked exactly if its
    canonical URL is listed. Null urls and urls without ``://`` have empty host and path,
    no rule, and are allowed. Repeated pages are judged one by one; other columns of
    ``pages`` are not read. An empty list allows every page without a rule.
    """
    key = listed.columns[0]
    urls = listed.select(F.col(key).alias("lkey")).where(F.col("lkey").isNotNull()).distinct()
    n = urls.count()
    blocks = max(1, -(-n * BITS_PER_URL // 64))
    bloom = blocked_bloom(urls, "lkey", blocks)
    if 16 * blocks <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    parts = pages.select(pages[id_col].alias(id_col), host_of(pages[url_col]).alias("host"),
                         path_of(pages[url_col]).alias("path"))
    judged = (parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
              .withColumn("canonical", canonical(F.col("host"), F.col("path")))
              .withColumn("bits", bloom_mask(F.col("canonical")))
              # pages without a host get a block of their own, which the filter doesn't have
              .withColumn("at", F.when(F.col("canonical").isNotNull(),
                                       bloom_block(F.col("canonical"), blocks)).otherwise(-1)))
    probed = judged.join(bloom, F.col("at") == F.col("block"), "left").withColumn(
        "maybe", F.coalesce(F.col("mask").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False)))
    # Only possible hits meet the exact list; the others never take part in that join.
    hits = (probed.where("maybe").join(urls, F.col("canonical") == F.col("lkey"), "left")
            .withColumn("listed", F.col("lkey").isNotNull()).drop("lkey"))
    rest = probed.where(~F.col("maybe")).withColumn("listed", F.lit(False))
    verdict = F.coalesce(F.col("r.verdict"),
                         F.when(F.col("listed"), "block").otherwise("allow"))
    return hits.unionByName(rest).select(
        id_col, "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"),
        "canonical", "listed")


def junk_listing(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Canonical URLs to list: those of which some copy has symbol runs in its title."""
    title = F.regexp_extract(F.col(html_col), r"<title>([^<]*)", 1)
    junk = title.rlike(r"###|\*\*\*|%%%|\$\$\$")
    c = canonical(host_of(F.col(url_col)), path_of(F.col(url_col)))
    return pages.where(junk).select(c.alias("canonical")).where(F.col("canonical").isNotNull()).distinct()
