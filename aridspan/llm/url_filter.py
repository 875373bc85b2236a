"""URL filters: rules by host and path, then a list of canonical URLs. A blocked Bloom filter of the
list passes possible hits to an exact hash join, which removes false positives.

Native: DataFrame operations only. The filter is a table of 64-bit words, one for each block; a key sets
four bits of one block. It is broadcast only while its fixed number of blocks keeps it under 8 MB; beyond
that Spark joins it by block number. URLs are made distinct, then their canonical forms (both with a map-side combine)
before anything meets the filter, so a host or URL that holds a third of all pages is one row by then; the URLs of a hot
host that is listed, and the pages of such a URL, are dealt out to all tasks when verdicts come back to them. The list is
a table, key by key: hosts as ``host/``, pages as host and path, in canonical form (no user, port, dots at the end, ``www.``
or ``m.`` before a page, repeated slashes or slashes at the end; A-Z lower-cased in the host).

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed;
repeated rows are each judged; an empty list blocks nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import join_spread, stored, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: (verdict, host, path). A rule fits its host and all subdomains if the URL's path starts with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: The query's list: each of these names under each of these domains, as hosts with all of their pages and subdomains.
NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
DOMAINS = ("example.com", "example.info", "example.net", "example.org")

#: Blocks of 64 bits for each listed URL, and rows of the filter up to which it is broadcast.
BLOCKS_PER_URL, MAX_BROADCAST_ROWS = 0.25, 1 << 18


def with_parts(rows: DataFrame) -> DataFrame:
    """Adds host and path of url: the host from behind the first :// up to / ? or #, the path from there up to ? or #."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    host = F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 1)
    return rows.withColumn("path", F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", 2)).withColumn(
        "host", F.translate(host, UPPER, UPPER.lower())
    )


def rule_column(rules: tuple) -> tuple[Column, Column]:
    """Of the longest rule that fits host and path: its name and verdict, else null."""
    name = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def keys() -> Column:
    """The canonical forms of a URL that a list may hold: its page, and its host and parent domains."""
    host = F.rtrim(F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", ""), F.lit("."))
    path = F.regexp_replace(F.regexp_replace("path", "/+", "/"), "/$", "")
    page = F.concat(F.regexp_replace(host, "^(www|m)[.]", ""), path)
    labels = F.split(host, "[.]")
    hosts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)),
        lambda i: F.concat(F.array_join(F.slice(labels, i, F.size(labels)), "."), F.lit("/")),
    )
    return F.array_distinct(F.concat(F.array(page), hosts))


def block_of(blocks: int) -> Column:
    return F.expr(f"pmod(xxhash64(key), {blocks}L)")


#: The four bits of a key in its block.
MASK = "(" + " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(key, 17), {6 * i}) & 63 as int))" for i in range(4)) + ")"


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of listed (key): block, bits."""
    return listed.select(block_of(blocks).alias("block"), F.expr(MASK).alias("mask")).groupBy("block").agg(
        F.bit_or("mask").alias("bits")
    )


def listed_urls(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """url, n (its pages) of each URL of pages (url) that listed (key) holds in some canonical form."""
    listed = listed.select("key").distinct()
    blocks = 1 << max(6, (int(listed.count() * BLOCKS_PER_URL)).bit_length())
    filter_ = bloom(listed, blocks)
    if blocks <= MAX_BROADCAST_ROWS:
        filter_ = F.broadcast(filter_)
    urls = stored(pages.filter("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n_pages")), "urls")
    every = with_parts(urls).filter("host <> ''").select("url", "n_pages", F.explode(keys()).alias("key"))
    distinct = every.groupBy("key").agg(F.count("*").alias("n")).withColumn("block", block_of(blocks))
    possible = distinct.join(filter_, "block").filter(F.expr(f"(bits & {MASK}) = {MASK}")).select("key", "n")
    found = stored(possible.join(listed, "key", "left_semi"), "listed-keys")
    return join_spread(every, found, "key", "url").select("url", F.col("n_pages").alias("n")).distinct()


def default_list(spark: SparkSession) -> DataFrame:
    """key: the canonical URLs of the query's list."""
    values = lambda xs: ", ".join(f"('{x}')" for x in xs)
    return spark.sql(f"SELECT concat(n, '.', d, '/') AS key FROM VALUES {values(NAMES)} a(n) CROSS JOIN VALUES {values(DOMAINS)} b(d)")


def judge_urls(pages: DataFrame, rules: tuple = RULES, listed: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and whether the URL is listed, for each row of pages (page_id, url)."""
    spark = pages.sparkSession
    listed = default_list(spark) if listed is None else listed
    rows = pages.select("page_id", "url")
    hits = stored(listed_urls(rows, listed).withColumn("hit", F.lit(True)), "listed-urls")
    name, verdict = rule_column(rules)
    out = with_parts(join_spread(rows, hits, "url", "page_id", "left")).withColumn("listed", F.coalesce("hit", F.lit(False)))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return out.select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        name.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"),
        "listed",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL THEN '' WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM cut
), judged AS (
  SELECT page_id, host, path, rtrim(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS bare,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
    regexp_matches(bare, '(^|[.])(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)[.]example[.](com|info|net|org)$') AS listed
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM judged
"""
