"""URL filters: allow and block rules, then a blocked Bloom filter in front of an exact join with listed URLs.

Everything is a DataFrame expression. The Bloom filter is itself a small table, one row per block of 512 bits held as
eight 64-bit words; a URL sets one bit in each word of one block. URLs whose bits are all set are possible hits and
take part in the exact join on the canonical text, which removes the false positives; the others never shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WORDS_PER_BLOCK = 8
#: A filter up to this size is broadcast (its size is known before the join); a larger one is joined by block number.
BROADCAST_BYTES = 32 << 20
BYTES_PER_BLOCK = 8 * (WORDS_PER_BLOCK + 1)
#: Query parameters that say where a visitor came from, not which page it is.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One text for the spellings of a page: no scheme, ``www.``/``m.``, fragment, tracking parameters, ``.html`` or
    trailing slash; other parameters sorted. Empty where the URL has no host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host == "", F.lit("")).otherwise(F.concat(host, path, tail))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; nulls if none does. Ties go to the first given."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the longest is tested first
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and the bit of each word, from two independent hashes of the key."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    spread = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    bits = [
        F.call_function("shiftleft", one, F.shiftrightunsigned(spread, 6 * j).bitwiseAND(F.lit(63)).cast("int"))
        for j in range(WORDS_PER_BLOCK)
    ]
    return block, bits


def bloom_table(listed: DataFrame, key: str, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """(filter rows, number of blocks) for distinct keys; the number of bits follows their count."""
    n = listed.count()
    blocks = max(1, -(-n * bits_per_key // (64 * WORDS_PER_BLOCK)))
    block, bits = _place(F.col(key), blocks)
    rows = listed.select(block.alias("bf_block"), *[b.alias(f"bf_{j}") for j, b in enumerate(bits)])
    merged = rows.groupBy("bf_block").agg(*[F.bit_or(f"bf_{j}").alias(f"bf_{j}") for j in range(WORDS_PER_BLOCK)])
    return merged, blocks


def flag_listed(rows: DataFrame, key: Column, bloom: DataFrame, blocks: int, name: str) -> DataFrame:
    """The rows with a flag that is true for every listed key and few others; for all where the filter is too large."""
    if blocks * BYTES_PER_BLOCK > BROADCAST_BYTES:
        return rows.withColumn(name, F.lit(True))
    block, bits = _place(key, blocks)
    possible = F.lit(True)
    for j, bit in enumerate(bits):
        possible = possible & (F.col(f"bf_{j}").bitwiseAND(bit) != 0)
    joined = rows.join(F.broadcast(bloom), block == F.col("bf_block"), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce(possible, F.lit(False)).alias(name))


def maybe_listed(rows: DataFrame, key: Column, listed: DataFrame, listed_key: str) -> DataFrame:
    """The rows whose key may be among ``listed`` (distinct, written): none that is goes missing, few others stay.

    With more keys than a filter of ``BROADCAST_BYTES`` serves, all rows are returned; an exact join has to follow.
    """
    bloom, blocks = bloom_table(listed, listed_key)
    if blocks * BYTES_PER_BLOCK > BROADCAST_BYTES:
        return rows
    block, bits = _place(key, blocks)
    possible = F.lit(True)
    for j, bit in enumerate(bits):
        possible = possible & (F.col(f"bf_{j}").bitwiseAND(bit) != 0)
    return rows.join(F.broadcast(bloom), block == F.col("bf_block")).where(possible).select(*[rows[c] for c in rows.columns])


def judge(
    pages: DataFrame, listed_urls: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, canonical, rule, listed, verdict.

    ``listed_urls`` has URLs in column ``url``. A rule's verdict goes first; else listed pages are blocked and the
    others allowed. Null URLs, and those without ``://``, have empty host and path, fit no rule, are never listed and
    are allowed. Repeated pages give repeated rows; an empty list blocks nothing.
    """
    listed = written(
        listed_urls.select(canonical(F.col("url")).alias("key")).where("key != ''").distinct(), "listed-urls"
    )
    bloom, blocks = bloom_table(listed, "key")
    if blocks * BYTES_PER_BLOCK <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        canonical(F.col(url)).alias("canonical"),
    )
    block, bits = _place(F.col("canonical"), blocks)
    probe = rows.withColumns({"block": block, **{f"bit_{j}": b for j, b in enumerate(bits)}})
    possible = F.lit(True)
    for j in range(WORDS_PER_BLOCK):
        possible = possible & (F.col(f"bf_{j}").bitwiseAND(F.col(f"bit_{j}")) != 0)
    probed = probe.join(bloom, probe["block"] == bloom["bf_block"], "left").select(
        *rows.columns, F.coalesce(possible, F.lit(False)).alias("possible")
    )
    hits = probed.where("possible").join(
        listed.select(F.col("key"), F.lit(True).alias("found")), F.col("canonical") == F.col("key"), "left"
    )
    out = hits.select(*rows.columns, F.coalesce("found", F.lit(False)).alias("listed")).unionAll(
        probed.where("not possible").select(*rows.columns, F.lit(False).alias("listed"))
    )
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", "canonical", rule.alias("rule"), "listed", F.coalesce(verdict, by_list).alias("verdict")
    )


#: The rules the query is asked to apply.
QUERY_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]
#: URLs whose digest starts below this are on the query's list: one spelling in eight.
LISTED_BELOW = "2"


def listed_in(pages: DataFrame) -> DataFrame:
    """URLs that stand for a published list: one in eight spellings in the table, by digest, so that it grows with it.

    A digest of the spelling says nothing about the host or the page: other spellings of a listed page are found by
    their canonical form only.
    """
    return pages.where(F.md5("url") < LISTED_BELOW).select("url")


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, listed_in(pages), QUERY_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "canonical", "listed"
    )


_HOST = "translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"
ORACLE = rf"""
with parts as (
  select page_id, url, {_HOST} as host, {_PATH} as path,
         list_sort(list_filter(string_split(coalesce(regexp_extract(url, '://[^?#]*\?([^#]*)', 1), ''), '&'),
             lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) as params
  from pages
), rows_ as (
  select page_id, url, host, path,
         case when host = '' then '' else regexp_replace(host, '^(www|m)\.', '')
              || regexp_replace(path, '(/index)?(\.html?)?/*$', '')
              || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end end as canonical
  from parts
), listed_ as (
  select distinct canonical from rows_
  where canonical <> '' and md5(url) < '2'
), ruled as (
  select r.*, canonical in (select canonical from listed_) as listed,
         case when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
              when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
              when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
              when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
              when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule
  from rows_ r
)
select page_id, host, path, rule, canonical, listed,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when listed then 'block' else 'allow' end as verdict
from ruled
"""
