"""URL filter: host and path rules, then a Bloom filter cascade.

The cascade stores a set of listed keys against the complete set of keys of
the corpus. Level 1 is a Bloom filter of the listed keys; level 2 one of the
other keys that level 1 wrongly holds; level 3 one of the listed keys that
level 2 wrongly holds; and so on until no key is wrong. A key's answer is the
parity of the first level that does not hold it, which is exact for every key
of the corpus. Rows are judged by an expression over the filters' words; there
is no join.

Level 1 takes the false-positive rate that makes the cascade smallest
(sqrt(0.5) x listed / others), the deeper ones 1/2, so the whole takes a few
bits a listed key. A filter reaches the tasks as one array, so its size is
bounded: keys are split by hash into as many parts as keep every filter under
``max_bits``, each part has a cascade of its own, and rows are judged part by
part.

Defined results: a null url, or one without ``://``, has an empty host and
path; the empty host is a key like any other. Repeated rows are judged alike;
an empty table gives an empty result; with no listed key nothing is listed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import bit_array, bit_at, table, written

# The rules of the query (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Names of listed sites, as a label of the host.
LISTED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BITS = 64 << 23  # 64 MB a filter


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, parts, 1), UPPER, LOWER), F.regexp_extract(u, parts, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. A rule fits its
    host and all subdomains where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


class Level:
    """One Bloom filter: ``bits`` positions, ``hashes`` of them a key."""

    def __init__(self, n_keys: int, rate: float, seed: int):
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.bits = max(64, 64 * math.ceil(n_keys * self.hashes / math.log(2) / 64))
        self.seed = seed
        self.words: Column | None = None

    def position(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed * 64 + i), key), F.lit(self.bits))

    def build(self, spark: SparkSession, keys: DataFrame) -> None:
        at = F.array(*[self.position(F.col("key"), i) for i in range(self.hashes)])
        self.words = bit_array(spark, keys.select(F.explode(at).alias("at")), self.bits)

    def holds(self, key: Column) -> Column:
        return reduce(lambda a, b: a & b, [bit_at(self.words, self.position(key, i)) for i in range(self.hashes)])


class Cascade:
    """Exact membership of every key of ``universe(key, listed)`` (distinct
    keys), by filters alone."""

    def __init__(self, spark: SparkSession, universe: DataFrame):
        self.levels: list[Level] = []
        n = universe.groupBy("listed").count().collect()
        n_in = sum(r["count"] for r in n if r.listed)
        n_out = sum(r["count"] for r in n if not r.listed)
        encode, check = universe.where("listed"), universe.where("NOT listed")
        rate = min(0.5, n_in * math.sqrt(0.5) / max(n_out, 1))
        while n_in:
            level = Level(n_in, rate, len(self.levels))
            level.build(spark, encode)
            self.levels.append(level)
            wrong = written(spark, check.where(level.holds(F.col("key"))), "cascade")
            encode, check, rate = wrong, encode, 0.5
            n_in = wrong.count()

    def listed(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(~self.levels[i].holds(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def with_listed(spark: SparkSession, rows: DataFrame, key: str, universe: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``rows`` with the boolean ``listed``: whether ``key`` is listed in
    ``universe(key, listed)``, which holds every key of ``rows`` once."""
    universe = written(spark, universe, "url-keys")
    n = universe.groupBy("listed").count().collect()
    n_in = sum(r["count"] for r in n if r.listed)
    n_all = sum(r["count"] for r in n)
    need = n_in / math.log(2) * max(1.0, math.log2(max(2.0, n_all / max(n_in, 1))) + 1)
    parts = max(1, math.ceil(need / max_bits))
    part = lambda c: F.pmod(F.xxhash64(F.lit("part"), c), F.lit(parts))
    out = []
    for p in range(parts):
        own = universe.where(part(F.col("key")) == p) if parts > 1 else universe
        mine = rows.where(part(F.col(key)) == p) if parts > 1 else rows
        out.append(mine.withColumn("listed", Cascade(spark, own).listed(F.col(key))))
    return reduce(DataFrame.unionByName, out)


def judge_pages(spark: SparkSession, pages: DataFrame, rules=RULES, names=LISTED_NAMES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every page. The keys are
    the corpus's hosts; a host is listed when one of its labels is in ``names``."""
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    universe = (seen.groupBy("host").count().select(F.col("host").alias("key"), F.arrays_overlap(
        F.split("host", r"\."), F.array(*map(F.lit, names))).alias("listed")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = with_listed(spark, seen, "host", universe)
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(spark, table(spark, sf_dir, "pages"))


OP1_SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), j AS (
  SELECT *, list_has_any(string_split(host, '.'),
                         ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS listed,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM j
"""
