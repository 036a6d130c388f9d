"""URL filters: rules looked up in a cascade of Bloom filters, exact on the corpus's own keys.

A rule such as ``example.com/en/`` fits a host, its subdomains, and paths that start
with its path.  Rules come in few shapes (number of host labels, length of path), so a
url has one key for each shape that may be a rule.  All these keys of all urls are the
universe.  Level 1 of a cascade holds the listed keys; level 2 the keys of the universe
that level 1 takes for listed; level 3 the listed keys that level 2 takes for those, and
so on until nobody is mistaken.  The first level that lacks a key settles it: an odd one
says not listed, an even one says listed.  One cascade tells rules from other keys, a
second tells blocking rules from allowing ones.  No url is joined to anything.

A level is an array of 64-bit words that every task has as a literal.  Level 1 has
``bits`` bits for each rule and level 2 some for each mistaken key, and the share of keys
mistaken is set to rules / universe: the literal grows with the rules and the logarithm
of the universe.  Beyond ``MOST_RULES`` rules the lookup is a join instead.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm.common import ascii_lower, let, read, stored

#: More rules than this don't go into a literal (about 4 MB with a universe of 10^12 keys).
MOST_RULES = 500_000


class Level(NamedTuple):
    words: list[int]  # signed 64-bit
    hashes: int


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _strings(spark: SparkSession, values: list[str]) -> DataFrame:
    """A row (key) for each value, made by the JVM from one literal."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), "array<string>")).alias("key"))


def _shape(rule: str) -> tuple[int, int]:
    host, _, path = rule.partition("/")
    return host.count(".") + 1, len(path) + 1


def keys(host: Column, path: Column, rules: list[str]) -> Column:
    """The keys of a url that may be rules, the longest first; a missing one is null."""
    out = []
    for labels, n in sorted({_shape(r) for r in rules}):
        fits = (F.size(F.split(host, r"\.")) >= labels) & (F.length(path) >= n) & (host != "")
        out.append(F.when(fits, F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, n))))
    by_length = lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0)
    return F.array_sort(F.filter(F.array(*out), lambda k: k.isNotNull()), by_length)


def _bit(key: Column, level: int, i: int, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level * 64 + i), key), F.lit(n_bits))


def build_level(keys_: DataFrame, level: int, n_keys: int, bits: float) -> Level:
    """A Bloom filter of ``keys_`` (key) with ``bits`` bits a key."""
    n_words = max(1, math.ceil(n_keys * bits / 64))
    hashes = max(1, min(30, round(bits * math.log(2))))
    at = keys_.select(F.explode(F.array(*(_bit(F.col("key"), level, i, 64 * n_words) for i in range(hashes)))).alias("bit"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
    words = at.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.bit_or(mask).alias("set")).collect()  # as many rows as the literal has words
    out = [0] * n_words
    for word, bits_set in words:
        out[word] = bits_set
    return Level(out, hashes)


def might_hold(key: Column, level: int, filter_: Level) -> Column:
    n = 64 * len(filter_.words)
    words = F.lit(np.array(filter_.words, dtype=np.int64))

    def one(i: int) -> Column:
        return let(_bit(key, level, i, n), lambda b: F.getbit(F.element_at(words, (F.floor(b / 64) + 1).cast("int")), F.pmod(b, F.lit(64)).cast("int")) == 1)

    test = one(0)
    for i in range(1, filter_.hashes):
        test = test & one(i)
    return test


def build_cascade(listed: list[str], universe: DataFrame, n_universe: int, bits: float | None = None) -> list[Level]:
    """Levels that tell ``listed`` from all other keys of ``universe`` (key), without error.

    ``universe`` is read once; it may repeat keys.  What level 1 mistakes is kept in the
    shared folder, and later levels read only that.
    """
    spark = universe.sparkSession
    bits = bits or max(4.0, 1.44 * math.log2(max(2.0, n_universe / max(1, len(listed)))) + 2)
    yes = _strings(spark, listed)
    levels = [build_level(yes, 1, len(listed), bits)]
    not_listed = universe.filter(might_hold(F.col("key"), 1, levels[0])).join(yes, "key", "left_anti")
    no = stored(not_listed.distinct(), "mistaken", compact=True)
    n = no.count()
    while n:
        level = len(levels) + 1
        wrong, other = (no, yes) if level % 2 == 0 else (yes, no)
        levels.append(build_level(wrong, level, n, 8.0))
        still = stored(other.filter(might_hold(F.col("key"), level, levels[-1])), f"level{level}", compact=True)
        if level % 2 == 0:
            yes = still
        else:
            no = still
        n = still.count()
    return levels


def in_cascade(key: Column, levels: list[Level]) -> Column:
    """Whether ``key``, one of the universe, is listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in range(len(levels), 0, -1):
        answer = F.when(~might_hold(key, level, levels[level - 1]), F.lit(level % 2 == 0)).otherwise(answer)
    return answer


def filter_urls(pages: DataFrame, rules: dict[str, str], default: str = "allow") -> DataFrame:
    """``pages`` (url, ...) with host, path, rule and verdict.

    ``rules`` maps a rule to ``allow`` or ``block``; the longest that fits wins, between
    equally long ones the first in code point order.  A url that no rule fits, a null url
    and one without ``://`` get a null rule and ``default``.  Repeated rows each stay.
    Columns of ``pages`` named like the new ones give way to them.
    """
    spark: SparkSession = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    d = pages.withColumn("__host", host).withColumn("__path", path)
    if not rules:
        return _named(d.withColumn("__rule", F.lit(None).cast("string")).withColumn("__verdict", F.lit(default)))
    d = d.withColumn("__keys", keys(F.col("__host"), F.col("__path"), list(rules)))
    if len(rules) > MOST_RULES:
        return _joined(spark, d, rules, default)
    universe = d.select(F.explode("__keys").alias("key"))
    n = universe.agg(F.approx_count_distinct("key")).first()[0]
    is_rule = build_cascade(list(rules), universe, n)
    blocking = [r for r, v in rules.items() if v == "block"]
    all_rules = _strings(spark, list(rules))
    blocks = build_cascade(blocking, all_rules, len(rules)) if blocking else []
    rule = F.try_element_at(F.filter("__keys", lambda k: in_cascade(k, is_rule)), F.lit(1))
    d = d.withColumn("__rule", rule)
    verdict = F.when(F.col("__rule").isNull(), default).when(in_cascade(F.col("__rule"), blocks), "block").otherwise("allow")
    return _named(d.withColumn("__verdict", verdict))


def _named(d: DataFrame) -> DataFrame:
    new = {f"__{c}": c for c in ("host", "path", "rule", "verdict")}
    return d.drop("__keys", *new.values()).withColumnsRenamed(new)


def _joined(spark: SparkSession, d: DataFrame, rules: dict[str, str], default: str) -> DataFrame:
    """The same by one equi-join for each key of a url, for lists too long for a literal."""
    blocking = _strings(spark, [r for r, v in rules.items() if v == "block"]).withColumn("__action", F.lit("block"))
    allowing = _strings(spark, [r for r, v in rules.items() if v != "block"]).withColumn("__action", F.lit("allow"))
    listed = blocking.unionByName(allowing)
    d = d.withColumn("__row", F.monotonically_increasing_id())
    d = stored(d, "keyed")
    hits = d.select("__row", F.explode("__keys").alias("key")).join(listed, "key")
    best = hits.groupBy("__row").agg(F.min(F.struct(-F.length("key"), "key", "__action")).alias("b")).select("__row", F.col("b.key").alias("__rule"), F.col("b.__action").alias("__verdict"))
    return _named(d.join(best, "__row", "left").drop("__row").withColumn("__verdict", F.coalesce("__verdict", F.lit(default))))


#: The contract's rules.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by ``RULES``; a url that no rule fits is allowed."""
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, host, path, action) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
m AS (SELECT h.page_id, r.rule, r.action, row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule) DESC, r.rule) AS n
      FROM h JOIN rules r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.action, 'allow') AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id AND m.n = 1
"""
