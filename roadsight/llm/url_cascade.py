"""URL filter: prefix rules, then a Bloom filter cascade with exact membership and no join.

The key universe is every distinct host of the corpus, so it is complete.  Level 1 encodes the
listed keys; level 2 encodes the unlisted keys that pass level 1; level 3 the listed keys that pass
level 2; and so on until nothing passes wrongly.  The first level that refuses a key tells the
answer: odd levels refuse unlisted keys, even ones listed keys.  So membership is exact for every
key of the corpus, at about ten bits a listed key.

A level is an array of 64-bit words, found by one grouped bit-or and put into the probing plan as a
scalar subquery.  The first level has so many bits a listed key (more, the more unlisted keys there
are for each) that about as many unlisted keys pass it as keys are listed; so every level is about as
large as the list.  Keys are split by hash into groups such that no level of a group exceeds
``MAX_BYTES``: the number of groups is doubled until that holds.  Rows are written by group, and each
group's plan reads its own.

All of it is DataFrame expressions.  A null URL, or one without ``://``, has an empty host and path,
fits no rule and is allowed.  Repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadsight.llm.common import stage
from roadsight.session import scratch_dir

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Host labels of the sites the query lists (fixed values).
SPAM_LABELS = ["casino-win", "free-bets", "cheap-pills", "win-casino", "hot-singles", "payday-loans"]
BITS, HASHES = 10, 6
MAX_BYTES = 4 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    own = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.when(F.instr(url, "://") > 0, own).otherwise("")


def path(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def matched_rule(host_: Column, path_: Column, rules=tuple(RULES)) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (both null if none does)."""
    name = verdict = F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == rule_host) | host_.endswith("." + rule_host)) & path_.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, action).otherwise(verdict)
    return name, verdict


class Level:
    """One Bloom filter of a cascade: its words, in a table of one row, and its number of bits."""

    def __init__(self, keys: DataFrame, count: int, salt: int, others: int = 0):
        self.bits, self.hashes, self.salt = *level_size(count, others), salt
        at = F.explode(F.array(*[self._at(F.col("key"), i) for i in range(self.hashes)])).alias("at")
        words = keys.select(at).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set"))
        every = keys.sparkSession.range(self.bits // 64).join(words, F.col("id") == F.col("word"), "left")
        ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("set", F.lit(0).cast("long")).alias("set"))))
        self.table = stage(every.agg(F.transform(ordered, lambda w: w["set"]).alias("words")), "bloom")

    def _at(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.salt), F.lit(i)), F.lit(self.bits))

    def passes(self, key: Column) -> Column:
        words = self.table.scalar()
        return reduce(lambda a, b: a & b, [
            F.getbit(F.get(words, F.floor(self._at(key, i) / 64).cast("int")), (self._at(key, i) % 64).cast("int")) == 1
            for i in range(self.hashes)])


def level_size(count: int, others: int) -> tuple[int, int]:
    """Bits and hash functions of a level of ``count`` keys that at most about ``count`` of ``others`` should pass."""
    hashes = max(HASHES, math.ceil(math.log2(max(others, 1) / max(count, 1))) if others > count else 0)
    return max(64, -(-math.ceil(count * max(BITS, hashes / math.log(2))) // 64) * 64), hashes


class Cascade:
    """Exact membership of the keys of ``universe(key, listed)`` (distinct keys)."""

    def __init__(self, universe: DataFrame, max_bytes: int = MAX_BYTES):
        universe = stage(universe, "universe")
        listed = universe.where("listed").count()
        bits, _ = level_size(listed, universe.count() - listed)
        self.groups, self.levels = max(1, -(-bits // (4 * max_bytes))), None
        while self.levels is None:
            self.levels = self._all(universe, 8 * max_bytes)
            if self.levels is None:
                self.groups *= 2

    def _all(self, universe: DataFrame, max_bits: int) -> list[list[Level]] | None:
        """The levels of all groups, or none if one would be too large (a single key's level never is)."""
        out = []
        for g in range(self.groups):
            levels = self._build(universe.where(self._group(F.col("key")) == g), max_bits)
            if levels is None:
                return None
            out.append(levels)
        return out

    def _group(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(self.groups))

    def _build(self, universe: DataFrame, max_bits: int) -> list[Level] | None:
        levels: list[Level] = []
        rest, side = universe, True  # ``side``: what this level encodes, listed keys or not
        while count := rest.where(F.col("listed") == side).count():
            own, others = rest.where(F.col("listed") == side), rest.where(F.col("listed") != side)
            other = others.count()
            if level_size(count, other)[0] > max_bits and count > 1:
                return None
            level = Level(own, count, len(levels), other)
            levels.append(level)
            rest, side = stage(own.unionByName(others.where(level.passes(F.col("key")))), "cascade"), not side
        return levels

    def contains(self, key: Column, group: int = 0) -> Column:
        """Whether a key of the universe, of this hash group, is listed."""
        levels = self.levels[group]
        answer = F.lit(len(levels) % 2 == 1)
        for number in range(len(levels) - 1, -1, -1):
            answer = F.when(levels[number].passes(key), answer).otherwise(F.lit(number % 2 == 1))
        return answer

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """Add the boolean ``name``; one plan a hash group, no join."""
        if self.groups == 1:
            return rows.withColumn(name, self.contains(F.col(key)))
        path, spark = scratch_dir(rows.sparkSession, "groups"), rows.sparkSession
        dealt = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), self._group(F.col(key)).alias("group"))
        dealt.write.mode("overwrite").partitionBy("group").parquet(path)
        stored = spark.read.schema(dealt.schema).parquet(path)
        parts = [stored.where(F.col("group") == g).select("row.*").withColumn(name, self.contains(F.col(key), g))
                 for g in range(self.groups)]
        return reduce(DataFrame.unionByName, parts)


def judge(pages: DataFrame, is_listed, rules=tuple(RULES), max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every page.

    ``is_listed`` is a table of listed hosts (column ``host``), or tells for a host column whether it is
    on the list.  The list meets the distinct hosts once, when the cascade is built; pages never join it.
    """
    url = F.col("url")
    rows = pages.select("page_id", host(url).alias("host"), path(url).alias("path"))
    universe = rows.select(F.col("host").alias("key")).distinct()
    if isinstance(is_listed, DataFrame):
        listed = is_listed.select(F.translate("host", _UPPER, _LOWER).alias("key"), F.lit(True).alias("listed")).where("key IS NOT NULL").distinct()
        universe = universe.join(listed, "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        universe = universe.withColumn("listed", F.coalesce(is_listed(F.col("key")), F.lit(False)))
    marked = Cascade(universe, max_bytes).mark(rows, "host", "listed")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return marked.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def listed_hosts(pages: DataFrame) -> DataFrame:
    """The list that the query uses: hosts of the corpus with a listed label."""
    return pages.select(host(F.col("url")).alias("host")).where(spam_host(F.col("host"))).distinct()


def spam_host(host_: Column) -> Column:
    """Hosts with a listed label."""
    return F.arrays_overlap(F.split(host_, r"\."), F.array(*[F.lit(x) for x in SPAM_LABELS]))


JUDGE_SQL = f"""
WITH u AS (SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
m AS (SELECT *, list_has_any(string_split(host, '.'), {SPAM_LABELS!r}) AS listed,
        CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
             WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
             WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
             WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM m"""
