"""URL filters by host and path rules and a Bloom filter cascade, with built-in expressions only.

A cascade answers "is this key listed?" exactly for every key of a known universe. Level 1 is a
Bloom filter of the listed keys. Level 2 holds those keys of the universe that pass level 1 without
being listed, level 3 the listed keys that pass level 2, and so on until nothing passes wrongly. A
key is listed if the first level that rejects it is an even one (or none does and the last level is
odd). The levels travel as literals inside the expression, so pages meet no join and no shuffle.

The levels take about 1.44 log2(universe / listed) bits per listed key in the first and a few bits
in the others: they grow with the list, and only with the logarithm of the corpus. ``max_bytes``
checks that size. Beyond it the keys are dealt by hash over as many shards as it takes, each with a
cascade of its own that is as exact over its share of the universe; pages are written by shard once,
and every shard's pages are answered by that shard's levels alone, still without a join.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged
from stayrate.session import run_folder

WORD = 64
#: Levels after the first take about as many bits again as the first.
ALL_LEVELS = 2.5


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _passes(key: Column, number: int, level: Level) -> Column:
    """Whether all bits of the key are set in a level held as a literal array of words."""
    words = F.from_json(F.lit(json.dumps(level.words)), "array<bigint>")
    tests = [
        F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
        for at in _positions(key, number, level.bits, level.hashes)
    ]
    return reduce(and_, tests)


def _filled(keys: DataFrame, number: int, bits: int, hashes: int) -> Level:
    """The level's bits, combined per task before they meet: at most ``bits`` / 64 rows."""
    at = F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at")
    rows = keys.select(at).select(
        F.shiftright("at", 6).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(at % {WORD} as int))").alias("bit"),
    )
    words = [0] * math.ceil(bits / WORD)
    for word, value in rows.groupBy("word").agg(F.bit_or("bit")).collect():
        words[word] = value
    return Level(bits, hashes, tuple(words))


def _shape(inside: int, outside: int) -> tuple[int, int]:
    """Bits and hashes that let about as many wrong keys pass as there are right ones."""
    rate = min(0.5, max(1e-9, inside / max(1, outside) / math.sqrt(2)))
    bits = math.ceil(inside * math.log2(1 / rate) / math.log(2))
    return max(WORD, WORD * math.ceil(bits / WORD)), max(1, round(math.log2(1 / rate)))


def known_keys(universe: DataFrame) -> DataFrame:
    """Every key of (key, listed) once; a key listed once is listed, null keys are left out."""
    keys = universe.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
    return staged(keys, "universe")


def _sizes(keys: DataFrame) -> tuple[int, int]:
    """Numbers of listed and of other keys."""
    sizes = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    return sizes.get(True, 0), sizes.get(False, 0)


def cascade(universe: DataFrame, max_bytes: int = 8 << 20) -> list[Level] | None:
    """The levels for a universe of (key, listed); None if they would be larger than allowed.

    Keys may repeat; a key listed once is listed. Null keys are left out.
    """
    return _levels(known_keys(universe), max_bytes)


def _levels(keys: DataFrame, max_bytes: int) -> list[Level] | None:
    inside, outside = keys.where("listed"), keys.where("NOT listed")
    n_in, n_out = _sizes(keys)
    levels: list[Level] = []
    size = 0
    while n_in:
        bits, hashes = _shape(n_in, n_out)
        size += bits // 8
        if size > max_bytes:
            return None
        level = _filled(inside, len(levels), bits, hashes)
        wrong = staged(outside.where(_passes(F.col("key"), len(levels), level)), "wrong")
        levels.append(level)
        inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
    return levels


def listed(key: Column, levels: Sequence[Level]) -> Column:
    """Whether a key of the universe is listed, level by level."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in range(len(levels) - 1, -1, -1):
        answer = F.when(~_passes(key, number, levels[number]), F.lit(number % 2 == 1)).otherwise(
            answer
        )
    return answer


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def _by_shard(rows: DataFrame, key: str, shards: int, purpose: str) -> str:
    """Write ``rows`` in one folder per shard of ``key``. Rows of a shard, even those of one key,
    are ranges of row hashes, so a shard that holds most rows is many tasks and files."""
    path = run_folder(rows.sparkSession, purpose)
    rows = rows.withColumn("_shard", _shard(F.col(key), shards)).withColumn("_salt", F.xxhash64(*rows.columns))
    rows = rows.repartitionByRange("_shard", "_salt").drop("_salt")
    rows.write.partitionBy("_shard").parquet(path)
    return path


def _answered(rows: DataFrame, key: str, keys: DataFrame, shards: int, max_bytes: int) -> DataFrame | None:
    """``_listed`` for rows by one cascade per shard of keys; None if one of these is too large.

    The driver holds the levels of one shard at a time.
    """
    spark = rows.sparkSession
    keys_path = _by_shard(keys, "key", shards, "keys")
    rows_path = _by_shard(rows, key, shards, "rows")
    all_keys = spark.read.schema(f"{_ddl(keys)}, _shard int").parquet(keys_path)
    all_rows = spark.read.schema(f"{_ddl(rows)}, _shard int").parquet(rows_path)
    out = run_folder(spark, "answers")
    for shard in range(shards):
        levels = _levels(all_keys.where(F.col("_shard") == shard).drop("_shard"), max_bytes)
        if levels is None:
            return None
        part = all_rows.where(F.col("_shard") == shard).drop("_shard")
        part.withColumn("_listed", listed(F.col(key), levels)).write.mode("append").parquet(out)
    return spark.read.schema(f"{_ddl(rows)}, _listed boolean").parquet(out)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def with_listed(rows: DataFrame, key: str, universe: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """``rows`` with ``_listed``: whether ``key``, which must be in the universe, is listed.

    No level set is larger than ``max_bytes``: beyond it there is one for each shard of keys.
    """
    keys = known_keys(universe)
    n_in, n_out = _sizes(keys)
    shards = max(1, math.ceil(ALL_LEVELS * _shape(n_in, n_out)[0] / 8 / max_bytes)) if n_in else 1
    if shards == 1:
        levels = _levels(keys, max_bytes)
        if levels is not None:
            return rows.withColumn("_listed", listed(F.col(key), levels))
    while shards <= n_in:
        shards *= 2
        found = _answered(rows, key, keys, shards, max_bytes)
        if found is not None:
            return found
    raise ValueError(f"max_bytes={max_bytes} is too small for a single key")


# -- urls and rules ---------------------------------------------------------------------------
def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tail(host: str, labels: int) -> Column:
    """The last labels of a host, or null if it has fewer."""
    count = F.length(host) - F.length(F.replace(F.col(host), F.lit("."))) + 1
    return F.when(count >= labels, F.substring_index(host, ".", -labels))


def candidates(rules: Sequence[tuple[str, str, str]], host: str, path: str) -> Column:
    """The keys under which a url can be listed: one for each shape (labels, path length) of rule,
    the longest first, of two as long the one with more labels."""
    shapes = {(h.count(".") + 1, len(p)) for h, p, _ in rules}
    keys = []
    for labels, size in sorted(shapes):
        tail, start = _tail(host, labels), F.substring(path, 1, size)
        fits = tail.isNotNull() & (F.length(start) == size)
        keys.append(F.when(fits, F.concat(tail, start)))
    kept = F.filter(F.array(*keys), lambda k: k.isNotNull())
    return F.array_sort(
        F.array_distinct(kept), lambda a, b: F.coalesce(F.length(b) - F.length(a), F.lit(0))
    )


@dataclass(frozen=True)
class UrlFilter:
    """Rules, ready to be applied to any part of the corpus they were built for."""

    rules: tuple[tuple[str, str, str], ...]
    rule_keys: tuple[Level, ...]
    block_keys: tuple[Level, ...]

    def rule(self, host: str, path: str) -> Column:
        """The longest fitting rule, as ``host`` + ``path``; else null."""
        keys = candidates(self.rules, host, path)
        return F.get(F.filter(keys, lambda k: listed(k, self.rule_keys)), F.lit(0))

    def verdict(self, rule: str, host_listed: Column) -> Column:
        """The rule's verdict, without a rule that of the host list."""
        by_rule = F.when(F.col(rule).isNotNull(), listed(F.col(rule), self.block_keys))
        return F.when(F.coalesce(by_rule, host_listed), F.lit("block")).otherwise("allow")


def split_urls(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(id, host, path) of every page; null urls and urls without ``://`` have neither."""
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select(
        "id", host_of("url").alias("host"), path_of("url").alias("path")
    )


def build_filter(
    urls: DataFrame, rules: Sequence[tuple[str, str, str]], max_bytes: int = 8 << 20
) -> UrlFilter:
    """``urls`` has host and path of the whole corpus."""
    spark = urls.sparkSession
    rows = [
        F.struct(F.lit(h + p).alias("key"), F.lit(verdict == "block").alias("block"))
        for h, p, verdict in rules
    ]
    known = spark.range(1).select(F.inline(F.array(*rows)))
    keys = urls.select(F.explode(candidates(rules, "host", "path")).alias("key")).distinct()
    keys = staged(keys, "candidates")
    no = F.lit(False).alias("listed")
    rule_keys = cascade(keys.select("key", no).union(known.select("key", F.lit(True))), max_bytes)
    block_keys = cascade(known.select("key", F.col("block").alias("listed")), max_bytes)
    if rule_keys is None or block_keys is None:
        raise ValueError("rules come from the driver and must fit into max_bytes")
    return UrlFilter(tuple(rules), tuple(rule_keys), tuple(block_keys))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    hosts: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    max_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    The longest fitting rule decides, of two as long the one whose host has more labels; a url
    without a rule is blocked if its host is listed in ``hosts``. Null urls and urls without
    ``://`` have an empty host and path. Pages that repeat are returned as often as they occur;
    other columns are ignored; an empty table gives no rows.
    """
    urls = split_urls(pages, id_col, url_col)
    built = build_filter(urls, rules, max_bytes)
    of_corpus = urls.select(F.col("host").alias("key"), F.lit(False).alias("listed"))
    universe = of_corpus.union(hosts.select("host", F.lit(True)))
    found = with_listed(urls, "host", universe, max_bytes).withColumn("rule", built.rule("host", "path"))
    verdict = built.verdict("rule", F.col("_listed")).alias("verdict")
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", verdict)
