"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join.

A listed entry is a host and the beginning of a path (``example.com/en/``).  A URL
may be hit under each of its host's suffixes and each beginning of its path that
is as long as some listed one.  The filter has blocks of eight 64-bit words; a key
picks one block and one bit in each word, so a probe touches a single cache line.
It is built by ``bit_or`` over the hashed list in Spark and shipped; its size is
fixed by ``filter_bytes`` whatever the list holds.  Keys that pass are joined with
the whole list by hash, so false positives end there.

Defined cases: a null url, or one without ``://``, has empty host and path and
fits no rule; a url that fits no rule is allowed, since this is a filter of
listed URLs.  Of rules that fit, the longest text wins, then the longer host, and
of rules listed twice with both verdicts the block.  Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
#: At most 32 MiB are shipped; a longer list only lets more false hits through.
MAX_FILTER_BYTES = 32 << 20
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(rule_host, rule_path, verdict)`` from a short list; long lists come as a table."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")


def _key(host_part: Column, path_part: Column) -> Column:
    # a host holds no slash, so a rule's text is unambiguous with a separator
    return F.concat(host_part, F.lit("\n"), path_part)


def listed(rules: DataFrame) -> DataFrame:
    """One row per canonical entry: its key, text, lengths of host and path, verdict."""
    name, start = F.translate(F.col("rule_host"), UPPER, LOWER), F.col("rule_path")
    return (
        rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL")
        .select(
            _key(name, start).alias("key"), F.concat(name, start).alias("rule"),
            F.char_length(name).alias("n_host"), F.char_length(start).alias("n_path"), F.col("verdict").alias("says"),
        )
        .groupBy("key", "rule", "n_host", "n_path").agg(F.max("says").alias("says"))
    )


def slots(hashed: Column, blocks: int) -> list[Column]:
    """The block of a hash, then one bit of each word."""
    bits = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.pmod(F.xxhash64(hashed), F.lit(blocks)), *bits]


def bloom_filter(keys: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> np.ndarray:
    """(blocks, 8) words; only blocks with a key come to the driver, ``max_bytes`` at most."""
    wanted = max(1, keys.count() * BITS_PER_KEY // (64 * WORDS))
    blocks = min(1 << (wanted - 1).bit_length(), max_bytes // (8 * WORDS))
    placed = keys.select(F.xxhash64("key").alias("h")).select(*slots(F.col("h"), blocks))
    placed = placed.toDF("block", *[f"b{i}" for i in range(WORDS)])
    one = F.lit(1).cast("bigint")
    filled = placed.groupBy("block").agg(*[
        F.bit_or(F.call_function("shiftleft", one, F.col(f"b{i}"))).alias(f"w{i}") for i in range(WORDS)
    ])
    table = np.zeros((blocks, WORDS), np.int64)
    rows = filled.toArrow()
    if rows.num_rows:
        table[rows.column("block").to_numpy()] = np.stack([rows.column(f"w{i}").to_numpy() for i in range(WORDS)], axis=1)
    return table


def might_contain(table) -> object:
    """Arrow function of (block, bit 0 .. bit 7) -> boolean over a broadcast filter."""

    def probe(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        words = table.value
        for block, *bits in columns:
            row = words[block.to_numpy(zero_copy_only=False)]
            bit = np.stack([b.to_numpy(zero_copy_only=False) for b in bits], axis=1).astype(np.int64)
            yield pa.array(((row >> bit) & 1).all(axis=1))

    probe.__annotations__ = {"columns": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(probe, "boolean")


def judge(pages: DataFrame, rules: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``."""
    spark = pages.sparkSession
    entries = listed(rules)
    table = bloom_filter(entries, max_bytes)
    # as many as there are lengths of listed paths, not as there are entries
    lengths = F.array(*[F.lit(r.n_path) for r in entries.select("n_path").distinct().collect()]).cast("array<int>")
    urls = pages.select("url").distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    starts = F.transform(
        F.filter(lengths, lambda n: n <= F.char_length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n)
    )
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: _key(s, p))))
    tried = urls.where("host != ''").select("url", F.explode(keys).alias("key")).withColumn("h", F.xxhash64("key"))
    hits = tried.where(might_contain(spark.sparkContext.broadcast(table))(*slots(F.col("h"), len(table))))
    longest = F.struct((F.col("n_host") + F.col("n_path")).alias("n"), "n_host", "rule", "says")
    verdicts = (
        hits.join(entries, "key").groupBy("url").agg(F.max(longest).alias("best"))
        .select(F.col("url").alias("u"), "best.rule", "best.says")
    )
    return pages.select("page_id", "url").join(verdicts, F.col("url") == F.col("u"), "left").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule",
        F.coalesce("says", F.lit("allow")).alias("verdict"),
    )
