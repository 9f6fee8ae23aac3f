"""URL filter: a blocked Bloom filter of listed canonical URLs passes possible
hits to an exact hash join that removes the false positives.

A list entry is (host, path); it fits a URL whose host is the entry's host or
a subdomain of it and whose path starts with the entry's path. So a URL fits
exactly the entries among its keys ``host suffix + path prefix``, and prefix
lengths that no entry has need not be tried. The keys of the distinct
(host, path) pairs are probed against the filter, the survivors are joined
with the list on the whole key, and the longest entry wins (then the longer
host).

Everything is DataFrame functions. The filter has 512-bit blocks (eight
64-bit words, one bit in each per key, as in split-block Bloom filters).
Its table is broadcast while its size, known from the entry count, is at most
``broadcast_bytes``; beyond that the probe is a shuffle join on the block
number.

Defined results: a null URL, or one without ``://``, has empty host and path
and no rule; an empty list gives the default verdict everywhere; repeated
list entries count once (conflicting verdicts for one key: ``allow`` wins as
the smaller string); repeated page rows each get their row; other columns of
either table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lowered;
    path: from there up to ``? #`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _bloom(key: Column, n_blocks: int) -> tuple[Column, list]:
    block = F.pmod(F.xxhash64(key), F.lit(n_blocks))
    bits = F.xxhash64(key, F.lit(1))
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"),
                             F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int"))
             for i in range(WORDS)]
    return block, masks


def build_filter(entries: DataFrame, n_entries: int, bits_per_key: int = 16) -> tuple[DataFrame, int]:
    """One row (block, w0..w7) per non-empty block."""
    n_blocks = max(1, -(-n_entries * bits_per_key // (64 * WORDS)))
    block, masks = _bloom(F.col("entry_key"), n_blocks)
    words = [F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)]
    return (entries.select(block.alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(masks)])
            .groupBy("block").agg(*words)), n_blocks


def probe(keys: DataFrame, blocks: DataFrame, n_blocks: int, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``keys`` (column entry_key) that the filter may hold."""
    if n_blocks * (WORDS + 1) * 8 <= broadcast_bytes:
        blocks = F.broadcast(blocks)
    block, masks = _bloom(F.col("entry_key"), n_blocks)
    hit = None
    for i, m in enumerate(masks):
        one = F.col(f"w{i}").bitwiseAND(m) == m
        hit = one if hit is None else hit & one
    return keys.withColumn("block", block).join(blocks, "block").where(hit).select(*keys.columns)


def filter_urls(pages: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", bits_per_key: int = 16, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """(id, host, path, rule, verdict) of every page row.

    ``entries`` has host, path and verdict. The driver reads three bounded
    values from it: how many entries there are, the most labels of a host
    and the distinct path lengths (at most the longest path's length)."""
    entries = (entries.where("host is not null and path is not null")
               .select(ascii_lower(F.col("host")).alias("entry_host"), F.col("path").alias("entry_path"), "verdict")
               .withColumn("entry_key", F.concat("entry_host", "entry_path"))
               .groupBy("entry_key", "entry_host").agg(F.min("verdict").alias("verdict")))
    stats = entries.agg(F.count("*").alias("n"),
                        F.max(F.size(F.split("entry_host", r"\."))).alias("labels"),
                        F.collect_set(F.length("entry_key") - F.length("entry_host")).alias("lengths")).first()
    host, path = url_host_path(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not stats["n"]:
        return rows.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    labels, lengths = int(stats["labels"]), sorted(int(x) for x in stats["lengths"])

    urls = rows.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
                           lambda i: F.array_join(F.slice(parts, -i, i), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length("path")),
                           lambda x: F.substring(F.col("path"), F.lit(1), x))
    keys = (urls.where("host <> ''").withColumn("key_host", F.explode(suffixes))
            .withColumn("key_path", F.explode(prefixes))
            .select("host", "path", "key_host", F.concat("key_host", "key_path").alias("entry_key")))
    blocks, n_blocks = build_filter(entries, stats["n"], bits_per_key)
    hits = probe(keys, blocks, n_blocks, broadcast_bytes)
    # the host as well: "a.b" + "c/" and "a.bc" + "/" spell the same key
    exact = hits.join(entries.withColumnRenamed("entry_host", "key_host"), ["entry_key", "key_host"])
    best = (exact.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("entry_key").alias("n"), F.length("key_host").alias("h"),
                                "entry_key", "verdict")).alias("b"))
            .select("host", "path", F.col("b.entry_key").alias("rule"), F.col("b.verdict").alias("verdict")))
    return (rows.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
