"""URL rules as a sort-merge range join over reversed hosts, in DataFrame expressions only.

With its labels reversed and each ended by a dot (``com.example.``), a host lies in the interval of
every rule whose host it equals or is a subdomain of; the intervals nest. URLs and the ends of
the intervals are sorted together and swept: the running state is the stack of the rules that are
open at the place. What remains at a URL is to compare its path with those few rules.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK, ALLOW = "block", "allow"
RULE = "struct<rule:string,path:string,verdict:string>"
# Order of what stands at one place of the sweep.
CLOSE, OPEN, PAGE = 0, 1, 2


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else ''."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substr(url, found + 3)).otherwise("")


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(_labels(host), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    rows = [
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _stacks(rules: DataFrame) -> DataFrame:
    """For each rule host its key, and the rules of it and of the hosts above it; and those above."""
    host, path = lower_ascii(F.col("host")), F.coalesce("path", F.lit(""))
    named = (
        rules.where(F.col("host") != "").select(host.alias("host"), path.alias("path"), "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
    )
    own = named.groupBy("host").agg(F.collect_list(F.struct("rule", "path", "verdict")).alias("own"))
    own = own.withColumn("lo", host_key(F.col("host")))
    labels = _labels(F.col("host"))
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")),
    )
    chain = own.select("lo", F.explode(above).alias("at"))
    held = chain.join(own.select(F.col("lo").alias("at"), "own"), "at")
    return held.groupBy("lo").agg(
        F.flatten(F.collect_list("own")).alias("stack"),
        F.flatten(F.collect_list(F.when(F.col("at") != F.col("lo"), F.col("own")))).alias("parents"),
    )


def _bucket(key: Column, bounds: Sequence[str], low: int = 0) -> Column:
    """How many of the sorted bounds are not above the key, by a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    half = len(bounds) // 2
    return F.when(key < F.lit(bounds[half]), _bucket(key, bounds[:half], low)).otherwise(
        _bucket(key, bounds[half + 1 :], low + half + 1)
    )


def _bounds(pages: DataFrame, buckets: int, sample_rows: int) -> tuple[list[str], list[int]]:
    """Range bounds from a sample of keys, and into how many parts to salt each range.

    A key that fills several quantiles starts a range of its own, salted as many times. The
    sample, of about ``sample_rows`` keys, steers the load only, never the result.
    """
    step = max(1, pages.count() // sample_rows)
    hashed = F.pmod(F.xxhash64("page_id", "key"), F.lit(step)) == 0
    sample = sorted(row[0] for row in pages.where(hashed).select("key").limit(4 * sample_rows).collect())
    cuts = [sample[len(sample) * k // buckets] for k in range(1, buckets)] if sample else []
    times = Counter(cuts)
    bounds = sorted(times)
    return bounds, [1, *[times[bound] for bound in bounds]]


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
    buckets: int = 64,
    sample_rows: int = 16_384,
) -> DataFrame:
    """Judge every URL by the longest rule that fits it. One row per row of ``pages``.

    Columns: page_id, host, path, rule (host and path, or null), verdict (the rule's, else
    ``default``). ``rules`` has host, path and verdict. A rule fits its host and all its
    subdomains if the URL's path starts with the rule's (null: any path). The longest is the
    one with the most characters in host and path, then the last by code point. Of the
    verdicts given to one rule the last by code point holds. Rules without a host are left
    out. A null URL, or one without ``://``, has empty host and path, and no rule. Repeated
    rows and null ids are judged each; an empty table gives no rows; a URL of any length is judged whole.
    Other columns are not looked at. Counts the pages when called.

    Pages are dealt out by ranges of reversed hosts, a frequent host over several salted
    parts. A rule goes into the ranges its interval touches, so only broad rules are
    repeated, at most once for each part.
    """
    url = F.col(url_column)
    pages = pages.select(F.col(id_column).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    pages = pages.withColumn("key", host_key(F.col("host")))
    bounds, salts = _bounds(pages, buckets, sample_rows)
    parts = F.array(*[F.lit(n) for n in salts])
    bucket = _bucket(F.col("key"), bounds)

    row_hash = F.xxhash64("page_id", "path", F.spark_partition_id())
    salt = F.pmod(row_hash, parts[F.col("bucket")]).cast("int")
    none = F.lit(None).cast(f"array<{RULE}>")
    places = pages.withColumn("bucket", bucket).select(
        "bucket", salt.alias("salt"), F.col("key").alias("place"), F.lit(PAGE).alias("kind"),
        F.lit("").alias("lo"), none.alias("stack"), "page_id", "host", "path",
    )

    stacks = _stacks(rules).withColumn(
        "hi", F.concat(F.substr(F.col("lo"), F.lit(1), F.length("lo") - 1), F.lit("/"))
    )
    first, last = _bucket(F.col("lo"), bounds), _bucket(F.col("hi"), bounds)
    spread = stacks.withColumn("first", first).withColumn("last", last).select(
        "*", F.explode(F.sequence("first", "last")).alias("bucket")
    )
    place = F.when(F.col("bucket") == F.col("first"), F.col("lo")).otherwise("")
    opens = spread.select("bucket", place.alias("place"), F.lit(OPEN).alias("kind"), "lo", "stack")
    closes = spread.where(F.col("bucket") == F.col("last")).select(
        "bucket", F.col("hi").alias("place"), F.lit(CLOSE).alias("kind"), "lo", F.col("parents").alias("stack")
    )
    every_salt = F.explode(F.sequence(F.lit(0), parts[F.col("bucket")] - 1)).alias("salt")
    ends = opens.unionByName(closes).select("*", every_salt)

    sweep = (
        Window.partitionBy("bucket", "salt").orderBy("place", "kind", "lo")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = places.unionByName(ends, allowMissingColumns=True).withColumn(
        "open", F.last("stack", ignorenulls=True).over(sweep)
    )
    fitting = F.filter("open", lambda r: F.startswith(F.col("path"), r["path"]))
    longest = F.array_max(
        F.transform(fitting, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))
    )
    judged = swept.where(F.col("kind") == PAGE).withColumn("best", longest)
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
