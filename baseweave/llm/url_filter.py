"""URL rules by hash-prefix lookup, in DataFrame operations only.

Each distinct URL is expanded into the host suffixes and path prefixes at which
a rule can stand. Expressions meet rules by an equi-join on a short prefix of
their SHA-256; the full digest then confirms the match, and the longest rule
decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: Hex digits of a digest in the join key: 32 bits.
PREFIX = 8
#: A URL is hot from this share of all rows on, so there are at most as many of them; rows of each are dealt over so many salts.
HOT, SALTS = 1000, 64


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path) as a table for ``judge_urls``."""
    each = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*each)))


def _hot(urls: DataFrame) -> Column:
    """Whether ``url`` is one of the commonest, by its hash: at most HOT hashes come to the driver, however many rows there are."""
    counted = urls.groupBy(F.xxhash64("url").alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    rows = urls.count()
    return F.xxhash64("url").isin([r["hash"] for r in counted.filter(F.col("n") * HOT >= rows).collect()])


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` has the columns verdict, host and path. A rule fits its host and
    all subdomains where the URL's path starts with the rule's path. The longest
    rule wins; of equal rules, ``block`` wins over ``allow``. Without a rule
    the verdict is ``default``. A null URL and one without ``://`` have empty
    host and path and so get the default, as rules have a host. Repeated rows
    give repeated results, columns other than id and URL are not read, and an
    empty table gives no rows.

    Expansions are bounded by the label counts and path lengths found among the
    rules, read from the rule table as two small sets. The join carries no
    broadcast hint: Spark broadcasts the rules only when their size allows. Rows
    of a URL that a thousandth of all rows have meet its verdict by salt.
    """
    shape = rules.select(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()
    rule = rules.select("verdict", F.concat("host", "path").alias("rule")).withColumn("digest", F.sha2("rule", 256))
    rule = rule.select("verdict", "rule", "digest", F.substring("digest", 1, PREFIX).alias("prefix"))
    seen = pages.select(F.col(url_col).alias("url")).filter("url is not null").distinct()
    seen = seen.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels, lengths = sorted(shape["labels"]) or [0], sorted(shape["lengths"]) or [0]
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in labels]))
    prefixes = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in lengths]))
    asked = (
        seen.select("url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("url", "suffix", F.explode("prefixes").alias("start"))
        .select("url", F.concat("suffix", "start").alias("expression"))
        .withColumn("asked", F.sha2("expression", 256))
        .select("url", "asked", F.substring("asked", 1, PREFIX).alias("prefix"))
    )
    hit = asked.join(rule, "prefix").filter(F.col("asked") == F.col("digest"))
    rank = F.struct(F.length("rule").alias("size"), (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
    verdicts = hit.groupBy("url").agg(F.max(rank).alias("best"))
    left = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    # Rows without a URL meet no rule; they stay out of the join, where they would all have one key.
    none = left.filter("url is null").withColumn("best", F.lit(None).cast(verdicts.schema["best"].dataType))
    left = left.filter("url is not null")
    hot = _hot(left)
    dealt = F.when(hot, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(0).cast("int")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    judged = left.withColumn("salt", dealt).join(verdicts.withColumn("salt", F.explode(every)), ["url", "salt"], "left").drop("salt")
    return judged.unionByName(none).select(
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
    )
