"""URL filters as a sort-merge range join on reversed-host keys.

A rule (host, path) becomes the key ``com.example//en/`` (labels reversed,
``/`` after the host, then the path). All urls it fits have keys that start
with it, so a rule is an interval of the sorted keys, and two intervals nest
or are apart. A url stands at one key for each of its parent domains, as deep
as the deepest rule's host.

Keys of urls, each at most ``salts`` times, and starts of rules are dealt over
key ranges and swept in order; what fits a key goes back to its urls by (key,
salt), so home pages of one top-level domain, which share a key, neither meet in
one range nor in one join task. Each start carries the stack of the rules that are open there (itself and the
rules around it); a url takes the last stack before it and pops the rules
whose interval has ended. Range bounds are starts as well, which carry the
rules open at the bound, so every range is swept alone.

Edge cases: null urls and urls without ``://`` have host and path ``''`` and
get the default verdict; equal rules with different verdicts count as
``block``; of two fitting rules of one length that with the longer host wins;
repeated rows are judged like any other and stay; further columns are kept,
columns named like an output are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import search, shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
OUTPUT = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_keys(rules: DataFrame) -> DataFrame:
    """key, rule, verdict, length, labels: one row for each distinct rule."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    return (rules.select(F.concat(F.array_join(_labels(host), "."), F.lit("/"), path).alias("key"),
                         F.concat(host, path).alias("rule"), "verdict",
                         F.size(_labels(host)).alias("labels"), F.length(host).alias("host_length"))
            .groupBy("key", "rule", "labels", "host_length").agg(F.max("verdict").alias("verdict")))


def _stacks(points: DataFrame, rules: DataFrame) -> DataFrame:
    """key, stack: the rules open at each key, from the outermost to the
    innermost. A stack is no longer than its key."""
    prefixes = points.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("key"), F.lit(1))),
        lambda n: F.substring("key", F.lit(1), n))).alias("prefix")).distinct()
    outer = rules.select(F.col("key").alias("prefix"), F.struct(
        F.length("rule").alias("length"), "host_length", F.col("key").alias("start"), "rule", "verdict").alias("open"))
    return (prefixes.join(outer, "prefix", "left").groupBy("key")
            .agg(F.sort_array(F.collect_list("open")).alias("stack")))


def _url_keys(pages: DataFrame, depth: int, salts: int) -> DataFrame:
    """__url, __salt, key, __deal: the keys of each url, down to ``depth``
    labels. __deal, below ``salts``, parts the urls of one key."""
    labels = _labels(host_of(F.col("__url")))
    return (pages.select("__url", "__salt").distinct()
            .select("__url", "__salt", path_of(F.col("__url")).alias("path"), labels.alias("labels"))
            .select("__url", "__salt", F.explode(F.transform(
                F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(depth))),
                lambda n: F.concat(F.array_join(F.slice("labels", F.lit(1), n), "."), F.lit("/"), F.col("path"))))
                .alias("key"))
            .withColumn("__deal", F.pmod(F.xxhash64("__url", "__salt"), F.lit(salts))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url", ranges: int | None = None, sample_rows: int = 4096, salts: int = 64) -> DataFrame:
    """``pages`` with host, path, rule (null where none fits) and verdict.

    rules: host, path, verdict. ranges: key ranges of the sweep (default: four
    for each shuffle partition); their bounds come from a sample of
    ``sample_rows`` keys, which moves work only, never results. Copies of one
    url are judged as ``salts`` rows at most and joined back by (url, salt), and
    urls with one key are swept as ``salts`` rows at most.
    """
    spark = pages.sparkSession
    keep = [c for c in pages.columns if c not in OUTPUT]
    salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    pages = pages.select(*keep, url.alias("__url"), salt.alias("__salt"))
    rules = _rule_keys(rules)
    depth = rules.agg(F.max("labels")).first()[0]
    if depth is None:
        return pages.select(*keep, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"),
                            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    keys = _url_keys(pages, depth, salts)
    dealt = keys.select("key", "__deal").distinct()
    ranges = min(ranges or 4 * shuffle_partitions(spark), sample_rows)
    sample = sorted(r[0] for r in dealt.select("key", F.xxhash64("key", "__deal").alias("h"))
                    .orderBy("h", "key").limit(sample_rows).select("key").collect())
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []

    points = rules.select("key")
    if bounds:
        points = points.union(spark.createDataFrame([(b,) for b in bounds], "key string"))
    starts = _stacks(points, rules)
    events = (dealt.select("key", F.lit(1).alias("kind"), "__deal")
              .unionByName(starts.select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True)
              .withColumn("range", search(bounds, F.col("key"))))
    order = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    fits = (events.withColumn("stack", F.last("stack", ignorenulls=True).over(order))
            .where("kind = 1")
            .withColumn("fits", F.filter("stack", lambda r: F.startswith(F.col("key"), r["start"])))
            .select("key", "__deal", F.get("fits", F.size("fits") - 1).alias("fit")).where("fit IS NOT NULL"))
    best = keys.join(fits, ["key", "__deal"]).groupBy("__url", "__salt").agg(F.max("fit").alias("fit"))
    return (pages.join(best, ["__url", "__salt"], "left")
            .select(*keep, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"),
                    F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict")))


#: The rules of the registered query: fixed values.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def query(spark, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC NULLS LAST) AS nth
  FROM parts LEFT JOIN rules ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE nth = 1
"""
