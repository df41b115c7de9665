"""URL filter: host-suffix and path-prefix expressions against rule digests.

Each distinct (host, path) is expanded into the expressions a rule could have:
host suffixes at label boundaries times path prefixes. Expressions meet the
rules by an equi-join on a short prefix of their SHA-256; the full digest then
confirms, and the longest rule wins.

Suffixes are only made up to the largest label count of any rule, prefixes only
at the lengths of rule paths (both read from the rules in one row), so no
matching rule is missed however long a URL is.

Defined results: a null URL or one without ``://`` has empty host and path and
gets the default verdict; rules with an empty host are ignored. Repeated rows are each returned. An empty rule table
gives the default everywhere. Only the id and URL columns are read, so other
columns may have any name. Among equally long rules that fit, the longer host
wins, then block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import UPPER_LETTERS

PREFIX_HEX = 8


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER_LETTERS, UPPER_LETTERS.lower())


def path_of(url: Column) -> Column:
    rest = _rest(url)
    after = F.regexp_replace(rest, "^[^/?#]*", "")
    return F.regexp_extract(after, "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """rules (host, path, action) with host in lower case, plus rule, digest."""
    host = F.translate(F.col("host"), UPPER_LETTERS, UPPER_LETTERS.lower())
    rule = F.concat("_h", "_p")
    return (
        rules.select(host.alias("_h"), F.coalesce("path", F.lit("")).alias("_p"), F.col("action").alias("_a"))
        .where("_h <> ''")
        .distinct()
        .select("_h", "_p", "_a", rule.alias("_rule"), F.sha2(rule, 256).alias("_rdigest"))
        .withColumn("_short", F.substring("_rdigest", 1, PREFIX_HEX))
    )


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null if none), verdict."""
    rows = pages.select(
        F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    ).fillna("", ["host", "path"])
    ready = prepare_rules(rules)
    # one row: the distinct path lengths (at most the longest path) and the most labels
    shape = ready.agg(F.collect_set(F.length("_p")), F.max(F.size(F.split("_h", r"\.")))).first()
    if not shape[0]:
        return rows.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths, most = sorted(shape[0]), shape[1]
    keys = rows.select("host", "path").distinct().where("host <> ''")
    labels = F.split("host", r"\.")
    keys = keys.withColumn("_labels", F.slice(labels, F.greatest(F.size(labels) - most + 1, F.lit(1)), most))
    suffix = F.transform(
        F.sequence(F.lit(1), F.size("_labels")), lambda i: F.array_join(F.slice("_labels", i, F.size("_labels")), ".")
    )
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    prefix = F.transform(fits, lambda n: F.col("path").substr(F.lit(1), n))
    made = keys.select("host", "path", F.explode(suffix).alias("_s"), prefix.alias("_ps"))
    made = made.select("host", "path", "_s", F.explode("_ps").alias("_pre"))
    made = made.withColumn("_digest", F.sha2(F.concat("_s", "_pre"), 256)).withColumn("_short", F.substring("_digest", 1, PREFIX_HEX))
    # no hint: Spark broadcasts the rules only while they are small
    hits = made.join(ready, "_short").where("_digest = _rdigest")
    best = F.max(F.struct(F.length("_rule"), F.length("_h"), F.col("_a") == "block", "_rule", "_a")).alias("_best")
    verdicts = hits.groupBy("host", "path").agg(best)
    return rows.join(verdicts, ["host", "path"], "left").select(
        id_col,
        "host",
        "path",
        F.col("_best._rule").alias("rule"),
        F.coalesce("_best._a", F.lit(default)).alias("verdict"),
    )


# The rules of the query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(spark, sf_dir):
    from pitwall.llm.common import table

    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return judge(table(spark, sf_dir, "pages"), rules)


ORACLE = r"""
with u as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0
                       then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw_host, rest from u),
p as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') as path from h),
r as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule from p)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from r
"""
