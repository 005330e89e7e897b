"""URL allow and block rules by a sort-merge range join.

Hosts are reversed label by label (``blog.example.net`` -> ``net.example.blog``), so a host
and its subdomains share a prefix. Every distinct (host, path) asks once for each of its
ancestor hosts: the canonical key ``ancestor NUL path``. A rule's key is a prefix of the
keys it fits, that is an interval of the sorted keys, and intervals of prefixes are either
nested or disjoint.

The sweep sorts rule starts, rule ends and URL keys together. Each rule boundary carries the
stack of rules that are active after it (at most one per character of the path), and a URL
takes the stack of the last boundary before it; the top of the stack is the longest rule of
that ancestor, and the longest over all ancestors wins.

Partitions: the sorted rows are cut by sampled ranges of (key, kind, salt), so a hot key is
spread over partitions, and written once with their partition numbers; every partition
starts with the stack of the last boundary in the partitions before it (one row per
partition). Distinct (host, path) pairs go into the sweep, so a URL that a third of all rows
share is one key; the verdicts go back to the rows by an equi-join that Spark splits when
one key is hot. Nothing is broadcast by a hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kickstar.frames import literal_frame
from kickstar.llm.common import ascii_lower, stored

RULE_SCHEMA = "host string, path string, verdict string"
# The rules of the contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# Kinds of rows at one key, in sorting order: a rule's start stands before the URLs it fits;
# its end is a key that no URL has, just after all keys with the rule's prefix.
START, END, URL = 0, 1, 2
#: Follows every continuation of a prefix in Spark's byte order (no UTF-8 text holds this byte).
AFTER = "unhex('ff')"


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return literal_frame(spark, rules, RULE_SCHEMA)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    for null and for texts without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _key(host: Column, path: Column) -> Column:
    return F.concat(F.encode(reversed_host(host), "UTF-8"), F.lit(bytearray(b"\x00")), F.encode(path, "UTF-8"))


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, kind, stack): the rules active after each start and each end of an interval,
    longest last.

    The rules around a rule are found by joining each prefix of its path with the rules of
    the same host, so a host with very many rules is no single group. Equal (host, path)
    with different verdicts count as one rule that blocks."""
    one = (rules.select(ascii_lower(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
           .filter("host <> ''").groupBy("host", "path").agg(F.min(F.when(F.col("verdict") == "block", 0).otherwise(1)).alias("v"))
           .select("host", "path", F.when(F.col("v") == 0, "block").otherwise("allow").alias("verdict")))
    prefixes = one.select(F.col("host").alias("h"), F.col("path").alias("p"),
                          F.explode(F.sequence(F.lit(0), F.char_length("path"))).alias("n")) \
        .withColumn("pre", F.expr("substr(p, 1, n)"))
    active = (prefixes.join(one, (prefixes.h == one.host) & (prefixes.pre == one.path))
              .groupBy("h", "p").agg(F.sort_array(F.collect_list(
                  F.struct(F.col("n"), F.col("host"), F.col("path"), F.col("verdict")))).alias("stack"))
              .withColumn("key", _key(F.col("h"), F.col("p"))))
    starts = active.select("key", F.lit(START).alias("kind"), "stack")
    ends = active.select(F.concat("key", F.expr(AFTER)).alias("key"), F.lit(END).alias("kind"),
                         F.expr("slice(stack, 1, size(stack) - 1)").alias("stack"))
    # rules that end at the same key would tie; a longer key with the same end sorts before
    return starts.unionByName(ends)


def sweep(keys: DataFrame, marks: DataFrame, partitions: int | None = None) -> DataFrame:
    """``keys`` (key, and other columns) with ``top``, the innermost rule at each key."""
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in keys.columns if c != "key"]
    both = (keys.withColumns({"kind": F.lit(URL), "salt": F.xxhash64(*cols)})
            .unionByName(marks.withColumn("salt", F.lit(0).cast("long")), allowMissingColumns=True))
    # ends of nested rules follow each other from the inside out: longer keys have longer ends
    ranged = stored(both.repartitionByRange(n, "key", "kind", "salt").withColumn("part", F.spark_partition_id()), "urls")
    carried = (ranged.filter(F.col("kind") != URL).groupBy("part")
               .agg(F.max_by("stack", F.struct("key", "kind")).alias("stack")))
    spread = spark.range(n).select(F.col("id").cast("int").alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    carry = spread.join(carried, "part", "left").select("part", F.last("stack", True).over(before).alias("carry"))
    here = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (ranged.withColumn("seen", F.last("stack", True).over(here)).filter(F.col("kind") == URL)
             .join(carry, "part").withColumn("stack", F.coalesce("seen", "carry")))
    return swept.select("key", *cols, F.when(F.size("stack") > 0, F.element_at("stack", -1)).alias("top"))


def judge(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's path; of the
    fitting rules the one with the most characters (host and path) wins, then the longer
    host. Without a fitting rule the verdict is ``default`` and the rule null; null urls and
    urls without ``://`` have an empty host and path, which no rule fits. Repeated rows and
    rows with a null id each get a row; other columns are not read. An empty table gives no rows.
    A host asks for as many ancestors as the longest rule host has labels, however long it is."""
    rules = rules_frame(pages.sparkSession) if rules is None else rules
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    asked = rows.filter("host <> ''").select("host", "path").distinct()
    # only the host of a rule can fit, so ancestors have no more labels than the longest of them
    most = rules.select(F.size(F.split("host", r"\.")).alias("n")).agg(F.max("n")).first()[0] or 1
    labels = F.split("host", r"\.")
    up = F.expr(f"transform(sequence(1, least(size(labels), {int(most)})), k -> array_join(slice(labels, -k, k), '.'))")
    keys = (asked.withColumn("labels", labels).withColumn("ancestor", F.explode(up))
            .select("host", "path", _key(F.col("ancestor"), F.col("path")).alias("key")))
    found = sweep(keys, boundaries(rules)).filter("top is not null")
    best = (found.groupBy("host", "path").agg(F.max(F.struct(
        (F.char_length("top.host") + F.char_length("top.path")).alias("n"), F.char_length("top.host").alias("m"),
        F.concat("top.host", "top.path").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("best")))
    return (rows.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
