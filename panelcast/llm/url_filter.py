"""URL rules by host and path: a sorted sweep over canonical keys with a stack of nested rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelcast.llm.common import col, stored

#: Stands between host and path in a key; sorts below every character of a host.
END = "\u0001"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; then up to ``?``, ``#`` or the end. Both are empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, "host/path") pairs as a frame of verdict, host, path."""
    parts = [(v, r.partition("/")[0], "".join(r.partition("/")[1:])) for v, r in rules]
    return spark.createDataFrame(parts, "verdict string, host string, path string")


def _reversed(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the stack that a sweep has when it passes the key: this rule and all rules
    whose keys are its prefixes, which are the intervals around it.

    A rule with an empty host or null fields is dropped: it fits no host. Of rules with the same host
    and path, ``block`` wins over ``allow`` (the greatest verdict in code point order).
    """
    keyed = (
        rules.where("host <> '' and path is not null and verdict is not null")
        .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat(_reversed(F.split("host", r"\.")), F.lit(END), "path").alias("key"),
            F.struct(
                (F.length("host") + F.length("path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                F.col("verdict"),
            ).alias("entry"),
        )
    )
    # every prefix of a key that may be a key itself: those behind the host's end
    end = F.instr("key", END)
    heads = keyed.select(
        F.col("key").alias("inner"), F.explode(F.sequence(end, F.length("key"))).alias("n")
    ).select("inner", F.expr("substring(inner, 1, n)").alias("key"))
    return (
        heads.join(keyed, "key")
        .groupBy("inner")
        .agg(F.sort_array(F.collect_list(F.struct("key", "entry"))).alias("stack"))
        .withColumnRenamed("inner", "key")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    slices: int | None = None,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    A rule (verdict, host, path) fits its host and all its subdomains if the url's path starts with the
    rule's. The rule with most characters wins, of equals the one with the longer host; without any the
    verdict is ``default`` and the rule null. Null and odd urls have empty host and path and fit
    no rule. Repeated rows are judged each; an empty rule table gives every page the default.

    Sort-merge range join: a rule's key (reversed host, end mark, path) is a prefix, that is an interval of
    keys, and intervals of prefixes are nested or apart. Each url asks once for each of its host's
    suffixes. Urls are dealt evenly into ``slices`` by their hash, so no host is hot; each slice is
    sorted together with the rules and swept once, carrying the stack of the last rule passed, in which
    all rules around the url's key lie. Every rule goes to every slice. Only ids and urls shuffle.
    """
    spark = pages.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(col(url_col).cast("string"))
    asked = pages.select(
        F.monotonically_increasing_id().alias("row"),
        col(id_col).alias("id"),
        host.alias("host"),
        path.alias("path"),
        F.pmod(F.xxhash64(col(id_col).cast("string"), col(url_col).cast("string")), F.lit(slices)).cast("int").alias("slice"),
    )
    labels = F.split("host", r"\.")
    probes = asked.withColumn("from", F.explode(F.sequence(F.lit(1), F.size(labels)))).select(
        "slice",
        F.concat(_reversed(F.slice(labels, F.col("from"), F.size(labels))), F.lit(END), "path").alias("key"),
        F.lit(1).alias("kind"),
        "row",
        "id",
        F.when(F.col("from") == 1, F.col("host")).alias("host"),
        F.when(F.col("from") == 1, F.col("path")).alias("path"),
    )
    stacks = stored(rule_stacks(rules), "rules")
    starts = stacks.select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "key", F.lit(0).alias("kind"), "stack")
    both = probes.unionByName(starts, allowMissingColumns=True)
    sweep = Window.partitionBy("slice").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    around = F.filter("open", lambda s: F.startswith(F.col("key"), s["key"]))
    best = F.array_max(F.transform(around, lambda s: s["entry"]))
    return (
        swept.withColumn("best", best)
        .groupBy("slice", "row")
        .agg(
            F.first("id", ignorenulls=True).alias("id"),
            F.max("host").alias("host"),
            F.max("path").alias("path"),
            F.max("best").alias("best"),
        )
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
        )
    )
