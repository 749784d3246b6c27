"""URL filters: host-suffix and path-prefix expressions against a list of rules.

Each URL is expanded into the expressions that could be a rule (the label suffixes of its host that have
as many labels as some rule's, times the prefixes of its path that are as long as some rule's path), expressions are cut to a short
hash prefix, equi-joined with the rules' hash prefixes, and survivors are confirmed by the full
digest and by the expression itself. Of the confirmed rules the longest wins.

Hot hosts do not matter: with a rule list of at most ``BROADCAST_RULES`` rows (counted first) the
join is map-side and the only shuffle is by page; beyond it the join is by hash prefix and adaptive
execution splits the prefixes that many pages share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules that may be broadcast; at under 200 bytes each that is 20 MB at most.
BROADCAST_RULES = 100_000
#: Hexadecimal digits of SHA-256 in a short hash prefix (32 bits).
PREFIX_DIGITS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or for a URL without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as the frame that :func:`judge` takes; host and path as in ``net`` and ``/en/``."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule and verdict for every row of ``urls`` (page_id, url).

    A rule (verdict, host, path) fits its host and all its subdomains if the URL's path starts with
    the rule's. The longest rule (host and path together, then host) wins; of equal rules ``block``
    wins. Rules with a null or empty host or a null path fit nothing. No rule fits: ``rule`` is null
    and the verdict is ``default``. Null or empty URLs and URLs without ``://`` have an empty host
    and path and fit no rule. Null page_ids are kept. Repeated rows stay, each with its verdict. An
    empty table gives an empty result; other columns of ``urls``, whatever their names, are left out.
    """
    rules = (
        rules.where("host is not null and path is not null and host <> ''")
        .groupBy(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"))
        .agg(F.max("verdict").alias("r_verdict"))  # 'block' sorts after 'allow'
        .withColumn("digest", F.sha2(F.concat("r_host", F.lit("\n"), "r_path"), 256))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    )
    # One row comes back: the lengths that rule paths have, the counts of labels that rule hosts have, and the count of rules.
    labels = F.size(F.split("r_host", r"\.", -1))
    lengths = rules.agg(F.collect_set(F.length("r_path")).alias("lengths"), F.collect_set(labels).alias("labels"), F.count("*").alias("n")).first()
    host, path = host_and_path(F.col("url"))
    # Equal rows are counted by the partition that they are read in, so that very many of them are many groups.
    pages = urls.select("page_id", "url", F.spark_partition_id().alias("part")).withColumns({"host": host, "path": path})
    if lengths["n"] <= BROADCAST_RULES:
        rules = F.broadcast(rules)
    wide = pages.select("page_id", "url", "part", "host", "path", F.posexplode(_expressions(sorted(lengths["lengths"]), sorted(lengths["labels"]))).alias("at", "e"))
    wide = wide.withColumn("full", F.sha2(F.concat("e.s", F.lit("\n"), "e.p"), 256))
    joined = wide.join(rules, F.when(F.col("at") > 0, F.substring("full", 1, PREFIX_DIGITS)) == F.col("short"), "left")
    confirmed = (F.col("full") == F.col("digest")) & (F.col("e.s") == F.col("r_host")) & (F.col("e.p") == F.col("r_path"))
    rank = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("h"), F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")
    )
    # A page's expressions are made in one task, so all but one row of a page fall to the map-side
    # part of this aggregate; expression 0 stands for the row itself and counts repeated rows.
    # (Expression 0 gets no hash prefix, so it joins nothing.)
    first = F.when(F.col("at") == 0, 1)
    best = (
        joined.where((F.col("at") == 0) | confirmed)
        .groupBy("page_id", "url", "part")
        .agg(F.max(F.when(confirmed, rank)).alias("best"), F.count(first).alias("rows"))
    )
    host, path = host_and_path(F.col("url"))
    return best.select(
        "page_id", "url", host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")


def _expressions(path_lengths: list[int], label_counts: list[int]) -> Column:
    """All (label suffix s of host, prefix p of path) that could be a rule, after an empty one that stands for the page."""
    # From the right, substring_index stops at the n-th dot, so a host of very many labels costs no more than its length.
    dots = F.length(F.regexp_replace("host", r"[^.]+", ""))
    some = [F.when(dots >= n - 1, F.substring_index("host", ".", -n)) for n in label_counts]
    suffixes = F.filter(F.array(*some), lambda s: s.isNotNull()) if some else F.array().cast("array<string>")
    some = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in path_lengths]
    prefixes = F.filter(F.array(*some), lambda p: p.isNotNull()) if some else F.array().cast("array<string>")
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("s"), p.alias("p")))))
    return F.concat(F.array(F.struct(F.lit("").alias("s"), F.lit("").alias("p"))), pairs)
