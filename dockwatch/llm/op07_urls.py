"""URL filters by a sort-merge range join on canonical keys; DataFrame functions only.

A host is keyed by its labels in reverse with a final dot (``www.example.org`` -> ``org.example.www.``), so a host and all
its subdomains are one interval of the sorted keys; below a host, the urls that start with a rule's path are one interval
of the sorted paths. Two sorted sweeps follow: the hosts of the urls pass the rule hosts, then the paths pass the rules of
each fitting host. A sweep carries the stack of nested rules that were open at the last rule before a row and closes those
whose interval has ended, that is whose key is no prefix of the row's key. Intervals of prefixes are nested or disjoint,
so the last open rule is the longest.

Hot groups (one host or top-level domain with a third of all urls) are dealt over as many salts as their counted rows
need; only their own rules are repeated per salt.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one sorted sweep.
SWEEP_ROWS = 500_000


def url_host(url):
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.locate("://", url) > 0, host).otherwise("")


def url_path(url):
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    path = F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0)
    return F.when(F.locate("://", url) > 0, path).otherwise("")


def host_key(host):
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def nested(marks: DataFrame) -> DataFrame:
    """``grp, key`` -> with ``stack``: the keys of the group that are prefixes of the key, shortest first, itself last.

    Prefixes are cut only at lengths that occur in the group and looked up by equality, so rules are never paired all with all.
    """
    lengths = marks.groupBy("grp").agg(F.collect_set(F.length("key")).alias("lengths"))
    cut = marks.join(lengths, "grp").select("grp", "key", F.explode(F.expr(
        "transform(filter(lengths, n -> n <= length(key)), n -> substring(key, 1, n))")).alias("prefix"))
    found = cut.join(marks.select("grp", F.col("key").alias("prefix")), ["grp", "prefix"])
    return found.groupBy("grp", "key").agg(F.array_sort(F.collect_list("prefix")).alias("stack"))


def sweep(points: DataFrame, marks: DataFrame, sweep_rows: int) -> DataFrame:
    """Distinct ``grp, key`` points with ``open``: the marks that are prefixes of the key, longest last; points without are left out."""
    salts = points.groupBy("grp").agg(F.ceil(F.count("*") / sweep_rows).cast("int").alias("salts"))
    dealt = points.join(salts, "grp").select(
        "grp", F.expr("cast(pmod(xxhash64(key), salts) as int)").alias("salt"), "key", F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    opened = nested(marks).join(salts, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "key", F.lit(0).alias("kind"), "stack")
    order = Window.partitionBy("grp", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = opened.unionByName(dealt).withColumn("stack", F.last("stack", ignorenulls=True).over(order))
    fitting = F.expr("filter(stack, k -> startswith(key, k))")
    return swept.where("kind = 1").select("grp", "key", fitting.alias("open")).where(F.size("open") > 0)


def filter_urls(df: DataFrame, rules: DataFrame, id_col="page_id", url_col="url", default="allow", sweep_rows=SWEEP_ROWS) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every row of ``df``; ``rules`` has ``host, path, verdict``.

    A rule fits its host and all subdomains if the url's path starts with the rule's path; the longest rule (host and path
    together, then the longer host) wins; ``default`` holds where none fits. Rule hosts are compared lower-cased; of equal
    rules with different verdicts ``block`` wins; a rule without host or verdict fits nothing; a null rule path is empty.
    Null urls and urls without ``://`` have an empty host and path and no rule. Repeated rows are judged each, ids may be
    null, other columns are ignored, and an empty table gives an empty result.
    """
    rules = (rules.where("host is not null and host <> '' and verdict is not null")
             .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("rhost", host_key(F.col("host"))))
    url = F.col(url_col)
    pages = df.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    pages = pages.select(id_col, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    urls = materialise(pages.where("host <> ''").select("host", "path").distinct(), "urls")

    top = F.substring_index(F.col("key"), ".", 1)
    hosts = urls.select("host").distinct().select(host_key(F.col("host")).alias("key")).withColumn("grp", top)
    rule_hosts = rules.select(F.col("rhost").alias("key")).distinct().withColumn("grp", top)
    host_rules = materialise(sweep(hosts, rule_hosts, sweep_rows).select(F.col("key").alias("hkey"), "open"), "hosts")

    probes = urls.withColumn("hkey", host_key(F.col("host"))).join(host_rules, "hkey").select(
        "host", "path", F.explode("open").alias("rhost"))
    probes = materialise(probes, "probes")
    points = probes.select(F.col("rhost").alias("grp"), F.col("path").alias("key")).distinct()
    marks = rules.select(F.col("rhost").alias("grp"), F.col("path").alias("key"))
    paths = sweep(points, marks, sweep_rows).select(F.col("grp").alias("rhost"), F.col("key").alias("path"), F.element_at("open", -1).alias("rpath"))
    won = (probes.join(paths, ["rhost", "path"])
           .join(rules.select("rhost", F.col("path").alias("rpath"), F.col("host").alias("rule_host"), "verdict"), ["rhost", "rpath"])
           .groupBy("host", "path").agg(F.max(F.struct(
               (F.length("rule_host") + F.length("rpath")).alias("n"), F.length("rule_host").alias("m"),
               F.concat("rule_host", "rpath").alias("rule"), "verdict")).alias("won")))
    return (pages.join(won, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict")))
