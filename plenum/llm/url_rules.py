"""URL filters: rules as intervals of reversed-host keys, met by URLs in one sorted sweep.

Only DataFrame functions. A host ``www.example.com`` has the key ``com.example.www.``; a rule's host covers itself
and its subdomains, which are the keys that begin with the rule's key, an interval. Such intervals are nested or
apart. Along the sorted keys the rules that cover a place therefore form a stack: it grows where an interval begins
and goes back to the stack of the enclosing interval where it ends.

A stack holds the rules of a host with few of them, and only the name of a host with many. URLs below such a host go
through a second sweep, along its paths: there too rules are nested intervals, and as the longest path wins, an event
is one rule. So no event grows with the list of rules: it has at most ``INLINE`` entries per label of its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_PER_SWEEP = 1_000_000
#: Rules of one host that are carried through the sweep of hosts.
INLINE = 16


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for a null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot; the empty host has the empty key, before all others."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_events(told: DataFrame, inline: int = INLINE) -> DataFrame:
    """``key, stack``: the rules in force from ``key`` on. One row where an interval begins and one where it ends.

    ``told`` has distinct ``rule, host, path, verdict``. Of a host with more than ``inline`` rules the stack has one
    entry with its name as ``below``. Each rule host meets the hosts above it by an equi-join on its own suffixes, as
    many as it has labels.
    """
    n_rules = told.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None)
    pointer = F.struct(none.cast("int").alias("size"), none.cast("int").alias("host_size"), none.cast("string").alias("rule"),
                       none.cast("string").alias("path"), none.cast("string").alias("verdict"), F.col("host").alias("below"))
    few = told.join(n_rules.filter(F.col("n") <= inline), "host").groupBy("host").agg(
        F.collect_list(F.struct(*_ranked(), none.cast("string").alias("below"))).alias("own"))
    by_host = few.unionByName(n_rules.filter(F.col("n") > inline).select("host", F.array(pointer).alias("own")))
    labels = F.split("host", r"\.")
    above = by_host.select(
        "host", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("from"), labels.alias("labels")
    ).select("host", F.array_join(F.expr("slice(labels, from, size(labels))"), ".").alias("above"))
    stacks = above.join(by_host.select(F.col("host").alias("above"), "own"), "above").groupBy("host").agg(
        F.flatten(F.collect_list("own")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("above") != F.col("host"), F.col("own")))).alias("outside"))
    key = host_key(F.col("host"))
    # "/" follows "." among bytes, so it ends the interval of keys that begin with the rule's key
    after = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/"))
    return stacks.withColumn("_key", key).select(
        F.explode(F.array(F.struct(F.col("_key").alias("key"), F.col("inside").alias("stack")),
                          F.struct(after.alias("key"), F.col("outside").alias("stack")))).alias("e")).select("e.*")


def _ranked() -> list[Column]:
    """A rule as it is compared with others: the greatest wins."""
    return [(F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
            F.col("rule"), F.col("path"), F.col("verdict")]


def path_events(told: DataFrame) -> DataFrame:
    """``below, key, on``: the longest rule in force along the paths of each host, one row per begin and end.

    Each path meets the rules with a shorter path that begins it by an equi-join on its own prefixes. A host begins
    with nothing in force.
    """
    rules = told.groupBy("host", "path").agg(F.max(F.struct(*_ranked())).alias("best"))
    cut = F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("cut")
    shorter = rules.filter(F.length("path") > 0).select("host", "path", cut).select(
        "host", "path", F.expr("substring(path, 1, cut)").alias("prefix"))
    around = shorter.join(rules.select("host", F.col("path").alias("prefix"), F.col("best").alias("outer")), ["host", "prefix"])
    nested = rules.join(around.groupBy("host", "path").agg(F.max("outer").alias("outer")), ["host", "path"], "left")
    start = F.col("path").cast("binary")
    # no text has the byte FF, so it ends the interval of paths that begin with the rule's path
    events = nested.select(F.col("host").alias("below"), F.explode(F.array(
        F.struct(start.alias("key"), F.lit(0).alias("kind"), F.struct(F.col("best")).alias("on")),
        F.struct(F.concat(start, F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"), F.struct(F.col("outer").alias("best")).alias("on")),
    )).alias("e")).select("below", "e.*")
    kind = rules.schema["best"].dataType
    begins = rules.select(F.col("host").alias("below")).distinct().select(
        "below", F.unhex(F.lit("")).alias("key"), F.lit(-1).alias("kind"), F.struct(F.lit(None).cast(kind).alias("best")).alias("on"))
    return events.unionByName(begins)


def _along_paths(swept: DataFrame, told: DataFrame, inline: int, sweeps: int) -> DataFrame:
    """``swept`` (``_id, host, path, best, below``) with ``best`` of the rules of the hosts ``below`` as well."""
    many = told.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > inline).select("host")
    events = path_events(told.join(many, "host"))
    held = F.size("below") > 0
    same = swept.filter(held).groupBy("_id", "host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.max("best").alias("best"), F.max("below").alias("below"))
    rows = same.select("_id", "host", "path", "n", "best", F.explode("below").alias("below")).select(
        F.pmod(F.xxhash64("_id", "host", "path"), F.lit(sweeps)).alias("sweep"), "below", F.col("path").cast("binary").alias("key"),
        F.lit(1).alias("kind"), "_id", "host", "path", "n", "best", F.lit(None).cast(events.schema["on"].dataType).alias("on"))
    marks = events.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(sweeps - 1).cast("bigint"))).alias("sweep"),
                          "below", "key", "kind", "on")
    along = Window.partitionBy("sweep").orderBy("below", "key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.unionByName(marks, allowMissingColumns=True).withColumn(
        "found", F.last("on", ignorenulls=True).over(along)).filter("kind = 1")
    told_best = found.groupBy("_id", "host", "path").agg(
        F.max("n").alias("n"), F.max(F.array_max(F.array("best", "found.best"))).alias("best"))
    return swept.filter(~held).select("_id", "host", "path", "best").unionByName(
        told_best.select("_id", "host", "path", F.explode(F.array_repeat("best", F.col("n").cast("int"))).alias("best")))


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", otherwise: str = "allow",
    rows_per_sweep: int = ROWS_PER_SWEEP, inline: int = INLINE,
) -> DataFrame:
    """Per row of ``pages``: ``key, host, path, rule, verdict``.

    URLs and rule events are sorted together and swept; the URLs are dealt to sweeps of ``rows_per_sweep`` rows
    by a hash of the row, so a host with any share of the rows stays spread, and every sweep gets all rule events.
    Sweeps have at least ten times as many rows as there are events: the copies never exceed a tenth of the input,
    however long the list of rules. ``inline`` bounds the events (see above) and changes no result. Of the rules whose host covers the URL's and whose path begins its path, the
    longest (host and path together, then host, then the greater text) decides; without one ``otherwise``. A null or
    malformed URL has empty host and path and no rule; repeated rows each get their verdict; repeated rules count
    once and null rules not at all.
    """
    told = rules.filter(F.col("host").isNotNull() & (F.col("host") != "") & F.col("path").isNotNull()).select(
        "rule", "host", "path", "verdict").distinct()
    events = rule_events(told, inline)
    per_host = told.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    n_hosts, n_paths = per_host.agg(F.count(F.lit(1)), F.sum(F.when(F.col("n") > inline, F.col("n")))).first()
    n_events = 2 * n_hosts + 2 * (n_paths or 0)
    sweeps = max(1, -(-pages.count() // max(rows_per_sweep, 10 * n_events)))
    some = pages.select(F.col(key).alias("_id"), F.col(url).alias("_url"))
    host, path = url_parts(F.col("_url"))
    urls = some.select("_id", host.alias("host"), path.alias("path"), F.pmod(F.xxhash64("_id", "_url"), F.lit(sweeps)).alias("sweep"))
    none = F.lit(None)
    rows = urls.select("sweep", host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "_id", "host", "path",
                       none.cast(events.schema["stack"].dataType).alias("stack"))
    marks = events.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(sweeps - 1).cast("bigint"))).alias("sweep"), "key",
        F.lit(0).alias("kind"), none.cast(some.schema["_id"].dataType).alias("_id"), none.cast("string").alias("host"),
        none.cast("string").alias("path"), "stack")
    along = Window.partitionBy("sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = rows.unionByName(marks).withColumn("active", F.last("stack", ignorenulls=True).over(along)).filter("kind = 1")
    fits = F.filter("active", lambda r: r["below"].isNull() & F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(*[r[c].alias(c) for c in ("size", "host_size", "rule", "path", "verdict")])))
    hosts = F.transform(F.filter("active", lambda r: r["below"].isNotNull()), lambda r: r["below"])
    judged = swept.select("_id", "host", "path", best.alias("best"), F.coalesce(hosts, F.array()).alias("below"))
    if n_paths:
        judged = _along_paths(judged, told, inline, sweeps)
    return judged.select(
        F.col("_id").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(otherwise)).alias("verdict"))
