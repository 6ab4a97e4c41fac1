"""URL filter: fixed rules first, then a tree of path templates with labelled purity.

Rules: a rule (host suffix, path prefix, verdict) fits a host and all its subdomains if the
path starts with the rule's path. The rule with the longest path and host wins.

Templates: each host has a tree of path segments.

1. Segments with a variable form (digits, long hexadecimal, identifiers with digits)
   become a wildcard of that form at once.
2. Below each node (host and the generalised path so far), if the distinct segments are many and
   few of them repeat, all become one wildcard: the node's children are variable. The paths
   below a new wildcard meet in its nodes, so these are counted again, as often as
   wildcards lie below each other; each round reads only the paths that the one before changed.
3. Sibling templates of a node are ordered by their labelled share, in ``BINS`` + 1 bins. Neighbours whose
   shares do not differ by a two-proportion test are merged, from the lowest share up, and take the
   pooled share. A template without labels has no share and is not merged.
4. A template is rejected if the smoothed share of blocked labels of its merged branch exceeds
   ``REJECT``. It is pulled towards its host's share (and that towards the share of all labels), but
   to ``REJECT`` at most: only labels of the branch reject, one without labels is undecided and allowed.

Labels are rows whose verdict is known, by default those that a rule decides. All counts
are aggregates over (host, node, segment), combined before they are shuffled, so a
host with a third of all rows is spread over its segments; counts are written before
they are joined, so the adaptive skew join can split the rows of a hot host.

A null URL, or one without ``://``, has an empty host and path. Empty tables give empty results. Repeated rows are judged
each and count each. Of rules of equal length the smaller one by (host, path, verdict) wins. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import written

#: A node's children are variable if so many are distinct and at least half of its rows differ.
LEAST_CHILDREN = 20
VARIABLE_SHARE = 0.5
#: Siblings with a smaller normal deviate count as alike.
ALIKE = 1.96
#: Siblings whose shares of blocked labels agree in steps of one 64th are pooled at once, so a node has few rows to merge.
BINS = 64
PRIOR = 5.0
REJECT = 0.5

Rule = tuple[str, str, str]  # host suffix, path prefix, verdict


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The best fitting rule as a struct (rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for suffix, prefix, verdict in reversed(ordered):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        choice = F.when(fits, F.struct(F.lit(suffix + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(choice)
    return choice


def _form(segment: Column) -> Column:
    """Wildcard of a segment with a variable form, else the segment."""
    base = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(base.rlike(r"^[0-9]+$"), F.lit("{number}"))
        .when(base.rlike(r"^[0-9a-fA-F]{12,}$"), F.lit("{hex}"))
        .when(base.rlike(r"[0-9]") & base.rlike(r"[A-Za-z]") & (F.length(base) >= 8), F.lit("{id}"))
        .otherwise(segment))


def split_urls(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host, path, rule, its verdict, and the segments with variable forms replaced."""
    parts = df.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    return parts.select(key, "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("known"),
                        F.transform(segments, _form).alias("forms"))


def templates(rows: DataFrame) -> DataFrame:
    """One row per (host, forms): template, rows, labelled rows, blocked rows."""
    distinct = written(
        rows.groupBy("host", "forms").agg(
            F.count(F.lit(1)).alias("n"), F.count("known").alias("labelled"),
            F.count(F.when(F.col("known") == "block", 1)).alias("blocked")), "paths")
    numbered = distinct.withColumn("path_id", F.xxhash64("host", "forms"))
    # Paths whose levels below ``settled`` are not judged yet.
    open_paths = numbered.select("host", "path_id", "n", F.col("forms").alias("now"), F.lit(-1).alias("settled"))
    changed = None
    while True:
        # A node is the hash of its path: strings of every length of a long path would be many times the path.
        nodes = open_paths.select("host", "path_id", "n", "now", "settled", F.posexplode("now").alias("depth", "segment")).filter(
            "depth > settled").select("host", "path_id", "n", "depth", "segment", F.xxhash64(F.expr("slice(now, 1, depth)")).alias("node"))
        variable = written(
            nodes.groupBy("host", "depth", "node", "segment").agg(F.sum("n").alias("n"))
            .groupBy("host", "depth", "node").agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("rows"))
            .filter((F.col("distinct") >= LEAST_CHILDREN) & (F.col("distinct") >= VARIABLE_SHARE * F.col("rows")))
            .select("host", "depth", "node"), "nodes")
        if variable.isEmpty():
            break
        # Only the highest new wildcard of a path is sure: the nodes below it are counted again.
        hits = nodes.join(variable, ["host", "depth", "node"], "left_semi").groupBy("host", "path_id").agg(F.min("depth").alias("at"))
        open_paths = written(
            open_paths.join(hits, ["host", "path_id"]).select(
                "host", "path_id", "n", F.transform("now", lambda x, i: F.when(i == F.col("at"), "{any}").otherwise(x)).alias("now"),
                F.col("at").alias("settled")), "open")
        newer = open_paths.select("host", "path_id", "now")
        changed = newer if changed is None else written(
            changed.join(newer.select("host", "path_id"), ["host", "path_id"], "left_anti").unionByName(newer), "changed")
    template = F.array_join("forms", "/")
    if changed is not None:
        numbered = numbered.join(changed, ["host", "path_id"], "left")
        template = F.array_join(F.coalesce("now", "forms"), "/")
    return written(numbered.select("host", "forms", template.alias("template"), "n", "labelled", "blocked"), "judged")


def _clusters(bins: Column) -> Column:
    """Neighbouring bins merged from the lowest up: an array of (low, high, labelled, blocked)."""

    def step(done: Column, one: Column) -> Column:
        last = F.element_at(done, -1)
        both = (last["l"] + one["l"]).cast("double")
        share = (last["b"] + one["b"]) / both
        spread = F.sqrt(share * (1 - share) * (1 / last["l"] + 1 / one["l"]))
        alike = F.abs(last["b"] / last["l"] - one["b"] / one["l"]) <= ALIKE * spread
        merged = F.struct(last["low"].alias("low"), one["high"].alias("high"), (last["l"] + one["l"]).alias("l"), (last["b"] + one["b"]).alias("b"))
        return F.when(alike, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(merged))).otherwise(F.concat(done, F.array(one)))

    return F.aggregate(F.slice(bins, 2, BINS + 1), F.slice(bins, 1, 1), step)


def purity(paths: DataFrame) -> DataFrame:
    """One row per (host, template): the smoothed share of blocked labels after merging like siblings."""
    by_template = paths.groupBy("host", "template").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    parent = F.when(F.instr("template", "/") > 0, F.regexp_replace("template", r"/[^/]*$", "")).otherwise(F.lit(""))
    level = written(by_template.withColumn("parent", F.xxhash64(parent)).withColumn(
        "bin", F.try_divide(F.col("blocked") * BINS, F.col("labelled")).cast("int")), "shares")
    # At most BINS + 1 rows meet in a node.
    bins = level.filter("labelled > 0").groupBy("host", "parent", "bin").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    merged = written(
        bins.groupBy("host", "parent").agg(F.array_sort(F.collect_list(
            F.struct(F.col("bin").alias("low"), F.col("bin").alias("high"), "l", "b"))).alias("bins"))
        .select("host", "parent", F.explode(_clusters(F.col("bins"))).alias("c")).select("host", "parent", "c.*"), "clusters")
    hosts = written(level.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("blocked").alias("hb")), "hosts")
    overall = hosts.agg(F.sum("hl").alias("al"), F.sum("hb").alias("ab")).head()
    everything = ((overall["ab"] or 0) + 1) / ((overall["al"] or 0) + 2)
    host_share = (F.col("hb") + PRIOR * everything) / (F.col("hl") + PRIOR)
    # One cluster holds the bin of a labelled template, none that of others.
    found = level.alias("t").join(merged.alias("c"), (F.col("t.host") == F.col("c.host")) & (F.col("t.parent") == F.col("c.parent"))
                                  & F.col("t.bin").between(F.col("c.low"), F.col("c.high")), "left").select("t.*", "l", "b").join(hosts, "host")
    return found.select("host", "template", "n", "labelled", "blocked",
                        ((F.coalesce("b", F.lit(0)) + PRIOR * F.least(host_share, F.lit(REJECT))) / (F.coalesce("l", F.lit(0)) + PRIOR)).alias("purity"))


def judge(df: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row: key, host, path, rule, verdict, template, purity."""
    rows = split_urls(df, rules, key, url)
    paths = templates(rows)
    shares = written(purity(paths), "purity")
    table = written(paths.join(shares.select("host", "template", "purity"), ["host", "template"])
                    .select("host", F.col("forms"), "template", "purity"), "verdicts")
    return rows.join(table, ["host", "forms"], "left").select(
        key, "host", "path", "rule",
        F.coalesce("known", F.when(F.col("purity") > REJECT, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("template", F.lit("")).alias("template"), F.coalesce("purity", F.lit(0.0)).alias("purity"))
