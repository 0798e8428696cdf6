"""URL filter: rules of hosts and paths, and a template tree of every host for the rest."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetrace.llm.common import ascii_lower, packed
from linetrace.session import checkpointed

ANY, END, TAIL = "*", "$", "**"
#: Levels every template has; below them only nodes with labels of both kinds grow on, what lies below the others is one tail.
DEPTH = 6
#: A segment that looks like a number, date, hash or id is variable wherever it stands.
VARIABLE = r"^(?:[0-9]+(?:[-_.][0-9]+)*|[0-9a-fA-F-]{16,})(?:\.[A-Za-z]{1,5})?$"
#: Branches differ if their rates of blocked labels are so many standard errors apart.
DISTANCE = 1.96
#: Weight of the parent's rate in a template's, in labels.
PRIOR = 4.0
#: Templates with a smoothed rate of blocked labels from here on are rejected.
REJECT = 0.6


@dataclass(frozen=True)
class UrlRule:
    """``host`` and all hosts below it, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, else null.

    The rules are a short list by contract, so they become one expression.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _segments(path: Column) -> Column:
    """The path's segments by level, the end marked."""
    return F.concat(F.array_remove(F.split(path, "/"), ""), F.array(F.lit(END)))


def _with_tails(rows: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """Rows of nodes without labels of both kinds end in a tail at this level.

    No branch of such a node can differ from its siblings, however deep.
    """
    mixed = nodes.where("allow > 0 and block > 0").select("template", F.lit(True).alias("mixed"))
    grows = F.col("mixed") | (F.size("segments") <= level + 1)
    tail = F.concat(F.slice("segments", 1, level), F.array(F.lit(TAIL)))
    return rows.join(mixed, "template", "left").withColumn("segments", F.when(grows, F.col("segments")).otherwise(tail)).drop("mixed")


def template_tree(urls: DataFrame) -> DataFrame:
    """Add ``template``, ``rate`` and ``labels`` to rows with ``host, path, label``.

    ``label`` is 1 for urls known to be blocked, 0 for allowed ones, null for unknown;
    a column ``n``, if there is one, says for how many urls a row stands.
    The tree of a host grows level by level. Below each node a segment is a wildcard if
    it looks variable; of the others each stays apart, however small, only if
    its rate of blocked labels differs from its siblings' by ``DISTANCE``
    standard errors, the rest merge into the wildcard. ``rate`` is the smoothed rate
    of the deepest node: every node adds ``PRIOR`` labels of its parent's rate, and a
    host those of all labels. A node without labels has the rate of all labels, for what
    its parent knows lies in branches that were found to differ. ``labels`` counts the node's own.

    Work per level is one count by (node, segment), so a hot host is summed before it is
    shuffled; only named branches, which all have labels, are joined back. Rows whose path
    ends leave the rounds.
    """
    weight = F.col("n") if "n" in urls.columns else F.lit(1)
    own = [F.when(F.col("label") == k, weight).otherwise(0).alias(name) for k, name in enumerate(("allow", "block"))]
    urls = urls.select("*", *own)
    sums = [F.sum(name).alias(name) for name in ("allow", "block")]
    total = urls.agg(*sums).first()
    known = (total.allow or 0) + (total.block or 0)
    overall = (total.block or 0) / known if known else 0.0

    def smoothed(parent: Column) -> Column:
        known_here = F.col("allow") + F.col("block")
        return F.when(known_here == 0, F.lit(overall)).otherwise((F.col("block") + PRIOR * parent) / (known_here + PRIOR))

    rows = urls.withColumn("segments", _segments(F.col("path"))).withColumn("template", F.col("host"))
    hosts = rows.groupBy("template").agg(*sums).withColumn("rate", smoothed(F.lit(overall)))
    nodes = checkpointed(hosts.select("template", "rate", "allow", "block"))
    rows = checkpointed(rows)
    ended, level = [], 0
    while (rows.agg(F.max(F.size("segments"))).first()[0] or 0) > level:
        if level >= DEPTH:
            rows = checkpointed(_with_tails(rows, nodes, level))
        segment = F.get("segments", level)
        branches = checkpointed(
            rows.withColumn("segment", F.when(segment.rlike(VARIABLE), ANY).otherwise(segment))
            .groupBy("template", "segment")
            .agg(*sums)
        )
        totals = branches.groupBy("template").agg(F.sum("allow").alias("all_allow"), F.sum("block").alias("all_block"))
        seen = branches.join(totals, "template").where(f"segment <> '{ANY}'")
        n, rest = F.col("allow") + F.col("block"), F.col("all_allow") + F.col("all_block") - F.col("allow") - F.col("block")
        pooled = F.try_divide("all_block", F.col("all_allow") + F.col("all_block"))
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), rest)))
        other = F.try_divide(F.col("all_block") - F.col("block"), rest)
        apart = F.abs(F.try_divide(F.col("block"), n) - other) > DISTANCE * error
        named = checkpointed(
            seen.where(F.col("segment").isin(END, TAIL) | apart).select("template", F.col("segment").alias("own"), F.lit(1).alias("named"))
        )
        placed = checkpointed(
            rows.withColumn("own", segment)
            .join(named, ["template", "own"], "left")
            .withColumn("parent", F.col("template"))
            .withColumn("template", F.concat("template", F.lit("/"), F.when(F.col("named") == 1, F.col("own")).otherwise(ANY)))
            .drop("named", "own")
        )
        nodes = checkpointed(
            placed.groupBy("template", "parent").agg(*sums)
            .join(nodes.select(F.col("template").alias("parent"), F.col("rate").alias("above")), "parent")
            .withColumn("rate", smoothed(F.col("above")))
            .select("template", "rate", "allow", "block")
        )
        level += 1
        ends = placed.where(F.size("segments") <= level).drop("segments", "parent", "allow", "block")
        ended.append(ends.join(nodes.select("template", "rate", (F.col("allow") + F.col("block")).alias("labels")), "template"))
        rows = placed.where(F.size("segments") > level).drop("parent")
    if not ended:
        nothing = nodes.select("template", "rate", (F.col("allow") + F.col("block")).alias("labels"))
        return rows.drop("segments", "allow", "block").join(nothing, "template")
    return reduce(DataFrame.unionByName, ended)


def judged_urls(pages: DataFrame, rules: list[UrlRule], url_column: str = "url") -> DataFrame:
    """Each row as struct ``row`` with ``host, path, rule, verdict, template``.

    The rule that fits decides; rules are tried longest first. The urls that a rule
    decides are the labels of the template tree, which decides the others: ``block`` where
    the template holds labels and its smoothed rate of blocked ones reaches ``REJECT``. Every
    distinct host and path goes through the tree once, with its count. A null url, or one without ``://``, has empty host and
    path and is judged like any other; repeated rows stay rows; other columns are
    carried in ``row``; no rows give no rows; no labels block nothing.
    """
    url = F.col(f"`{url_column}`")
    parsed = packed(pages, host=host_of(url), path=path_of(url)).withColumn(
        "ruled", matched_rule(F.col("host"), F.col("path"), rules)
    )
    label = (F.col("ruled.verdict") == "block").cast("int")
    judged = template_tree(parsed.groupBy("host", "path", label.alias("label")).agg(F.count("*").alias("n")))
    own = F.when((F.col("labels") > 0) & (F.col("rate") >= REJECT), "block").otherwise("allow")
    return parsed.join(judged.select("host", "path", "template", "rate", "labels"), ["host", "path"]).select(
        "row", "host", "path", F.col("ruled.rule").alias("rule"), F.coalesce("ruled.verdict", own).alias("verdict"), "template"
    )
