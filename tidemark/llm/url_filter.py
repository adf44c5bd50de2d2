"""URL filter with a tree of path templates per host.

Hand-written rules judge the urls that they fit, and label them. For all others, each host's
paths form a tree: variable segments become wildcards, siblings whose share of blocked urls does
not differ are merged, and a template is rejected where its labelled urls are mostly blocked.
Labels reach templates without any: purity leans on the branches above, the host and its parent domains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
         Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

WILD = "*"
VARIABLE = r"[0-9]|^.{33,}$"    # a segment with a digit, or a very long one, is a value
CHILDREN, SUPPORT = 16, 4   # that many children with fewer urls each on average are values too
SIMILAR, LEAST_LABELLED = 1.96, 5   # z score below which branches with enough labels are merged
PRIOR, PRIOR_WEIGHT = 0.1, 2.0      # where no node above has labels, a template is taken to be good
REJECT = 0.5
END = "/"                   # marks the end of a path; no segment holds it


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between the first ``://`` and the next ``/ ? #``, lower case; then up to ``?`` or ``#``.

    Null urls and those without ``://`` have empty host and path.
    """
    rest = F.when(F.instr(url, F.lit("://")) > 0, F.substr(url, F.instr(url, F.lit("://")) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def path_segments(path: Column) -> Column:
    """Segments with values as wildcards."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    return F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), WILD).otherwise(s))


def _renamed(level: int, to_wild: Column) -> Column:
    return F.transform("segments", lambda s, i: F.when((i == level) & to_wild, WILD).otherwise(s))


def _branches(tree: DataFrame, level: int) -> DataFrame:
    """Sums of each branch: host, the segments above, and its own."""
    return (tree.where(F.size("segments") > level)
            .groupBy("host", F.slice("segments", 1, level).alias("above"), F.get("segments", F.lit(level)).alias("own"))
            .agg(F.sum("urls").alias("urls"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))


def _generalised(tree: DataFrame, level: int) -> DataFrame:
    """Branches of a node with very many, thinly filled ones become one wildcard."""
    wide = (_branches(tree, level).groupBy("host", "above")
            .agg(F.count("*").alias("children"), F.sum("urls").alias("all_urls"))
            .where((F.col("children") >= CHILDREN) & (F.col("all_urls") < SUPPORT * F.col("children")))
            .select("host", "above", F.lit(True).alias("wide")))
    placed = tree.withColumn("above", F.slice("segments", 1, level)).join(wide, ["host", "above"], "left")
    return materialise(placed.withColumn("segments", _renamed(level, F.col("wide").isNotNull()))
                       .select(*tree.columns), "url-tree")


def _merged(tree: DataFrame, level: int) -> DataFrame:
    """Branches whose share of blocked urls is not different from that of their siblings become
    one wildcard: a two-proportion z test against all siblings together. Branches with few
    labels say nothing about themselves and stay as they are."""
    branches = _branches(tree, level).where(F.col("labelled") >= LEAST_LABELLED)
    nodes = branches.groupBy("host", "above").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"),
                                                  F.count("*").alias("siblings")).where("siblings > 1")
    others, other_blocked = F.col("n") - F.col("labelled"), F.col("b") - F.col("blocked")
    share = F.col("b") / F.col("n")
    spread = F.sqrt(share * (1 - share) * (1 / F.col("labelled") + 1 / others))
    gap = F.abs(F.col("blocked") / F.col("labelled") - other_blocked / others)
    similar = (branches.join(nodes, ["host", "above"])
               .where(gap <= SIMILAR * spread).select("host", "above", "own", F.lit(True).alias("similar")))
    placed = tree.withColumns({"above": F.slice("segments", 1, level), "own": F.get("segments", F.lit(level))})
    placed = placed.join(similar, ["host", "above", "own"], "left")
    return materialise(placed.withColumn("segments", _renamed(level, F.col("similar").isNotNull()))
                       .select(*tree.columns), "url-tree")


def _levels(tree: DataFrame, least: int, labels: int = 0) -> list[int]:
    """Levels at which some host has that many different segments with enough labels.

    Only there can a node have so many branches, so a very deep path costs no pass of its own.
    """
    own = (tree.select("host", "labelled", F.posexplode("segments").alias("level", "own"))
           .groupBy("host", "level", "own").agg(F.sum("labelled").alias("labelled")).where(F.col("labelled") >= labels))
    many = own.groupBy("host", "level").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return sorted(r.level for r in many.select("level").distinct().collect())


def _domain_labels(host: Column) -> Column:
    """Labels of the host's name from the right, the last two as one; numbers are no domain."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    labels = F.reverse(F.split(name, r"\."))
    registered = F.concat_ws(".", F.get(labels, F.lit(1)), F.get(labels, F.lit(0)))
    return F.when(name.rlike(r"^[0-9.]*$|^\[") | (F.size(labels) < 2), F.array().cast("array<string>")).otherwise(
        F.concat(F.array(registered), F.slice(labels, F.lit(3), F.greatest(F.size(labels) - 2, F.lit(0)))))


def _lineage(host: Column, segments: Column) -> Column:
    """Nodes from the parent domain over the host and the branches down to the template, as digests."""
    steps = F.concat(_domain_labels(host), F.array(F.concat(F.lit(END), host)), segments, F.array(F.lit(END)))
    return F.aggregate(steps, F.array().cast("array<string>"), lambda nodes, step: F.concat(
        nodes, F.array(F.md5(F.concat_ws("\n", F.coalesce(F.try_element_at(nodes, F.lit(-1)), F.lit("")), step)))))


def _purities(templates: DataFrame) -> DataFrame:
    """``host, segments, purity`` of each template.

    A template's share of blocked labels leans on its siblings, these on those of the node above,
    and so on up to the parent domain and the prior. A branch with labels counts once with its
    share, so a large one does not decide for its siblings alone, and its labels count at one
    level only: a node's own part is left out of what it leans on.
    """
    placed = materialise(templates.withColumn("nodes", _lineage(F.col("host"), F.col("segments"))), "url-nodes")
    parents = F.slice(F.transform("nodes", lambda n, i: F.struct(
        i.alias("level"), F.get("nodes", i - 1).alias("parent"), n.alias("node"))), F.lit(2), F.size("nodes"))
    branches = materialise(placed.where("labelled > 0").select("labelled", "blocked", F.inline(parents))
                           .groupBy("parent", "node").agg((F.sum("blocked") / F.sum("labelled")).alias("share")),
                           "url-branches")
    evidence = branches.groupBy("parent").agg(F.count("*").alias("n"), F.sum("share").alias("shares"))
    above = (placed.select("host", "segments", "labelled", "blocked", F.inline(parents))
             .join(evidence, "parent", "left").join(branches.select("node", "share"), "node", "left"))
    others = F.coalesce(F.col("n") - F.col("share").isNotNull().cast("int"), F.lit(0))
    other_shares = F.coalesce(F.col("shares") - F.coalesce("share", F.lit(0.0)), F.lit(0.0))
    lean = F.aggregate(F.array_sort(F.collect_list(F.struct("level", others.alias("n"), other_shares.alias("shares")))),
                       F.lit(PRIOR), lambda upper, e: (e["shares"] + upper * PRIOR_WEIGHT) / (e["n"] + PRIOR_WEIGHT))
    purity = (F.col("blocked") + F.col("lean") * PRIOR_WEIGHT) / (F.col("labelled") + PRIOR_WEIGHT)
    return (above.groupBy("host", "segments", "labelled", "blocked").agg(lean.alias("lean"))
            .select("host", "segments", purity.alias("purity")))


def template_verdicts(labelled: DataFrame) -> DataFrame:
    """``host, path_segments, template, purity, verdict`` from ``host, path, verdict`` (null: no rule)."""
    tree = (labelled.groupBy("host", path_segments(F.col("path")).alias("path_segments"))
            .agg(F.count("*").alias("urls"), F.count("verdict").alias("labelled"),
                 F.count_if(F.col("verdict") == "block").alias("blocked"))
            .withColumn("segments", F.col("path_segments")))
    tree = materialise(tree, "url-tree")
    for level in _levels(tree, CHILDREN):
        tree = _generalised(tree, level)
    for level in reversed(_levels(tree, 2, LEAST_LABELLED)):
        tree = _merged(tree, level)
    sums = tree.groupBy("host", "segments").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    judged = _purities(sums).withColumn(
        "template_verdict", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return (tree.select("host", "path_segments", "segments").join(judged, ["host", "segments"])
            .select("host", "path_segments", F.concat(F.lit("/"), F.array_join("segments", "/")).alias("template"),
                    "purity", "template_verdict"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of each row.

    A url gets its rule's verdict, or else its template's. Null and malformed urls belong to the
    empty host, which has no label and no parent, and is allowed. Repeated rows are judged each; other
    columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    parsed = materialise(parsed.withColumns({"rule": rule, "verdict": verdict}), "url-parsed")
    # written, so that a host with a third of all urls can be split in the join below
    templates = materialise(template_verdicts(parsed), "url-templates")
    return (parsed.withColumn("path_segments", path_segments(F.col("path")))
            .join(templates, ["host", "path_segments"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", "template_verdict").alias("verdict"), "template", "purity"))
