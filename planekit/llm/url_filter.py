"""URL filtering with a path-template tree, with DataFrame functions only.

Rules come first: a rule ``host/path`` fits its host and all subdomains if the
url's path starts with the rule's; the longest fitting rule decides.  Where no
rule fits, the method does; the pages that a rule decides are its labels.

1. *Templates.*  A path's segments are generalised by form: digit runs become
   ``{n}``, long hexadecimal words and UUIDs ``{x}``; with a ``depth``, segments
   beyond it are one (``judge_urls`` cuts none).  Pages are counted per host and
   generalised path, which is all the tree needs: its size does not follow the
   number of pages.
2. *Tree*, per host, from the root down.  A labelled child of a node becomes
   the wildcard ``*`` where its share of blocked pages, among its labelled ones,
   lies within ``z`` standard errors of all its siblings' together.  A child
   is variable where the node has at least ``fan_out`` children and the child's
   share of pages is below one in ``fan_out`` (a segment that its form did not
   show).  A variable child without labels joins ``*`` only where at least
   ``fan_out`` variable labelled siblings have become it; otherwise such
   children are one branch of their own, ``?``, which no path can hold.  What
   became a wildcard is one branch below; a path that is alone in its node is
   taken whole.
3. *Purity.*  A leaf template with ``b`` blocked of ``n`` labelled pages and
   ``u`` without a label has purity ``(b + (u + weight) / 2) / (n + u + weight)``
   and is rejected from ``reject_at``: pages without labels pull it to one half.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end; null, or no
``://``: both empty.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.session import cut_lineage

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEPTH = 6
FAN_OUT = 30
Z = 1.96
WEIGHT = 4.0
REJECT_AT = 0.8


def with_host_and_path(pages: DataFrame, url: Column) -> DataFrame:
    """Add ``host`` and ``path``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*+", 0)
    path = F.regexp_extract(after, r"^[^/?#]*+([^?#]*+)", 1)
    return pages.withColumns({
        "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase), "path": path})


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, h, p in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def template_segments(path: Column, depth: int | None = DEPTH) -> Column:
    """The path's segments, generalised by form."""
    def form(s: Column) -> Column:
        coded = s.rlike("^(?=.*[0-9])[0-9A-Fa-f]{8,}+$") | s.rlike("^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")
        return F.when(coded & ~s.rlike("^[0-9]++$"), "{x}").otherwise(F.regexp_replace(s, "[0-9]++", "{n}"))

    parts = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), form)
    if depth is None:
        return parts
    return F.when(F.size(parts) <= depth, parts).otherwise(F.concat(F.slice(parts, 1, depth - 1), F.array(F.lit("**"))))


def _grown(tree: DataFrame, level: int, fan_out: int, z: float) -> DataFrame:
    """Each row's template (``node``) one level longer, children merged where they should be."""
    at = F.get("segments", F.lit(level))
    here = tree.withColumn("child", F.coalesce(at, F.lit("")))
    below = (F.size("segments") > level) & ~F.col("ended")
    child = (here.where(below).groupBy("host", "node", "child")
             .agg(F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("blocked").alias("blocked"),
                  F.count(F.lit(1)).alias("paths")))
    node = child.groupBy("host", "node").agg(
        F.sum("n").alias("all_n"), F.sum("known").alias("all_known"), F.sum("blocked").alias("all_blocked"),
        F.count(F.lit(1)).alias("children"), F.count(F.when(F.col("known") > 0, 1)).alias("labelled"),
        F.sum("paths").alias("paths"))
    share, rate = (F.try_divide(F.col(b), F.col(k)) for b, k in (("blocked", "known"), ("all_blocked", "all_known")))
    error = F.sqrt(rate * (1 - rate) / F.nullif(F.col("known"), F.lit(0)))
    fits = (F.col("labelled") > 1) & F.coalesce(F.abs(share - rate) <= z * error, F.lit(False))
    variable = (F.col("children") >= fan_out) & (F.col("n") * fan_out < F.col("all_n"))
    told = child.drop("paths").join(node, ["host", "node"]).withColumns({"fits": fits, "variable": variable})
    agreed = told.groupBy("host", "node").agg(F.count(F.when(F.col("fits") & F.col("variable"), 1)).alias("agreed"))
    named = told.join(agreed, ["host", "node"]).select(
        "host", "node", "child", "paths",
        F.when(F.col("fits"), "*")
        .when(F.col("variable") & (F.col("known") == 0), F.when(F.col("agreed") >= fan_out, "*").otherwise("?"))
        .otherwise(F.col("child")).alias("name"))
    longer = here.join(named, ["host", "node", "child"], "left")
    alone = below & (F.col("paths") == 1)
    rest = F.array_join(F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0))), "/")
    return longer.withColumns({
        "node": F.when(alone, F.concat_ws("/", "node", rest)).when(below, F.concat_ws("/", "node", "name"))
        .otherwise(F.col("node")),
        "ended": F.col("ended") | F.coalesce(alone, F.lit(False))}).select(*tree.columns)


def templates(labelled: DataFrame, depth: int | None = DEPTH, fan_out: int = FAN_OUT, z: float = Z,
              weight: float = WEIGHT, reject_at: float = REJECT_AT) -> DataFrame:
    """``host, form, template, purity, rejected`` from ``host, path, label`` (``allow``, ``block`` or null)."""
    forms = labelled.select("host", template_segments(F.col("path"), depth).alias("segments"),
                            F.col("label").isNotNull().cast("long").alias("known"),
                            F.coalesce(F.col("label") == "block", F.lit(False)).cast("long").alias("blocked"))
    tree = cut_lineage(forms.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"), F.sum("known").alias("known"), F.sum("blocked").alias("blocked"))
        .withColumns({"node": F.lit(""), "ended": F.lit(False)}))
    level = 0
    while (tree.where(~F.col("ended")).agg(F.max(F.size("segments"))).first()[0] or 0) > level:
        tree = cut_lineage(_grown(tree, level, fan_out, z))
        level += 1
    unknown = F.sum("n") - F.sum("known")
    purity = (F.sum("blocked") + (unknown + weight) / 2) / (F.sum("n") + weight)
    leaves = tree.groupBy("host", "node").agg(purity.alias("purity"))
    return tree.join(leaves, ["host", "node"]).select(
        "host", F.array_join("segments", "/").alias("form"), F.col("node").alias("template"), "purity",
        (F.col("purity") >= reject_at).alias("rejected"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               depth: int | None = None, **kw) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``, one row per input row."""
    base = with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    base = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("label"))
    # a table of its own, so that the join is of two plain shuffles and a hot host's can be split
    tree = cut_lineage(templates(base, depth, **kw))
    form = F.array_join(template_segments(F.col("path"), depth), "/")
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return (base.withColumn("form", form).join(tree, ["host", "form"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"),
                    "template", "purity"))
