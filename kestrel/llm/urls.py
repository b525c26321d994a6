"""URL filter: host and path rules, then a tree of path templates per host.

Segments of a path are generalised level by level from the root.  First by
their form (digit runs read ``{n}``, long opaque names ``{x}``).  Then by counts:
below a node with more than ``max_children`` different children, those with less
than ``min_share`` of its pages and fewer than ``min_labels`` labelled ones, too few
to tell, become the wildcard ``*``.  Then siblings, rare or not, are merged
into ``*`` that are statistically like the rest: the form of what follows them
differs by at most ``max_shape`` (total variation) from all children of the
node, and their share of bad labels by no more than ``max_z`` standard errors.
A template is rejected when its smoothed share of bad labels reaches
``reject``: counts are smoothed towards the host's share, and that towards the
share of all.

Defined cases: a null URL, or one without ``://``, has an empty host and path (a
template of its own); segments from ``max_depth`` on are one segment together;
null ids have no labels; repeated labels of an id are one, bad if any is; each row is
judged by itself; an empty table gives an empty result.

Plan: pages are reduced to distinct (host, segment forms) with counts by partial
aggregation before anything else, so the levels work on a small table; every
step is a hash aggregate or a join of stored tables, and a hot host or template
meets as partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import stored

#: (verdict, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
MAX_CHILDREN = 20
MIN_SHARE = 0.02
MIN_LABELS = 10  # as many as SMOOTHING: from there on a branch of bad labels alone is rejected
MAX_SHAPE = 0.25
MAX_Z = 2.0
SMOOTHING = 10.0
REJECT = 0.5
MAX_DEPTH = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = None
    for what, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        a, b = F.lit(name + start), F.lit(what)
        rule = F.when(fits, a) if rule is None else rule.when(fits, a)
        verdict = F.when(fits, b) if verdict is None else verdict.when(fits, b)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def segment_forms(path: Column, max_depth: int = MAX_DEPTH) -> Column:
    """A path's segments by form; the last may hold several."""
    parts = F.when(path == "", F.array().cast("array<string>")) \
        .otherwise(F.split(F.regexp_replace(path, "^/", ""), "/", -1))
    head = F.slice(parts, 1, max_depth - 1)
    tail = F.array_join(F.slice(parts, max_depth, F.greatest(F.size(parts) - max_depth + 1, F.lit(0))), "/")
    whole = F.when(F.size(parts) >= max_depth, F.concat(head, F.array(tail))).otherwise(parts)
    # the marks of the forms must not occur in plain names
    plain = F.transform(whole, lambda s: F.replace(F.replace(s, F.lit("{"), F.lit("%7B")), F.lit("*"), F.lit("%2A")))
    opaque = r"^(?=[^/]*[0-9])[0-9A-Za-z_-]{16,}$"
    return F.transform(plain, lambda s: F.when(s.rlike(opaque), F.lit("{x}"))
                       .otherwise(F.regexp_replace(s, "[0-9]+", "{n}")))


def forms(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
          label_id: str = "doc_id", bad: Column | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(id, host, path, form, bad) per page, stored; bad is null without a label."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0) if bad is None else bad
    marks = labels.select(F.col(label_id).alias("l_id"), bad.alias("bad")).groupBy("l_id").agg(F.max("bad").alias("bad"))
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("__url")) \
        .select("id", host.alias("host"), path.alias("path"))
    return stored(rows.join(marks, rows["id"] == marks["l_id"], "left")
                  .select("id", "host", "path", segment_forms(F.col("path"), max_depth).alias("form"),
                          F.col("bad").cast("long").alias("bad")), "forms")


def templates(rows: DataFrame, max_children: int = MAX_CHILDREN, min_share: float = MIN_SHARE,
              max_shape: float = MAX_SHAPE, max_z: float = MAX_Z, min_labels: int = MIN_LABELS) -> DataFrame:
    """(host, form, template, n, lab, bad) per distinct host and form, stored."""
    tree = stored(rows.groupBy("host", "form").agg(
        F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("template", F.lit("")), "tree")
    deepest = tree.agg(F.max(F.size("form"))).first()[0] or 0
    for k in range(deepest):
        here = tree.filter(F.size("form") > k).withColumn("child", F.col("form")[k]) \
            .withColumn("shape", F.when(F.size("form") > k + 1,
                                        F.regexp_replace(F.col("form")[k + 1], r"[\p{L}%]+", "a")).otherwise("/"))
        sums = [F.sum(c).alias(c) for c in ("n", "lab", "bad")]
        children = here.groupBy("host", "template", "child").agg(*sums)
        parents = stored(children.groupBy("host", "template").agg(
            F.count("*").alias("children"), F.sum("n").alias("p_n"), F.sum("lab").alias("p_lab"),
            F.sum("bad").alias("p_bad")).filter("children > 1"), "parents")
        if parents.isEmpty():
            decided = None
        else:
            shapes = here.groupBy("host", "template", "child", "shape").agg(F.sum("n").alias("s_n"))
            of_all = shapes.groupBy("host", "template", "shape").agg(F.sum("s_n").alias("a_n"))
            # 1 - sum of the lesser shares over the child's own shapes is the total variation
            common = shapes.join(of_all, ["host", "template", "shape"]).join(parents, ["host", "template"]) \
                .join(children.select("host", "template", "child", F.col("n").alias("c_n")), ["host", "template", "child"]) \
                .groupBy("host", "template", "child") \
                .agg(F.round(1 - F.sum(F.least(F.col("s_n") / F.col("c_n"), F.col("a_n") / F.col("p_n"))), 9).alias("apart"))
            rate = F.col("p_bad") / F.col("p_lab")
            error = F.sqrt(rate * (1 - rate) / F.col("lab"))
            alike = (F.col("lab") == 0) | (F.abs(F.col("bad") / F.col("lab") - rate) <= max_z * error)
            rare = (F.col("children") > max_children) & (F.col("n") < min_share * F.col("p_n")) \
                & (F.col("lab") < min_labels)
            decided = stored(children.join(parents, ["host", "template"]).join(common, ["host", "template", "child"])
                             .filter(rare | ((F.col("apart") <= max_shape) & alike))
                             .select("host", "template", "child", F.lit(True).alias("any")), "decided")
        child = F.col("form")[k]
        grown = tree.withColumn("child", F.when(F.size("form") > k, child))
        grown = grown.withColumn("any", F.lit(None).cast("boolean")) if decided is None else \
            grown.join(decided, ["host", "template", "child"], "left")
        name = F.when(F.col("any"), F.lit("*")).otherwise(F.col("child"))
        tree = stored(grown.withColumn("template", F.when(F.col("child").isNull(), F.col("template"))
                                       .otherwise(F.concat("template", F.lit("/"), name)))
                      .select("host", "form", "template", "n", "lab", "bad"), "tree")
    return tree


def purities(tree: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(host, template, bad_share): smoothed over the host and all."""
    per_host = tree.groupBy("host").agg(F.sum("lab").alias("h_lab"), F.sum("bad").alias("h_bad"))
    all_lab, all_bad = tree.agg(F.coalesce(F.sum("lab"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = F.lit(all_bad / all_lab if all_lab else 0.0)
    per_host = per_host.select("host", ((F.col("h_bad") + smoothing * prior) / (F.col("h_lab") + smoothing)).alias("h_share"))
    return tree.groupBy("host", "template").agg(F.sum("lab").alias("lab"), F.sum("bad").alias("bad")) \
        .join(per_host, "host") \
        .select("host", "template",
                ((F.col("bad") + smoothing * F.col("h_share")) / (F.col("lab") + smoothing)).alias("bad_share"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules=RULES, reject: float = REJECT, **options) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, template."""
    rows = forms(pages, labels, id_col, url_col)
    tree = templates(rows, **options)
    judged = stored(tree.join(purities(tree), ["host", "template"])
                    .select("host", "form", "template", (F.col("bad_share") >= reject).alias("rejected")), "templates")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    found = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "form"]).select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, found).alias("verdict"), "template")
