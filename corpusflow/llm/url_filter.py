"""URL filters: host rules first, then a path-template tree per host.

The tree grows from the root. Under one node (host and template so far) a
segment stays literal if it has enough urls and either holds a fair part of
the node's urls or a labelled rate that differs from the node's; all other
segments become one wildcard. Where all urls of a branch go on alike, they go
on to the next difference at once, so the rounds follow the branching and not
the depth. From the last nodes up, children of one node whose labelled rates
do not differ statistically from the node's are merged and go on as one child
of the node above; the others are judged on their own. A group whose smoothed
share of bad labels is high is rejected. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.plans.strategy import bounded_broadcast, materialize

#: (verdict, host suffix, path prefix); the longest fitting rule wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A literal segment has at least this many urls, and a node this many that go on.
MIN_URLS = 4
#: It also holds at least the square root of its node's urls, divided by this.
ROOT_PART = 4.0
#: From this position on, segments too rare to be literal in their host's paths
#: are wildcards before the tree grows (the same result, in fewer rounds).
DEEP = 8
#: Children within this many standard errors of their node's rate are merged.
MERGE_Z = 1.96
#: Weight of the overall bad rate in a group's smoothed bad share, and the
#: share from which the group is rejected.
PRIOR_WEIGHT, REJECT_AT = 8.0, 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; '' without."""
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``; '' without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls. A rule
    fits its host and all subdomains, and paths that start with its path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, suffix, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):  # a longer one wraps a shorter one
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _wildcard(segment: Column) -> Column:
    """``*`` with the segment's file suffix, if it has one."""
    return F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1))


def _common(lo: Column, hi: Column) -> Column:
    """Length of the common beginning of two arrays: that of all arrays
    between them in order."""
    differ = F.array_position(F.zip_with(lo, hi, lambda a, b: a.eqNullSafe(b)), False)
    return F.when(differ == 0, F.size(lo)).otherwise(differ - 1).cast("int")


def _shown(token: Column) -> Column:
    """``=x`` is the segment x; other tokens are wildcards."""
    return F.when(token.startswith("="), F.substr(token, F.lit(2))).otherwise(token)


def _as_wildcard(token: Column) -> Column:
    return F.when(token.startswith("="), _wildcard(F.substr(token, F.lit(2)))).otherwise(token)


def _path_tokens(paths: DataFrame, min_urls: int) -> DataFrame:
    """Adds ``_tok``: the path's segments as ``=segment``, or as a wildcard
    where the segment itself starts with ``*`` or stands at position ``DEEP``
    or later with fewer than ``min_urls`` urls of its host.

    Only paths that reach so far are taken apart, and only they have segments
    there, so the counts are whole."""
    segs = F.split(F.regexp_replace("path", "^/", ""), "/")
    token = lambda x: F.when(x.startswith("*"), _wildcard(x)).otherwise(F.concat(F.lit("="), x))
    t = paths.withColumn("_tok", F.transform(segs, token))
    deep = t.where(F.size("_tok") > DEEP)
    parts = deep.select("host", "path", "w", F.posexplode(F.slice("_tok", DEEP + 1, 2**31 - 1)).alias("_i", "_t"))
    often = parts.groupBy("host", "_i", "_t").agg(F.sum("w").alias("_n")).where(F.col("_n") >= min_urls).select("host", "_i", "_t", F.lit(True).alias("_often"))
    marked = parts.join(often, ["host", "_i", "_t"], "left").withColumn("_t", F.when(F.col("_often"), F.col("_t")).otherwise(_as_wildcard(F.col("_t"))))
    tails = marked.groupBy("host", "path").agg(F.sort_array(F.collect_list(F.struct("_i", "_t"))).alias("_tail"))
    deep = deep.join(tails, ["host", "path"]).withColumn("_tok", F.concat(F.slice("_tok", 1, DEEP), F.col("_tail._t"))).drop("_tail")
    return t.where(F.size("_tok") <= DEEP).unionByName(deep)


def _steps(branches: DataFrame, min_urls: int) -> DataFrame:
    """(host, template, _s, step, take): what each segment of a node becomes,
    and how many tokens of the paths that makes up (null: all that are left).

    A segment is literal with at least ``min_urls`` urls, if it holds a fair
    part of its node's urls (``ROOT_PART``), or if its labelled rate is further from
    the node's than the largest of as many normal deviates as the node has
    such segments. So ids that recur do not become literals as the table
    grows, and a small section that is labelled otherwise does."""
    b = branches.withColumn("_cand", F.col("_s").startswith("=") & (F.col("n") >= min_urls))
    node = b.groupBy("host", "template").agg(
        F.sum("n").alias("_n"), F.sum("lab").alias("_lab"), F.sum("bad").alias("_bad"),
        F.count_if("_cand").alias("_d"), F.count(F.lit(1)).alias("_k"),
    )
    b = b.join(node, ["host", "template"])
    rate = F.col("_bad") / F.greatest("_lab", F.lit(1))
    z = F.lit(MERGE_Z) + F.sqrt(F.lit(2.0) * F.log(F.greatest(F.col("_d"), F.lit(1)).cast("double")))
    other = F.abs(F.col("bad") - F.col("lab") * rate) > z * F.sqrt(F.col("lab") * rate * (F.lit(1.0) - rate))
    literal = F.col("_cand") & ((F.lit(ROOT_PART) * F.col("n") >= F.sqrt("_n")) | other)
    ahead = F.slice("lo", 1, _common(F.col("lo"), F.col("hi")))
    alike = F.concat(F.lit("/"), F.array_join(F.transform(ahead, _shown), "/"))
    one = F.concat(F.lit("/"), _as_wildcard(F.col("_s")))
    ends = F.col("_n") < min_urls
    on = literal | (F.col("_k") == 1)  # nothing else can join this branch
    return b.select(
        "host", "template", "_s", F.when(on, alike).otherwise(one).alias("step"),
        F.when(ends, F.lit(None)).when(on, F.size(ahead)).otherwise(F.lit(1)).cast("int").alias("take"),
    )


def path_templates(paths: DataFrame, min_urls: int = MIN_URLS) -> DataFrame:
    """Adds ``template`` and ``starts`` to rows ``host, path, w, lab, bad``
    (distinct paths; urls, labelled urls, bad urls): the template of the whole
    path, and how many segments each node on its way has, the root first.

    One partial aggregate per round gives the counts of a node's segments and
    the least and greatest of what follows them, whose common beginning is
    that of the whole branch. Only rows with segments left go on; a node with
    fewer than ``min_urls`` urls that go on has no node below, and what remains
    of their paths becomes wildcards at once."""
    t = _path_tokens(paths, min_urls).withColumn("template", F.lit("")).withColumn("starts", F.array(F.lit(0)))
    out = None
    while True:
        t = materialize(t, "templates")
        ended = t.where(F.size("_tok") == 0)
        out = ended if out is None else out.unionByName(ended)
        t = t.where(F.size("_tok") > 0).withColumn("_s", F.get("_tok", F.lit(0)))
        branches = materialize(t.groupBy("host", "template", "_s").agg(
            F.sum("w").alias("n"), F.sum("lab").alias("lab"), F.sum("bad").alias("bad"), F.min("_tok").alias("lo"), F.max("_tok").alias("hi"),
        ), "segments")
        if not branches.head(1):
            return out.drop("_tok")
        steps, _ = bounded_broadcast(_steps(branches, min_urls))
        take, rest = F.col("take"), F.concat(F.lit("/"), F.array_join(F.transform("_tok", _as_wildcard), "/"))
        t = t.join(steps, ["host", "template", "_s"]).select(
            "host", "path", "w", "lab", "bad",
            F.when(take.isNull(), F.array().cast("array<string>")).otherwise(F.slice("_tok", F.coalesce(take, F.lit(0)) + 1, F.size("_tok"))).alias("_tok"),
            F.concat("template", F.when(take.isNull(), rest).otherwise(F.col("step"))).alias("template"),
            F.when(take.isNull(), F.col("starts")).otherwise(F.concat("starts", F.array(F.element_at("starts", -1) + take))).alias("starts"),
        )


def merge_siblings(leaf: DataFrame) -> DataFrame:
    """(host, template, n, bad) with the counts of the group that each row of
    ``leaf(host, template, starts, n, bad)`` belongs to.

    From the last nodes up, the children of a node are its own leaves and what
    the nodes below it merged to. Those at the node's labelled rate are merged
    and become a child of the node above; each other one is a group, as is
    what reaches a host's root. A leaf belongs to the last group above it. A
    node that is skipped because all its urls go on alike would hand its only
    child on."""
    last = leaf.agg(F.max(F.size("starts"))).first()[0]
    if last is None:
        return leaf.select("host", "template", "n", "bad")
    prefix = "substring_index({0}, '/', element_at(starts, -1) + 1)"
    own = leaf.select(
        "host", "starts", F.expr(prefix.format("template")).alias("node"), F.col("template").alias("origin"),
        F.lit(-1).alias("at"), "n", "bad",
    )
    carry, groups = None, None
    for at in range(last - 1, -1, -1):
        here = own.where(F.size("starts") == at + 1)
        here = here if carry is None else here.unionByName(carry)
        node = here.groupBy("host", "node").agg(F.sum("n").alias("node_n"), F.sum("bad").alias("node_bad"))
        rate = F.col("node_bad") / F.greatest("node_n", F.lit(1))
        # |bad - n p| <= z sqrt(n p (1 - p)): the child may have the node's rate
        near = F.abs(F.col("bad") - F.col("n") * rate) <= F.lit(MERGE_Z) * F.sqrt(F.col("n") * rate * (F.lit(1.0) - rate))
        here = materialize(here.join(node, ["host", "node"]).withColumn("merged", near).drop("node_n", "node_bad"), "url-nodes")
        apart = here.where(~F.col("merged")).select("host", "origin", "at", "n", "bad")
        groups = apart if groups is None else groups.unionByName(apart)
        pool = here.where("merged").groupBy("host", "starts", F.col("node").alias("origin")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        pool = pool.withColumn("starts", F.slice("starts", 1, at)).withColumn("at", F.lit(at))
        carry = pool.select("host", "starts", (F.expr(prefix.format("origin")) if at else F.lit("")).alias("node"), "origin", "at", "n", "bad")
    groups, _ = bounded_broadcast(groups.unionByName(carry.drop("node", "starts")))
    # The leaf itself, then every node above it.
    above = F.expr("transform(starts, (d, i) -> struct(substring_index(template, '/', d + 1) as origin, i as at, i as depth))")
    self_ = F.expr("array(struct(template as origin, -1 as at, size(starts) as depth))")
    up = leaf.select("host", "template", F.explode(F.concat(above, self_)).alias("_p")).select("host", "template", "_p.*")
    found = up.join(groups, ["host", "origin", "at"]).groupBy("host", "template")
    return found.agg(F.max_by(F.struct("n", "bad"), "depth").alias("_g")).select("host", "template", "_g.*")


def judge_urls(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, min_urls: int = MIN_URLS,
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``,
    ``verdict`` (the rule's, else the tree's) and ``template``.

    ``labels(key, bad)`` marks pages by the text of a whole number that stands
    alone in the path (``bad`` 1 or 0; of repeated keys the larger counts).

    Defined cases: a null url or one without ``://`` has an empty host and
    path and is judged like any other; null or missing labels count for
    nothing; repeated rows and null ids are kept; without any label every
    template passes; a segment that itself starts with ``*`` counts as a
    wildcard; an empty table gives no rows; other columns are ignored.
    """
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    p = p.withColumn("rule", rule).withColumn("_verdict", verdict)
    marks = labels.select(F.col("key").cast("string").alias("_key"), F.col("bad").cast("int").alias("bad")).where("_key is not null and bad in (0, 1)")
    marks = marks.groupBy("_key").agg(F.max("bad").alias("_bad"))
    p = p.withColumn("_key", F.regexp_extract("path", r"/([0-9]+)(?:[./]|$)", 1)).join(marks, "_key", "left").drop("_key")
    # The tree sees each path once, with its counts.
    p = materialize(p, "url-pages")
    paths = p.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("w"), F.count("_bad").alias("lab"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")
    )
    t = materialize(path_templates(paths, min_urls), "url-templates")

    leaf = t.groupBy("host", "template", "starts").agg(F.sum("lab").alias("n"), F.sum("bad").alias("bad"))
    leaf = materialize(leaf, "url-leaves")
    whole = leaf.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    prior = whole["bad"] / whole["n"] if whole["n"] else 0.0
    share = (F.col("bad") + F.lit(PRIOR_WEIGHT) * F.lit(float(prior))) / (F.col("n") + F.lit(PRIOR_WEIGHT))
    judged = merge_siblings(leaf).select("host", "template", F.when(share >= REJECT_AT, "block").otherwise("allow").alias("_tree"))
    t = t.select("host", "path", "template").join(judged, ["host", "template"], "left")
    return p.join(t, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_verdict", "_tree", F.lit("allow")).alias("verdict"), "template"
    )
