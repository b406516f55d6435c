"""URL filters by a path-template tree (DataFrame operations only).

Rules come first: a rule ``host/path`` fits its host and all subdomains if the url's path
starts with the rule's path, and the longest fitting rule decides.  Urls no rule fits are
judged by templates learnt from labelled urls:

1. *Tree.*  A host's urls form a tree of path segments, built from the root down, one level
   at a time.  A node is named by its parent and its own *generalised* segment, so whatever
   lies below a wildcard is pooled.
2. *Wildcards.*  A node with more than ``max_children`` distinct segments generalises them to
   ``*``, however many urls they hold; only a segment whose own labels differ significantly
   from the node's and give it another verdict stays literal.  Elsewhere a segment with
   digits falls back to its shape (digit runs and long hex runs become a mark).  From
   ``max_depth`` segments on, the rest of a path is ``**``.
3. *Merging.*  From the deepest position up, templates equal but for a literal segment at
   that position are pooled per host.  A template whose labelled share does not differ
   significantly from its pool's (two-sided test at ``z`` standard errors; one without labels
   never does) joins it and counts with it from then on; a differing one stays apart.
4. *Verdict.*  The rejected share of a (merged) template is smoothed towards its host's share,
   and that towards the corpus share (``prior`` pseudo-counts each).  A template is rejected
   from ``reject_from`` on; hosts without labels inherit the corpus share.

All counts cover all urls.  Urls are stored once and again after each level, with the
segments used up dropped.  Counts are pre-aggregated in each task; the tables of wildcard nodes,
of literal segments and of templates are joined back by broadcast when a count shows at most
``SMALL_ROWS`` rows, so the urls of a hot host are not brought together, and otherwise by a
shuffle with AQE's skew handling.

Defined cases: NULL urls and urls without ``://`` have empty host and path; the rule path
must be a prefix of the url path, so an empty path fits no rule; NULL labels are no labels;
very long urls are judged by their first ``max_depth`` segments; repeated pages count each
time; repeated labels of an id are averaged; of equally long rules one fits at most; an empty
label table gives the verdict ``allow``, an empty page table an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import pick, stored

#: (action, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))


#: Segments of a path that the tree distinguishes.
MAX_DEPTH = 12
#: Rows of a table (of some 50 bytes) that may be broadcast.
SMALL_ROWS = 100_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substr(url, F.instr(url, "://") + F.lit(3))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, lower).otherwise(""), F.when(has, path).otherwise("")


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its action (NULL if none fits)."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Each rule wraps the shorter ones, so the longest fitting rule is asked first.
    for what, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(action)
    return rule, action


def _name(*parts: Column) -> Column:
    """16-byte name of some parts: as many urls as a crawl holds collide in 64 bits."""
    return F.unhex(F.md5(F.concat_ws("\x00", *[c.cast("string") for c in parts])))


def _shape(segment: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(segment, r"[0-9a-fA-F]{16,}", "<x>"), r"[0-9]+", "<n>")


def _smooth(bad: Column, n: Column, towards: Column, prior: float) -> Column:
    return (bad + F.lit(prior) * towards) / (n + F.lit(prior))


def _small(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if it is small."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _differs(bad: Column, n: Column, share: Column, z: float) -> Column:
    """Is the share of ``n`` labels further than ``z`` standard errors from ``share``?"""
    return F.abs(bad / F.nullif(n, F.lit(0.0)) - share) > F.lit(z) * F.sqrt(share * (1 - share) / F.nullif(n, F.lit(0.0)))


def templates(urls: DataFrame, max_children: int, prior: float, z: float, reject_from: float, max_depth: int) -> DataFrame:
    """``urls`` (key, host, path, n, bad) -> key, host, n, bad and ``template``, the path's
    segments with variable ones generalised."""
    spark = urls.sparkSession
    tree = urls.select("key", "host", "n", "bad", F.md5("host").alias("node"),
                       F.when(F.col("path") != "", F.split(F.substr(F.col("path"), F.lit(2)), "/")).alias("rest"),
                       F.array().cast("array<string>").alias("template"))
    tree = stored(tree.withColumn("rest", F.coalesce("rest", F.array().cast("array<string>"))), spark, "url-tree")
    for depth in range(max_depth):
        inner = tree.where(F.size("rest") > 0).withColumn("segment", F.get("rest", F.lit(0)))
        labelled = F.when(F.col("bad").isNotNull(), F.col("n"))
        per_segment = inner.groupBy("node", "segment").agg(
            F.coalesce(F.sum(labelled), F.lit(0)).cast("double").alias("seg_n"),
            F.coalesce(F.sum(F.col("bad") * F.col("n")), F.lit(0.0)).alias("seg_bad"))
        per_segment = stored(per_segment, spark, f"url-segments-{depth}")
        if per_segment.isEmpty():
            break
        variable = per_segment.groupBy("node").agg(
            F.count("*").alias("kinds"), F.sum("seg_n").alias("all_n"), F.sum("seg_bad").alias("all_bad")) \
            .where(F.col("kinds") > max_children)
        share = F.col("all_bad") / F.nullif(F.col("all_n"), F.lit(0.0))
        turned = (_smooth(F.col("seg_bad"), F.col("seg_n"), share, prior) >= F.lit(reject_from)) != (share >= F.lit(reject_from))
        literal = per_segment.where("seg_n > 0").join(variable, "node").where(
            _differs(F.col("seg_bad"), F.col("seg_n"), share, z) & turned).select("node", "segment")
        # Wildcard nodes (no segment) and the segments of theirs that stay literal.
        wild = stored(variable.select("node", F.lit(None).cast("string").alias("segment")).union(literal), spark, f"url-wild-{depth}")
        few = wild.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
        variable = wild.where("segment IS NULL").select("node", F.lit(True).alias("variable"))
        literal = wild.where("segment IS NOT NULL").withColumn("literal", F.lit(True))
        segment = F.get("rest", F.lit(0))
        # Marks of the method cannot be mistaken for the text of a segment.
        plain = F.replace(F.replace(F.replace(F.col("segment"), F.lit("*"), F.lit("%2A")), F.lit("<"), F.lit("%3C")),
                          F.lit("+"), F.lit("%2B"))
        mark = (F.when(F.col("literal"), plain).when(F.col("variable"), F.lit("*")).otherwise(_shape(plain)))
        tree = (tree.withColumn("segment", segment)
                .join(F.broadcast(variable) if few else variable, "node", "left")
                .join(F.broadcast(literal) if few else literal, ["node", "segment"], "left").withColumn("mark", mark)
                .select("key", "host", "n", "bad",
                        F.when(F.col("mark").isNull(), F.col("node")).otherwise(F.md5(F.concat("node", F.lit("/"), "mark"))).alias("node"),
                        F.when(F.size("rest") > 0, F.expr("slice(rest, 2, greatest(size(rest) - 1, 0))")).otherwise(F.col("rest"))
                        .alias("rest"),
                        F.when(F.col("mark").isNull(), F.col("template")).otherwise(F.concat("template", F.array("mark")))
                        .alias("template")))
        tree = stored(tree, spark, f"url-tree-{depth}")
    deeper = F.when(F.size("rest") > 0, F.concat("template", F.array(F.lit("**")))).otherwise(F.col("template"))
    return tree.select("key", "host", "n", "bad", deeper.alias("template"))


def merged_counts(counts: DataFrame, z: float, max_depth: int) -> DataFrame:
    """counts (host, template, n, bad) -> host, template and the counts of the pool each
    template has joined."""
    spark = counts.sparkSession
    groups = stored(counts.withColumn("group", F.col("template")), spark, "url-groups")
    deepest = groups.agg(F.max(F.size("group"))).first()[0] or 0
    for at in reversed(range(min(deepest, max_depth))):
        here = F.get("group", F.lit(at))
        open_ = here.isNotNull() & ~here.rlike("[*<+]")
        pool = F.when(open_, F.concat(F.slice("group", F.lit(1), F.lit(at)), F.array(F.lit("+")),
                                      F.expr(f"slice(group, {at + 2}, greatest(size(group) - {at + 1}, 0))")))
        own = groups.groupBy("host", "group").agg(F.sum("n").alias("own_n"), F.sum("bad").alias("own_bad"))
        own = own.withColumn("pool", pool).where(F.col("pool").isNotNull())
        pools = own.groupBy("host", "pool").agg(F.sum("own_n").alias("pool_n"), F.sum("own_bad").alias("pool_bad"),
                                                F.count("*").alias("members")).where("members > 1")
        share = F.col("pool_bad") / F.nullif(F.col("pool_n"), F.lit(0.0))
        joins = own.join(pools, ["host", "pool"]).where(
            ~F.coalesce(_differs(F.col("own_bad"), F.col("own_n"), share, z), F.lit(False))).select("host", "group", "pool")
        joins = stored(joins, spark, f"url-pools-{at}")
        groups = stored(groups.join(_small(joins), ["host", "group"], "left").select(
            "host", "template", "n", "bad", F.coalesce("pool", "group").alias("group")), spark, f"url-groups-{at}")
    total = groups.groupBy("host", "group").agg(F.sum("n").alias("m_n"), F.sum("bad").alias("m_bad"))
    return groups.select("host", "template", "group").join(total, ["host", "group"])


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, label_id: Column | None = None,
          bad: Column | None = None, max_children: int = 20, prior: float = 20.0, z: float = 1.96,
          reject_from: float = 0.5, max_depth: int = MAX_DEPTH) -> DataFrame:
    """page_id, host, path, rule, verdict, template, score, for every page.

    ``label_id``: the labelled id a url stands for (default: the last number of its path);
    ``bad``: 1 for a rejected label (default: quality 0)."""
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    p = pick(pages, page_id="bigint", url="string").withColumns({"host": host, "path": path})
    if label_id is None:
        label_id = F.regexp_extract("path", r"([0-9]{1,18})[^0-9/]*/?$", 1).try_cast("bigint")
    p = stored(p.withColumns({"key": _name(F.col("host"), F.col("path")), "label_id": label_id}).drop("url"), spark, "url-pages")
    bad = 1 - F.col("quality") if bad is None else bad
    marks = labels.select(F.col("doc_id").cast("bigint").alias("label_id"), bad.cast("double").alias("bad")) \
        .where("label_id IS NOT NULL AND bad IS NOT NULL").groupBy("label_id").agg(F.avg("bad").alias("bad"))
    urls = p.groupBy("key", "host", "path").agg(F.count("*").alias("n"), F.first("label_id").alias("label_id"))
    urls = templates(urls.join(marks, "label_id", "left"), max_children, prior, z, reject_from, max_depth)
    labelled = F.when(F.col("bad").isNotNull(), F.col("n"))
    counts = stored(urls.groupBy("host", "template").agg(
        F.coalesce(F.sum(labelled), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum(F.col("bad") * F.col("n")), F.lit(0.0)).alias("bad")), spark, "url-counts")
    hosts = counts.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("bad").alias("host_bad"))
    all_n, all_bad = counts.agg(F.sum("n"), F.sum("bad")).first()
    base = F.lit(float((all_bad or 0.0) / (all_n or 1.0)))
    host_share = _smooth(F.col("host_bad"), F.col("host_n"), base, prior)
    scores = stored(merged_counts(counts, z, max_depth).join(hosts, "host").select(
        "host", "template", _smooth(F.col("m_bad"), F.col("m_n"), host_share, prior).alias("score")), spark, "url-scores")
    scored = urls.join(_small(scores), ["host", "template"]).select(
        "key", F.concat(F.when(F.size("template") > 0, F.lit("/")).otherwise(""), F.array_join("template", "/")).alias("template"), "score")
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= F.lit(reject_from), F.lit("block")).otherwise(F.lit("allow"))
    return p.join(scored, "key").select("page_id", "host", "path", rule.alias("rule"),
                                        F.coalesce(action, own).alias("verdict"), "template", "score")
