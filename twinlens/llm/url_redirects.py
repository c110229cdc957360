"""URL filters with redirect equivalence (operator 3), DataFrame functions only.

A url's verdict is that of its longest fitting rule. Urls without a rule share
the decisions of their aliases: urls that differ only in scheme, query,
fragment, a trailing slash or ``.html`` are one node, and nodes linked by
canonical links, refresh redirects in the page or rows of a redirect table form
components. Linked urls count with their rules whether or not they are rows of
``pages``. In a component an explicit allow goes before any block; without
either the verdict is allow. A rule that fits the url itself always decides.

Nodes are summed up before anything is linked, so a url repeated by a third of
all rows is one node; pages never cross a shuffle, only urls' keys do.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule, is linked to nothing and is allowed; equal rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinlens.llm.common import ascii_lower, connected_components
from twinlens.session import materialize

#: Verdict, host and path of the rules.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
CANONICAL = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(h: Column, p: Column, rules=RULES) -> Column:
    """Struct of the longest fitting rule's string and verdict; null without one."""
    out = F.lit(None)
    for verdict, rh, rp in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((h == rh) | F.endswith(h, F.lit("." + rh))) & F.startswith(p, F.lit(rp))
        out = F.when(fits, F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def node(url: Column) -> Column:
    """Hash of host and path without a trailing slash or ``.html``; null where there is no host."""
    h, p = host(url), F.regexp_replace(path(url), r"(?:/|\.html?)$", "")
    return F.when(h != "", F.xxhash64(h, p))


def resolved(base: Column, to: Column) -> Column:
    """``to`` as a whole url: an absolute one as it is, any other against the page's url ``base``.

    Without ``.`` and ``..`` segments. Null where ``to`` is empty, names
    another scheme without ``//`` (``mailto:``), or ``base`` has no host.
    """
    site = F.regexp_extract(base, r"^((?s:.*?)://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^((?s:.*?):)//", 1)
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    joined = (F.when(F.startswith(to, F.lit("//")), F.concat(scheme, to))
              .when(F.startswith(to, F.lit("/")), F.concat(site, to))
              .when(F.startswith(to, F.lit("?")) | F.startswith(to, F.lit("#")), F.concat(site, path(base), to))
              .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), to)))
    segments = F.split(F.regexp_replace(path(joined), "^/", ""), "/", -1)
    dot = F.lit(".")
    up = F.lit("..")
    walked = F.aggregate(segments, F.array().cast("array<string>"), lambda out, x: F.when(
        x == up, F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(x == dot, out).otherwise(
        F.concat(out, F.array(x))))
    # a path that ends in a dot segment names a folder
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit("")))
    whole = F.concat(walked, F.coalesce(tail, F.array().cast("array<string>")))
    straight = F.when(path(joined).rlike(r"(?:^|/)\.{1,2}(?:/|$)"), F.concat(
        F.regexp_extract(joined, r"^((?s:.*?)://[^/?#]*)", 1), F.lit("/"), F.array_join(whole, "/"),
        F.regexp_extract(joined, r"^(?s:.*?)://[^/?#]*[^?#]*((?s:.*))$", 1))).otherwise(joined)
    return F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to).when(
        (to != "") & (host(base) != "") & ~to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), straight)


def page_links(pages: DataFrame) -> DataFrame:
    """``(a, b, to)``: nodes that a page links to itself by a canonical link or a refresh redirect, and the target's url."""
    html = F.coalesce("html", F.lit(""))
    targets = F.array(F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
                      F.regexp_extract(F.regexp_extract(html, REFRESH, 0), REFRESH_URL, 1))
    found = pages.where(html.rlike(r"(?i)canonical|http-equiv")).select("url", F.explode(targets).alias("to"))
    whole = found.select("url", resolved(F.col("url"), F.col("to")).alias("to"))
    return whole.select(node(F.col("url")).alias("a"), node(F.col("to")).alias("b"), "to")


def judge(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page; ``redirects`` has ``source_url, target_url``."""
    url = F.col("url")
    df = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), node(url).alias("node"))
    df = df.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    # written out: the pages' texts are read once for the links and their targets
    linked = materialize(page_links(pages).where(F.col("a").isNotNull() & F.col("b").isNotNull()), "url-links")
    edges, ends = linked.select("a", "b"), linked.select(F.col("to").alias("url"))
    if redirects is not None:
        edges = edges.union(redirects.select(node(F.col("source_url")), node(F.col("target_url"))))
        ends = ends.union(redirects.select(F.explode(F.array("source_url", "target_url"))))
    extra = ends.select(node(url).alias("node"), rule_of(host(url), path(url), rules).alias("r"))
    said = df.select("node", "r").union(extra)
    nodes = materialize(said.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.max(F.coalesce(F.col("r.verdict") == "allow", F.lit(False))).alias("allow"),
        F.max(F.coalesce(F.col("r.verdict") == "block", F.lit(False))).alias("block")), "url-nodes")
    roots = connected_components(edges, "a", "b").withColumnRenamed("node", "member")
    # both sides are written out, so that the join on the root can be split where a component has many urls
    rooted = materialize(nodes.join(roots, F.col("node") == F.col("member"), "left").withColumn(
        "root", F.coalesce("root", "node")), "url-rooted")
    groups = materialize(rooted.groupBy("root").agg(
        F.max("allow").alias("any_allow"), F.max("block").alias("any_block")), "url-groups")
    # written out, so that a node of many pages can be split in the join
    state = materialize(rooted.select(F.col("node").alias("member"), "root").join(groups, "root").select(
        "member", (F.col("any_block") & ~F.col("any_allow")).alias("shared_block")), "url-states")
    out = df.join(state, F.col("node") == F.col("member"), "left")
    verdict = F.when(F.col("r").isNotNull(), F.col("r.verdict")).when(
        F.coalesce("shared_block", F.lit(False)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))
