"""URL filter with redirect equivalence.

Rules allow or block (host, path prefix) pairs; the longest rule that fits a
url decides. A url without a rule takes the decision of its aliases: pages
connected by redirect (meta refresh) and canonical-link edges form a
component, found by distributed connected components, and a block anywhere in
the component blocks every alias that has no allow rule of its own (explicit
allow precedence). All else is allowed. DataFrame functions only.

Defined results
    null url or no ``://``   host and path empty, no rule, allowed
    null or empty html       no edges
    relative link targets    resolved against the page's url
    equal rule lengths       allow wins, then the smaller rule string
    repeated rows            judged one by one, all alike
    empty table              empty result
    extra columns            ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, lower_az, stage
from sievekit.llm.components import connected_components

#: beyond this many rules the rule table is joined instead of inlined
MAX_INLINE_RULES = 200

Rule = tuple[str, str]  # ("example.com/en/", "allow" or "block")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_az(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A url without scheme, fragment and host case: the node of the link graph."""
    rest = F.regexp_extract(url, r"://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), rest))


def _parts(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host.lower(), "/" + path


def _fits(rule: str, host: Column, path: Column) -> Column:
    rule_host, rule_path = _parts(rule)
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def with_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rule`` and ``decision`` (null where no rule fits) to rows that
    have ``host`` and ``path``."""
    ranked = sorted(set(rules), key=lambda r: (-len(r[0]), r[1], r[0]))
    if len(ranked) <= MAX_INLINE_RULES:
        found = F.lit(None).cast("struct<rule:string,decision:string>")
        for rule, decision in reversed(ranked):
            found = F.when(_fits(rule, F.col("host"), F.col("path")),
                           F.struct(F.lit(rule).alias("rule"), F.lit(decision).alias("decision"))).otherwise(found)
        return df.withColumn("_found", found).select("*", "_found.rule", "_found.decision").drop("_found")
    return _with_joined_rule(df, ranked)


def _with_joined_rule(df: DataFrame, ranked: list[Rule]) -> DataFrame:
    """Many rules: the distinct (host, path) pairs meet the rules at every host
    suffix; the first rule in rank order that fits wins."""
    table = df.sparkSession.createDataFrame(
        [(*_parts(rule), i, rule, decision) for i, (rule, decision) in enumerate(ranked)],
        "rule_host string, rule_path string, rank int, rule string, decision string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    places = df.select("host", "path").distinct()
    hits = places.withColumn("rule_host", F.explode(suffixes)).join(hinted(stage(table, "url-rules")), "rule_host").filter(
        F.col("path").startswith(F.col("rule_path")))
    best = hits.groupBy("host", "path").agg(F.min(F.struct("rank", "rule", "decision")).alias("best")).select(
        "host", "path", "best.rule", "best.decision")
    return df.join(hinted(stage(best, "url-places")), ["host", "path"], "left")


def resolved(target: Column, url: Column) -> Column:
    """A link target as an absolute url."""
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    origin = F.regexp_extract(url, r"^([^:/?#]*://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"^([^:/?#]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (F.when(target.contains("://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(origin, F.lit("/"))), target)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) nodes of canonical links and meta refresh redirects."""
    url, html = F.col("_url"), F.col("_html")
    tag = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
    refresh = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
    href = F.regexp_extract(F.regexp_extract(html, tag, 0), r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    goes = F.regexp_extract(F.regexp_extract(html, refresh, 0), r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = (pages.select(F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
             .filter(html.rlike(r"(?i)\b(canonical|refresh)\b") & url.contains("://"))
             .select("_url", F.explode(F.array(href, goes)).alias("_target")).filter("_target <> ''"))
    ends = found.select(node_of(url).alias("src"),
                        node_of(resolved(F.replace(F.col("_target"), F.lit("&amp;"), F.lit("&")), url)).alias("dst"))
    return ends.filter("src is not null and dst is not null and src <> dst").distinct()


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, decided_by.

    ``edges``: further (src, dst) urls, such as a crawl's redirect log.
    """
    url = F.col("_url")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    rows = with_rule(rows.select("_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("_node")), rules)
    links = link_edges(pages, url_col, html_col)
    if edges is not None:
        links = links.unionByName(edges.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst"))
                                  .filter("src is not null and dst is not null"))
    links = stage(links, "url-edges")
    method = F.lit("allow")
    decided = F.lit("default")
    if not links.isEmpty():
        parts = connected_components(links)
        faked = F.concat(F.lit("x://"), F.col("node"))  # a node is a url without its scheme
        nodes = with_rule(parts.select("node", "component", host_of(faked).alias("host"), path_of(faked).alias("path")), rules)
        nodes = stage(nodes.select("node", "component", "decision"), "url-nodes")
        blocked = nodes.filter("decision = 'block'").select("component").distinct()
        aliases = nodes.join(hinted(stage(blocked, "url-blocked")), "component", "left_semi").select(
            F.col("node").alias("_node"), F.lit(True).alias("_blocked")).distinct()
        rows = rows.join(hinted(stage(aliases, "url-aliases")), "_node", "left")
        method = F.when(F.col("_blocked"), "block").otherwise("allow")
        decided = F.when(F.col("_blocked"), "alias").otherwise("default")
    return rows.select(
        F.col("_id").alias(id_col), "host", "path", "rule",
        F.coalesce("decision", method).alias("verdict"),
        F.when(F.col("decision").isNotNull(), "rule").otherwise(decided).alias("decided_by"))
