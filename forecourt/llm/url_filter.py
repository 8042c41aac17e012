"""URL filters: rules by host and path, and block decisions that follow redirects and canonical links to aliases.

A page's own rule decides. A page without one takes part in its aliases' fate: URLs joined by redirect or canonical-link
edges are one component; if a rule allows any of its URLs the page is allowed, else if a rule blocks one it is blocked,
else it is allowed.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from .components import connected_components
from .shared import fixed

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self):
        return self.host + self.path


def url_host(url):
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _CAPITALS, _CAPITALS.lower()), F.lit(""))


def url_path(url):
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _plain_path(path):
    """A path without ``.`` and ``..`` segments; an empty one is ``/``. Paths beyond the root stay at the root."""

    def step(kept, segment):
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(segment == ".", kept).when(segment == "..", up).otherwise(F.concat(kept, F.array(segment)))

    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), F.array().cast("array<string>"), step)
    ended = F.when(F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    plain = F.concat(F.lit("/"), F.array_join(kept, "/"), ended)
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(?:/|$)"), plain).otherwise(path)


def url_node(url):
    """The resource a URL names: scheme and host lowered, without a default port, plain path and query, no fragment."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    port = F.when(scheme == "http", r":(80)?$").when(scheme == "https", r":(443)?$").otherwise(r":$")
    host = F.regexp_replace(url_host(url), port, F.lit(""))
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host, _plain_path(url_path(url)), query))


def fitting(rules, host, path, value):
    """``value(rule)`` of the longest rule that fits, else null; an ordered conditional over a list of rules.

    For lists of hundreds of rules; of equally long ones an allowing rule comes first.
    """
    chosen = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.verdict, r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, value(rule)) if chosen is None else chosen.when(fits, value(rule))
    return F.lit(None).cast("string") if chosen is None else chosen


def _resolved(url, link):
    """A link on the page ``url``, which has a host, as an absolute URL; both are names of columns."""
    root, at = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.col(link)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)", 1)
    return (
        F.when(at.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), at)
        .when(at.startswith("//"), F.concat(F.regexp_extract(url, r"(?s)^(.*?:)//", 1), at))
        .when(at.startswith("/"), F.concat(root, at))
        .when((at != "") & ~at.startswith("#"), F.concat(F.rtrim(folder, F.lit("/")), F.lit("/"), at))
    )


def alias_edges(pages, url_col="url", html_col="html"):
    """Edges (a, b) between the resources of pages and of their canonical links and meta refresh targets."""
    tags = F.regexp_extract_all(F.col(html_col), F.lit(r"(?is)<(?:link|meta)\b[^>]*(?:canonical|refresh)[^>]*>"), F.lit(0))
    tagged = pages.where(F.col(url_col).contains("://") & F.col(html_col).rlike("(?i)canonical|refresh"))
    tagged = tagged.select(F.col(url_col).alias("url"), F.explode(tags).alias("tag"))
    canonical = F.when(
        F.col("tag").rlike(r"""(?is)<link\b[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""),
        F.regexp_extract("tag", r"""(?is)\bhref\s*=\s*["']?([^"'>\s]+)""", 1),
    )
    refresh = F.when(
        F.col("tag").rlike(r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b"""),
        F.regexp_extract("tag", r"""(?is)\burl\s*=\s*['"]?([^'">\s]+)""", 1),
    )
    link = F.trim(F.regexp_replace(F.coalesce(canonical, refresh), "&amp;", "&"))
    linked = tagged.select("url", link.alias("link")).withColumn("target", _resolved("url", "link"))
    return linked.select(url_node(F.col("url")).alias("a"), url_node(F.col("target")).alias("b")).where("a <> b").distinct()


def judge_urls(pages, rules, id_col="page_id", url_col="url", html_col="html", redirects=None):
    """One row per page: page_id, host, path, rule, verdict.

    ``redirects`` may hold further edges (a, b) of URLs. A null url, and one without ``://``, has an empty host and path,
    no rule and no aliases, and is allowed. Repeated rows each give a row; a null html has no links. An empty table gives
    no rows; other columns are not looked at.
    """
    url = F.col("url")
    judged = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    judged = judged.withColumns({"host": url_host(url), "path": url_path(url), "node": url_node(url)})

    def by_rule(value):
        return fitting(rules, F.col("host"), F.col("path"), value)

    judged = judged.withColumns({"rule": by_rule(lambda r: F.lit(r.text)), "own": by_rule(lambda r: F.lit(r.verdict))})
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(url_node(F.col("a")).alias("a"), url_node(F.col("b")).alias("b")))
    roots = connected_components(edges)
    aliases = roots.withColumns({"host": url_host(F.col("node")), "path": url_path(F.col("node"))})
    fate = aliases.groupBy("root").agg(F.min(by_rule(lambda r: F.lit(r.verdict))).alias("shared"))  # allow before block
    shared = fixed(roots.join(fate, "root").where("shared is not null").select(F.col("node").alias("_node"), "shared"))
    verdict = F.coalesce("own", "shared", F.lit("allow"))
    return judged.join(shared, judged.node == F.col("_node"), "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict")
    )
