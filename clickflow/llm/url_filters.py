"""URL filters: rules by host and path, carried over redirects and canonical links.

Built-in functions only. A url that no rule fits takes the decision of its aliases: urls in
the same connected component of redirect and canonical-link edges.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.common import components, small_side


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Query parameters that name where a visitor came from, not what is shown.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty for a url without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The form that usual redirects lead to: no scheme, fragment, tracking parameter, leading
    ``www.`` or ``m.`` and no slash or ``.html`` at the path's end. Null without a host."""
    host, path = host_of(url), path_of(url)
    query = F.split(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.filter(query, lambda q: (q != "") & ~q.rlike(f"^(?:{TRACKING})(?:=|$)")), "&")
    page = F.regexp_replace(path, r"(?:/|/index\.html?|\.html?)$", "")
    site = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(site, page, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


# How the characters that urls need are written in attributes; & itself comes last.
ENTITIES = (
    ("&quot;|&#0*34;|&#x0*22;", '"'),
    ("&apos;|&#0*39;|&#x0*27;", "'"),
    ("&#0*47;|&#x0*2f;|&sol;", "/"),
    ("&#0*58;|&#x0*3a;|&colon;", ":"),
    ("&#0*61;|&#x0*3d;|&equals;", "="),
    ("&#0*63;|&#x0*3f;|&quest;", "?"),
    ("&amp;|&#0*38;|&#x0*26;", "&"),
)
TAG = r"(?is)<(?:link|meta)[\s/][^<>]*>"
# What a refresh holds: a delay, then the target, with or without its name and quotes.
REFRESH = r"""(?is)^\s*[0-9.]+\s*[;,\s]\s*(?:url\s*=\s*)?["']?([^"']*)"""


def attribute_pattern(name: str) -> str:
    """Groups 1 to 3 are the value in double quotes, in single quotes or in none."""
    return rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attribute(tag: Column, name: str) -> Column:
    return F.concat(*(F.regexp_extract(tag, attribute_pattern(name), group) for group in (1, 2, 3)))


def _tag_target(tag: Column) -> Column:
    """Where a link or meta tag leads; empty if it is no canonical link and no refresh."""
    relations = F.split(F.lower(_attribute(tag, "rel")), r"\s+")
    is_link = F.lower(F.substring(tag, 1, 5)) == "<link"
    link = F.when(is_link & F.array_contains(relations, "canonical"), _attribute(tag, "href"))
    is_refresh = ~is_link & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    return F.coalesce(link, F.when(is_refresh, F.regexp_extract(_attribute(tag, "content"), REFRESH, 1)), F.lit(""))


def _decoded(text: Column) -> Column:
    for written, character in ENTITIES:
        text = F.regexp_replace(text, f"(?i){written}", character)
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments; it keeps a slash at its end."""
    parts = F.split(path, "/")

    def step(kept, part):
        up = F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends_open = path.rlike(r"/\.\.?$")
    return F.concat(F.array_join(kept, "/"), F.when(ends_open, "/").otherwise(""))


def resolved(target: Column, source: Column) -> Column:
    """``target`` as a whole url, seen from the page ``source``.

    Null if it has another kind of scheme, such as ``mailto:``, names the page itself, or is
    relative to a page without a host.
    """
    scheme = F.regexp_extract(source, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    authority = F.regexp_extract(source, r"(?s)^.*?://([^/?#]*)", 1)
    site = F.concat(scheme, F.lit("://"), authority)
    folder = F.regexp_extract(path_of(source), r"(?s)^(.*/)", 1)
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substring(target, F.length(path) + 1, F.length(target))
    whole = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    inside = F.concat(site, F.when(path == "", path_of(source)).otherwise(_without_dots(whole)), rest)
    known = (scheme != "") & (authority != "")
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (target == "") | F.startswith(target, F.lit("#")), None)
        .when(known & F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(known, inside)
    )


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """source, target: a page's canonical links and refreshes, as whole urls.

    Attributes may stand in any order and quoting, with entities for the characters that urls
    need; a target may be relative to the page. Null urls and null pages give no edge, and neither does
    a target that ``resolved`` finds nothing for. A tag ends at its first ``>`` and holds no ``<``.
    """
    tags = F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0))
    found = pages.filter(F.col(url).isNotNull()).select(F.col(url).alias("source"), F.explode(tags).alias("tag"))
    found = found.select("source", _decoded(_tag_target(F.col("tag"))).alias("written"))
    edges = found.select("source", resolved(F.col("written"), F.col("source")).alias("target"))
    return edges.filter(F.col("target").isNotNull())


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    schema = "rule_host string, rule_path string, rule_verdict string"
    return spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules], schema)


def matched(df: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``__host``, ``__path`` and ``__rule`` (rule, verdict; null: none fits).

    The rules of one host are one row, so the join on a host suffix, one for each number of
    labels that rule hosts have, never multiplies rows; rules too many to broadcast are
    shuffled, and Spark splits a hot suffix. The longest of host and path together wins.
    """
    entry = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"),
        F.col("rule_path").alias("path"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    grouped = rules.dropDuplicates().groupBy("rule_host").agg(F.collect_list(entry).alias("entries"))
    grouped = grouped.withColumn("labels", F.size(F.split("rule_host", "\\.")))
    depths = [row.labels for row in grouped.select("labels").distinct().orderBy("labels").collect()]
    out = df.withColumn("__host", host_of(F.col(url))).withColumn("__path", path_of(F.col(url)))
    side = small_side(grouped, "rules")
    for depth in depths:
        own = side.filter(F.col("labels") == depth).select(F.col("rule_host").alias("__suffix"), F.col("entries").alias(f"__entries{depth}"))
        suffix = F.substring_index("__host", ".", -depth)
        out = out.join(own, suffix == F.col("__suffix"), "left").drop("__suffix")
    empty = F.array().cast("array<struct<size:int,host_size:int,path:string,rule:string,verdict:string>>")
    every = F.concat(empty, *(F.coalesce(F.col(f"__entries{d}"), empty) for d in depths))
    best = F.array_max(F.filter(every, lambda e: F.startswith(F.col("__path"), e["path"])))
    return out.withColumn("__rule", F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict"))).drop(*(f"__entries{d}" for d in depths))


def url_filter(df: DataFrame, rules: DataFrame, edges: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``__host``, ``__path``, ``__rule`` and ``__verdict``, allow or block.

    A fitting rule decides. Otherwise a url is blocked if a rule blocks one of its aliases
    and none allows one: an explicit allow takes precedence, and so does allow where nothing
    is known. Aliases share a canonical form or are linked by ``edges`` (source, target),
    followed both ways and over any distance. Urls without a host, null ones included, have
    no aliases. Rows keep their number and columns.
    """
    judged = matched(df, rules, url).withColumn("__form", canonical(F.col(url)))
    forms = edges.select(canonical(F.col("source")).alias("a"), canonical(F.col("target")).alias("b"))
    found = components(forms)
    # Targets are judged too, whether or not a page has been fetched from them.
    ends = edges.select(F.explode(F.array("source", "target")).alias("url"))
    known = judged.select("__form", F.col("__rule.verdict").alias("verdict")).unionByName(
        matched(ends, rules).select(canonical(F.col("url")).alias("__form"), F.col("__rule.verdict").alias("verdict"))
    )
    marks = (
        known.filter("__form IS NOT NULL AND verdict IS NOT NULL")
        .groupBy("__form")
        .agg(F.max(F.col("verdict") == "block").alias("blocked"), F.max(F.col("verdict") == "allow").alias("allowed"))
    )
    marks = marks.join(found, F.col("__form") == F.col("node"), "left")
    marks = marks.select(F.coalesce("component", "__form").alias("component"), "blocked", "allowed")
    marks = marks.groupBy("component").agg(F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed"))
    blocked = marks.filter("blocked AND NOT allowed").select("component")
    # Every form of a blocked component: its linked forms, and the component's name itself.
    linked = blocked.join(found, "component").select(F.col("node").alias("__alias"))
    aliases = small_side(linked.unionByName(blocked.select(F.col("component").alias("__alias"))).distinct(), "blocked_forms")
    out = judged.join(aliases, F.col("__form") == F.col("__alias"), "left")
    own = F.when(F.col("__alias").isNotNull(), "block").otherwise("allow")
    return out.withColumn("__verdict", F.coalesce("__rule.verdict", own)).drop("__alias", "__form")
