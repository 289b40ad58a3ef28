"""Allow and block rules for urls, carried over redirects and canonical links.

A rule names a host and a beginning of a path, and fits the host, all its subdomains and all paths
that begin so; of the rules that fit, the longest decides. A page that no rule fits follows its
aliases: urls that are joined by redirects or canonical links, over any number of steps, are one
resource. If a rule allows any of them, that explicit allowance stands; otherwise, if a rule blocks
any of them, so is the page; otherwise it is allowed.

Everything is DataFrame expressions. Locations are judged once each, however many pages have them:
the ends of their hosts and the beginnings of their paths that a rule could name meet the rules in
joins on equality, so no page meets more than one rule per host label and path length. Components
are found by alternating stars, whose minima combine before the shuffle and whose joins have one row
per node on one side, so that a url with very many aliases is split like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourney.llm.scratch import cleaned, materialise

Rule = tuple[str, str, str]

# The rules of the registered query: verdict, host, path.
RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# From the first :// on: host, path, query.
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
# Comments and scripts, whose contents are no tags, and the tags looked for.
_NO_TAGS = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)"
_TAGS = r"(?i)<(?:link|meta)\b[^<>]*>"
_HINTS = r"(?i)canonical|http-equiv"
_REFRESH = r"""(?i)^ ?[0-9.]* ?[;,] ?url ?= ?["']?([^"']*)"""


def url_part(url: Column, part: int) -> Column:
    """1: host in lower case (A-Z only), 2: path, 3: query with its mark; empty without ``://``."""
    found = F.coalesce(F.regexp_extract(url, _URL, part), F.lit(""))
    return F.translate(found, _UPPER, _LOWER) if part == 1 else found


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules (verdict, host, path) as a table; any other table of these columns will do."""
    names = ("verdict", "host", "path")
    form = "struct<v: string, h: string, p: string>"
    rows = [F.struct(*map(F.lit, rule)).cast(form) for rule in rules]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(name) for name in names])
    return spark.range(1).select(F.inline(F.array(*rows)).alias(*names))


def _fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``rule`` and ``explicit`` of the distinct (host, path) in ``places`` that a rule fits.

    The longest rule wins; of equal length those that allow come first.
    """
    known = rules.where("host != '' AND verdict IN ('allow', 'block')").select(
        F.translate("host", _UPPER, _LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("explicit"),
    )
    labels = F.size(F.split("rule_host", r"\."))
    shapes = known.groupBy("rule_host").agg(
        F.collect_set(F.length("rule_path")).alias("lengths"), F.max(labels).alias("labels")
    )
    most = known.agg(F.max(labels)).first()[0]
    if most is None:
        return places.limit(0).selectExpr("*", "'' AS rule", "'' AS explicit")
    # No rule fits more labels than the longest has.
    count = F.size("host_labels")
    first = F.greatest(count - most + 1, F.lit(1))
    ends = F.transform(
        F.sequence(first, count),
        lambda i: F.array_join(F.slice("host_labels", i, count), "."),
    )
    candidates = (
        places.where(F.col("host") != "")
        .withColumn("host_labels", F.split("host", r"\."))
        .select("host", "path", F.explode(ends).alias("rule_host"))
        .join(shapes, "rule_host")
        .select("host", "path", "rule_host", F.explode("lengths").alias("length"))
        .where(F.col("length") <= F.length("path"))
        .select(
            "host", "path", "rule_host", F.expr("substring(path, 1, length)").alias("rule_path")
        )
    )
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(
        F.length(rule).alias("size"),
        (F.col("explicit") == "allow").alias("allows"),
        rule.alias("rule"),
        "explicit",
    )
    return (
        candidates.join(known, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", "best.rule", "best.explicit")
    )


def _resolved(target: Column) -> Column:
    """A link as an absolute url; ``host``, ``path`` and ``query`` are those of its page."""
    link = F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")))
    folder = F.concat_ws("/", F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1))
    folder = F.concat(folder, F.lit("/"))
    start = F.concat(F.lit("x://"), "host")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("x:"), link))
        .when(link.startswith("/"), F.concat(start, link))
        .when(link.startswith("?"), F.concat(start, "path", link))
        .when((link == "") | link.rlike("^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)"), None)
        .otherwise(F.concat(start, folder, link))
    )


def _location(url: Column) -> Column:
    """A url without scheme and fragment, or null without a host."""
    host = url_part(url, 1)
    return F.when(host != "", F.concat(host, url_part(url, 2), url_part(url, 3)))


def _once(**columns: Column) -> Column:
    """The columns, by a generator, so that conditions on them do not work them out again."""
    return F.inline(F.array(F.struct(*(value.alias(name) for name, value in columns.items()))))


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag without runs of white space; empty if it has none."""
    form = f"""(?i)[ "'/]{name} ?= ?(?:"([^"]*)"|'([^']*)'|([^ "'<>]+))"""
    return F.concat(*(F.regexp_extract(tag, form, group) for group in (1, 2, 3)))


def declared_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): canonical links and refresh redirects in the html of pages (url, html).

    Tags within comments and scripts do not count, nor do links to no url (``#top``, ``mailto:``).
    Relative links are taken relative to the url of the page, without resolving ``..``.
    """
    hinted = pages.where(F.col("html").rlike(_HINTS))
    plain = F.regexp_replace("html", _NO_TAGS, " ")
    found = F.explode(F.regexp_extract_all(plain, F.lit(_TAGS), F.lit(0)))
    tag = F.regexp_replace("tag", r"\s+", " ")
    tags = hinted.select("url", found.alias("tag")).select("url", _once(tag=tag))
    tag = F.col("tag")
    parts = {"host": url_part(F.col("url"), 1), "path": url_part(F.col("url"), 2)}
    named = {
        "kind": F.lower(F.substring(tag, 2, 4)),
        "rel": F.split(F.lower(_attribute(tag, "rel")), " "),
        "href": _attribute(tag, "href"),
        "equiv": F.lower(F.trim(_attribute(tag, "http-equiv"))),
        "content": _attribute(tag, "content"),
    }
    read = tags.select("url", _once(**parts, **named))
    target = (
        F.when((F.col("kind") == "link") & F.array_contains("rel", "canonical"), F.col("href"))
        .when(
            (F.col("kind") == "meta") & (F.col("equiv") == "refresh"),
            F.regexp_extract("content", _REFRESH, 1),
        )
        .otherwise("")
    )
    links = read.select("url", "host", "path", _once(target=target))
    links = links.where("target != '' AND host != ''")
    return links.select(F.col("url").alias("from_url"), _once(to_url=_resolved(F.col("target"))))


def _node(location: Column) -> Column:
    """Nodes are 128-bit digests, so long urls are not shuffled in every round."""
    return F.unhex(F.md5(location))


def alias_groups(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the stored links (u, v): root is the smallest node reached.

    Every node hangs its larger neighbours on the smallest node it knows, then its smaller ones,
    until nothing changes. Each round is stored, which also cuts the lineage.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialise(edges.where("u != v").distinct(), "aliases")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        hung = both.where("v > u").join(least, F.col("u") == F.col("n"))
        hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        hung = materialise(hung.distinct(), "large-stars")
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        rest = hung.join(least.withColumnRenamed("u", "n"), F.col("u") == F.col("n"))
        rest = rest.where("v != m")
        small = rest.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        stars = materialise(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-stars"
        )
        # Stars are left when every node hangs on one other, which hangs on none.
        hangs = stars.select(F.col("u").alias("h"))
        done = (
            stars.groupBy("u").agg(F.count(F.lit(1)).alias("k")).where("k > 1").isEmpty()
            and stars.join(hangs, F.col("v") == F.col("h"), "left_semi").isEmpty()
        )
        edges = stars
        if done:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    hanging = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return hanging.unionByName(roots).distinct()


def _alias_verdicts(links: DataFrame, rules: DataFrame) -> DataFrame:
    """(node, alias_verdict) of all linked locations of a group that a rule decides on."""
    ends = links.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("place"), _node(F.col("a")).alias("node")),
                F.struct(F.col("b").alias("place"), _node(F.col("b")).alias("node")),
            )
        )
    ).distinct()
    as_url = F.concat(F.lit("x://"), "place")
    ends = ends.select(
        "node", url_part(as_url, 1).alias("host"), url_part(as_url, 2).alias("path")
    )
    ruled = _fitting_rules(ends.select("host", "path").distinct(), rules)
    groups = alias_groups(links.select(_node(F.col("a")).alias("u"), _node(F.col("b")).alias("v")))
    groups = materialise(groups, "groups")
    decided = ends.join(ruled, ["host", "path"]).join(groups, "node")
    # "allow" comes before "block".
    of_group = decided.groupBy("root").agg(F.min("explicit").alias("alias_verdict"))
    return groups.join(of_group, "root").select("node", "alias_verdict")


@cleaned
def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): host, path, the rule that fits, and the verdict.

    ``rules`` are rows (verdict ``allow`` or ``block``, host, path); ``redirects`` optional rows
    (from_url, to_url) beside the links that the html declares. Two urls are the same location if
    they differ only in scheme, fragment, or case of the host.

    A url that is null or has no ``://`` has an empty host and path, fits no rule, has no aliases
    and is allowed; null html declares nothing; repeated pages each give their row; further columns
    are left out; without rules everything is allowed.
    """
    parts = [url_part(F.col("url"), i).alias(n) for i, n in ((1, "host"), (2, "path"))]
    places = pages.select("page_id", "url", *parts)
    links = declared_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    links = links.select(
        _once(a=_location(F.col("from_url")), b=_location(F.col("to_url")))
    )
    links = materialise(links.where("a != b").distinct(), "links")
    ruled = _fitting_rules(places.select("host", "path").distinct(), rules)
    inherited = _alias_verdicts(links, rules)
    inherited = inherited.withColumnRenamed("node", "alias_node")
    return (
        places.join(ruled, ["host", "path"], "left")
        .join(inherited, _node(_location(F.col("url"))) == F.col("alias_node"), "left")
        .select(
            F.col("page_id").cast("bigint").alias("page_id"),
            "host",
            "path",
            "rule",
            F.coalesce("explicit", "alias_verdict", F.lit("allow")).alias("verdict"),
        )
    )


# The same over the table ``pages``, with ``RULES``.
ORACLE_SQL = r"""
WITH RECURSIVE rules(verdict, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), page AS (
    SELECT page_id, url, html,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), raw_tag AS (
    SELECT url, host, path, unnest(regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)', ' ', 'g'),
        '(?i)<(?:link|meta)\b[^<>]*>')) AS raw
    FROM page WHERE html IS NOT NULL AND host <> ''
), tag AS (
    SELECT url, host, path, regexp_replace(raw, '\s+', ' ', 'g') AS tag FROM raw_tag
), attribute AS (
    SELECT url, host, path, lower(tag[2:5]) AS kind,
           lower(concat(regexp_extract(tag, '(?i)[ "''/]rel ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 1),
                        regexp_extract(tag, '(?i)[ "''/]rel ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 2),
                        regexp_extract(tag, '(?i)[ "''/]rel ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 3))) AS rel,
           concat(regexp_extract(tag, '(?i)[ "''/]href ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 1),
                  regexp_extract(tag, '(?i)[ "''/]href ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 2),
                  regexp_extract(tag, '(?i)[ "''/]href ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 3)) AS href,
           lower(trim(concat(
               regexp_extract(tag, '(?i)[ "''/]http-equiv ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 1),
               regexp_extract(tag, '(?i)[ "''/]http-equiv ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 2),
               regexp_extract(tag, '(?i)[ "''/]http-equiv ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 3)))) AS equiv,
           concat(regexp_extract(tag, '(?i)[ "''/]content ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 1),
                  regexp_extract(tag, '(?i)[ "''/]content ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 2),
                  regexp_extract(tag, '(?i)[ "''/]content ?= ?(?:"([^"]*)"|''([^'']*)''|([^ "''<>]+))', 3)) AS content
    FROM tag
), target AS (
    SELECT url, host, path, trim(replace(CASE
        WHEN kind = 'link' AND list_contains(string_split(rel, ' '), 'canonical') THEN href
        WHEN kind = 'meta' AND equiv = 'refresh'
        THEN regexp_extract(content, '(?i)^ ?[0-9.]* ?[;,] ?url ?= ?["'']?([^"'']*)', 1)
        ELSE '' END, '&amp;', '&')) AS link
    FROM attribute
), resolved AS (
    SELECT url, CASE
        WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
        WHEN starts_with(link, '//') THEN 'x:' || link
        WHEN starts_with(link, '/') THEN 'x://' || host || link
        WHEN starts_with(link, '?') THEN 'x://' || host || path || link
        WHEN link = '' OR regexp_matches(link, '^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
        ELSE 'x://' || host || regexp_extract('/' || path, '^/(.*/|)[^/]*$', 1)
             || CASE WHEN path LIKE '%/%' THEN '' ELSE '/' END || link END AS to_url
    FROM target
), both_ends AS (
    SELECT url AS a, to_url AS b FROM resolved WHERE to_url IS NOT NULL
    UNION SELECT to_url, url FROM resolved WHERE to_url IS NOT NULL
), every_url AS (
    SELECT a AS url FROM both_ends UNION SELECT url FROM page
), located AS (
    SELECT url,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*([^#]*)', 1), '') AS query
    FROM every_url
), place AS (
    SELECT url, host, path, CASE WHEN host = '' THEN NULL ELSE
           host || path || query END AS place
    FROM located
), edge AS (
    SELECT DISTINCT x.place AS a, y.place AS b FROM both_ends
    JOIN place x ON x.url = both_ends.a JOIN place y ON y.url = both_ends.b
    WHERE x.place <> y.place
), reach(a, b) AS (
    SELECT a, a FROM edge
    UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b
), fit AS (
    SELECT host, path, max(struct_pack(size := length(rule_host || rule_path),
                                       allows := CAST(verdict = 'allow' AS INTEGER),
                                       rule := rule_host || rule_path, verdict := verdict)) AS best
    FROM (SELECT DISTINCT host, path FROM place) p JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
), inherited AS (
    SELECT reach.a AS place, min(fit.best.verdict) AS verdict FROM reach
    JOIN place ON place.place = reach.b JOIN fit ON fit.host = place.host AND fit.path = place.path
    GROUP BY reach.a
)
SELECT page.page_id, page.host, page.path, fit.best.rule AS rule,
       coalesce(fit.best.verdict, inherited.verdict, 'allow') AS verdict
FROM page LEFT JOIN fit ON fit.host = page.host AND fit.path = page.path
LEFT JOIN place ON place.url = page.url
LEFT JOIN inherited ON inherited.place = place.place
"""
