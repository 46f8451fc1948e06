"""URL filters: rules by host and path, spread over pages that redirects and canonical links make one.

Every url names a node; a redirect (meta refresh, or a given table) and a canonical link of the
page are links between nodes. Connected components of these links are classes of aliases. A page that no rule fits takes
the decision of its class: allow if a rule allows any alias, block if one is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, passing, read_table, written

#: (decision, host, path): a rule fits its host and all subdomains, under its path.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """A url's node: the url itself with scheme and host in lower case, without fragment, ``/`` for no path; null without a host."""
    whole = F.regexp_replace(_rest(url), r"(?s)#.*$", "")
    scheme = F.lower(F.substring_index(url, "://", 1))
    tail = F.substring(whole, F.length(host_of(url)) + 1, F.length(whole))
    tail = F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.when(host_of(url) != "", F.concat(scheme, F.lit("://"), host_of(url), tail))


def plain_form(url: Column) -> Column:
    """A looser node, one for the usual spellings of an address: no scheme, www, m or amp label, query, index file, .html or closing slash."""
    short = F.regexp_replace(host_of(url), r"^(?:www\d?|m|mobile|amp)\.(?=[^.]+\.)", "")
    trail = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.(?:html?|php)$", "/"), r"(?:\.html?|/)+$", "")
    return F.when(host_of(url) != "", F.concat(short, trail))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """Name (host and path) and decision of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1], r[2]))
    name, decision = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, decision = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(decision)
    return name, decision


#: Character references that urls in attributes are written with; the ampersand's last.
REFERENCES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&#47;", "/"), ("&#x2f;", "/"), ("&#58;", ":"), ("&#x3a;", ":"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"))
_TAG = r"(?is)<(?:link|meta|base)\b[^>]*>"


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, wherever it stands and however it is quoted; empty if it is missing."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))
    for code, sign in REFERENCES:
        value = F.regexp_replace(value, f"(?i){code}", sign)
    return F.trim(value)


def resolve(target: Column, url: Column) -> Column:
    """``target``, an absolute or relative reference, as a full url seen from ``url``; null if it names no page."""
    scheme = F.substring_index(url, "://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1))
    path, query = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(\?[^#]*)?", 1)
    merged = F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_replace(path_of(url), r"(?s)[^/]*$", ""), path))
    step = lambda a, x: F.when(x == ".", a).when(x == "..", F.regexp_replace(a, r"(?s)/[^/]*$", "")).otherwise(F.concat(a, F.lit("/"), x))
    closed = F.regexp_replace(merged, r"(?s)(^|/)(\.\.?)$", "$1$2/")
    parts = F.split(F.regexp_replace(closed, "^/", ""), "/")
    relative = F.concat(root, F.aggregate(parts, F.lit(""), step), query)
    same = F.concat(root, path_of(url), F.when(query != "", query).otherwise(F.regexp_extract(_rest(url), r"(?s)^[^?#]*(\?[^#]*)?", 1)))
    return (
        F.when(target == "", None).when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(host_of(url) == "", None).when(target.startswith("//"), F.concat(scheme, F.lit(":"), target)).when(path == "", same).otherwise(relative)
    )


def link_targets(html: Column, url: Column) -> Column:
    """Full urls that a page names as canonical or redirects to; references are read against the page's ``<base>``, or else its url."""
    tags = F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))
    named = lambda t, name: F.lower(t).startswith(f"<{name}")
    canonical = F.transform(F.filter(tags, lambda t: named(t, "link") & F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)")), lambda t: _attribute(t, "href"))
    content = r"""(?is)\burl\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s][^\s]*))"""
    target = lambda c: F.concat(*(F.regexp_extract(c, content, i) for i in (1, 2, 3)))
    refresh = F.transform(F.filter(tags, lambda t: named(t, "meta") & (F.lower(_attribute(t, "http-equiv")) == "refresh")), lambda t: F.trim(target(_attribute(t, "content"))))
    base = F.get(F.filter(F.transform(F.filter(tags, lambda t: named(t, "base")), lambda t: resolve(_attribute(t, "href"), url)), lambda u: u.isNotNull()), F.lit(0))
    found = F.transform(F.concat(canonical, refresh), lambda t: resolve(t, F.coalesce(base, url)))
    return F.when(F.lower(html).rlike("canonical|refresh"), F.filter(found, lambda u: u.isNotNull())).otherwise(F.array().cast("array<string>"))


def judge(pages: DataFrame, url: str = "url", html: str | None = "html", page_id: str = "page_id", rules: tuple[tuple[str, str, str], ...] = RULES, redirects: DataFrame | None = None, spellings: bool = False) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rule`` is the longest rule that fits, ties going to the first in order of decision
    and name; ``verdict`` is its decision, or else that of the page's aliases (any
    allowed alias wins over blocked ones), or else allow. Aliases are joined by redirects and canonical links between
    equal urls; ``spellings`` also takes the usual spellings of an address for one (``plain_form``). ``redirects`` may add
    links (``src``, ``dst``: urls) that the pages do not show; nulls there link nothing. Targets need not be pages of the table:
    a rule that fits a target counts for its aliases. Null urls and urls
    without ``://`` have empty host and path, no aliases, and are allowed unless a rule
    fits; null html has no links; repeated rows stay and get equal verdicts; an
    empty table gives an empty result; other columns are not read.
    """
    node_of = lambda c: F.md5(plain_form(c) if spellings else address(c))
    with passing() as keep:
        rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), (F.col(html) if html else F.lit(None).cast("string")).alias("html"))
        to = F.coalesce(link_targets(F.col("html"), F.col("url")), F.array().cast("array<string>")).alias("to")
        name, decision = rule_of(F.col("host"), F.col("path"), rules)
        rows = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"), to)
        rows = keep(written(rows.withColumns({"rule": name, "decision": decision})))
        links = rows.where(F.size("to") > 0).select(F.col("url").alias("src"), F.explode("to").alias("dst"))
        if redirects is not None:
            links = links.unionByName(redirects.select("src", "dst"))
        links = written(links.distinct())
        labels = keep(connected_components(links.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b"))))
        ends = links.select(F.col("src").alias("u")).union(links.select(F.col("dst").alias("u")))
        of_ends = ends.select(node_of(F.col("u")).alias("node"), rule_of(host_of(F.col("u")), path_of(F.col("u")), rules)[1].alias("decision"))
        spoken = rows.select("node", "decision").union(of_ends).where("decision is not null and node is not null")
        # whether an alias is allowed is gathered per address first, so that a busy class moves few rows
        allowed = lambda c: F.max(c).alias("allowed")
        spoken = spoken.groupBy("node").agg(allowed(F.col("decision") == "allow"))
        roots = keep(written(spoken.join(labels, "node", "left").groupBy(F.coalesce("component", "node").alias("root")).agg(allowed(F.col("allowed")))))
    spread = F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block")
    out = rows.join(labels, "node", "left").withColumn("root", F.coalesce("component", "node")).join(roots, "root", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("decision", spread, F.lit("allow")).alias("verdict"))


def op9_urls(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"))


def _sql() -> str:
    rest = lambda u: f"CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
    host = lambda u: f"translate(regexp_extract({rest(u)}, '(?s)^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
    path = lambda u: f"regexp_extract({rest(u)}, '(?s)^[^/?#]*([^?#]*)', 1)"
    quoted = lambda lead: [f"(?is){lead}" + r"""\s*=\s*(?:"([^"]*)"|''([^'']*)''|""" + last for last in (r"""([^\s"''>]+))""", r"""([^"''\s][^\s]*))""")]

    lead = r"""[\s"''/]"""

    def attribute(name: str) -> str:
        value = "concat(" + ", ".join(f"""regexp_extract(tag, '{quoted(lead + name)[0]}', {i})""" for i in (1, 2, 3)) + ")"
        for code, sign in REFERENCES:
            value = f"regexp_replace({value}, '(?i){code}', '{sign.replace(chr(39), chr(39) * 2)}', 'g')"
        return f"trim({value})"

    content = "concat(" + ", ".join(f"regexp_extract(content, '{quoted(chr(92) + 'burl')[1]}', {i})" for i in (1, 2, 3)) + ")"
    rules = ", ".join(f"('{d}', '{h}', '{p}')" for d, h, p in RULES)
    absolute = "regexp_matches({0}, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://')"

    def resolved(t: str, u: str) -> str:
        top = f"(split_part({u}, '://', 1) || '://' || regexp_extract({rest(u)}, '(?s)^([^/?#]*)', 1))"
        to_path, query, own_query = f"regexp_extract({t}, '(?s)^([^?#]*)', 1)", f"regexp_extract({t}, '(?s)^[^?#]*(\\?[^#]*)?', 1)", f"regexp_extract({rest(u)}, '(?s)^[^?#]*(\\?[^#]*)?', 1)"
        merged = f"CASE WHEN starts_with({to_path}, '/') THEN {to_path} ELSE regexp_replace({path(u)}, '(?s)[^/]*$', '') || {to_path} END"
        parts = f"list_prepend('', string_split(regexp_replace(regexp_replace({merged}, '(?s)(^|/)(\\.\\.?)$', '\\1\\2/'), '^/', ''), '/'))"
        folded = f"list_reduce({parts}, lambda a, x: CASE x WHEN '.' THEN a WHEN '..' THEN regexp_replace(a, '(?s)/[^/]*$', '') ELSE a || '/' || x END)"
        return (
            f"CASE WHEN {t} = '' THEN NULL WHEN {absolute.format(t)} THEN {t} WHEN regexp_matches({t}, '(?s)^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN {host(u)} = '' THEN NULL "
            f"WHEN starts_with({t}, '//') THEN split_part({u}, '://', 1) || ':' || {t} WHEN {to_path} = '' THEN {top} || {path(u)} || CASE WHEN {query} <> '' THEN {query} ELSE {own_query} END ELSE {top} || {folded} || {query} END"
        )

    tail = f"substr(regexp_replace({rest('url')}, '(?s)#.*$', ''), length({host('url')}) + 1)"
    return rf"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
tags AS (SELECT row, url, tag, no FROM (SELECT row, url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta|base)\b[^>]*>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?is)<(?:link|meta|base)\b[^>]*>'), 1) AS no
         FROM p WHERE regexp_matches(lower(html), 'canonical|refresh'))),
read AS (SELECT row, url, no, lower(substr(tag, 2, 4)) AS kind, {attribute("rel")} AS rel, {attribute("href")} AS href, {attribute("http-equiv")} AS equiv, {attribute("content")} AS content FROM tags),
base AS (SELECT row, arg_min(b, no) AS b FROM (SELECT row, no, {resolved("href", "url")} AS b FROM read WHERE kind = 'base') WHERE b IS NOT NULL GROUP BY row),
refs AS (SELECT row, url, coalesce(b, url) AS seen, t FROM (SELECT row, url, href AS t FROM read WHERE kind = 'link' AND regexp_matches(lower(rel), '(^|\s)canonical(\s|$)')
         UNION ALL SELECT row, url, trim({content}) FROM read WHERE kind = 'meta' AND lower(equiv) = 'refresh') LEFT JOIN base USING (row)),
links AS (SELECT DISTINCT url AS src, {resolved("t", "seen")} AS dst FROM refs),
urls AS (SELECT url FROM p UNION SELECT src FROM links UNION SELECT dst FROM links WHERE dst IS NOT NULL),
h AS (SELECT url, {host("url")} AS host, {path("url")} AS path, CASE WHEN {host("url")} <> '' THEN lower(split_part(url, '://', 1)) || '://' || {host("url")} || CASE WHEN starts_with({tail}, '/') THEN {tail} ELSE '/' || {tail} END END AS node FROM urls),
rules(decision, rh, rp) AS (VALUES {rules}),
fit AS (SELECT url, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(decision, length(rh || rp)) AS decision
        FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY url),
sides AS (SELECT a.node AS a, b.node AS b FROM links JOIN h a ON a.url = src JOIN h b ON b.url = dst WHERE a.node IS NOT NULL AND b.node IS NOT NULL),
ways AS (SELECT a, b FROM sides UNION SELECT b, a FROM sides),
reach(node, other) AS (SELECT DISTINCT a, a FROM ways UNION SELECT reach.node, ways.b FROM reach JOIN ways ON ways.a = reach.other),
class AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
j AS (SELECT h.*, rule, decision, coalesce(root, h.node) AS root FROM h LEFT JOIN fit USING (url) LEFT JOIN class USING (node)),
spread AS (SELECT root, min(decision) AS decision FROM j WHERE decision IS NOT NULL AND root IS NOT NULL GROUP BY root)
SELECT page_id, host, path, rule, coalesce(j.decision, spread.decision, 'allow') AS verdict FROM p JOIN j USING (url) LEFT JOIN spread USING (root)
"""


OP9_SQL = _sql()
