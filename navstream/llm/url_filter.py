"""URL filters with redirect equivalence.

Rules name a host and the beginning of a path; a rule fits its host and every subdomain, and the longest fitting rule decides. Pages
without a rule of their own take the decisions of their aliases: URLs joined by redirects and canonical links
are one resource. Connected components over those links (large and small stars) carry a block to every alias;
an explicit allow takes precedence, both on the page that has it and, for pages without a rule, anywhere in the component.
What no rule decides, directly or through an alias, is allowed.

Links come from the pages: ``<link rel=canonical href>`` and ``<meta http-equiv=refresh content="n; url=...">``
outside comments, scripts and styles; and from a table of observed redirects, if given. Targets resolve against the page's URL (absolute,
scheme-relative, rooted, relative and query-only references, with dot segments). A URL is named without its fragment, with scheme and
host in ASCII lower case and the empty path as ``/``. A ``<base>`` element is not followed.

Few rules are matched in place, by an expression over each row. More of them are joined: every distinct (host, path) meets
the rules at its host's suffixes and its path's beginnings of the lengths that rules have. A hub that a third of all pages
link to is one node; its links are reduced to minima before each shuffle (``components``). Everything is DataFrame expressions.

Defined cases: a NULL URL, or one without ``://``, has empty host and path, fits no rule and has no aliases; a NULL
html has no links; repeated URLs and ids are judged row by row, alike; a link to itself, to nothing or to another scheme
(``mailto:``) is none; further columns are ignored; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navstream.llm.common import cut
from navstream.llm.components import components

ALLOW, BLOCK = "allow", "block"
#: (verdict, host and path) of the standard policy.
RULES = ((ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"))
#: Rules up to this number are matched by an expression.
INLINE = 64

SCHEME = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; '' without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: str) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; '' without a host's ``://``."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def longest_rule(rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> Column:
    """struct(rule, decided) of the longest rule that fits, or NULL: rules are tried by falling length."""
    chain = F.lit(None).cast("struct<rule: string, decided: string>")
    for verdict, rule in sorted(set(rules), key=lambda r: (len(r[1]), r[1], r[0])):
        name, start = split_rule(rule)
        fits = ((F.col(host) == name) | F.endswith(F.col(host), F.lit(f".{name}"))) & F.startswith(F.col(path), F.lit(start))
        chain = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("decided"))).otherwise(chain)
    return chain


def joined_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, fit) of the distinct (host, path) that a rule of ``rules`` (verdict, rule) fits, by equality of
    keys: a host's suffixes times its path's beginnings as long as some rule's path (those lengths alone come to the
    driver; they are no more than the longest rule has characters)."""
    keyed = rules.select("rule", "verdict", F.length(F.regexp_extract("rule", r"(?s)\A[^/]*(.*)\z", 1)).alias("length")).where("rule IS NOT NULL")
    lengths = F.array(*[F.lit(r["length"]) for r in keyed.select("length").distinct().orderBy("length").collect()]).cast("array<int>")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    starts = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    at = places.select("host", "path").distinct()
    probes = at.select("host", "path", F.explode(suffixes).alias("suffix"), starts.alias("starts")).select(
        "host", "path", F.explode("starts").alias("start"), "suffix"
    )
    found = probes.select("host", "path", F.concat("suffix", "start").alias("key")).join(
        keyed.select(F.col("rule").alias("key"), "verdict"), "key"
    )
    longest = F.max(F.struct(F.length("key").alias("n"), F.col("key").alias("rule"), F.col("verdict").alias("decided")))
    return found.groupBy("host", "path").agg(longest.alias("fit")).select("host", "path", F.struct("fit.rule", "fit.decided").alias("fit"))


def with_rules(places: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """``places`` (host, path, ...) with ``fit``: struct(rule, decided) of the longest rule, or NULL."""
    if not isinstance(rules, DataFrame):
        if len(rules) <= INLINE:
            return places.withColumn("fit", longest_rule(rules))
        rules = places.sparkSession.createDataFrame([(v, r) for v, r in rules], "verdict string, rule string")
    found = cut(joined_rules(places, rules), "url-rules")
    return places.join(found, ["host", "path"], "left")


def _dotless(path: Column) -> Column:
    """Path without ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, x: F.when(x == ".", kept)
        .when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
        .otherwise(F.concat(kept, F.array(x))),
    )
    joined = F.concat(F.array_join(walked, "/"), F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit("")))
    return F.when(F.contains(path, F.lit("/.")), joined).otherwise(path)


def node_of(url: str) -> Column:
    """The name of a URL as a resource; NULL without a scheme."""
    scheme = ascii_lower(F.regexp_extract(F.col(url), SCHEME, 1))
    path = path_of(url)
    query = F.regexp_extract(F.col(url), r"(?s)\A[^?#]*(\?[^#]*)", 1)
    return F.when(
        F.col(url).rlike(SCHEME),
        F.concat(scheme, F.lit("://"), host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query),
    )


def _tag_value(tag: Column, name: str) -> Column:
    """An attribute's value, quoted or not, with the entities a URL can hold decoded."""
    found = F.concat(*[F.regexp_extract(tag, rf"(?is)[\s\"']{name}{VALUE}", k) for k in (1, 2, 3)])
    return F.trim(F.replace(F.replace(found, F.lit("&#38;"), F.lit("&")), F.lit("&amp;"), F.lit("&")))


def _references(html: str) -> Column:
    """Array of the references of canonical links and of refresh redirects."""
    shown = F.regexp_replace(F.col(html), HIDDEN, " ")
    links = F.filter(
        F.regexp_extract_all(shown, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)),
        lambda t: F.array_contains(F.split(F.lower(_tag_value(t, "rel")), r"\s+"), F.lit("canonical")),
    )
    metas = F.filter(
        F.regexp_extract_all(shown, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: F.lower(_tag_value(t, "http-equiv")) == "refresh"
    )
    target = lambda t: F.trim(F.regexp_replace(F.regexp_extract(_tag_value(t, "content"), r"(?is)\burl\s*=\s*(.*)\z", 1), "[\"']", ""))
    found = F.concat(F.transform(links, lambda t: _tag_value(t, "href")), F.transform(metas, target))
    # most pages have neither word, and their tags are never listed
    return F.when(F.col(html).rlike(r"(?i)canonical|http-equiv"), found).otherwise(F.array().cast("array<string>"))


def _resolved(ref: str, node: str) -> Column:
    """A reference as an absolute URL, seen from the page named ``node``."""
    r, n = F.col(ref), F.col(node)
    site = F.regexp_extract(n, r"(?s)\A[^:]*://[^/?#]*", 0)
    page = F.regexp_extract(n, r"(?s)\A[^?]*", 0)
    folder = F.regexp_extract(n, r"(?s)\A([^:]*://[^?]*/)", 1)
    return (
        F.when(r.rlike(SCHEME), r)
        .when(F.startswith(r, F.lit("//")), F.concat(F.regexp_extract(n, r"\A[^:]*:", 0), r))
        .when((r == "") | F.startswith(r, F.lit("#")) | r.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(F.startswith(r, F.lit("?")), F.concat(page, r))
        .otherwise(
            F.concat(
                site,
                _dotless(
                    F.regexp_extract(
                        F.when(F.startswith(r, F.lit("/")), r).otherwise(F.concat(F.substr(folder, F.length(site) + 1), r)), r"(?s)\A[^?#]*", 0
                    )
                ),
                F.regexp_extract(r, r"(?s)\A[^?#]*(\?[^#]*)", 1),
            )
        )
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): nodes joined by a canonical link or a refresh redirect, distinct."""
    listed = pages.select(node_of(url_col).alias("a"), _references(html_col).alias("refs")).where("a IS NOT NULL AND size(refs) > 0")
    targets = listed.select("a", F.explode("refs").alias("ref")).withColumn("to", _resolved("ref", "a"))
    return targets.select("a", node_of("to").alias("b")).where("b IS NOT NULL AND a <> b").distinct()


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] | DataFrame = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """(id, url, host, path, rule, verdict, alias_of) of every row; alias_of is the least node of its component, NULL
    where the URL has no alias. ``redirects`` (source, target) holds observed redirects between URLs."""
    parts = []
    if html_col:
        parts.append(page_links(pages, url_col, html_col))
    if redirects is not None:
        parts.append(redirects.select(node_of("source").alias("a"), node_of("target").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b"))
    judged = with_rules(
        pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host_of("url"), "path": path_of("url")}), rules
    )
    if not parts:
        return judged.select("id", "url", "host", "path", "fit.rule", F.coalesce("fit.decided", F.lit(ALLOW)).alias("verdict"), F.lit(None).cast("string").alias("alias_of"))
    links = cut(reduce(DataFrame.unionByName, parts), "url-links")
    found = components(links, "url")
    # every node of a component, the least one included, with the decision of its own rule
    members = cut(found.unionByName(found.select(F.col("component").alias("id"), "component")).distinct(), "url-members")
    ruled = with_rules(members.withColumns({"host": host_of("id"), "path": path_of("id")}), rules)
    decided = cut(
        ruled.where("fit IS NOT NULL").groupBy("component")
        .agg(F.max(F.col("fit.decided") == ALLOW).alias("allowed"))
        .select(F.col("component").alias("group"), F.when(F.col("allowed"), ALLOW).otherwise(BLOCK).alias("by_alias")),
        "url-decided",
    )
    aliases = cut(
        members.join(decided, F.col("component") == F.col("group"), "left").select(F.col("id").alias("node"), F.col("component").alias("alias_of"), "by_alias"),
        "url-aliases",
    )
    return judged.withColumn("own", node_of("url")).join(aliases, F.col("own") == F.col("node"), "left").select(
        "id", "url", "host", "path", "fit.rule",
        F.coalesce("fit.decided", "by_alias", F.lit(ALLOW)).alias("verdict"), "alias_of",
    )
