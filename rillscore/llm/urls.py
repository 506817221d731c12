"""URL filters: rules by host and path, and redirect equivalence for the urls that no rule fits.

Pages that redirect to each other or name each other as canonical are aliases: the connected components over those edges.
A block decision of one alias holds for all of them, unless a rule allows one of them.
"""

from __future__ import annotations

import html
import html.entities
import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import table
from rillscore.llm.components import connected_components

#: (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
LINK = "(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"']?canonical\\b[^>]*>"
HREF = "(?is)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"
REFRESH = "(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b[^>]*>"
TO = "(?is)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)"
BASE = "(?is)<base\\b[^>]*\\bhref\\b[^>]*>"
#: A character reference of an attribute: a name without its semicolon counts only if neither `=` nor a letter or digit follows.
REFERENCE = "^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9])))"
#: Names (those with a semicolon have it) and the numbers that stand for another character than their own.
CHARACTERS = {**html.entities.html5, **{f"#{n}": html.unescape(f"&#{n};") for n in (0, 13, *range(128, 160))}}


def _parts(df: DataFrame, url: str) -> DataFrame:
    """Adds host and path: host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path what
    follows up to `?`, `#` or the end. Both are empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(F.col(url), F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits host and path as struct(rule, verdict), or null; of equally long ones an allow wins.

    A rule fits its host and all subdomains if the path starts with the rule's path. The rules become one expression;
    long lists are a table instead (see `judged`).
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judged(df: DataFrame, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Adds r, the struct of rule_of, to df(host, path, ...).

    rules is a list of (verdict, host, path), or a table with these columns for lists of any length: then the distinct
    hosts and paths meet the rules on each suffix of the host, and the best rule comes back on host and path.
    """
    if isinstance(rules, list):
        return df.withColumn("r", rule_of(rules))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = df.select("host", "path").distinct().withColumn("on", F.explode(suffixes))
    told = rules.select(F.col("verdict").alias("v"), F.col("host").alias("on"), F.col("path").alias("p"))
    fits = pairs.join(told, "on").where(F.col("path").startswith(F.col("p"))).withColumn("rule", F.concat("on", "p"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", F.col("v").alias("verdict")), F.struct(F.length("rule"), F.col("v") == "allow")).alias("r"))
    return df.join(best, ["host", "path"], "left")


def decoded(text: Column) -> Column:
    """An attribute's value with its character references decoded as HTML does it; unknown names stay."""
    known = F.from_json(F.lit(json.dumps(CHARACTERS)), "map<string,string>")

    def one(piece: Column) -> Column:
        ref = F.regexp_extract(piece, REFERENCE, 1)
        hexadecimal = F.regexp_extract(ref, "^#[xX]0*([0-9a-fA-F]*)", 1)
        decimal = F.regexp_extract(ref, "^#0*([0-9]*)", 1)
        of_hex = F.when(F.length(hexadecimal) > 6, 0x110000).otherwise(F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).cast("int"))
        of_decimal = F.when(F.length(decimal) > 7, 0x110000).otherwise(F.concat(F.lit("0"), F.substr(decimal, F.lit(1), F.lit(7))).cast("int"))
        point = F.when(ref.rlike("^#[xX]"), of_hex).otherwise(of_decimal)
        point = F.when((point > 0x10FFFF) | point.between(0xD800, 0xDFFF), 0xFFFD).otherwise(point)
        number = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        key = F.when(ref.startswith("#"), F.concat(F.lit("#"), point.cast("string"))).otherwise(ref)
        char = F.coalesce(known[key], F.when(ref.startswith("#"), number))
        return F.when(ref == "", piece).otherwise(F.coalesce(F.concat(char, F.substr(piece, F.length(ref) + 2)), piece))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "(?=&)"), one), "")).otherwise(text)


def resolved(url: Column, to: Column) -> Column:
    """The target of a reference in the page url (RFC 3986); null for a relative one where url has no `://`.

    Targets with a scheme or a host stay as they are; the paths of others lose their `.` and `..` segments.
    """
    url = F.regexp_replace(url, "(?s)#.*$", "")
    origin = F.regexp_extract(url, "^[^/?#]*://[^/?#]*", 0)
    path = F.regexp_extract(url, "^[^/?#]*://[^/?#]*([^?#]*)", 1)
    own, rest = F.regexp_extract(to, "^[^?#]*", 0), F.regexp_extract(to, "(?s)^[^?#]*(.*)$", 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "(?s)^.*/", 0))
    whole = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    whole = F.when(whole.rlike("/\\.\\.?$"), F.concat(whole, F.lit("/"))).otherwise(whole)

    def step(kept: Column, segment: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        return F.when(segment == "..", up).when(segment == ".", kept).otherwise(F.array_append(kept, segment))

    whole = F.array_join(F.aggregate(F.split(whole, "/"), F.array().cast("array<string>"), step), "/")
    relative = F.when(own == "", F.when(rest.startswith("?"), F.concat(origin, path, rest)).otherwise(url)).otherwise(F.concat(origin, whole, rest))
    return F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), to).when(origin == "", None).when(to.startswith("//"), F.concat(F.regexp_extract(url, "^[^/?#]*:", 0), to)).otherwise(relative)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b): url and the target of each canonical link and refresh, without fragments, as `_node` writes them.

    Character references in targets are decoded. Relative targets are resolved against the page's `<base href>`, itself
    resolved against the url, or else against the url.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    named = lambda element, target, at: F.transform(F.regexp_extract_all(html, F.lit(element), 0), lambda e: F.struct(F.lit(at).alias("at"), F.regexp_extract(e, target, 1).alias("to")))
    found = pages.select(F.col(url_col).cast("string").alias("url"), F.regexp_extract(F.regexp_extract(html, BASE, 0), HREF, 1).alias("base"), F.explode(F.concat(named(LINK, HREF, 0), named(REFRESH, TO, 1))).alias("e"))
    found = found.select("url", "base", "e.at", "e.to").where("to <> '' AND url IS NOT NULL")
    # Each step is generated, so that the optimizer does not write one step's expression into every use by the next.
    step = lambda c, name: F.explode(F.array(c)).alias(name)
    found = found.select("url", "at", step(F.transform(F.array("base", "to"), decoded), "d"))
    # The quotes around a refresh's target may be references themselves.
    to = F.when(F.col("at") == 1, F.regexp_extract(F.col("d")[1], "^[\"']?([^\"']*)", 1)).otherwise(F.col("d")[1])
    found = found.select("url", F.col("d")[0].alias("base"), step(to, "to"))
    base = F.when(F.col("base") == "", F.col("url")).otherwise(F.coalesce(resolved(F.col("url"), F.col("base")), F.col("url")))
    found = found.select("url", "to", step(base, "from"))
    # A mere fragment is the page itself, whatever its base.
    found = found.where("to <> '' AND NOT startswith(to, '#')").select("url", step(resolved(F.col("from"), F.col("to")), "to"))
    return found.select(_node(F.col("url")).alias("a"), _node(F.col("to")).alias("b")).where("contains(b, '://')")


def _node(url: Column) -> Column:
    """The url as a vertex: without fragment, scheme and host in lower case (A-Z), an empty path as `/`."""
    url = F.regexp_replace(url, "(?s)#.*$", "")
    front = F.regexp_extract(url, "^[^/?#]*://[^/?#]*", 0)
    rest = F.substr(url, F.length(front) + 1)
    lower = F.translate(front, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(front == "", url).otherwise(F.concat(lower, F.when(rest.startswith("/"), "").otherwise("/"), rest))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: id, host, path, rule (host and path of the longest that fits, or null), verdict (allow or block).

    A rule's verdict holds for the url itself. Without a rule the aliases decide: allow if a rule allows any of them,
    else block if a rule blocks any of them, else allow. redirects(a, b), if given, are more edges. Null urls and urls
    without `://` have empty host and path, fit no rule and are allowed; null or empty html has no edges. Repeated rows
    get a row each; an empty table gives an empty table. Only edges and their ends are shuffled, never pages or html;
    a target that very many pages name is a key of labels that are minimised before they meet.
    """
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(_node(F.col("a").cast("string")).alias("a"), _node(F.col("b").cast("string")).alias("b")))
    edges = table(edges.where("a <> b").distinct(), "alias-edges")
    out = judged(_parts(pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("u")), "u"), rules)
    verdict = F.col("r.verdict")
    if edges.limit(1).count():
        members = connected_components(edges, "aliases")
        ruled = judged(_parts(members, "node"), rules)
        say = ruled.where("r IS NOT NULL").groupBy("label").agg(F.max(F.when(F.col("r.verdict") == "allow", 1)).alias("allowed"))
        alias = members.join(say, "label").select(F.col("node").alias("n"), F.when(F.col("allowed") == 1, "allow").otherwise("block").alias("alias_verdict"))
        out = out.withColumn("n", _node(F.col("u"))).join(alias, "n", "left")
        verdict = F.coalesce(verdict, "alias_verdict")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), F.coalesce(verdict, F.lit("allow")).alias("verdict"))


def oracle(rules: list[tuple[str, str, str]] = RULES) -> str:
    """DuckDB SQL for the same rows: rules as a table, aliases by a recursive query over the edges."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    parts = """lower_ascii(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path""".replace("lower_ascii(", "translate(").replace("'^[^/?#]*')) AS host", f"'^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host")
    rest = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END AS rest"
    fit = "(x.host = r.host OR ends_with(x.host, '.' || r.host)) AND starts_with(x.path, r.path)"
    rx = lambda p: p.replace("'", "''")
    return f"""
    WITH RECURSIVE rules(verdict, host, path) AS (VALUES {values}),
    p0 AS (SELECT page_id, url, html, {rest.format("url")} FROM pages),
    p AS (SELECT page_id, url, html, {parts} FROM p0),
    found AS (
      SELECT url, regexp_extract(regexp_extract(html, '{rx(LINK)}'), '{rx(HREF)}', 1) AS target FROM pages
      UNION ALL SELECT url, regexp_extract(regexp_extract(html, '{rx(REFRESH)}'), '{rx(TO)}', 1) FROM pages),
    resolved AS (
      SELECT url, CASE WHEN starts_with(target, '//') THEN regexp_extract(url, '^[^/?#]*:') || target
                       WHEN starts_with(target, '/') THEN regexp_extract(url, '^[^/?#]*://[^/?#]*') || target ELSE target END AS target
      FROM found WHERE target <> '' AND url IS NOT NULL),
    e0 AS (SELECT split_part(url, '#', 1) AS a, split_part(target, '#', 1) AS b FROM resolved WHERE contains(target, '://')),
    e AS (SELECT a, b FROM e0 WHERE a <> b UNION SELECT b, a FROM e0 WHERE a <> b),
    reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
    n0 AS (SELECT DISTINCT b AS node, {rest.format("b")} FROM reach),
    x AS (SELECT node, {parts} FROM n0),
    node_rule AS (SELECT x.node, arg_max(r.verdict, (length(r.host || r.path), r.verdict = 'allow')) AS verdict FROM x JOIN rules r ON {fit} GROUP BY 1),
    alias AS (SELECT reach.a AS node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reach JOIN node_rule ON reach.b = node_rule.node GROUP BY 1),
    page_rule AS (
      SELECT x.host, x.path, arg_max(r.host || r.path, (length(r.host || r.path), r.verdict = 'allow')) AS rule,
             arg_max(r.verdict, (length(r.host || r.path), r.verdict = 'allow')) AS verdict
      FROM (SELECT DISTINCT host, path FROM p) x JOIN rules r ON {fit} GROUP BY 1, 2)
    SELECT p.page_id, p.host, p.path, q.rule, coalesce(q.verdict, alias.verdict, 'allow') AS verdict
    FROM p LEFT JOIN page_rule q ON p.host = q.host AND p.path = q.path LEFT JOIN alias ON split_part(p.url, '#', 1) = alias.node
    """
