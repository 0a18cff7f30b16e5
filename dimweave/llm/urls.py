"""URL filters: host rules and filter patterns, looked up by key instead of tried one by one.

* A host rule (host, path, verdict) fits a URL whose host is the rule's host or a subdomain
  of it and whose path starts with the rule's path; the longest fitting rule decides.
* A filter pattern (``||`` start of a host label, ``|`` start or end, ``^`` separator, ``*``
  anything, the rest literal; ``@@`` in front makes it an exception) becomes a regular
  expression.  Each pattern is indexed by its rarest literal token: rarity is counted over all
  URLs, and the tokens of a URL fetch the few patterns whose regular expression is then run.
  A pattern without a whole literal token is a candidate of every URL.

A URL's host rule decides; without one an exception allows, a pattern blocks, and the default
verdict holds for the rest.

Cases: a null URL or one without ``://`` has an empty host and path, fits no host rule and no
pattern; repeated rows are judged alike; an empty table gives an empty result; input columns
named like a result column are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUT = ["host", "path", "rule", "verdict", "pattern"]


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Pattern:
    """A filter pattern, its regular expression (over the URL with A-Z lower-cased) and its
    whole literal tokens."""

    text: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str


def parse_pattern(text: str) -> Pattern:
    body, verdict = (text[2:], "allow") if text.startswith("@@") else (text, "block")
    body = body.lower()
    core = body.removeprefix("||") if body.startswith("||") else body.removeprefix("|")
    head = r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?" if body.startswith("||") else "^" if body.startswith("|") else ""
    tail = "$" if core.endswith("|") else ""
    core = core.removesuffix("|")
    special = {"*": ".*", "^": "([^a-z0-9_.%-]|$)"}
    regex = head + "".join(special.get(c) or re.sub(r"([^a-z0-9/_%=&:,;!~@<>\"' -])", r"\\\1", c) for c in core) + tail
    tokens = []
    for m in re.finditer("[a-z0-9]+", core):
        before = head if m.start() == 0 else core[m.start() - 1].replace("*", "")
        after = tail if m.end() == len(core) else core[m.end()].replace("*", "")
        if before and after:  # else the URL's token may be longer than the pattern's
            tokens.append(m[0])
    return Pattern(text, "(?s)" + regex, tuple(dict.fromkeys(tokens)), verdict)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path from there to ``?``, ``#`` or the end."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def host_suffixes(host: Column) -> Column:
    """The host and every parent of it: a.b.c, b.c, c."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(url), F.lit("[a-z0-9]+"), 0))


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many of ``urls`` (column url) each of the rules' tokens occurs; at most one row
    for each token comes to the driver."""
    if not tokens:
        return {}
    hit = urls.select(F.explode(F.array_intersect(url_tokens(F.col("url")), F.array(*map(F.lit, tokens)))).alias("t"))
    return {r["t"]: r["n"] for r in hit.groupBy("t").agg(F.count("*").alias("n")).collect()}


def judge_urls(pages: DataFrame, host_rules: Sequence[HostRule], patterns: Sequence[str], *, url: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (the deciding host rule or null), pattern (the deciding
    filter pattern or null) and verdict.

    The rules are a list held by the caller; their tables take part in ordinary equi-joins
    (on a host suffix and on a token), so Spark broadcasts them only while they are small.
    Only distinct URLs are looked up, so a URL held by a third of all rows costs one lookup.
    """
    spark = pages.sparkSession
    base = pages.drop(*[c for c in OUT if c != url])
    key = "_u_url"
    urls = base.select(F.col(url).alias("url")).filter(F.col("url").contains("://")).distinct()
    parsed = [parse_pattern(p) for p in patterns]
    counts = token_counts(urls, sorted({t for p in parsed for t in p.tokens}))
    rows, always = [], []
    for k, p in enumerate(parsed):
        row = (p.regex, p.text, p.verdict, k)
        if p.tokens:
            rows.append((min(p.tokens, key=lambda t: (counts.get(t, 0), t)), *row))
        else:
            always.append(row)
    index = spark.createDataFrame(rows, "token string, regex string, pattern string, v string, k int")
    hosts = spark.createDataFrame([(r.host, r.path, r.name, r.verdict) for r in host_rules],
                                  "h string, p string, name string, v string")

    host, path = url_parts(F.col("url"))
    low = ascii_lower(F.col("url"))
    null = F.lit(None).cast("string")
    # rank: host rules before exceptions before blocking patterns; the smallest wins
    fit = (urls.select("url", path.alias("path"), F.explode(host_suffixes(host)).alias("h")).join(hosts, "h")
           .filter(F.col("path").startswith(F.col("p")))
           .select("url", F.struct(F.lit(0).alias("tier"), (-F.length("name")).alias("order"), F.col("name").alias("rule"),
                                   null.alias("pattern"), F.col("v").alias("v")).alias("d")))
    order = F.when(F.col("v") == "allow", 1).otherwise(2)
    decision = F.struct(order.alias("tier"), F.col("k").alias("order"), null.alias("rule"), F.col("pattern"),
                        F.col("v")).alias("d")
    hit = (urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token")).join(index, "token")
           .filter(F.rlike(low, F.col("regex"))).select("url", decision))
    found = fit.unionByName(hit)
    for regex, text, verdict, k in always:
        found = found.unionByName(
            urls.filter(low.rlike(regex)).withColumns({"pattern": F.lit(text), "v": F.lit(verdict), "k": F.lit(k)})
            .select("url", decision))
    best = found.groupBy(F.col("url").alias(key)).agg(F.min("d").alias("_u_d"))
    host, path = url_parts(F.col(url))
    joined = base.join(best, F.col(url) == F.col(key), "left")
    return joined.select(*[F.col(c) for c in base.columns], host.alias("host"), path.alias("path"),
                         F.col("_u_d.rule").alias("rule"), F.coalesce("_u_d.v", F.lit(default)).alias("verdict"),
                         F.col("_u_d.pattern").alias("pattern"))


#: The host rules of the op9 query.
HOST_RULES = [
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
]
#: The default filter patterns: advertising and tracking hosts, log-in and basket pages,
#: session links, binaries.
PATTERNS = [
    "||ads-track.", "||adserver.", "||doubleclick.", "||popunder.", "/banner/", "/popunder/", "/wp-login.php",
    "/cgi-bin/", "/login^", "/checkout/", "/cart/", "?sessionid=", "&sessionid=", "?phpsessid=", ".exe|", ".zip|",
    "@@/login^help", "@@||docs.*/cgi-bin/",
]
