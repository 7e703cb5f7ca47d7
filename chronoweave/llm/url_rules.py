"""URL filters: pattern rules indexed by their rarest literal token.

The tokens of a URL fetch the few rules that can match; only those run their regular expressions. Everything is one
map over the URLs: the rule table is a bounded constant of the plan, and no URL is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most rules of one rule set; the set is sent with every task.
MAX_RULES = 20_000
TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``kind`` site: ``text`` is host and path prefix, for the host and its subdomains. ``kind`` pattern: ``text`` is
    literal text over host and path, with ``*`` for any run, ``^`` for a separator or end, ``||`` for a host label start."""

    text: str
    action: str
    kind: str = "pattern"

    def regex(self) -> str:
        if self.kind == "site":
            host, _, path = self.text.partition("/")
            return f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape('/' + path)}"
        body = self.text[2:] if self.text.startswith("||") else self.text
        out = "".join({"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}.get(c, re.escape(c)) for c in body)
        return "(?s)" + ("^(?:[^/]*\\.)?" if self.text.startswith("||") else "") + out

    def tokens(self) -> list[str]:
        """Literal tokens that every matching URL holds as whole tokens: those with a separator or anchor on either side."""
        text = self.text.lower()
        anchored = self.kind == "site" or text.startswith("||")
        text = text[2:] if text.startswith("||") else text
        found = []
        for m in re.finditer(TOKEN, text):
            before = anchored if m.start() == 0 else text[m.start() - 1] != "*"
            after = m.end() < len(text) and text[m.end()] != "*"
            if before and after:
                found.append(m[0])
        return list(dict.fromkeys(found))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path up to ``?``, ``#`` or the
    end. Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.regexp_replace(rest, r"(?s)[?#].*$", "")
    cut = F.instr(rest, "/")
    host = F.when(cut > 0, F.substring(rest, F.lit(1), cut - 1)).otherwise(rest)
    path = F.when(cut > 0, F.substring(rest, cut, F.length(rest))).otherwise("")
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    return F.split(ascii_lower(F.concat(host, path)), "[^a-z0-9]+")


def token_counts(pages: DataFrame, tokens: list[str], url: str = "url") -> dict[str, int]:
    """How many URLs hold each of the given tokens, over all rows; the result is at most as large as the rule set."""
    host, path = split_url(F.col(url))
    held = F.array_intersect(url_tokens(host, path), F.array(*map(F.lit, tokens)))
    rows = pages.select(F.explode(held).alias("t")).groupBy("t").count().collect()
    return dict.fromkeys(tokens, 0) | {r["t"]: r["count"] for r in rows}


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and matched pattern for each row of ``pages``.

    Among the matching site rules the longest text wins (then the smaller text) and gives ``rule`` and ``verdict``. With
    no site rule, ``rule`` is null and the matching pattern rules decide: an allow pattern before a block pattern; the
    deciding text is ``pattern``. With no match the verdict is ``default``. A null, empty or malformed URL has an empty
    host and path; a very long one is one value of one task. Repeated rows and ids stay; columns other than ``keep`` and
    ``url`` are ignored, and a kept column that has the name of an output column is left out; no rows give no rows.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    keep = tuple(k for k in keep if k.lower() not in ("host", "path", "rule", "verdict", "pattern"))
    # kept columns travel in one struct, so that no name can clash
    src = pages.select(F.struct(*[F.col(f"`{k}`") for k in keep] or [F.lit(None).alias("none")]).alias("_keep"), F.col(url).alias("_url"))
    counts = token_counts(src, sorted({t for r in rules for t in r.tokens()} or {""}), "_url")
    index: dict[str, list[Rule]] = {}
    for r in rules:
        rarest = min(r.tokens(), key=lambda t: (counts[t], t), default="")  # without a whole token, the rule is for every URL
        index.setdefault(rarest, []).append(r)
    host, path = split_url(F.col("_url"))
    at = src.select("_keep", host.alias("host"), path.alias("path"))
    entry = lambda r: F.struct(F.lit(r.kind == "site").alias("site"), F.lit(len(r.text)).alias("size"), F.lit(r.action == "allow").alias("allow"), F.lit(r.text).alias("text"), F.lit(r.regex()).alias("regex"))
    if not index:
        index[""] = [Rule("\0", default)]
    table = F.create_map(*[x for t, rs in index.items() for x in (F.lit(t), F.array(*map(entry, rs)))])
    held = F.array_intersect(F.concat(F.array(F.lit("")), url_tokens(F.col("host"), F.col("path"))), F.array(*map(F.lit, index)))
    fetched = F.flatten(F.transform(held, lambda t: F.coalesce(F.try_element_at(table, t), F.array().cast("array<struct<site:boolean,size:int,allow:boolean,text:string,regex:string>>"))))
    matched = F.filter(F.col("fetched"), lambda r: F.rlike(F.concat("host", "path"), r["regex"]))
    best = lambda site: F.element_at(F.array_sort(F.filter(F.col("matched"), lambda r: r["site"] if site else ~r["site"]), lambda a, b: _order(a, b, site)), 1)
    at = at.withColumn("fetched", F.when(F.size(held) > 0, fetched)).withColumn("matched", F.when(F.size("fetched") > 0, matched))
    at = at.withColumn("_site", F.when(F.exists("matched", lambda r: r["site"]), best(True))).withColumn("_pattern", F.when(F.exists("matched", lambda r: ~r["site"]), best(False)))
    chosen = F.coalesce("_site", "_pattern")
    verdict = F.when(chosen.isNull(), F.lit(default)).when(chosen["allow"], F.lit("allow")).otherwise(F.lit("block"))
    return at.select(*[F.col("_keep")[k].alias(k) for k in keep], "host", "path", F.col("_site")["text"].alias("rule"), verdict.alias("verdict"), F.when(F.col("_site").isNull(), F.col("_pattern")["text"]).alias("pattern"))


def _order(a: Column, b: Column, site: bool) -> Column:
    x, y = ("size", None) if site else ("allow", "size")
    first = F.when(a[x] > b[x], -1).when(a[x] < b[x], 1)
    if y:
        first = first.when(a[y] > b[y], -1).when(a[y] < b[y], 1)
    return first.when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0)


#: Fixed by the contract of op2.
SITE_RULES = [Rule("net/", "block", "site"), Rule("example.net/en/", "allow", "site"), Rule("example.com/de/", "block", "site"), Rule("org/fr/", "allow", "site")]
#: The method's own rules: advertising and gambling hosts, tracking paths.
PATTERN_RULES = [Rule(t, "block") for t in ("||cheap-pills.", "||free-bets.", "||casino.", "||adserver.", "||click-here.", "||payday-loans.", "/ads/banner^", "/affiliate/*/out^", "/track/click^", "-online-casino^")] + [Rule("||casino.example.org/history/", "allow")]

ORACLE = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_replace(substr(url, strpos(url, '://') + 3), '[?#][\s\S]*$', '') ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE rest END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM u),
r(rule, rhost, rpath, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM (SELECT DISTINCT page_id, host, path FROM p), r
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
t(pattern, regex, action) AS (VALUES __PATTERNS__),
b AS (SELECT page_id, arg_max(pattern, CASE WHEN action = 'allow' THEN 1000 ELSE 0 END + length(pattern)) AS pattern, arg_max(action, CASE WHEN action = 'allow' THEN 1000 ELSE 0 END + length(pattern)) AS action
  FROM (SELECT DISTINCT page_id, host, path FROM p), t WHERE regexp_matches(host || path, regex) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.action, b.action, 'allow') AS verdict, CASE WHEN m.rule IS NULL THEN b.pattern END AS pattern
FROM p LEFT JOIN m USING (page_id) LEFT JOIN b USING (page_id)
""".replace("__PATTERNS__", ", ".join("('{}', '{}', '{}')".format(r.text, r.regex(), r.action) for r in PATTERN_RULES))


def op2(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), SITE_RULES + PATTERN_RULES)
