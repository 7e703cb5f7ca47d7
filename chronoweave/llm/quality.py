"""Quality rules: a short-circuit cascade of native rules, ordered by rejections per cost on a sample.

The measures are array and string functions of one row, so the plan is one map without a shuffle. A rule's own measures
stand in its branch of the cascade, so a document that an earlier rule rejects never pays for them. The order changes only
how soon a bad document is given up, never the verdict.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"
#: Rows that rule costs and selectivities are estimated on, and the share of the rows they are drawn from.
SAMPLE_ROWS, SAMPLE_SHARE = 500, 0.05


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(ws: Column, n: int = 8) -> Column:
    """Hashes of the n-word windows of an array."""
    return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.xxhash64(F.slice(ws, i, n)))).otherwise(F.array().cast("array<bigint>"))


def _covered(runs: Column, n: int = 8) -> Column:
    """Words in windows that stand twice or more, the first one included: equal neighbours among the sorted window hashes show
    the repeated windows, and their sorted starts cover the words."""
    at = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(at, F.slice(at, 2, F.size(runs)), lambda a, b: F.when(a["h"] == b["h"], F.struct(a["i"].alias("a"), b["i"].alias("b"))))
    pairs = F.filter(pairs, lambda p: p.isNotNull())
    twice = F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["a"], p["b"])))))
    return F.aggregate(
        twice,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(n))).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )


#: Arrays that several measures read; computed once a row.
_PARTS = {"_words": words, "_lines": lambda t: F.split(F.coalesce(t, F.lit("")), "\n")}
_LETTERS = "[A-Za-z\u00aa-\uffff]"


def _measure(name: str) -> Column:
    """A measure over text, _words, _lines and _runs."""
    t, n = F.coalesce("text", F.lit("")), F.size("_words").cast("long")
    full = F.filter("_lines", lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return {
        "n_words": n,
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size(full) - F.size(F.array_distinct(full))).cast("long"),
        "n_repeat_words": F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), _covered(F.col("_runs"))).otherwise(F.lit(0)).cast("long"),
    }[name]


#: The measures that every row gets, by the contract of op8.
CONTRACT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with_parts(docs: DataFrame) -> DataFrame:
    """``docs`` with the arrays of _PARTS and _runs; its columns travel in the struct ``row``, so that no name can clash."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    df = df.select("row", F.col("row.text").alias("text")).withColumns({k: f(F.col("text")) for k, f in _PARTS.items()})
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    return df.withColumn("_runs", repeated_words(F.col("_hashes"))).drop("_hashes")


@dataclass(frozen=True)
class QualityRule:
    """``fails`` is SQL over the measures it ``needs``."""

    name: str
    fails: str
    needs: tuple[str, ...]

    def test(self, have: tuple[str, ...] = ()) -> Column:
        """Whether the rule rejects; measures that are not in ``have`` are computed in place, in the rule's own branch."""
        sql = self.fails
        for n in self.needs:
            if n not in have:
                sql = re.sub(rf"\b{n}\b", lambda _: _SQL[n], sql)
        return F.expr(sql)


#: Measures of single rules as SQL over the arrays.
_SQL = {
    "n_lines": "size(_lines)",
    "n_letter_words": f"size(filter(_words, w -> w rlike '{_LETTERS}'))",
    "n_full_lines": r"size(filter(_lines, x -> x rlike '[^\\x20\\x09-\\x0D]'))",
    "n_cut_lines": r"size(filter(_lines, x -> x rlike '(\\.\\.\\.|\u2026)[\\x20\\x09-\\x0D]*$'))",
}
#: few_words and repeats are fixed by the contract of op8.
RULES = [
    QualityRule("few_words", "n_words < 20", ("n_words",)),
    QualityRule("repeats", "100 * n_repeat_words > 30 * n_words", ("n_repeat_words", "n_words")),
    QualityRule("symbols", "10 * n_symbols > 4 * n_words", ("n_symbols", "n_words")),
    QualityRule("dup_lines", "n_dup_lines >= 4 and 100 * n_dup_lines > 30 * n_lines", ("n_dup_lines", "n_lines")),
    QualityRule("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words", ("word_chars", "n_words")),
    QualityRule("few_letters", "2 * n_letter_words < n_words", ("n_letter_words", "n_words")),
    QualityRule("cut_lines", "n_cut_lines >= 4 and 10 * n_cut_lines > 3 * n_full_lines", ("n_cut_lines", "n_full_lines")),
]


def estimate_order(docs: DataFrame, rules: list[QualityRule] = RULES, rows: int = SAMPLE_ROWS, share: float = SAMPLE_SHARE, scratch: Scratch | None = None) -> list[tuple[QualityRule, float, float]]:
    """(rule, share rejected, seconds) by falling rejections per second on at most ``rows`` sampled documents.

    A rule is timed with the measures that it needs and no others, as the projection that the cascade runs."""
    scratch = scratch or Scratch(docs.sparkSession)
    sample = scratch.save(docs.select("text").sample(share, seed=17).limit(rows))
    own, total, found = _with_parts(sample), sample.count(), []
    timed = lambda r: own.select(*[_measure(n).alias(n) for n in CONTRACT if n in r.needs], "_words", "_lines", "text").select(r.test(CONTRACT).cast("int").alias("bad")).agg(F.sum("bad")).first()[0]
    if total:
        timed(rules[0])  # starts the session's machinery
    for r in rules:
        began = time.perf_counter()
        bad = timed(r) or 0 if total else 0
        found.append((r, bad / max(total, 1), time.perf_counter() - began))
    scratch.drop(sample)
    return sorted(found, key=lambda x: (-(x[1] + 1e-3) / x[2], x[0].name))


def quality_cascade(docs: DataFrame, rules: list[QualityRule] = RULES, order: list[QualityRule] | None = None) -> DataFrame:
    """docs' columns with the contract's measures, ``rejected_by`` (first failing rule in cascade order, else null) and ``kept``.

    ``order`` None estimates it on a sample. Needs ``text``; a null or empty text has no words and fails few_words; a very
    long text is one value of one task. The contract's measures are computed for every row; those of the other rules only
    where no earlier rule rejects. A column of docs that has the name of an output column is left out. Equal texts get equal
    verdicts; no rows give no rows.
    """
    cascade = order if order is not None else [r for r, *_ in estimate_order(docs, rules)]
    steps = F.lit(None).cast("string")
    for r in reversed(cascade):
        steps = F.when(r.test(CONTRACT), F.lit(r.name)).otherwise(steps)
    df = _with_parts(docs).select("row", "text", "_words", "_lines", *[_measure(n).alias(n) for n in CONTRACT])
    out = {*CONTRACT, "rejected_by", "kept"}
    df = df.select("row", *CONTRACT, steps.alias("rejected_by"))
    return df.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in out], *CONTRACT, "rejected_by", F.col("rejected_by").isNull().alias("kept"))


ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT r, p, unnest(ws[p:p+7]) AS x, unnest(range(8)) AS o FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS p FROM w WHERE len(ws) >= 8)),
h AS (SELECT r, p, string_agg(x, ' ' ORDER BY o) AS win FROM g GROUP BY r, p),
d AS (SELECT r, p, count(*) OVER (PARTITION BY r, win) AS n FROM h),
c AS (SELECT r, count(DISTINCT p + o) AS n FROM d, range(8) AS k(o) WHERE d.n > 1 GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(string_split(text, chr(10))) AS n_lines,
  len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z\x{00aa}-\x{ffff}]'))) AS n_letter_words, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_full_lines,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'))) AS n_cut_lines FROM w LEFT JOIN c USING (r) LEFT JOIN l USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 4 * n_words OR (n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 2 * n_letter_words < n_words OR (n_cut_lines >= 4 AND 10 * n_cut_lines > 3 * n_full_lines)) AS kept FROM b
"""


def op8(spark, sf_dir: str) -> DataFrame:
    out = quality_cascade(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.expr(f"({RULES[0].fails}) or ({RULES[1].fails})")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")
