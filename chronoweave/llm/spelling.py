"""Spelling variant grouping: words at edit distance one, found by their halves.

One edit leaves one of a word's halves as it was: the first at the start, or the second at the end of the other word. An
Aho-Corasick automaton for each shard holds halves; every word is scanned by the shards that can hold a half of a word near
to it, matches are checked for offset and length, and the distance is verified. Each ordered pair is met once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

#: Halves that one automaton holds, as an expected number.
SHARD = 100_000
#: Words with the same half at the same side that one shard holds; the words of a commoner half are dealt to several.
SAME_HALF = 20_000
#: Words of one half and length up to which a scanned word is verified against each; more are looked up by what is left
#: of them after one deletion.
DIRECT = 16
#: Distinct words a task counts before it hands them on.
HELD = 400_000
RUN = re.compile("[a-zÀ-ÿ]{6,}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    crc, counts = zlib.crc32, {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return batch

    for b in batches:
        for i, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
            raw = text.as_buffer()
            if raw is None:
                continue
            runs = RUN.findall(raw.to_pybytes().lower().decode("utf-8", "replace"))
            start = crc(b"%s:" % (b"" if i is None else str(i).encode()))
            seen: dict[str, str] = {}
            for run in runs:
                if (word := seen.get(run)) is None:
                    h = crc(run.encode(), start)
                    if h % 199 == 0:
                        at = h % len(run)
                        word = run[:at] + run[at + 1 :]
                        word = word if len(word) >= 6 else ""
                    else:
                        word = run
                    seen[run] = word
                counts[word] = counts.get(word, 0) + 1
            counts.pop("", None)
            if len(counts) > HELD:
                yield out()
    yield out()


def corpus_words(docs: DataFrame, least: int = 5) -> DataFrame:
    """(word, n) of the words of at least six code points that occur ``least`` times or more in all texts.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; where 199 divides the crc32 h of
    ``<doc_id>:<run>``, code point h % length is deleted. A null doc_id counts as an empty one, a null text has no words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i, top = 0, len(a)
    while i < top and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Shard:
    """Halves of words and the automaton that finds them. Segments are ``^half`` and ``half$`` in one automaton."""

    def __init__(self) -> None:
        self.by_half: dict[str, dict[int, list[tuple[str, int]]]] = {}
        self.rests: dict[tuple[str, int], dict[str, list[tuple[str, int]]]] = {}
        self.automaton = None

    def hold(self, half: str, word: str, n: int) -> None:
        self.by_half.setdefault(half, {}).setdefault(len(word), []).append((word, n))

    def close(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for half in self.by_half:
            self.automaton.add_word(half, half)
        self.automaton.make_automaton()

    def _near(self, half: str, size: int, word: str) -> Iterator[tuple[str, int]]:
        """Held words of length ``size`` with this half that are one edit away from ``word``, which has it in place."""
        words = self.by_half[half].get(size, ())
        if len(words) <= DIRECT:
            yield from (x for x in words if one_edit(x[0], word))
            return
        front = half[0] == "^"
        k = len(half) - 1
        rest = (lambda w: w[k:]) if front else (lambda w: w[: len(w) - k])
        if (table := self.rests.get((half, size))) is None:
            table = self.rests[half, size] = {}
            for x in words:
                r = rest(x[0])
                for v in {r, *(r[:i] + r[i + 1 :] for i in range(len(r)))}:
                    table.setdefault(v, []).append(x)
        r, seen = rest(word), set()
        for v in {r, *(r[:i] + r[i + 1 :] for i in range(len(r)))}:
            for x in table.get(v, ()):
                if x[0] not in seen:
                    seen.add(x[0])
                    if one_edit(x[0], word):
                        yield x

    def scan(self, word: str) -> tuple[int, int, str] | None:
        """(number of near words, n and text of the best) among the held words."""
        text, length, count, best = f"^{word}$", len(word), 0, None
        for end, half in self.automaton.iter(text):
            front = half[0] == "^"
            # offset: a first half begins, a second half ends the word; the marks make anything else impossible
            if end != (len(half) - 1 if front else length + 1):
                continue
            for size in (length - 1, length, length + 1):
                if len(half) - 1 != (size // 2 if front else size - size // 2):
                    continue
                for other, n in self._near(half, size, word):
                    if not front and word.startswith(other[: size // 2]):
                        continue  # met by its first half
                    count += 1
                    if best is None or (-n, other) < best:
                        best = (-n, other)
        return (count, -best[0], best[1]) if best else None


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, halves ahead of the words to scan."""
    now, shard = None, None
    for b in batches:
        found = []
        for key, half, word, n in zip(*(b[c].to_pylist() for c in ("shard", "half", "word", "n")), strict=True):
            if key != now:
                now, shard = key, Shard()
            if half is not None:
                shard.hold(half, word, n)
                continue
            if shard.automaton is None:
                shard.close()
            if shard.by_half and (hit := shard.scan(word)):
                found.append((word, *hit))
        cols = list(zip(*found, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, shard: int = SHARD, same_half: int = SAME_HALF) -> DataFrame:
    """(word, n_near, best_n, best) for each word of ``words`` (saved; word distinct, n) with near words.

    ``best`` is the near word of largest n, ties by code points. A word goes to at most six shards, more only where a half
    is shared by over ``same_half`` words; shards hold about ``shard`` halves.
    """
    total = words.count()
    shards = max(1, -(-2 * total // shard))
    halves = words.select("word", "n", F.explode(F.array(F.concat(F.lit("^"), F.expr("left(word, length(word) div 2)")), F.concat(F.expr("substring(word, int(length(word) div 2) + 1)"), F.lit("$")))).alias("half"))
    # at most 2 x words / same_half rows
    hot = F.broadcast(halves.groupBy("half").count().where(F.col("count") > same_half).select("half", F.ceil(F.col("count") / same_half).cast("int").alias("parts")))
    part = F.coalesce(F.col("parts"), F.lit(1))
    held = halves.join(hot, "half", "left").select(F.pmod(F.xxhash64("half", F.pmod(F.xxhash64("word"), part).cast("int")), F.lit(shards)).alias("shard"), "half", "word", "n")
    # halves that a near word of length size - 1, size or size + 1 can have: first of size // 2, second of size - size // 2
    sizes = "array(length(word) - 1, length(word), length(word) + 1)"
    probes = F.expr(f"array_distinct(concat(transform({sizes}, s -> concat('^', left(word, int(s div 2)))), transform({sizes}, s -> concat(right(word, int(s - s div 2)), '$'))))")
    scans = words.select("word", F.explode(probes).alias("half")).join(hot, "half", "left").select("word", "half", F.explode(F.sequence(F.lit(0), part - 1)).alias("part"))
    scans = scans.select(F.pmod(F.xxhash64("half", "part"), F.lit(shards)).alias("shard"), F.lit(None).cast("string").alias("half"), "word", F.lit(0).cast("long").alias("n")).distinct()
    rows = held.unionByName(scans).repartition("shard").sortWithinPartitions("shard", F.col("half").isNull())
    found = rows.mapInArrow(_match, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def group_variants(words: DataFrame, scratch: Scratch, ratio: int = 5, max_rounds: int = 40) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; other columns are ignored).

    ``form`` is the near word of largest n if that is at least ``ratio`` times the word's, else null; ``root`` the end of the
    chain of forms, which doubling jumps reach. Words are distinct, not null and have two code points or more. No words give
    no rows.
    """
    words = scratch.save(words.select("word", "n"))
    near = scratch.save(words.join(near_words(words), "word", "left").withColumn("form", F.expr(f"if(best_n >= {ratio} * n, best, null)")))
    ends = scratch.save(near.where("form is not null").select("word", F.col("form").alias("root")))
    for _ in range(max_rounds):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not ends.join(further, "root", "left_semi").limit(1).count():
            break
        ends, before = scratch.save(ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))), ends
        scratch.drop(before)
    else:
        raise RuntimeError("the chain of forms has no end")
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("if(form is null, null, best_n)").alias("form_n"))


def spelling_variants(docs: DataFrame, scratch: Scratch, least: int = 5) -> DataFrame:
    """The groups of all words of ``docs`` (doc_id, text), as in ``group_variants`` and ``corpus_words``.

    Null and empty texts have no words, repeated rows count again, texts of any length are read whole; no words, no rows.
    """
    return group_variants(corpus_words(docs, least), scratch)


#: By deletion neighbourhoods: words at distance one meet in what is left after one deletion at the same place, or one is such a rest.
ORACLE = r"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY doc_id, run),
k AS (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS raw FROM d),
x AS (SELECT *, hex(raw) AS s FROM k),
y AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(4 * length(s)), lambda i:
  (((instr('0123456789ABCDEF', s[(2 * (i // 8) + CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END)::INT]) - 1) >> (i % 4)::INT) & 1)::BIGINT)),
  lambda a, b: xor(a >> 1, 3988292384::BIGINT * (xor(a, b) & 1))), 4294967295::BIGINT) AS h FROM x),
z AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word, n FROM y),
w AS (SELECT word, sum(n)::BIGINT AS n FROM z WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
v AS (SELECT word, n, unnest(list_prepend({'rest': word, 'pos': -1}, list_transform(range(length(word)), lambda i: {'rest': left(word, i::BIGINT) || substr(word, (i + 2)::BIGINT), 'pos': i::INT})), recursive := true) FROM w),
p AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM v a JOIN v b USING (rest) WHERE a.word <> b.word AND (a.pos = b.pos OR least(a.pos, b.pos) = -1)),
f AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM p GROUP BY word),
g AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM w LEFT JOIN f USING (word)),
c AS (SELECT word, form AS root FROM g WHERE form IS NOT NULL)
"""
ORACLE = "WITH RECURSIVE" + ORACLE.strip()[4:] + """,
e AS (SELECT word, root, 1 AS step FROM c UNION ALL SELECT e.word, c.root, step + 1 FROM e JOIN c ON c.word = e.root),
t AS (SELECT word, arg_max(root, step) AS root FROM e GROUP BY word)
SELECT g.word, g.form, coalesce(t.root, g.word) AS root, g.n, g.n_near, g.form_n FROM g LEFT JOIN t USING (word)
"""


def op12(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), Scratch(spark))
