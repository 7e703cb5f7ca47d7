"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is a context restaurant whose customers are the words that followed it; all contexts share one parent, the root
restaurant of single words, whose base is uniform over the vocabulary and one unknown word. A context's tables are the root's
customers. Seatings are kept by their number of tables for each (context, word): Gibbs sweeps draw it from its conditional
distribution given the customers, the context's tables and the root's probability; the root's tables are drawn alike. Draws
of one sweep use the state of the sweep before, so all restaurants are drawn at once, and each draw is a function of a hash of
its pair: any task can draw it again. Probabilities are averaged over the last sweeps.

Texts are hashed once, into chunks of about a million tokens with a word list each; later passes read those. Pairs meet in
buckets, as sorted hashes of chunks; chunks get counts back by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch
from .words import chunks, mix

#: Tokens of a chunk, about; a document is never cut.
CHUNK_TOKENS = 1 << 20
#: (chunk, pair) entries that one bucket gets, as an expected number.
BUCKET = 2_000_000
#: Most frequent words whose values are sent to every task; the others meet the chunks' word lists in a shuffle.
HOT_WORDS = 1 << 17
#: Customers up to which the number of tables is drawn from its exact conditional distribution; beyond, from the limit.
EXACT = 200
#: Gibbs sweeps; the first BURN_IN are not averaged.
SWEEPS, BURN_IN = 3, 1
THETA, ROOT_THETA = 1.0, 1.0
#: The word that ends every text; as a context it stands for the start.
END = np.uint64(0x5EED0F7E27)
GOLD = np.uint64(0x9E3779B97F4A7C15)

ENCODED = "chunk long, words binary, codes binary, ids binary, id_null binary, sizes binary, kinds binary"
COUNTED = ENCODED + ", counts binary, n binary, alone_context binary, alone_word binary, all_context binary, all_word binary, pair_context binary, pair_word binary, pair_n binary"


def _planes(x: np.ndarray) -> bytes:
    """uint32 values by byte planes, which compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplane(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def encode(docs: DataFrame, mod: int = 7, held: int = 2) -> DataFrame:
    """Chunks of whole documents (``ENCODED``): the words' hashes by falling frequency, every token's place in that list,
    ids, tokens of each document (its end included) and kind (0 learned from, 1 held out, 2 neither: no id)."""
    rest = F.expr("crc32(encode(cast(cast(doc_id as long) as string), 'UTF-8'))") % mod
    kind = F.when(F.col("doc_id").isNull(), 2).when(rest == held, 1).otherwise(0).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, k = TaskContext.get().partitionId() << 32, 0
        tokens, ids, sizes, kinds, held_tokens = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            words, codes = _distinct(np.concatenate(tokens))
            order = np.argsort(-np.bincount(codes), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            cols = [words[order].tobytes(), _planes(place[codes]), np.array([i or 0 for i in ids], np.int64).tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(), np.array(sizes, np.int64).tobytes(), np.array(kinds, np.uint8).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([base + k]), *[pa.array([c], pa.binary()) for c in cols]], [x.split()[0] for x in ENCODED.split(", ")])

        for b in batches:
            for i, h, _, _, at, _ in chunks(b["text"]):
                for j in range(len(at) - 1):
                    own = h[at[j] : at[j + 1]]
                    tokens.append(np.append(own, END))
                    ids.append(b["doc_id"][i + j].as_py())
                    kinds.append(b["kind"][i + j].as_py())
                    sizes.append(len(own) + 1)
                    held_tokens += len(own) + 1
                if held_tokens >= CHUNK_TOKENS:
                    yield out()
                    k += 1
                    tokens, ids, sizes, kinds, held_tokens = [], [], [], [], 0
        if tokens:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), kind.alias("kind")).mapInArrow(run, ENCODED)


class Chunk:
    """A chunk's tokens and its distinct pairs by rising hash; buckets are ranges of hashes."""

    def __init__(self, row: dict) -> None:
        self.words = np.frombuffer(row["words"], np.uint64)
        self.codes = _unplane(row["codes"]).astype(np.int64)
        self.sizes, self.kinds = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["kinds"], np.uint8)
        self.learned = np.repeat(self.kinds == 0, self.sizes)
        end = np.flatnonzero(self.words == END)
        before = np.concatenate((end, self.codes[:-1]))
        key = mix((self.words * GOLD)[before] + mix(self.words)[self.codes])
        order = _argsort(key)
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = order[new]
        self.key, self.context, self.word = key[new], before[first], self.codes[first]
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.n = np.bincount(self.at[self.learned], minlength=len(first)).astype(np.int64)


def _argsort(x: np.ndarray) -> np.ndarray:
    """Stable order of uint64 hashes: their leading bits sorted together with their places, which is much faster than sorting
    places; hashes that differ only in the bits left out are rare and sorted the plain way."""
    bits = np.uint64(max(1, len(x).bit_length()))
    packed = (x >> bits << bits) | np.arange(len(x), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    y = x[order]
    return order if (y[1:] >= y[:-1]).all() else np.argsort(x, kind="stable")


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and the place of each entry among them."""
    order = _argsort(x)
    y = x[order]
    new = np.concatenate(([True], y[1:] != y[:-1]))[: len(y)]
    at = np.empty(len(x), np.int64)
    at[order] = np.cumsum(new) - 1
    return y[new], at


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * GOLD + mix(word))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b[c][i].as_py() for c in b.schema.names}


def _small(x: np.ndarray) -> bytes:
    """Mostly small counts: one byte each and the large ones apart."""
    big = np.flatnonzero(x >= 255)
    return np.array([len(big)], np.int64).tobytes() + big.astype(np.int64).tobytes() + x[big].astype(np.int64).tobytes() + np.minimum(x, 255).astype(np.uint8).tobytes()


def _unsmall(b: bytes) -> np.ndarray:
    k = int(np.frombuffer(b, np.int64, 1)[0])
    out = np.frombuffer(b, np.uint8, offset=8 + 16 * k).astype(np.int64)
    out[np.frombuffer(b, np.int64, k, 8)] = np.frombuffer(b, np.int64, k, 8 + 8 * k)
    return out


def _ranges(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of sorted hashes: buckets are equal ranges of hashes."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[a]), int(a), int(z)) for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)], strict=True) if z > a]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    names = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, names, strict=True)], [n for n, _ in names])


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(schema, rows)])


def count_pairs(chunk_rows: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, counts, own): for each pair of a chunk, in its order, the customers in all learned texts, and one bit
    that gives each pair to one of the chunks that learned it. A chunk sends each pair once, whatever its number."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            parts = _ranges(c.key, buckets)
            yield _batch("chunk long, bucket long, keys binary, n binary", [(row["chunk"], k, c.key[a:z].tobytes(), _small(c.n[a:z])) for k, a, z in parts])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        keys = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        n = np.concatenate([_unsmall(x) for x in table["n"].to_pylist()])
        _, at = _distinct(np.concatenate(keys))
        total = np.bincount(at, weights=n, minlength=at.max() + 1).astype(np.int64)
        owner = np.full(len(total), len(at), np.int64)
        np.minimum.at(owner, at[n > 0], np.flatnonzero(n > 0))
        own = owner[at] == np.arange(len(at))
        edge = np.cumsum([0] + [len(k) for k in keys])
        counts = total[at]
        parts = list(zip(edge[:-1], edge[1:], strict=True))
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "counts": pa.array([_small(counts[a:z]) for a, z in parts], pa.binary()), "own": pa.array([np.packbits(own[a:z]).tobytes() for a, z in parts], pa.binary())})

    sent = chunk_rows.select("chunk", "words", "codes", "sizes", "kinds").mapInArrow(send, "chunk long, bucket long, keys binary, n binary")
    return sent.groupBy("bucket").applyInArrow(add, "chunk long, bucket long, counts binary, own binary")


def attach_counts(chunk_rows: DataFrame, counted: DataFrame) -> DataFrame:
    """Chunks with the counts of their pairs (``COUNTED``), learned tokens of each word, own pairs by context and by word (those
    met once, and all), and the own pairs met more often."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        c, right = Chunk(next(_rows(left.to_batches()))), right.sort_by("bucket")
        parts = [_unsmall(x) for x in right["counts"].to_pylist()]
        own = np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(x)) for o, x in zip(right["own"].to_pylist(), parts, strict=True)]).astype(bool)
        counts, size = np.concatenate(parts), len(c.words)
        once, more = own & (counts == 1), own & (counts > 1)
        by_word = [np.bincount(x, minlength=size) for x in (c.codes[c.learned], c.context[once], c.word[once], c.context[own], c.word[own])]
        cols = [_small(counts), *map(_small, by_word), _planes(c.context[more]), _planes(c.word[more]), _small(counts[more])]
        for name, col in zip(COUNTED.split(", ")[len(ENCODED.split(", ")) :], cols, strict=True):
            left = left.append_column(name.split()[0], pa.array([col], pa.binary()))
        return left

    return chunk_rows.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(join, COUNTED)


WORD_SUMS = ("n", "alone_context", "alone_word", "all_context", "all_word")
LEARNED = "bucket long, words binary, " + ", ".join(f"{x} binary" for x in WORD_SUMS) + ", size long, tokens long, alone long, once long, twice long"


def learned_words(counted: DataFrame, buckets: int) -> DataFrame:
    """One row for each range of word hashes (``LEARNED``): the words, their learned tokens, and their pairs as context and as
    word - those met once, which have one table for good, and all; with the row's totals."""

    def sums(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        words, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        words, at = _distinct(words)
        return [words, *[np.bincount(at, weights=x, minlength=len(words)).astype(np.int64) for x in rest]]

    schema = "bucket long, words binary, " + ", ".join(f"{x} binary" for x in WORD_SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _rows(batches):
            n, *more = (_unsmall(row[x]) for x in WORD_SUMS)
            yes = n > 0
            held.append([np.frombuffer(row["words"], np.uint64)[yes], n[yes], *[x[yes] for x in more]])
            size += len(n)
            if size > 1_000_000:
                cols = sums(held)
                held, size = [], 0
                yield _batch(schema, [(k, cols[0][a:z].tobytes(), *[_small(x[a:z]) for x in cols[1:]]) for k, a, z in _ranges(cols[0], buckets)])
        if held:
            cols = sums(held)
            yield _batch(schema, [(k, cols[0][a:z].tobytes(), *[_small(x[a:z]) for x in cols[1:]]) for k, a, z in _ranges(cols[0], buckets)])

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        cols = sums([[np.frombuffer(r["words"], np.uint64), *[_unsmall(r[x]) for x in WORD_SUMS]] for r in rows])
        return _table(LEARNED, [(rows[0]["bucket"], cols[0].tobytes(), *[_small(x) for x in cols[1:]], len(cols[0]), int(cols[1].sum()), int(cols[2].sum()), int((cols[5] == 1).sum()), int((cols[5] == 2).sum()))])

    return counted.select("words", *WORD_SUMS).mapInArrow(run, schema).groupBy("bucket").applyInArrow(add, LEARNED)


ANSWER = "chunk long, bucket long, known binary, n binary, floats binary"
PAIRS = "kind int, bucket long, contexts binary, words binary, n binary, tables binary, twice long"
#: Kinds of packed pairs: both words hot (places in the hot list), a hot context and another word (bucket of the word),
#: another context (its bucket), and that with its context's tables (bucket of the word).
BOTH, HOT_CONTEXT, COLD, ASKED = range(4)


def learned_pairs(counted: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Pairs met twice or more, each once, packed (``PAIRS``) by where their values are to be had. No bucket holds a hot word's
    pairs, so buckets stay even."""
    sent = counted.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for row in _rows(batches):
            words = np.frombuffer(row["words"], np.uint64)
            a, w, n = _unplane(row["pair_context"]), _unplane(row["pair_word"]), _unsmall(row["pair_n"])
            yes, place = _inside(hot, words)
            both, front = yes[a] & yes[w], yes[a] & ~yes[w]
            out = [(BOTH, 0, _planes(place[a[both]]), _planes(place[w[both]]), _small(n[both]), None, int((n[both] == 2).sum()))]
            for kind, mask, by in ((HOT_CONTEXT, front, w), (COLD, ~yes[a], a)):
                at = np.flatnonzero(mask)
                at = at[_argsort(words[by[at]])]
                for k, x, z in _ranges(words[by[at]], buckets):
                    p = at[x:z]
                    out.append((kind, k, words[a[p]].tobytes(), words[w[p]].tobytes(), _small(n[p]), None, int((n[p] == 2).sum())))
            yield _batch(PAIRS, out)

    return counted.select("words", "pair_context", "pair_word", "pair_n").mapInArrow(run, PAIRS)


class Seats:
    """Draws numbers of tables. For c customers of one dish, t tables have weight x**t S(c, t): S are the generalized
    Stirling numbers of the discount, x the weight of a new table (concentration and discount times tables, times the parent's
    probability)."""

    def __init__(self, discount: float) -> None:
        self.d = discount
        rows = [np.array([0.0])]  # log S(1, 1)
        for c in range(1, EXACT):
            old = rows[-1]
            t = np.arange(1, c + 2)
            stay = np.full(c + 1, -np.inf)
            stay[:c] = old + np.log(c - t[:c] * discount)
            rows.append(np.logaddexp(stay, np.concatenate(([-np.inf], old))))
        self.log_s = rows

    def draw(self, c: np.ndarray, x: np.ndarray, key: np.ndarray, sweep: int) -> np.ndarray:
        """One draw for each entry; the same for equal arguments on any machine."""
        salt = mix(key + mix(np.array([2 * sweep + 1], np.uint64)))
        u, v = _unit(salt), _unit(mix(salt + GOLD))
        t, logx = np.ones(len(c), np.int64), np.log(np.maximum(x, 1e-300))
        capped = np.minimum(c, EXACT + 1)
        order = np.lexsort((logx, capped))
        edges = np.searchsorted(capped[order], np.arange(2, EXACT + 3))
        for k in range(2, EXACT + 1):
            own = order[edges[k - 2] : edges[k - 1]]
            for at in range(0, len(own), 1 << 13):
                part = own[at : at + (1 << 13)]
                # beyond the last number of any weight for the largest x there is none for a smaller x either
                most = logx[part[-1]] * np.arange(k) + self.log_s[k - 1]
                size = int(np.flatnonzero(most > most.max() - 36)[-1]) + 1
                w = logx[part, None] * np.arange(size) + self.log_s[k - 1][:size]
                w = np.exp(w - w.max(1, keepdims=True)).cumsum(1)
                t[part] = 1 + (w < (u[part] * w[:, -1])[:, None]).sum(1)
        if len(own := order[edges[-1] :]):
            t[own] = self._limit(c[own].astype(np.float64), x[own], u[own], v[own])
        return np.minimum(t, c)

    def _limit(self, c: np.ndarray, x: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Tables of many customers: a compound Poisson sum of table sizes conditioned on its total c, by exponential
        tilting: with y = 1 - z, the mean total x z y**(d - 1) is c, the tables' mean x (1 - y**d) / d."""
        d, low, high = self.d, np.full(len(c), -700.0), np.full(len(c), -1e-12)
        for _ in range(42):  # log y by halving
            mid = (low + high) / 2
            more = np.log(np.maximum(x, 1e-300)) + np.log(-np.expm1(mid)) + (d - 1) * mid > np.log(c)
            low, high = np.where(more, mid, low), np.where(more, high, mid)
        y = np.exp((low + high) / 2)
        mean = x * -np.expm1(d * (low + high) / 2) / d
        total = c * (1 + (1 - y) * (1 - d) / y)
        var = np.maximum(mean - c * c / total, 1e-9)
        normal = np.rint(mean + np.sqrt(var) * np.sqrt(-2 * np.log(np.maximum(u, 1e-300))) * np.cos(2 * np.pi * v))
        # few tables besides the large one: a Poisson number, by inversion
        k, p, left = np.zeros(len(c)), np.exp(-np.minimum(mean, 30)), u.copy()
        for i in range(1, 80):
            go = left > p
            if not go.any():
                break
            k, left = k + go, np.where(go, left - p, -1)
            p = p * np.minimum(mean, 30) / i
        return np.maximum(1, 1 + np.where(mean < 30, k, normal)).astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def discount_of(once: int, twice: int) -> float:
    """The usual estimate of a discount from how many are met once and twice, kept within 0.05 and 0.95."""
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


STATE = "bucket long, words binary, n binary, alone_context binary, alone_word binary, floats binary, tables binary, customers binary, root binary, sum_customers long, sum_root long"
SUMS = "bucket long, words binary, c binary, w binary"


def _seat(row: dict, floats: bytes, tables: np.ndarray, customers: np.ndarray, seats: Seats, weight: float, sweep: int) -> tuple:
    """A row of ``STATE``: the words' customers in the root seated anew."""
    words = np.frombuffer(row["words"], np.uint64)
    root = np.where(customers > 0, seats.draw(np.maximum(customers, 1), np.full(len(words), weight), mix(words), sweep), 0)
    return (row["bucket"], row["words"], row["n"], row["alone_context"], row["alone_word"], floats, tables.astype(np.float32).tobytes(), customers.tobytes(), root.tobytes(), int(customers.sum()), int(root.sum()))


def _floats(row: dict, model: dict) -> np.ndarray:
    """(tables, root probability) of every sweep so far, as float32 rows: every draw of a pair sees these same values."""
    size = len(row["words"]) // 8
    tables, customers, root = np.frombuffer(row["tables"], np.float32), np.frombuffer(row["customers"], np.int64), np.frombuffer(row["root"], np.int64)
    prob = (customers - model["d0"] * root + model["weight"][-1]) / (ROOT_THETA + model["customers"][-1])
    return np.vstack([np.frombuffer(row["floats"], np.float32).reshape(-1, size), tables[None], prob.astype(np.float32)[None]])


def _first_seats(model: dict, weight: float):
    """Every pair has one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seats = Seats(model["d0"])
        for row in _rows(batches):
            yield _batch(STATE, [_seat(row, b"", _unsmall(row["all_context"]), _unsmall(row["all_word"]), seats, weight, 0)])

    return run


def _next_seats(model: dict, weight: float, sweep: int):
    """The words' tables after a sweep: those of pairs met once, and the drawn ones."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        words, tables, customers = np.frombuffer(row["words"], np.uint64), _unsmall(row["alone_context"]), _unsmall(row["alone_word"])
        for r in right.to_pylist():
            at = np.searchsorted(words, np.frombuffer(r["words"], np.uint64))
            tables[at] += _unsmall(r["c"])
            customers[at] += _unsmall(r["w"])
        return _table(STATE, [_seat(row, _floats(row, model).tobytes(), tables, customers, Seats(model["d0"]), weight, sweep)])

    return run


def sample(words: DataFrame, pairs: DataFrame, hot: np.ndarray, scratch: Scratch, buckets: int, sweeps: int = SWEEPS) -> tuple[DataFrame, dict]:
    """Gibbs sweeps over the saved ``words`` and ``pairs``: (state, model). The state has the tables of each word's context and
    its root probability after every sweep (0: one table a pair). Sums and the hot words' values (a bounded list) reach the
    driver, nothing else."""
    size, tokens, alone, a, b = (x or 0 for x in words.agg(*[F.sum(x) for x in ("size", "tokens", "alone", "once", "twice")]).first())
    twice = pairs.agg(F.sum("twice")).first()[0] or 0
    model = {"V": size, "N": tokens, "d": discount_of(alone, twice), "d0": discount_of(a, b), "buckets": buckets, "weight": [], "customers": []}
    weight, state = (ROOT_THETA + model["d0"] * size) / (size + 1), None
    for sweep in range(sweeps + 1):
        before = dict(model, weight=list(model["weight"]), customers=list(model["customers"]))
        if state is None:
            state = scratch.save(words.mapInArrow(_first_seats(before, weight), STATE))
        else:
            sums = scratch.save(_tables(pairs, state, hot, sweep - 1, before, scratch))
            state, old = scratch.save(state.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(_next_seats(before, weight, sweep), STATE)), state
            scratch.drop(old, sums)
        customers, tables = (x or 0 for x in state.agg(F.sum("sum_customers"), F.sum("sum_root")).first())
        weight = (ROOT_THETA + model["d0"] * tables) / (size + 1)
        model["weight"].append(weight)
        model["customers"].append(customers)
    return state, model


def _tables(pairs: DataFrame, state: DataFrame, hot: np.ndarray, sweep: int, model: dict, scratch: Scratch) -> DataFrame:
    """(``SUMS``) drawn tables of all pairs by context and by word, given the state after ``sweep``, in packed pieces. Pairs of
    hot words are drawn where they lie; the others go to their context's bucket, and on to their word's unless it is hot."""
    d, buckets = model["d"], model["buckets"]
    sent = state.sparkSession.sparkContext.broadcast((hot, _hot_values(state, hot, model)[:, -2:]))

    def sums(a: np.ndarray, w: np.ndarray, t: np.ndarray) -> list[tuple]:
        words, at = _distinct(np.concatenate((a, w)))
        c, v = (np.bincount(x, weights=t, minlength=len(words)).astype(np.int64) for x in (at[: len(a)], at[len(a) :]))
        return [(k, words[x:z].tobytes(), _small(c[x:z]), _small(v[x:z])) for k, x, z in _ranges(words, buckets)]

    def draw(seats: Seats, a: np.ndarray, w: np.ndarray, n: np.ndarray, tables: np.ndarray, prob: np.ndarray) -> np.ndarray:
        return seats.draw(n, _weight(d, tables, prob), pair_key(a, w), sweep + 1)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (hot, value), seats = sent.value, Seats(d)
        by = np.zeros((2, len(hot)), np.int64)
        for row in _rows(batches):
            a, w, n = _unplane(row["contexts"]), _unplane(row["words"]), _unsmall(row["n"])
            t = draw(seats, hot[a], hot[w], n, value[a, 0], value[w, 1])
            for k, x in enumerate((a, w)):
                by[k] += np.bincount(x, weights=t, minlength=len(hot)).astype(np.int64)
        yes = by.any(0)
        words, c, w = hot[yes], by[0][yes], by[1][yes]
        yield _batch(SUMS, [(k, words[x:z].tobytes(), _small(c[x:z]), _small(w[x:z])) for k, x, z in _ranges(words, buckets)])

    mixed = PAIRS + ", c binary, w binary"

    def together(rows: list[dict]) -> list[np.ndarray]:
        """Contexts, words and counts of a bucket's rows; one draw for all of them, and one row for each bucket they go to."""
        return [np.concatenate(x) for x in zip(*[(np.frombuffer(r["contexts"], np.uint64), np.frombuffer(r["words"], np.uint64), _unsmall(r["n"])) for r in rows], strict=True)]

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(mixed, [])
        (hot, value), row = sent.value, right.to_pylist()[0]
        a, w, n = together(left.to_pylist())
        tables = _floats(row, model)[-2][np.searchsorted(np.frombuffer(row["words"], np.uint64), a)]
        yes, at = _inside(hot, w)
        t = draw(Seats(d), a[yes], w[yes], n[yes], tables[yes], value[at[yes], 1])
        out = [(None, k, None, words, None, None, None, c, v) for k, words, c, v in sums(a[yes], w[yes], t)]
        rest = np.flatnonzero(~yes)
        rest = rest[_argsort(w[rest])]
        for k, x, z in _ranges(w[rest], buckets):
            p = rest[x:z]
            out.append((ASKED, k, a[p].tobytes(), w[p].tobytes(), _small(n[p]), tables[p].tobytes(), 0, None, None))
        return _table(mixed, out)

    def words(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(SUMS, [])
        (hot, value), row, rows = sent.value, right.to_pylist()[0], left.to_pylist()
        a, w, n = together(rows)
        tables = np.concatenate([np.frombuffer(r["tables"], np.float32) if r["kind"] == ASKED else value[_inside(hot, np.frombuffer(r["contexts"], np.uint64))[1], 0].astype(np.float32) for r in rows])
        prob = _floats(row, model)[-1][np.searchsorted(np.frombuffer(row["words"], np.uint64), w)]
        return _table(SUMS, sums(a, w, draw(Seats(d), a, w, n, tables, prob)))

    by_bucket = state.groupBy("bucket")
    near = pairs.where(F.col("kind") == BOTH).select("contexts", "words", "n").mapInArrow(both, SUMS)
    cold = scratch.save(pairs.where(F.col("kind") == COLD).groupBy("bucket").cogroup(by_bucket).applyInArrow(contexts, mixed))
    asked = cold.where(F.col("kind") == ASKED).select(*pairs.columns).unionByName(pairs.where(F.col("kind") == HOT_CONTEXT))
    far = asked.groupBy("bucket").cogroup(by_bucket).applyInArrow(words, SUMS)
    return near.unionByName(cold.where("kind is null").select("bucket", "words", "c", "w")).unionByName(far)


def hot_list(words: DataFrame, most: int) -> np.ndarray:
    """Hashes of the ``most`` most frequent words, sorted; a bounded list that reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            n, h = _unsmall(row["n"]), np.frombuffer(row["words"], np.int64)
            top = np.argsort(-n, kind="stable")[:most]
            yield pa.RecordBatch.from_arrays([pa.array(h[top]), pa.array(n[top])], ["word", "n"])

    if not most:
        return np.zeros(0, np.uint64)
    top = words.select("words", "n").mapInArrow(run, "word long, n long").orderBy(F.desc("n"), "word").limit(most).select("word").toArrow()["word"]
    return np.sort(np.asarray(top, np.int64).view(np.uint64))


def _hot_values(state: DataFrame, hot: np.ndarray, model: dict) -> np.ndarray:
    """(learned tokens, tables and probability of each sweep) of the hot words, one row each."""
    sent = state.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yes, at = _inside(sent.value, np.frombuffer(row["words"], np.uint64))
            values = np.vstack([_unsmall(row["n"])[None], _floats(row, model)])[:, yes]
            yield _batch("at binary, v binary", [(at[yes].tobytes(), values.astype(np.float64).tobytes())])

    out = np.zeros((len(hot), 1 + 2 * len(model["weight"])))
    for row in state.mapInArrow(run, "at binary, v binary").toArrow().to_pylist() if len(hot) else []:
        at = np.frombuffer(row["at"], np.int64)
        out[at] = np.frombuffer(row["v"], np.float64).reshape(out.shape[1], len(at)).T
    return out


def _weight(discount: float, tables: np.ndarray, prob: np.ndarray) -> np.ndarray:
    return (THETA + discount * tables.astype(np.float64)) * prob.astype(np.float64)


def score_chunks(counted: DataFrame, state: DataFrame, model: dict, hot: np.ndarray, scratch: Scratch, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document of the chunks."""
    used = range(burn_in, sweeps + 1)
    width, buckets = 1 + 2 * len(used), model["buckets"]
    pick = [0, *[c for s in used for c in (1 + 2 * s, 2 + 2 * s)]]
    sent = counted.sparkSession.sparkContext.broadcast((hot, _hot_values(state, hot, model)[:, pick]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = np.frombuffer(row["words"], np.uint64)
            rest = np.sort(words[~_inside(sent.value[0], words)[0]])
            yield _batch("chunk long, bucket long, words binary", [(row["chunk"], k, rest[a:z].tobytes()) for k, a, z in _ranges(rest, buckets)])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        known, n, floats, out = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((width - 1, 0), np.float32), []
        for row in right.to_pylist():
            known, n, floats = np.frombuffer(row["words"], np.uint64), _unsmall(row["n"]), _floats(row, model)[[c - 1 for c in pick[1:]]]
        for r in left.to_pylist():
            yes, at = _inside(known, np.frombuffer(r["words"], np.uint64))
            mask, at = np.packbits(yes).tobytes(), at[yes]
            out.append((r["chunk"], r["bucket"], mask, _small(n[at]), floats[:, at].tobytes()))
        return _table(ANSWER, out)

    asked = counted.select("chunk", "words").mapInArrow(ask, "chunk long, bucket long, words binary")
    answers = scratch.save(asked.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(answer, ANSWER))
    scratch.free_shuffles()
    d, vocabulary, tokens = model["d"], model["V"], model["N"]
    unknown = np.array([w / (ROOT_THETA + c) for w, c in zip(model["weight"], model["customers"], strict=True)])[list(used)]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        seats, (hot, hot_values) = Seats(d), sent.value
        out, replies = [], {r["bucket"]: r for r in right.to_pylist()}
        for row in _rows(left.to_batches()):
            c = Chunk(row)
            value = np.zeros((len(c.words), width))
            value[:, 2::2] = unknown
            yes, at = _inside(hot, c.words)
            value[yes] = hot_values[at[yes]]
            rest = np.flatnonzero(~yes)
            rest = rest[np.argsort(c.words[rest])]
            for k, a, z in _ranges(c.words[rest], buckets):
                r = replies[k]
                own = rest[a:z][np.unpackbits(np.frombuffer(r["known"], np.uint8), count=z - a).astype(bool)]
                value[own, 0] = _unsmall(r["n"])
                value[own, 1:] = np.frombuffer(r["floats"], np.float32).reshape(width - 1, -1).T
            n = _unsmall(row["counts"])
            seen, met = value[c.context, 0], np.flatnonzero(n > 1)
            prob = np.zeros(len(n))
            for k in range(1, len(used)):
                t = np.minimum(n, 1)
                tables, parent = value[:, 2 * k - 1], value[:, 2 * k]
                t[met] = seats.draw(n[met], _weight(d, tables[c.context[met]].astype(np.float32), parent[c.word[met]].astype(np.float32)), c.key[met], burn_in + k)
                tables, parent = value[:, 2 * k + 1], value[:, 2 * k + 2]
                prob += (np.maximum(n - d * t, 0) + (THETA + d * tables[c.context]) * parent[c.word]) / (THETA + seen)
            logs = np.log10(prob / (sweeps - burn_in))[c.at]
            count = value[c.codes, 0]
            base = np.log10((count + 1) / (tokens + vocabulary + 1))
            edge = np.concatenate(([0], np.cumsum(c.sizes)))[:-1]
            ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["id_null"], np.uint8).astype(bool))
            out.append(pa.table({"doc_id": ids, "held_out": pa.array(c.kinds == 1), "n_tokens": pa.array(c.sizes), "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), edge)), "train_tokens": pa.array(np.full(len(c.sizes), tokens, np.int64)), "base_score": pa.array(np.add.reduceat(base, edge)), "score": pa.array(np.add.reduceat(logs, edge))}))
        kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.concat_tables(out) if out else pa.table({k: pa.array([], v) for k, v in kinds.items()})

    return counted.select(*[x.split()[0] for x in ENCODED.split(", ")], "counts").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _inside(hot: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hot):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return hot[at] == words, at


def score_texts(docs: DataFrame, scratch: Scratch, bucket: int = BUCKET, sweeps: int = SWEEPS, burn_in: int = BURN_IN, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    Learns from all whole texts whose crc32(doc_id) mod 7 is not 2. A null text is an empty one, which is its end token
    alone; a null doc_id is neither held out nor learned from. Repeated rows count and are scored again; a text of any
    length stays in one chunk. Unknown words have the root's base probability, unknown contexts the root's. Nothing learned
    gives every token the probability 1. Other columns are ignored; no rows give no rows.
    """
    encoded = scratch.save(encode(docs), "zstd", maxRecordsPerFile=8)
    entries, known = (x or 0 for x in encoded.agg(F.sum(F.octet_length("codes") / 4), F.sum(F.octet_length("words") / 2)).first())
    buckets = max(1, -(-int(entries) // bucket))
    pairs = scratch.save(count_pairs(encoded, buckets), "zstd")
    scratch.free_shuffles()
    counted = scratch.save(attach_counts(encoded, pairs), "zstd", maxRecordsPerFile=8)
    scratch.drop(encoded, pairs)
    scratch.free_shuffles()
    shares = max(1, -(-int(known) // bucket))
    words = scratch.save(learned_words(counted, shares))
    hot = hot_list(words, hot_words)
    pairs = scratch.save(learned_pairs(counted, hot, shares))
    scratch.free_shuffles()
    state, model = sample(words, pairs, hot, scratch, shares, sweeps)
    scratch.drop(words, pairs)
    scratch.free_shuffles()
    return score_chunks(counted, state, model, hot, scratch, sweeps, burn_in)


def op11(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), Scratch(spark))
