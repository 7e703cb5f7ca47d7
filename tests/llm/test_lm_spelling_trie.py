"""Language-model scores, spelling variants and the conversation trie against brute force, with edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import pitman_yor, prefix_trie, spelling
from chronoweave.llm.scratch import Scratch
from chronoweave.llm.words import hash_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc(x):
    return zlib.crc32(str(x).encode())


# --- language model ---------------------------------------------------------------------------------------------------


def plain_scores(rows, sweeps=3, burn_in=1):
    """The model with dicts, one pair at a time; draws come from the same function of the pair's hash."""
    texts = [[*map(str, WORD.findall((t or "").translate(LOWER))), None] for _, t in rows]
    kind = [2 if i is None else 1 if crc(i) % 7 == 2 else 0 for i, _ in rows]
    hashes = {}

    def h(w):
        if w not in hashes:
            hashes[w] = pitman_yor.END if w is None else hash_words(w.encode())[0][0]
        return hashes[w]

    n, pairs = Counter(), Counter()
    for words, k in zip(texts, kind, strict=True):
        if k == 0:
            n.update(words)
            pairs.update(zip([None, *words[:-1]], words, strict=True))
    total, size = sum(n.values()), len(n)
    d = pitman_yor.discount_of(sum(c == 1 for c in pairs.values()), sum(c == 2 for c in pairs.values()))
    seats = pitman_yor.Seats(d)
    t = {p: 1 for p in pairs}
    states = []
    for s in range(sweeps + 1):
        tables, customers = Counter(), Counter()
        for (u, w), k in t.items():
            tables[u] += k
            customers[w] += k
        if s == 0:
            d0 = pitman_yor.discount_of(sum(c == 1 for c in customers.values()), sum(c == 2 for c in customers.values()))
            root = pitman_yor.Seats(d0)
            weight = (pitman_yor.ROOT_THETA + d0 * size) / (size + 1)
        ws = sorted(n, key=str)
        rt = root.draw(np.array([customers[w] for w in ws], np.int64), np.full(len(ws), weight), pitman_yor.mix(np.array([h(w) for w in ws], np.uint64)), s) if ws else []
        weight = (pitman_yor.ROOT_THETA + d0 * sum(map(int, rt))) / (size + 1)
        whole = pitman_yor.ROOT_THETA + sum(customers.values())
        prob = {w: float(np.float32((customers[w] - d0 * int(k) + weight) / whole)) for w, k in zip(ws, rt, strict=True)}
        states.append((tables, prob, weight / whole))
        if s < sweeps:
            ps = sorted(pairs, key=str)
            x = np.array([(pitman_yor.THETA + d * tables[u]) * prob[w] for u, w in ps])
            key = pitman_yor.pair_key(np.array([h(u) for u, _ in ps], np.uint64), np.array([h(w) for _, w in ps], np.uint64)) if ps else np.zeros(0, np.uint64)
            t = dict(zip(ps, map(int, seats.draw(np.array([pairs[p] for p in ps], np.int64), x, key, s + 1)), strict=True))
            states[-1] += (t,)
    out = []

    def predict(u, w):
        got = 0.0
        for s in range(burn_in + 1, sweeps + 1):
            tables, prob, unknown = states[s][:3]
            own = states[s - 1][3].get((u, w), 0)
            got += (pairs[u, w] - d * own + (pitman_yor.THETA + d * tables[u]) * prob.get(w, unknown)) / (pitman_yor.THETA + n[u])
        return got / (sweeps - burn_in)

    for (i, _), words, k in zip(rows, texts, kind, strict=True):
        base = sum(math.log10((n[w] + 1) / (total + size + 1)) for w in words)
        score = sum(math.log10(predict(u, w)) for u, w in zip([None, *words[:-1]], words, strict=True))
        out.append((i, k == 1, len(words), sum(n[w] > 0 for w in words), total, base, score))
    return out, predict, n


def lm_rows():
    rng = random.Random(4)
    words = [f"w{int(rng.expovariate(0.05))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choice(words) + ("X" if rng.random() < 0.02 else "") for _ in range(rng.randrange(40)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, "  \n"), (None, "a w1 w2"), (7, rows[7][1]), (300, "hot hot " * 1500), (301, "UNSEEN words only here"), (302, "Größe naïve  x")]


def test_scores_are_those_of_a_plain_model(spark, monkeypatch):
    rows = lm_rows()
    want, predict, n = plain_scores(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("codes", F.lit(1)).withColumn("score", F.lit(5)).repartition(3)
    for bucket, hot in ((2_000_000, 1 << 16), (100, 5), (100, 0)):
        got = pitman_yor.score_texts(docs, Scratch(spark), bucket=bucket, hot_words=hot).collect()
        order = lambda x: (str(x[0]), x[2], x[6])
        assert len(got) == len(want)
        for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-9)
    # each context's probabilities, those of an unknown word included, sum to one
    for u in (None, "w1", "never seen"):
        assert sum(predict(u, w) for w in n) + predict(u, "unknown") == pytest.approx(1, abs=1e-5)


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string").coalesce(1)
    whole = sorted(pitman_yor.score_texts(docs, Scratch(spark)).collect(), key=str)
    tasks = docs.repartition(7)
    for a, b in zip(whole, sorted(pitman_yor.score_texts(tasks, Scratch(spark)).collect(), key=str), strict=True):
        assert tuple(a)[:5] == tuple(b)[:5] and tuple(a)[5:] == pytest.approx(tuple(b)[5:], rel=1e-9)


def test_scores_without_learned_rows(spark):
    held = next(i for i in range(100) if crc(i) % 7 == 2)
    got = pitman_yor.score_texts(spark.createDataFrame([(held, "a b"), (None, "c")], "doc_id long, text string"), Scratch(spark)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"], r["base_score"]) for r in got} == {(held, 3, 0, 0, 0.0, 0.0), (None, 2, 0, 0, 0.0, 0.0)}
    assert pitman_yor.score_texts(spark.createDataFrame([], "doc_id long, text string"), Scratch(spark)).count() == 0


def seatings(c):
    """All ways to seat c customers, as block sizes."""
    if c == 0:
        yield []
        return
    for rest in seatings(c - 1):
        yield [*rest, 1]
        for k in range(len(rest)):
            yield [*rest[:k], rest[k] + 1, *rest[k + 1 :]]


def test_draws_follow_the_seatings():
    d, x, c = 0.6, 0.9, 6
    weight = defaultdict(float)
    for sizes in seatings(c):
        weight[len(sizes)] += x ** len(sizes) * math.prod(math.prod(j - d for j in range(1, k)) for k in sizes)
    key = pitman_yor.mix(np.arange(40_000, dtype=np.uint64))
    got = Counter(pitman_yor.Seats(d).draw(np.full(len(key), c), np.full(len(key), x), key, 1).tolist())
    for t in range(1, c + 1):
        assert got[t] / len(key) == pytest.approx(weight[t] / sum(weight.values()), abs=0.012)


@pytest.mark.parametrize("x", [0.01, 1.0, 20.0, 500.0])
def test_limit_meets_the_exact_draws(monkeypatch, x):
    key = pitman_yor.mix(np.arange(20_000, dtype=np.uint64))
    seats = pitman_yor.Seats(0.7)
    c = np.full(len(key), pitman_yor.EXACT)
    exact = seats.draw(c, np.full(len(key), x), key, 1)
    limit = np.minimum(c, seats._limit(c.astype(float), np.full(len(key), x), pitman_yor._unit(key), pitman_yor._unit(pitman_yor.mix(key))))
    assert limit.mean() == pytest.approx(exact.mean(), rel=0.06) and (limit >= 1).all()
    assert limit.std() == pytest.approx(exact.std(), rel=0.25, abs=0.1)


def test_scores_beat_single_words(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(w for _ in range(12) for w in rng.choice([("a", "b", "c"), ("d", "e"), ("f", "g", "h", "i")]))) for i in range(120)]
    got = pitman_yor.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.65 * got[1]


# --- spelling variants ------------------------------------------------------------------------------------------------


def plain_words(rows, least=5):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = crc(f"{'' if i is None else i}:{run}")
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= least}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, ratio=5):
    form, out = {}, {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if distance_one(w, v))
        form[w] = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = [len(near), -near[0][0] if form[w] else None]
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, *out[w]))
    return rows


def dense_words(seed, count=700, alphabet="abç", sizes=(5, 6, 7, 8)):
    rng = random.Random(seed)
    return {"".join(rng.choice(alphabet) for _ in range(rng.choice(sizes))): int(5 * rng.paretovariate(0.5)) for _ in range(count)}


@pytest.mark.parametrize(("shard", "same_half", "direct"), [(100_000, 20_000, 16), (50, 5, 2), (50, 5, 10_000)])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, shard, same_half, direct):
    monkeypatch.setattr(spelling, "DIRECT", direct)
    words = dense_words(shard)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {r["word"]: r["n_near"] for r in spelling.near_words(df, shard, same_half).collect()}
    assert near == {w: k for w in words if (k := sum(distance_one(w, v) for v in words))}
    assert {tuple(r) for r in spelling.group_variants(df.withColumn("root", F.lit(1)), Scratch(spark)).collect()} == plain_groups(words)


def test_long_words_and_chains(spark):
    base = "abcdefghij" * 300
    words = {base: 10_000, base[1:]: 1000, base[1:-1]: 100, "x" + base[1:-1]: 10, base[:700] + "é" + base[700:]: 7, "zzzzzz": 5}
    got = {tuple(r) for r in spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"), Scratch(spark)).collect()}
    assert got == plain_groups(words) and any(r[2] == base and r[0] == "x" + base[1:-1] for r in got)


def test_words_of_texts(spark):
    rng = random.Random(9)
    vocabulary = ["Straße", "straßen", "Wörterbuch", "woerterbuch", "Wörterbücher", "colour", "COLOR", "colors", "a×b÷cde", "short", "naïveté"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)) + "1x_Straße") for i in range(80)] + [(None, "colour " * 9), (500, None), (501, ""), (502, "y" * 300_000), (503, "colour"), (503, "colour")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1))
    words = plain_words(rows)
    assert {(r["word"], r["n"]) for r in spelling.corpus_words(docs).collect()} == set(words.items())
    assert {tuple(r) for r in spelling.spelling_variants(docs, Scratch(spark)).collect()} == plain_groups(words)
    assert spelling.spelling_variants(docs.where("false"), Scratch(spark)).count() == 0


# --- conversation trie ------------------------------------------------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            role = r or ""
            digest = hashlib.md5(f"{len(role.encode())}\n{role}{x or ''}".encode()).digest()
            turns[c].append(((t is not None, t or 0), role, digest, x or ""))
    own = {c: [(r, x) for _, r, _, x in sorted(ts)] for c, ts in turns.items()}
    paths = {c: tuple(own.get(c - c % 5, [])[: (h := crc(c) % 9)] + ts[h:]) for c, ts in own.items()}
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = Counter(k[:-1] for k in members if k)
    below = defaultdict(lambda: [0, 0])
    for k, m in members.items():
        for d in range(len(k) + 1):
            below[k[:d]][0] += not kids[k]
            below[k[:d]][1] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return {(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], *below[k], sha([c for c in m if len(paths[c]) == len(k)])) for k, m in members.items()}


TURNS = "conv_id long, turn long, role string, text string"


def talk(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 11 == 3:
            continue
        for t in range(rng.choice([0, 1, 2, 3, 9, 14])):
            rows.append((c, t if rng.random() > 0.05 else None, rng.choice(["user", "assistant", None, ""]), rng.choice(["hi", "yes", "no", "", None, "größer"])))
    return rows + rng.sample(rows, 20) + [(None, 1, "user", "x")]


@pytest.mark.parametrize(("seed", "fan_in", "local", "bits"), [(1, 64, 200_000, 14), (2, 2, 7, 2)])
def test_trie_is_that_of_all_prefixes(spark, monkeypatch, seed, fan_in, local, bits):
    monkeypatch.setattr(prefix_trie, "LOCAL", local)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", bits)
    merge = prefix_trie.merge_tries
    monkeypatch.setattr(prefix_trie, "merge_tries", lambda p, s: merge(p, s, fan_in))
    rows = talk(seed)
    df = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit(1)).withColumn("depth", F.lit(1)).repartition(5)
    got = prefix_trie.conversation_trie(df, Scratch(spark)).collect()
    assert {tuple(r) for r in got} == plain_trie(rows) and len(got) == len(plain_trie(rows))


def test_deep_tries_and_copies(spark):
    # one long conversation, conversations that each go one turn further, and many copies
    rows = [(1000, t, "user", f"t{t}" + "x" * (5000 * (t == 3))) for t in range(400)]
    rows += [(5 * c, t, "user", f"s{t}") for c in range(1, 40) for t in range(c)] + [(5 * c, t, "user", f"k{t}") for c in range(300, 420) for t in range(3)]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS), Scratch(spark)).collect()
    assert {tuple(r) for r in got} == plain_trie(rows)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS), Scratch(spark)).count() == 0
    lone = prefix_trie.conversation_trie(spark.createDataFrame([(7, 0, "user", None)], TURNS), Scratch(spark)).collect()
    assert {tuple(r) for r in lone} == plain_trie([(7, 0, "user", None)])
