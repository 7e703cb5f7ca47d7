"""The ten operators against brute force on small fixtures, with nulls, empties, repeats and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chronoweave.llm import chat_format, decontaminate, langid, license_scan, mixture, ngram_join, quality, substring_dedup, toxicity, url_rules
from chronoweave.llm.components import connected_components
from chronoweave.llm.scratch import Scratch
from chronoweave.llm.words import chunks, hash_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, pool=400):
    return " ".join(rng.choice([f"w{rng.randrange(pool)}", f"w{rng.randrange(pool)}."]) if i % 9 == 8 else f"w{rng.randrange(pool)}" for i in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)


def test_words_match_the_pattern():
    text = "Ab  cD\u00a0e\x85f\tg\r\n\x0bÉé x" + " y" * 50
    h, s, e = hash_words(text.encode().lower())
    blob = text.encode().lower()
    assert [blob[a:z] for a, z in zip(s, e, strict=True)] == [w.encode().lower() for w in WORD.findall(text)]
    assert len(set(h.tolist())) == len({w.encode().lower() for w in WORD.findall(text)})
    assert sum(len(c[1]) for c in chunks(pa.array([None, "", "a b", "a"]))) == 3


def test_words_cut_long_texts_alike(monkeypatch):
    import chronoweave.llm.words as words

    blob = b" ".join(b"word%d" % (i % 97) for i in range(5000))
    whole = hash_words(blob)
    monkeypatch.setattr(words, "CHUNK", 1000)
    for a, b in zip(whole, hash_words(blob), strict=True):
        assert (a == b).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src long, dst long"), Scratch(spark)).collect()}
    assert got == {x: find(x) for x in {v for e in edges if e[0] != e[1] for v in e}}
    assert connected_components(spark.createDataFrame([], "src long, dst long"), Scratch(spark)).count() == 0


def jaccard_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    links = {a: sum(a != b and bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) for b in ids) for a in ids}
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


@pytest.mark.parametrize("k,percent,small,block,send", [(3, 90, 64, 1024, 2_000_000), (3, 90, 2, 7, 2_000_000), (3, 90, 2, 7, 0), (5, 80, 3, 1024, 2_000_000)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, k, percent, small, block, send):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    for limit in ("SEND_KEYS", "SEND_LISTS"):
        monkeypatch.setattr(ngram_join, limit, min(send, getattr(ngram_join, limit)))
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(k)
    rows = [(0, None), (1, ""), (2, " \t"), (3, "One two"), (4, "one TWO"), (5, "one")]
    base = prose(rng, 120)
    for i in range(6, 60):
        w = base.split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    # a chain whose ends are far apart, and texts of a few words
    chain = prose(rng, 200).split()
    for i in range(60, 75):
        chain[(i - 60) * 12] = f"y{i}"
        rows.append((i, " ".join(chain)))
    rows += [(i, prose(rng, rng.randrange(1, 8), 4)) for i in range(75, 110)] + [(i, prose(rng, 60)) for i in range(110, 130)]
    got = ngram_join.similar_documents(docs(spark, rows), Scratch(spark), k, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == jaccard_components(rows, k, percent)


def test_large_groups_of_near_copies(spark):
    """A group of thousands of texts with edits of their own: pairs meet in blocks, and no link is lost."""
    rng = random.Random(12)
    base = prose(rng, 60, 10**6).split()
    rows = []
    for i in range(2500):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    sets = [{hash(tuple(t.split()[j : j + 3])) for j in range(58)} for _, t in rows]
    order = {h: i for i, h in enumerate({h for s in sets for h in s})}
    m = np.zeros((len(rows), len(order)), np.float32)
    for i, s in enumerate(sets):
        m[i, [order[h] for h in s]] = 1
    common, size = m @ m.T, m.sum(1)
    linked = 100 * common >= 90 * (size[:, None] + size - common)
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in ngram_join.similar_documents(docs(spark, rows), Scratch(spark)).collect()}
    assert [got[i][0] for i in range(len(rows))] == (linked.sum(1) - 1).tolist()
    low = np.arange(len(rows))
    while (new := np.where(linked, low[None], len(rows)).min(1)).tolist() != low.tolist():
        low = new
    assert [got[i][1] for i in range(len(rows))] == low.tolist()


def test_ngram_join_edges(spark):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (None, "a b c d e"), (9, "a b c d e")]
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in ngram_join.similar_documents(docs(spark, rows), Scratch(spark)).select("doc_id", F.coalesce("component_id", F.lit(-1)).alias("component_id")).collect())
    assert got == [(-1, -1), (7, 7), (7, 7), (9, 7)]
    assert ngram_join.similar_documents(docs(spark, []), Scratch(spark)).count() == 0


def test_decontamination(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, n)) for i, n in enumerate((3, 7, 14, 22, 37, 59, 900))] + [(90, None), (91, "")]
    rows = []
    for i, t in items[:7]:
        rows.append((i, f"{prose(rng, rng.randrange(30))} {t.upper().replace(' ', ', ')} {prose(rng, 40)}"))
    cut = items[5][1].split()
    rows.append((20, prose(rng, 31) + " " + " ".join(cut[3:-3]) + " " + prose(rng, 20)))
    rows += [(i, prose(rng, 300)) for i in range(30, 50)] + [(51, None), (52, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(spark, rows), bench).collect()}
    assert got == {(i, i) for i in range(7)} | {(20, 5)}
    assert decontaminate.find_leaks(docs(spark, rows), bench.where("false")).count() == 0


def test_leaks_equal_brute_force(spark, monkeypatch):
    """Edited items against exact similarity at every place of every text, with the index in one part and in many."""
    rng = random.Random(21)
    items = [(i, prose(rng, rng.randrange(12, 70), 10**6).replace(".", "")) for i in range(30)]
    items.append((30, items[0][1] + " " + prose(rng, 8, 10**6).replace(".", "")))
    rows = []
    for d in range(120):
        w = items[d % 30][1].split()
        if d % 4 == 1:  # shortened
            w = w[: -max(1, len(w) // 12)]
        elif d % 4 == 2:  # a word in the middle goes or changes
            w[len(w) // 2] = rng.choice(["", "changed"])
        elif d % 4 == 3:
            w = w[2:]
        rows.append((d, f"{prose(rng, rng.randrange(40), 10**6)} {' '.join(w)} {prose(rng, 30, 10**6)}"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: decontaminate.plain_words(pa.array([t]))
    hashes = lambda t: next(chunks(words(t)))[1]
    df = {}
    for _, t in items:
        for x in set(decontaminate.shingle_hashes(hashes(t), 5).tolist()):
            df[x] = df.get(x, 0) + 1
    index = decontaminate.BenchIndex([(i, hashes(t)) for i, t in items], {x: n for x, n in df.items() if n > 1}, len(items))
    want = set()
    for d, t in rows:
        h = hashes(t)
        for i, (item, own) in enumerate(index.items):
            if any(index.similarity(i, h[a : a + len(own)]) >= 0.8 for a in range(max(1, len(h) - len(own) + 1))):
                want.add((d, item))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(spark, rows), bench).collect()}
    assert got <= want and len(got) >= 0.97 * len(want), (len(got), len(want), want - got)
    monkeypatch.setattr(decontaminate, "PART_WORDS", 200)
    assert got == {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs(spark, rows), bench).collect()}


def test_wide_windows_have_the_same_fingerprints():
    rng = np.random.RandomState(4)
    h = rng.randint(1, 2**62, 500).astype(np.uint64) * np.uint64(3)
    for size, stride in ((8, 2), (63, 5), (200, 40)):
        narrow = decontaminate.fingerprints(h, decontaminate.bit_counts(h), size, stride)
        assert narrow.tolist() == decontaminate.wide_fingerprints(h, size, stride)[: len(narrow)].tolist()


def test_block_index_finds_all_within_the_radius():
    rng = np.random.RandomState(0)
    index = decontaminate.BenchIndex([(i, rng.randint(1, 2**62, 40).astype(np.uint64)) for i in range(30)], {}, 30)
    key = next(iter(index.classes))
    fp = index.classes[key][0]
    w = fp[rng.randint(0, len(fp), 3000)].copy()
    for _ in range(9):
        flip = rng.rand(len(w)) < 0.8
        w[flip] ^= np.uint64(1) << rng.randint(0, 64, flip.sum()).astype(np.uint64)
    win, cand, _ = index.hits(w, key)
    d = np.bitwise_count(w[:, None] ^ fp[None])
    assert set(zip(win.tolist(), cand.tolist(), strict=True)) == set(map(tuple, np.argwhere(d <= decontaminate.RADIUS).tolist()))


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "https://example.net", "x://sub.example.com/de/1", "ftp://notexample.com/de/1", "http://o.org/fr/", "no scheme", None, "", "http://www.cheap-pills.example.com/en/", "http://h.io/path/affiliate/9/out"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.filter_urls(df.select("page_id", "url"), url_rules.SITE_RULES + url_rules.PATTERN_RULES).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("example.net", "", None, "allow")
    assert got[2][2:] == ("example.com/de/", "block") and got[3][2:] == (None, "allow") and got[4][2:] == ("org/fr/", "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow") and got[8][3] == "block" and got[9][3] == "block"
    for r in url_rules.PATTERN_RULES + url_rules.SITE_RULES:
        assert r.tokens(), r


def test_index_equals_running_every_rule(spark):
    rng = random.Random(8)
    parts = ["ads", "banner", "track", "click", "casino", "example", "org", "net", "history", "x"]
    urls = [f"http://{'.'.join(rng.choices(parts, k=3))}/{'/'.join(rng.choices(parts, k=3))}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [*url_rules.PATTERN_RULES, url_rules.Rule("*lick", "block")]
    got = {r["page_id"]: r["verdict"] for r in url_rules.filter_urls(df, rules).collect()}
    for i, u in enumerate(urls):
        hit = [r for r in rules if re.search(r.regex(), u[7:])]
        want = "allow" if not hit or any(r.action == "allow" for r in hit) else "block"
        assert got[i] == want, u


def test_mixture(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(0, 400)), "en", rng.choice(["a", "b", "é", None]) if i % 3 else "a", 0) for i in range(200)] + [(900, None, "en", "a", 0), (5, "again w w", "en", "b", 0)]
    df = spark.createDataFrame(rows, DOC)
    out, _ = mixture.mix_sources(df, Scratch(spark))
    got = out.collect()
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    goal = dict(zip(order, mixture.targets([size[s] for s in order], mixture.default_weights(len(order))), strict=True))
    assert len(got) == len(rows) and abs(sum(goal.values()) - sum(size.values())) < 1e-6
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert own[0]["source_size"] == size[s] and abs(own[0]["target"] - goal[s]) < 1e-6
        assert abs(sum(r["taken"] for r in own) - goal[s]) <= 3 * mixture.BLOCK and all(r["taken"] <= 3 * r["size"] for r in own)
    again, _ = mixture.mix_sources(df.repartition(7), Scratch(spark))
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, again.collect())) == sorted(map(key, got))
    assert mixture.mix_sources(df.where("false"), Scratch(spark))[0].count() == 0


def test_mix_equals_brute_force(spark):
    """Every written part against the packed words: blocks by hand, slots by the permutation forwards, shards by counts."""
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 300)).replace(" ", "  "), "en", rng.choice("abc"), 0) for i in range(60)]
    rows += [(900, prose(rng, 10), "en", "tiny", 0), (901, prose(rng, 40), "en", "tiny3", 0), (902, prose(rng, 30), "en", "a", 0), (902, "other text", "en", "a", 0), *[(903, "same text again", "en", "b", 0)] * 3, (904, prose(rng, 9000), "en", "c", 0), (905, None, "en", "c", 0)]
    out, made = mixture.mix_sources(spark.createDataFrame(rows, DOC), Scratch(spark), block=16, shards=8)
    got, made = out.collect(), made.collect()
    assert len(got) == len(rows) and len({r["shard"] for r in made}) == 8
    sources = sorted({r[3] for r in rows})
    sizes = [sum(len(WORD.findall(t or "")) for _, t, _, s, _ in rows if s == own) for own in sources]
    goals = mixture.targets(sizes, mixture.default_weights(len(sources)))
    layout = mixture.Layout(sizes, goals, [(i, 0, n) for i, n in enumerate(sizes)], 16, 8, 3)
    for i, s in enumerate(sources):
        # the stream of words as the parts tell it, from the whole turns or not at all
        at = {}
        for r in made:
            if r["source_index"] == i:
                assert r["words"] == len(WORD.findall(r["text"]))
                for k, w in enumerate(WORD.findall(r["text"])):
                    assert at.setdefault(r["block"] * 16 + r["at"] + k, w) == w
        blocks = -(-sizes[i] // 16)
        taken = {}
        for r in made:
            if r["source_index"] == i:
                key = (r["turn"], r["block"])
                taken.setdefault(key, [r["shard"], 0])[1] += r["words"]
                assert taken[key][0] == r["shard"]
        want, slot = {}, 0
        for turn in range(layout.turns[i] + 1):
            order = mixture.permute(np.arange(blocks), blocks, mixture._turn_key(i, turn, 3)).tolist()
            for j, b in enumerate(order):
                own = min(16, sizes[i] - b * 16)
                if turn == layout.turns[i]:
                    own = own if j < layout.rest[i] else min(own, layout.lead[i]) if j == layout.rest[i] else 0
                if own:
                    want[turn, b] = [int(np.searchsorted(layout.ends[i], slot, "right")), own]
                slot += 1
        assert taken == want, s
        own = [r for r in got if r["source"] == s]
        assert sum(r["taken"] for r in own) == sum(n for _, n in want.values()) == min(round(goals[i]), 3 * sizes[i]), s
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    for d, t, _, s, _ in rows:  # each document's own words are what was taken of it
        assert (d, len(WORD.findall(t or ""))) in {(r["doc_id"], r["size"]) for r in got if r["source"] == s}


def test_targets_reshare_the_excess():
    t = mixture.targets([10, 1000, 100], [3.0, 1.0, 2.0])
    assert t[0] == 30 and t[2] == 300 and abs(sum(t) - 1110) < 1e-9


def test_permutation():
    for n in (1, 2, 7, 64, 101):
        p = mixture.permute(np.arange(n), n, 4)
        assert sorted(p.tolist()) == list(range(n)) and mixture.permute(p, n, 4, True).tolist() == list(range(n))
    assert (mixture.permute(np.arange(101), 101, 4) != mixture.permute(np.arange(101), 101, 5)).any()


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1200):
        bad = i % 5 == 0
        w = prose(rng, 80).split()
        if bad:
            for _ in range(4):
                w[rng.randrange(80)] = rng.choice(["Scum!", "vermin", "Idiots"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    df = docs(spark, [*rows, (5000, None), (5001, "")])
    index = toxicity.fit(df.select("doc_id", "text"), spark.createDataFrame([*labels, (7, None), (None, 1), (99999, 1), (10, 0)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, index).collect()}
    assert all((got[i]["score"] >= toxicity.THRESHOLD) == bool(y) for i, y in labels)
    assert got[5000]["score"] == got[5001]["score"] < 0.3 and got[0]["evidence"]


def test_toxicity_search_is_exact():
    rng = np.random.RandomState(1)
    vocab = np.sort(rng.randint(1, 2**62, 60).astype(np.uint64))
    ex = [(i, i % 2, 1.0, np.sort(rng.choice(60, rng.randint(1, 12), replace=False)), None) for i in range(500)]
    ex = [(d, y, w, f, rng.randint(1, 5, len(f)).astype(float)) for d, y, w, f, _ in ex]
    index = toxicity.Index(vocab, rng.randint(1, 50, 60).astype(float), 1000, ex)
    dense = np.zeros((500, 60))
    for d, _, _, f, c in ex:
        dense[d, f] = index.weigh(f, c)[1]
    for d in range(0, 500, 7):
        i, s = index.search(*index.weigh(ex[d][3], ex[d][4]))
        want = np.sort(dense @ dense[d])[::-1][: len(s)]
        assert np.allclose(s, want)


def test_toxicity_without_labels(spark):
    index = toxicity.fit(docs(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert len({r["score"] for r in toxicity.score_toxicity(docs(spark, [(1, "a b"), (2, None)]), index).collect()}) == 1


def test_language_id(spark):
    rng = random.Random(6)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["schu", "ert", "ung"], "zz": ["ción", "que", "ñas"]}
    rows = [(i, " ".join("".join(rng.choices(parts[g], k=3)) for _ in range(rng.randrange(5, 80))), g, "s", 0) for i, g in enumerate(rng.choices(list(parts), k=600))]
    df = spark.createDataFrame([*rows, (900, None, "xx", "s", 0), (901, "12 34 !", "yy", "s", 0), (902, "kalomi", None, "s", 0), (None, "ertung", "yy", "s", 0)], DOC)
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert sum(got[i]["lang_pred"] == g for i, _, g, *_ in rows) >= 0.98 * len(rows)
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[902]["lang_pred"] == "xx" and got[None]["lang_pred"] == "yy"
    none = langid.fit(df.where("false"))
    assert {r["lang_pred"] for r in langid.identify(df, none).collect()} == {"und"}


def test_codewords_are_apart():
    for k in (2, 4, 6, 9, 20):
        c = langid.codewords(k).astype(int)
        d = (c.shape[1] - c @ c.T) // 2 + 10**6 * np.eye(k, dtype=int)
        assert d.min() >= (1 if k == 2 else c.shape[1] // 4)


def base_scan(text):
    t = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    at = [(i, label) for i in range(len(w)) for p, label in license_scan.BASE.items() if w[i : i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), sorted({x for _, x in at})


TEXTS = [None, "", "...", "x", "Under the MIT license", "é under, the: mit\nlicense under the mit license. Apache License, Version 2.0", "cc-by-nc cc by nc by nc", "summit license under the mit licenses", "Released under the GNU General Public License, version 3.", "Licensed under the Apache License Version 2; all rights reserved", "under the mit license " * 200, "mit " * 50]


def test_license_base(spark, tmp_path):
    path = str(tmp_path / "d")
    docs(spark, list(enumerate(TEXTS))).write.parquet(f"{path}/documents.parquet")
    got = {r["doc_id"]: r for r in license_scan.op7(spark, path).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], [x for x in r["base_labels"].split(",") if x]) == base_scan(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert "gpl-3" in got[8]["labels"] and "apache-2" in got[9]["labels"]


def test_license_suppression_equals_brute_force(spark):
    rules = license_scan.signatures()
    assert len(rules) > 200 and len({r.regex for r in rules}) == len(rules)
    rng = random.Random(1)
    bits = ["released under the mit license", "the mit license", "gnu general public license version 3", "licensed under apache", "the revised bsd license", "spdx license identifier mit", "w1 w2", "license", "all rights reserved"]
    texts = [" ".join(rng.choices(bits, k=6)) for _ in range(25)]
    got = {r["doc_id"]: r["found"] for r in license_scan.scan_licenses(docs(spark, list(enumerate(texts))), rules).collect()}
    for i, t in enumerate(texts):
        norm = f" {t} "
        held = set(norm.split())
        found = {(norm[: m.start()].count(" ") - 1, norm[: m.end()].count(" "), r.priority, r.label) for r in rules if r.keyword in held for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", norm)}
        kept = {d for d in found if not any(o != d and o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and (o[:3] != d[:3] or o[3] < d[3]) for o in found)}
        assert {(d["start"], -d["last"], -d["rank"], d["label"]) for d in got[i]} == kept, t


def spellings(parsed):
    """Texts that a pattern of literals, choices, options, classes and runs of them matches: all choices, one text a run."""
    out = [""]
    for op, x in parsed:
        kind = str(op)
        if kind == "LITERAL":
            own = [chr(x)]
        elif kind == "IN":
            own = [chr(c if str(k) == "LITERAL" else c[0]) for k, c in x]
        elif kind == "SUBPATTERN":
            own = spellings(x[3])
        elif kind == "BRANCH":
            own = [t for p in x[1] for t in spellings(p)]
        else:
            assert kind == "MAX_REPEAT" and x[0] in (0, 1)
            own = ([""] if x[0] == 0 else []) + spellings(x[2])
        out = [a + b for a in out for b in own]
    return out


def test_license_keywords_are_in_every_match(spark):
    """The prefilter loses nothing: each spelling of each signature holds its keyword, and the scan finds the signature."""
    rules = license_scan.signatures()
    texts = []
    for r in rules:
        every = spellings(re._parser.parse(r.regex))
        assert all(r.keyword in t.split() for t in every), r
        texts.append(f"w {max(every, key=len)} w")
    got = {r["doc_id"]: r["found"] for r in license_scan.scan_licenses(docs(spark, list(enumerate(texts))), rules).collect()}
    compiled = [(r, re.compile(f"(?<= )(?:{r.regex})(?= )")) for r in rules]
    for i, t in enumerate(texts):
        norm = f" {t} "
        found = {(norm[: m.start()].count(" ") - 1, norm[: m.end()].count(" "), r.priority, r.label) for r, p in compiled for m in p.finditer(norm)}
        kept = {d for d in found if not any(o != d and o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and (o[:3] != d[:3] or o[3] < d[3]) for o in found)}
        assert kept and {(d["start"], -d["last"], -d["rank"], d["label"]) for d in got[i]} == kept, t


def repeat_words(text, n=8):
    w = WORD.findall(text or "")
    at = {}
    for i in range(len(w) - n + 1):
        at.setdefault(tuple(w[i : i + n]), []).append(i)
    return len({j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + n)})


def test_quality(spark):
    rng = random.Random(9)
    line = prose(rng, 12)
    texts = [None, "", "a", prose(rng, 100), "\n".join([line] * 3 + [prose(rng, 30)]), "a " * 40, "x # $ " * 20, "l\nl\n\nl \nm" + prose(rng, 30)]
    got = {r["doc_id"]: r for r in quality.quality_cascade(docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r, w = got[i], WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat_words(t)), t
    order = [r for r, *_ in quality.estimate_order(docs(spark, list(enumerate(texts))))]
    assert {r.name for r in order} == {r.name for r in quality.RULES}
    kept = [{r["doc_id"]: r["kept"] for r in quality.quality_cascade(docs(spark, list(enumerate(texts))), order=o).collect()} for o in (quality.RULES, quality.RULES[::-1])]
    assert kept[0] == kept[1] and kept[0][3] and not kept[0][0]


def test_substring_dedup(spark):
    rng = random.Random(11)
    passage = prose(rng, 60) + "."
    rows = [(i, f"{prose(rng, 90, 10**6)}. {passage} {prose(rng, 70, 10**6)}.") for i in range(5)] + [(i, prose(rng, 200, 10**6)) for i in range(10, 30)] + [(40, None), (41, ""), (42, "short")]
    near = prose(rng, 80, 10**6).split()
    for i in (50, 51):
        w = list(near)
        w[5] = f"z{i}"
        rows.append((i, " ".join(w)))
    df = docs(spark, rows)
    found = substring_dedup.repeated_paragraphs(substring_dedup.with_row_id(df), Scratch(spark)).collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2, 3, 4, 50, 51}
    assert {r["doc_id"] for r in found if not r["kept"]} == {1, 2, 3, 4, 51}
    out = {r["doc_id"]: r for r in substring_dedup.remove_passages(df, Scratch(spark)).collect()}
    assert len(out) == len(rows) and sum(passage in (r["text"] or "") for r in out.values()) == 1
    words = passage.split()
    assert all(sum(" ".join(words[j : j + 20]) in out[i]["text"] for j in range(41)) == 0 for i in (1, 2, 3, 4))
    assert all(out[i]["text"] == dict(rows)[i] for i in [*range(10, 30), 0, 40, 41, 42]) and out[3]["n_chars"] == len(out[3]["text"])
    assert substring_dedup.remove_passages(df.where("false"), Scratch(spark)).count() == 0


def test_band_tuning():
    assert 1 - (1 - 0.8**substring_dedup.ROWS) ** substring_dedup.BANDS >= 0.95


def found_in(spark, texts):
    return substring_dedup.repeated_paragraphs(substring_dedup.with_row_id(docs(spark, list(enumerate(texts)))), Scratch(spark))


def test_every_shared_run_of_49_words_holds_a_paragraph():
    """Brute force over starts: two texts around one run have a paragraph inside it, wherever it stands."""
    rng = random.Random(3)
    for n in (49, 50, 60):
        run = prose(rng, n, 10**6)
        starts = []
        for lead, rest in ((rng.randrange(80), 70), (rng.randrange(80), 0), (0, 30)):
            text = " ".join(filter(None, [prose(rng, lead, 10**6), run, prose(rng, rest, 10**6)]))
            got = [p.tolist() for _, _, p, _, _ in substring_dedup._paragraphs(pa.array([text]))]
            starts.append({p - lead for x in got for p in x if p >= lead and p + substring_dedup.LENGTH <= lead + n})
        assert set.intersection(*starts), (n, starts)
    for n, most in ((29, 0), (30, 1), (31, 2), (48, 19)):
        got = [len(p) for _, _, p, _, _ in substring_dedup._paragraphs(pa.array([prose(rng, n, 10**6)]))]
        assert sum(got) == 0 if most == 0 else 1 <= sum(got) <= most


def edited(rng, words, n, last=3):
    """Copies of a text, each with a few words near its end changed."""
    return [" ".join([*words[:-last], *(rng.choice([w, f"z{rng.randrange(10**6)}"]) for w in words[-last:])]) for _ in range(n)]


def paragraph_sets(texts):
    """Shingle sets of the paragraphs of each text, by row."""
    out = {}
    for first, row, _, places, s in substring_dedup._paragraphs(pa.array(texts)):
        for r, i in zip((first + row).tolist(), places.tolist(), strict=True):
            out.setdefault(r, []).append(frozenset(s[i : i + substring_dedup.SPAN].tolist()))
    return out


def test_near_paragraphs_are_found(spark):
    """Recall of single paragraphs against brute force; 30 words give Jaccard 24/28 and 25/27 just above the threshold."""
    rng = random.Random(5)
    texts = [t for _ in range(700) for t in edited(rng, prose(rng, 30, 10**6).replace(".", "").split(), 2)]
    sets = paragraph_sets(texts)
    similar = [100 * len(sets[i][0] & sets[i + 1][0]) / len(sets[i][0] | sets[i + 1][0]) for i in range(0, len(texts), 2)]
    like = {2 * i for i, x in enumerate(similar) if x >= 80}
    got = {r["doc_id"] for r in found_in(spark, texts).where("not kept").collect()}
    assert got <= {i + 1 for i in like}
    for low, high in ((85, 90), (90, 99)):
        near = {2 * i + 1 for i, x in enumerate(similar) if low <= x <= high}
        assert len(near) > 25 and len(got & near) >= 0.95 * len(near), (low, len(near), len(got & near))


@pytest.mark.parametrize("block,few", [(7, 12), (512, 3)])
def test_bucket_keeps_links_apart_from_its_ends(spark, monkeypatch, block, few):
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    monkeypatch.setattr(substring_dedup, "FEW", few)
    rng = random.Random(6)
    texts = [t for _ in range(12) for t in edited(rng, prose(rng, 30, 10**6).replace(".", "").split(), 5)]
    df = substring_dedup.with_row_id(docs(spark, list(enumerate(texts))))
    ids = {r["doc_id"]: r["rid"] for r in df.collect()}
    rows, flat = [], {}
    for first, row, _, places, s in substring_dedup._paragraphs(pa.array(texts)):
        for r, i, c1, c2 in zip((first + row).tolist(), places.tolist(), *(c.tolist() for c in substring_dedup._classes(s, places)), strict=True):
            if not any(x[1:3] == (c1, c2) for x in rows):
                rows.append((len(rows), c1, c2, ids[r]))
                flat[len(rows) - 1] = frozenset(s[i : i + substring_dedup.SPAN].tolist())
    classes = spark.createDataFrame(rows, "cid long, c1 long, c2 long, rid long")
    links = substring_dedup.class_links(classes.select(F.lit(0).cast("long").alias("key"), "cid"), classes, df, Scratch(spark))
    got = {r["node"]: r["component"] for r in connected_components(links, Scratch(spark)).collect()}
    root = {c: c for c in flat}
    for _ in flat:
        for a in flat:
            for b in flat:
                if root[a] != root[b] and 100 * len(flat[a] & flat[b]) >= 80 * len(flat[a] | flat[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert len(set(root.values())) < len(flat) - 12
    assert {c: got.get(c, c) for c in flat} == root


@pytest.mark.parametrize("block", [7, 512])
def test_sets_move_once_to_their_buckets(spark, monkeypatch, block):
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    compare, plans, counts = substring_dedup._compare, [], []

    def look(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        counts.append((rows.count(), rows.distinct().count()))
        return compare(rows)

    monkeypatch.setattr(substring_dedup, "_compare", look)
    rng = random.Random(6)
    texts = [t for _ in range(12) for t in edited(rng, prose(rng, 30, 10**6).replace(".", "").split(), 2)]
    df = docs(spark, list(enumerate(texts)))
    df = substring_dedup.with_row_id(df.union(df))
    rows = substring_dedup.paragraph_table(df, Scratch(spark)).groupBy("c1", "c2").agg(F.min("rid").alias("rid"))
    classes = Scratch(spark).save(rows.withColumn("cid", F.monotonically_increasing_id()))
    held = classes.select(F.lit(0).cast("long").alias("key"), "cid")
    assert substring_dedup.class_links(held, classes, df, Scratch(spark)).count() and len(plans) == (2 if block == 7 else 1)
    for plan in plans:  # what makes the sets is not joined or shuffled any more before the buckets
        top = [x.strip(" +-:*()0123456789") for x in plan.splitlines() if not x.startswith(("AdaptiveSparkPlan", "== "))]
        assert top[0].startswith("MapInArrow"), plan
    # a row that is there twice brings its sets once
    assert all(n == d for n, d in counts) and counts[0][0] == classes.count()


def test_arrow_batches_of_long_rows_are_small(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        scratch = Scratch(spark)
        size = lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in it)
        rows = spark.range(0, 3000, 1, 1).select(F.expr("repeat(cast(id as string), 2000)").alias("x"))
        sizes = [r["n"] for r in scratch.save(rows.mapInArrow(size, "n long")).collect()]
        assert sum(sizes) > 20e6 and max(sizes) < 9e6
        spark.conf.set(key, 1 << 20)
        Scratch(spark)
        assert int(spark.conf.get(key).rstrip("b")) == 1 << 20
    finally:
        spark.conf.unset(key)


def test_tables_and_batches_of_long_rows_are_held_in_small_parts(spark):
    keys = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    for key in keys:
        spark.conf.unset(key)
    try:
        scratch = Scratch(spark)
        assert int(spark.conf.get(keys[1])) == 512
        size = lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in it)
        rows = spark.range(0, 40_000, 1, 1).select("id", F.expr("concat_ws(' ', transform(sequence(1, 70), i -> sha1(cast(id * 100 + i as string))))").alias("x"))
        saved = scratch.save(rows, compression="uncompressed")
        (file,) = saved.inputFiles()
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        groups = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
        assert sum(groups) > 100e6 and max(groups) < 20e6
        assert max(r["n"] for r in saved.mapInArrow(size, "n long").collect()) < 3e6
        assert saved.agg(F.sum("id"), F.sum(F.length("x"))).first() == rows.agg(F.sum("id"), F.sum(F.length("x"))).first()
        for key, n in zip(keys, (1 << 20, 100), strict=True):  # lower limits stay
            spark.conf.set(key, n)
        Scratch(spark)
        assert [int(spark.conf.get(k).rstrip("b")) for k in keys] == [1 << 20, 100]
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_shared_keys_need_not_be_sent(spark, monkeypatch):
    rng = random.Random(15)
    passage = prose(rng, 70, 10**6)
    texts = [f"{prose(rng, 40, 10**6)} {passage if i % 3 == 0 else ''} {prose(rng, 50, 10**6)}" for i in range(40)]
    key = lambda r: (r["doc_id"], r["p"], r["kept"], r["first_doc"])
    want = sorted(map(key, found_in(spark, texts).collect()))
    monkeypatch.setattr(substring_dedup, "SEND_KEYS", 0)
    assert want == sorted(map(key, found_in(spark, texts).collect())) and {r[0] for r in want} == {i for i in range(40) if i % 3 == 0}


def test_places_are_sent_by_their_number_not_by_their_rows(spark):
    # few rows with many places once went to every task through the driver
    df = substring_dedup.with_row_id(docs(spark, [(i, f"w{i} " * 40) for i in range(50)]))
    ids = spark.createDataFrame(list(enumerate(r["rid"] for r in df.collect())), "n long, rid long")
    wide = spark.range(600_000, numPartitions=4).select(F.col("id").alias("cid"), (F.col("id") % 50).alias("n"))
    classes = wide.join(ids, "n").select("cid", F.col("cid").alias("c1"), "rid")
    for n, shuffled in ((600_000, True), (500, False)):
        places = wide.where(f"cid < {n}").select("cid", F.col("cid").alias("key"), F.lit(0).alias("block"))
        plan = substring_dedup.bucket_sets(places, classes, df, Scratch(spark))._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" in plan) == shuffled, plan


def test_nothing_is_lost_if_too_much_to_send(spark, monkeypatch):
    rng = random.Random(16)
    passages = [prose(rng, 70, 10**6).split() for _ in range(3)]
    rows = []
    for i in range(60):
        w = list(passages[i % 3])
        w[rng.randrange(70)] = f"z{i}"
        rows.append((i, f"{prose(rng, 40, 10**6)} {' '.join(w) if i % 5 else ''} {prose(rng, 50, 10**6)}"))
    df = docs(spark, [*rows, rows[1], (None, rows[2][1]), (70, None), (71, ""), (72, "short"), (73, " ".join(passages[0])), *((i, " ".join(f"v{k}" for k in range(30))) for i in (80, 81))])
    df = df.withColumn("row", F.lit(1))

    def state():
        found = substring_dedup.repeated_paragraphs(substring_dedup.with_row_id(df), Scratch(spark)).select("doc_id", "p", "q", "kept", "first_doc")
        return sorted(map(str, found.collect())), sorted(map(str, substring_dedup.remove_passages(df, Scratch(spark)).collect()))

    want = state()
    assert len(want[0]) > 100 and len(want[1]) < df.count() and df.columns == substring_dedup.remove_passages(df, Scratch(spark)).columns
    for limit in ("SEND", "SEND_PLACES", "SEND_SPANS", "SEND_KEYS"):
        monkeypatch.setattr(substring_dedup, limit, 0)
    plans = []
    save = Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, d, *a, **k: plans.append((d.columns, d._jdf.queryExecution().executedPlan().toString())) or save(self, d, *a, **k))
    assert state() == want
    # paragraphs are not joined with the keys: a filter of bounded size leaves most of the others out
    tables = [p for c, p in plans if c[-1] == substring_dedup.KEYS[-1]]
    assert len(tables) == 2 and not any("Join" in p or "Exchange" in p for p in tables)


def test_key_filter_holds_every_shared_key(spark, monkeypatch):
    rng = np.random.default_rng(3)
    ranges, keys = 64, np.unique(rng.integers(0, 2**38, 40_000, dtype=np.uint64))
    shared = spark.createDataFrame([(r, bytearray((keys[keys >> np.uint64(32) == r]).astype(np.uint32).tobytes())) for r in range(60)], "range int, keys binary")
    keys, others = keys[keys < np.uint64(60 << 32)], rng.integers(0, 60 << 32, 100_000, dtype=np.uint64)
    for most, size, passed in ((8_000_000, 1 << 20, 0.02), (1000, 1 << 14, 1)):
        monkeypatch.setattr(substring_dedup, "SEND_KEYS", most)
        known, slots, times = substring_dedup.key_filter(shared, ranges, len(keys))
        inside = lambda x: np.logical_and.reduce([known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 for at in substring_dedup._filter_places(x, slots, times)])  # noqa: E731, B023
        assert len(known) * 8 == slots * ranges <= size and inside(keys).all() and inside(others).mean() <= passed


def test_row_marks(spark):
    ids = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 3000).tolist()
    rows = spark.createDataFrame([(i,) for i in [*ids, -1, 0, 2**63 - 1, -(2**63)]], "rid long")
    marks = substring_dedup.row_marks(rows.limit(0).union(rows.where("rid % 2 = 0")), Scratch(spark))
    here, rest = (substring_dedup.by_marks(rows, marks, x) for x in (True, False))
    assert here.where("rid % 2 = 0").count() == rows.where("rid % 2 = 0").count() and here.count() + rest.count() == rows.count() and rest.count() > 1400
    none = substring_dedup.row_marks(rows.limit(0), Scratch(spark))
    assert none.count() == 1 and substring_dedup.by_marks(rows, none).count() == 0


def test_escaping_is_reversible(spark):
    texts = ["", "<|im_start|>", "<\\|im_end|>\n", "</s>[INST] ok [/INST]", "a < b [0] \\<s>", "<\\\\s><s>", "<<s>>", "[[INST]]", "<|x|><|y z|>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat_format.escape(F.col("t")).alias("e"), chat_format.unescape(chat_format.escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and not re.search(r"<\|\w+\|>|</?s>|\[/?INST\]", r["e"])


def test_chat_round_trip(spark, tmp_path):
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 2, None, None), (2, 0, "assistant", ""), (None, 0, "user", "n"), (3, 0, "us\ner\\n", "<|im_end|>\n"), (3, 0, "us\ner\\n", "<|im_end|>\n"), (4, None, "user", "x"), (4, 1, "assistant", "é" * 3)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(37)]
    path = str(tmp_path)
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int").write.parquet(f"{path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat_format.op10(spark, path).collect()}
    assert got[-1]["loss_chars"] == len(chat_format.EXTRA)
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()), c


def test_reply_trees_rank_branches(spark):
    nodes = [("t", 1, None, 0.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 3, 9.0), ("t", 5, 4, 9.0), ("u", 6, 77, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = {}
    for r in chat_format.reply_paths(df, Scratch(spark), paths_per_tree=1).orderBy("tree", F.desc("up")).collect():
        got.setdefault((r["tree"], r["leaf"]), []).append(r["node"])
    assert got == {("t", 5): [1, 3, 4, 5], ("u", 6): [6]}
    every = chat_format.reply_paths(df, Scratch(spark)).collect()
    assert {(r["leaf"], r["node"], r["up"]) for r in every} == {(2, 2, 0), (2, 1, 1), (5, 5, 0), (5, 4, 1), (5, 3, 2), (5, 1, 3), (6, 6, 0)}
    loop = spark.createDataFrame([("t", 1, 2, 0.0), ("t", 2, 1, 0.0)], "tree string, node long, parent long, score double")
    with pytest.raises(ValueError, match="cycle"):
        chat_format.reply_paths(loop, Scratch(spark), max_doublings=5)


@pytest.mark.parametrize("pairs", [50, 1 << 20])
def test_common_counts_intersections_in_bounded_memory(monkeypatch, pairs):
    import tracemalloc

    from chronoweave.llm import overlap

    monkeypatch.setattr(overlap, "PAIRS", pairs)
    rng = np.random.default_rng(7)
    sets = [rng.choice(m, rng.integers(0, 30), replace=False).astype(np.int64) - 50 for m in [60] * 20 + [5000] * 20]
    flat = lambda s: (np.concatenate(s), np.array([len(x) for x in s], np.int64))
    a, b = flat(sets), flat(sets[10:35])
    want = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
    assert (overlap.common(*a, *a) == want).all() and (overlap.common(*a, *b) == want[:, 10:35]).all()
    none = (np.zeros(0, np.int64), np.zeros(3, np.int64))
    assert (overlap.common(*a, *none) == 0).all() and overlap.common(*none, *b).shape == (3, 25)
    assert (overlap.common(*none, *(b[0] + 10**6, b[1])) == 0).all() and (overlap.common(*a, *(b[0] + 10**6, b[1])) == 0).all()
    if pairs > 50:
        big = (np.tile(np.arange(1000, dtype=np.int64), 1000), np.full(1000, 1000, np.int64))
        big[0].reshape(1000, 1000)[:] += np.arange(1000)[:, None] * 400
        tracemalloc.start()
        got = overlap.common(*big, *big)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (np.diag(got) == 1000).all() and got[0, 1] == 600 and got[0, 3] == 0 and most < 120e6, most
