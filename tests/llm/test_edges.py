"""Every operator and stage on rows with nulls, empty and very long texts, repeats and columns named like its own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoweave.llm import chat_format, decontaminate, langid, license_scan, mixture, ngram_join, quality, substring_dedup, toxicity, url_rules
from chronoweave.llm.scratch import Scratch

#: Names that operators use inside or return.
CLASH = ["rid", "row", "spans", "n_words", "kept", "cid", "c1", "h", "n", "size", "place", "segment", "m", "s", "held", "norm", "_words", "_runs", "_keep", "_url", "score", "component_id", "taken", "p", "q", "key", "w"]
LONG = " ".join(f"word{i % 4001}." if i % 11 == 10 else f"w{i}" for i in range(180_000))
TEXTS = [None, "", " \n ", "one", "The same few words again", "The same few words again", "A licence: released under the MIT license!", LONG, LONG + " tail", "x " * 300, "Größe naïve 日本語 \U0001f600 " * 12]


@pytest.fixture(scope="module")
def rows(spark):
    ids = [1, 2, 3, 4, 5, 5, 6, 7, 8, None, 9]
    df = spark.createDataFrame([(i, t, "en" if k % 2 else None, "s" if k % 3 else None, len(t or "")) for k, (i, t) in enumerate(zip(ids, TEXTS, strict=True))], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (4, 1), (None, 1), (6, None), (4, 0)], "doc_id long, toxic int")


def bench(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "The same few words again"), (None, "The same few words again"), (5, " ".join(LONG.split()[2000:2400]))], "item_id long, text string")


OPERATORS = {
    "leaks": lambda spark, d, l: decontaminate.find_leaks(d, bench(spark)),
    "mix": lambda spark, d, l: mixture.mix_sources(d, Scratch(spark))[0],
    "join": lambda spark, d, l: ngram_join.similar_documents(d, Scratch(spark)),
    "toxicity": lambda spark, d, l: toxicity.score_toxicity(d, toxicity.fit(d, l)),
    "language": lambda spark, d, l: langid.identify(d, langid.fit(d)),
    "license": lambda spark, d, l: license_scan.scan_licenses(d),
    "quality": lambda spark, d, l: quality.quality_cascade(d),
    "passages": lambda spark, d, l: substring_dedup.remove_passages(d, Scratch(spark)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, rows, labels, name):
    out = OPERATORS[name](spark, rows, labels)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    got = out.collect()
    if name == "leaks":
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(5, 3), (7, 5), (8, 5)}
    elif name == "passages":
        # both long texts share all but the tail; the first stays whole
        kept = {r["doc_id"]: r for r in got}
        assert out.columns == rows.columns and kept[7]["text"] == LONG and len(kept[8]["text"]) < 400 and all(r["rid"] == CLASH.index("rid") for r in got)
        assert len(got) == len(TEXTS) and kept[4]["text"] == "one"
    else:
        assert len(got) == len(TEXTS)
    if name == "join":
        assert {(r["doc_id"], r["component_id"], r["n_links"]) for r in got} == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 1), (6, 6, 0), (7, 7, 1), (8, 7, 1), (None, None, 0), (9, 9, 0)}
    if name == "mix":
        assert all(r["taken"] <= 3 * r["size"] for r in got) and sum(r["taken"] for r in got) > 0
    if name in ("toxicity", "language"):
        assert all(0 <= r["score"] <= 1 for r in got)
    if name == "license":
        assert {r["label"] for x in got for r in x["base"]} == {"mit"}
    if name == "quality":
        assert not any(r["kept"] for r in got if not (r["text"] or "").strip()) and any(r["kept"] for r in got)


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("mix", "leaks")])
def test_operator_without_rows(spark, rows, labels, name):
    assert OPERATORS[name](spark, rows.where("false"), labels.where("false")).count() == 0


def test_urls(spark):
    urls = [None, "", "http://x.net/" + "a/" * 50_000, "http://x.net/", "http://x.net/", "https://EXAMPLE.com/de/x?y", "http://cheap-pills.example.org/"]
    df = spark.createDataFrame([(k, u, "own", "own") for k, u in enumerate(urls)], "page_id long, url string, host string, fetched string")
    out = url_rules.filter_urls(df, url_rules.SITE_RULES + url_rules.PATTERN_RULES, keep=("page_id", "host", "fetched"))
    got = {r["page_id"]: r for r in out.collect()}
    assert out.columns == ["page_id", "fetched", "host", "path", "rule", "verdict", "pattern"] and len(got) == len(urls)
    assert got[5]["host"] == "example.com" and got[5]["rule"] == "example.com/de/" and got[2]["verdict"] == "block" and got[0]["host"] == "" and got[1]["fetched"] == "own"
    # equal lengths: the smaller text decides
    ties = [url_rules.Rule("x.net/b/", "block", "site"), url_rules.Rule("x.net/a/", "allow", "site"), url_rules.Rule("||y.io/q", "block"), url_rules.Rule("||y.io/p", "block")]
    df = spark.createDataFrame([(1, "http://x.net/a/"), (2, "http://y.io/p/||y.io/q")], "page_id long, url string")
    got = {r["page_id"]: r for r in url_rules.filter_urls(df, ties).collect()}
    assert got[1]["rule"] == "x.net/a/" and got[2]["pattern"] == "||y.io/p"
    assert url_rules.filter_urls(df.where("false"), ties).count() == 0 and url_rules.filter_urls(df, []).count() == 2


def test_chats(spark):
    turns = spark.createDataFrame([(1, 0, "user", LONG, 7), (1, 1, "assistant", None, 7), (1, 1, "assistant", None, 7), (None, None, None, "", 7)], "conv_id long, turn long, role string, text string, formatted long")
    got = {r["conv_id"]: r for r in chat_format.format_conversations(turns, Scratch(spark)).collect()}
    assert set(got) == {1, None} and len(got[1]["loss_spans"]) == 2 and LONG in got[1]["formatted"]
    assert chat_format.format_conversations(turns.where("false"), Scratch(spark)).count() == 0
    # equal mean scores: the smaller leaf ranks first
    nodes = spark.createDataFrame([("t", 1, None, 1.0), ("t", 3, 1, 2.0), ("t", 2, 1, 2.0)], "tree string, node long, parent long, score double")
    assert {r["leaf"] for r in chat_format.reply_paths(nodes, Scratch(spark), paths_per_tree=1).collect()} == {2}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, rows, name, tmp_path_factory):
    """A stage keeps the caller's columns; nulls and empty texts pass the filters."""
    folder = str(tmp_path_factory.mktemp("in"))
    spark.createDataFrame([(1, 0), (4, 0)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench(spark).write.parquet(f"{folder}/benchmark.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, rows, folder)
    got = out.collect()
    if name == "source_mixing":
        assert len(got) == len(TEXTS)
        return
    assert out.columns == rows.columns
    ids = {r["doc_id"] for r in got}
    assert {1, 2, 3, 4, 6, 9} <= ids
    if name == "benchmark_decontamination":
        assert not ids & {5, 7, 8}
    if name == "ngram_jaccard_join":
        assert 7 in ids and 8 not in ids
