"""The operators of the training-data subpackage against brute force, round trips and held-out labels."""

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimloom.llm import chat_format, html_extract, license_scan, ngram_jaccard, packing, piece_codec, quality_classifier, quality_rules, sharding, staging, vector_search
from claimloom.llm.components import connected_components
from claimloom.llm.queries import queries, tokenizer_path

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " \n\t", "x", "é" * 7, "a  b c", "word " * 400, "L\n" * 50, "😀 𝒳 mixed 日本語 text", "A b C d E f g", "A b C d E f g", "tail\n"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts with repeated rows, null ids and columns that clash with internal names."""
    rows = [(i, t, "en" if i % 3 else None, "src", 1.0, 2, "z") for i, t in enumerate(ODD)] + [(3, "x", "en", "src", 1.0, 2, "z"), (None, "no id at all", "en", None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double, n int, `hash` string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


# 1


@needs_data
def test_classifier_learns_labels_and_keeps_the_held_out_fold(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = quality_classifier.classify_quality(docs, labels).toPandas()
    assert len(found) == docs.count() and found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.5)).all()
    assert (found.held_out == found.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)).all()
    both = found.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.9
    flipped = labels.withColumn("quality", F.when(quality_classifier.in_fold(F.col("doc_id"), 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_classifier.classify_quality(docs, flipped).toPandas()
    assert np.allclose(found.sort_values("doc_id").score, again.sort_values("doc_id").score)


def test_classifier_learns_once_from_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, "good text here", 0.0)] * 500 + [(2, "bad bad", 1.0), (3, None, 1.0)], "doc_id bigint, text string, Score double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, label int")
    vectors, network = quality_classifier.train_classifier(docs, labels)
    scored = quality_classifier.with_scores(docs, vectors, network, "score")
    assert scored.columns == ["doc_id", "text", "score"] and scored.count() == 502


def test_staged_tables_have_few_files(spark):
    """Every file of a local folder costs processes, which stand beside the executor."""
    most = 8 * spark.sparkContext.defaultParallelism
    many = spark.range(0, 10 * (most + 50), 1, most + 50).withColumn("row", F.monotonically_increasing_id())
    table = staging.staged(many, "many")
    assert len(table.inputFiles()) <= most
    assert sorted(table.collect()) == sorted(many.collect())


def test_staging_returns_heap_that_the_driver_no_longer_uses(spark):
    """The JVM keeps what it has once taken; beside its other memory that goes beyond what a driver may have."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    held = [spark._jvm.java.nio.ByteBuffer.allocate(8 << 20) for _ in range(int(runtime.maxMemory() * 0.6) >> 23)]
    taken = runtime.totalMemory()
    assert taken > 0.5 * runtime.maxMemory()
    del held
    assert staging.staged(spark.range(10), "few").count() == 10
    assert runtime.totalMemory() < 0.75 * taken


def test_the_drivers_native_memory_can_be_trimmed(spark):
    """The command is reached on this JVM; without it the native part of the driver only grows."""
    staging._trim_native(spark)


def test_staged_tables_need_a_shared_folder_on_a_cluster():
    from claimloom.llm.staging import shared_folder

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_classifier_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1), (3, 0), (6, 0), (None, 1), (5, None)], "doc_id bigint, quality int")
    found = quality_classifier.classify_quality(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    none = quality_classifier.classify_quality(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_classifier.classify_quality(odd.limit(0), labels).count() == 0


# 2


def brute_chat(rows):
    out = {}
    conversations = collections.defaultdict(list)
    for c, turn, role, text in rows:
        conversations[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in conversations.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


CHATS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "hi " * 60), (1, 2, "assistant", "yes " * 80), (1, 3, "user", "<|im_start|>user\nno<|im_end|>"), (1, 4, "assistant", "\\<|im_end|>\\\\ [INST] </s> <<SYS>>"),
    (1, 5, "assistant", "word " * 300), (1, 6, "user", None), (1, 7, "assistant", "a\nb\n"), (2, None, None, "x"), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (None, 1, "we\nird<|role", "é😀"), (3, 0, "assistant", "</s>[INST] ok [/INST]"),
    *[(4, i, "user" if i % 2 == 0 else "assistant", f"w{i} " * 16) for i in range(12)],
]
CHAT = "conv_id bigint, turn bigint, role string, text string"


def test_chat_round_trip_and_windows(spark):
    turns = spark.createDataFrame(CHATS, CHAT).withColumn("formatted", F.lit("clash"))
    windows = chat_format.format_conversations(turns, budget=100, history=2, history_budget=90)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.digests(windows).collect()}
    assert got == brute_chat(CHATS)
    rows = windows.where("conv_id = 1").orderBy("window").collect()
    assert len(rows) > 2 and all(r["formatted"].startswith("<|im_start|>system\nBe brief.<|im_end|>\n") for r in rows)
    assert all(r["repeated"] <= 3 for r in rows)
    short = windows.where("conv_id = 4").orderBy("window").collect()
    assert [r["repeated"] for r in short] == [0, 2, 2, 2] and all(r["n_tokens"] <= 100 for r in short)
    single = [r for r in rows if r["n_tokens"] > 100]
    assert all(r["formatted"].count("<|im_start|>") - r["repeated"] == 1 for r in single)
    texts = "".join(chat for r in rows for chat in [r["formatted"]])
    assert texts.count("<|im_end|>\n") == texts.count("<|im_start|>")
    assert chat_format.digests(chat_format.format_conversations(turns.limit(0))).count() == 0


def test_chat_is_native(spark):
    turns = spark.createDataFrame(CHATS, CHAT)
    plan = chat_format.digests(chat_format.format_conversations(turns))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 3


def test_pieces_equal_the_library(spark, odd):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    coded = piece_codec.encode_texts(odd, path)
    for r in coded.collect():
        text = "no id at all" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text)
    back = piece_codec.decode_ids(coded, path).collect()
    assert all(r["text"] == ("no id at all" if r["doc_id"] is None else ODD[r["doc_id"]] or "") for r in back)
    assert piece_codec.decode_ids(spark.createDataFrame([(1, None), (2, [99999])], "doc_id bigint, ids array<int>"), path).where("doc_id = 1").head()["text"] == ""
    assert piece_codec.encode_texts(odd.limit(0), path).count() == 0


def test_pieces_and_their_texts_come_from_one_worker(spark, odd):
    """A task needs one worker, which drops its encoder once it works for another operator."""
    path = tokenizer_path("piece_bpe_32k.model")
    both = piece_codec.encode_texts(odd, path, decoded="read back")
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = piece_codec.decode_ids(piece_codec.encode_texts(odd, path), path, text="read back")
    assert both.schema == apart.schema
    assert sorted(both.collect(), key=str) == sorted(apart.collect(), key=str)
    assert piece_codec.tk.KEPT["pieces"] is piece_codec._ENCODERS


def test_piece_recursion_equals_merging():
    model = piece_codec.PieceModel(tokenizer_path("piece_bpe_32k.model"))
    draw = np.random.default_rng(2)
    words = ["▁internationalization", "▁the,", "▁ErEa", "▁aaaaaaaaaa", "▁def(x):", "▁naïve", "▁" + "z" * 40, "▁x==1", "▁▁▁a▁▁", "▁" * 77, "▁" + "日本語のテキスト、長い。" * 40, "▁" + "ab" * 300, "▁" + "=" * 101 + "-" * 77]
    words += ["▁" + "".join(draw.choice(list("aabe▁tin日é=😀"), 90)) for _ in range(200)]
    ids, lengths = model.encode_words(words)
    merged = [[i for p in model.merged(w) for i in model.piece_ids(p)] for w in words]
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == merged


def test_pieces_of_very_long_words_equal_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    texts = ["x" * 3000, "日本語" * 20_000, "aé" * 2000 + "  " * 900 + "b", "word " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"]: r["ids"] for r in piece_codec.encode_texts(docs, path).collect()} == {i: library.encode(x) for i, x in enumerate(texts)}


# 4


def brute_model(texts, order):
    """Interpolated modified Kneser-Ney with the same counts, in plain dictionaries."""
    pad = b"\xff" * (order - 1)
    counts = {order: collections.Counter()}
    for t in texts:
        s = pad + t.encode()
        for i in range(order - 1, len(s)):
            counts[order][s[i - order + 1 : i + 1]] += 1
    places = {order: counts[order]}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
        places[n] = collections.Counter()
        for g, v in places[n + 1].items():
            places[n][g[1:]] += v
    discounts, totals, gammas = {}, {}, {}
    for n in counts:
        c = collections.Counter(counts[n].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else 0.5
        d = lambda v, most: min(max(v, 0.05), most)
        discounts[n] = [d(1 - 2 * y * c[2] / c[1] if c[1] else 0.5, 0.95), d(2 - 3 * y * c[3] / c[2] if c[2] else 0.5, 1.95), d(3 - 4 * y * c[4] / c[3] if c[3] else 0.5, 2.95)]
        total, mass = collections.Counter(), collections.Counter()
        for g, v in counts[n].items():
            total[g[:-1]] += v
            mass[g[:-1]] += min(discounts[n][min(v, 3) - 1], v)
        totals[n], gammas[n] = total, {h: mass[h] / total[h] for h in total}
    alphabet = len(counts[1]) + 1
    stood = {n: collections.Counter() for n in counts}
    for n in counts:
        for g, v in places[n].items():
            stood[n][g[:-1]] += v

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / alphabet
        h = gram[:-1]
        if n > 1 and stood[n][h] < 2:
            return p(gram[1:])
        v = counts[n][gram] if places[n][gram] > 1 else 0
        seen = (v - min(discounts[n][min(v, 3) - 1], v)) / totals[n][h] if v else 0
        return seen + gammas[n][h] * p(gram[1:])

    return lambda t: sum(math.log(p((pad + t.encode())[i : i + order])) for i in range(len(t.encode())))


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed


@needs_data
@pytest.mark.parametrize("entries", [4_000_000, 30_000])
def test_rules_equal_brute_force(spark, documents, entries):
    docs = documents.where("lang in ('fr', 'es')")
    rows = docs.select("doc_id", "text", "lang").collect()
    found = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, block_entries=entries).collect()}
    assert len(found) == len(rows)
    for lang in ("fr", "es"):
        mine = [r for r in rows if r["lang"] == lang]
        logp = brute_model([r["text"] or "" for r in mine], quality_rules.ORDER)
        for r in mine:
            got = found[r["doc_id"]]
            assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"], got["base_failed"]) == brute_base(r["text"])
            if r["text"]:
                assert got["perplexity"] == pytest.approx(math.exp(-logp(r["text"]) / len(r["text"].encode())), rel=1e-4)
            inside = got["lower_band"] is None or got["perplexity"] is None or got["lower_band"] <= got["perplexity"] <= got["upper_band"]
            assert got["kept"] == (not got["base_failed"] and inside)


def test_rules_odd_rows(spark, odd):
    found = quality_rules.quality_rules(odd).collect()
    assert len(found) == odd.count()
    for r in found:
        text = "no id at all" if r["doc_id"] is None else ODD[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_base(text)
    assert quality_rules.quality_rules(odd.limit(0)).count() == 0


def test_rules_model_takes_few_jobs(spark):
    """All orders share their jobs: the driver holds plans and task figures of every one."""
    rows = [("en", t, 1 + t % 3) for t in range(300)] + [(None, t, 2) for t in range(40)]
    counts = spark.createDataFrame(rows, "lang string, gram bigint, n bigint")
    spark.sparkContext.setJobGroup("model", "model")
    try:
        quality_rules.kneser_ney(counts).collect()
        assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("model")) <= 36
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rules_bands_reject_planted_junk(spark):
    draw = np.random.default_rng(4)
    parts = ["the", "an", "ti", "on", "er", "ing", "and", "re", "st", "ha", "nd", "ou", "sh", "wh"]
    words = ["".join(draw.choice(parts, draw.integers(1, 4))) for _ in range(3000)]
    texts = [" ".join(draw.choice(words, 150)) for _ in range(400)]
    noise = lambda: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    junk = [" ".join(noise() if k % 25 == 0 else w for k, w in enumerate(draw.choice(words, 150))) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts + junk)], "doc_id bigint, text string, lang string")
    rows = quality_rules.quality_rules(docs).collect()
    assert not any(r["base_failed"] for r in rows)
    assert sum(r["doc_id"] >= len(texts) and not r["kept"] for r in rows) == len(junk)
    assert sum(r["doc_id"] < len(texts) and r["kept"] for r in rows) >= 0.97 * len(texts)


# 5


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<p>a  b<br>c</p>", "a b c"),
        ("<html><head><title>t</title></head><body><nav><ul><li>x</li></ul></nav><article><h1>Head</h1><p>One <b>tw</b>o &amp;amp; &eacute;.<p>Three.</article><footer>f</footer></body></html>", "Head One two &amp; é. Three."),
        ("<body><div class='sidebar'>s</div><main><p>Long enough text, with marks. And more, yes.</p><section class='comments'><p>me too</p></section><form><p>f</p></form></main><script>if (a < b) { x('</p>') }</script><div id=ad>buy</div></body>", "Long enough text, with marks. And more, yes."),
        ("<div><p>Plain page, no article. Text goes on, and on.</p><!-- <p>no</p> --></div><header>h</header><div hidden><p>n</p></div>", "Plain page, no article. Text goes on, and on."),
        ("<article><p>unclosed <i>tags <p>go on</article", "unclosed tags go on"), ("<article><p>a<!-- open", "a"), ("5 < 6 and <b>bold</b>", "5 < 6 and bold"),
    ],
)
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


LONG = "A sentence of the story, long enough to count. And one more, with marks; yes. " * 4


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<body><div><h1>Short head</h1><p>%s<b>bold</b> and <a href=x>link</a>, <em>em</em>.</p><ul><li>one</li></ul><p>%s</p></div></body>", "Short head {0} bold and link, em. one {0}"),
        ("<body><div><p>%s</p><p>%s</p></div><article><p>A teaser of another story, in short.</p></article></body>", "{0} {0}"),
    ],
)
def test_main_text_keeps_inline_and_short_blocks(html, text):
    assert html_extract.main_text(html % (LONG, LONG)) == text.format(LONG.strip())


@pytest.mark.parametrize(
    "opening",
    ["<article class='post has-sidebar'>", "<main class='comments-open'>", "<div class='content no-ads'>", "<div id='legal-news'>", "<div data-id='ad'>", "<div class='sidebar'><article>", "<div class='share'>"],
)
def test_main_text_boilerplate_words(opening):
    aside = "<div class='cookie-banner'>We use cookies.</div><div class='sidebar-left'>more</div>"
    assert html_extract.main_text(f"<body>{aside}{opening}<p>{LONG}</p>") == LONG.strip()
    inner = "<p class='warning'>Mind this.</p><math><mi>x</mi></math><div class='tags-intro'>In short.</div><div class='related'>no</div>"
    assert html_extract.main_text(f"<article><p>{LONG}</p>{inner}</article>") == f"{LONG.strip()} Mind this. x In short."


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>", "t"), (1, "u", "<p>x</p>", "t"), (None, None, None, None)], "page_id bigint, url string, html string, text string")
    assert sorted(r["n_chars"] for r in html_extract.extract_main_text(pages).collect()) == [0, 1, 1]
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


# 6


def test_sharding_laws(spark, odd):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("té"), F.col("id"))).alias("text"), F.lit(1).alias("shard"))
    found = sharding.shard_documents(rows).toPandas()
    assert (found.text_crc32 == found.doc_id.map(lambda i: zlib.crc32(f"té{i}".encode() if i % 7 else b""))).all()
    assert (found["size"] == found.doc_id.map(lambda i: len(f"té{i}".encode()) + 1 if i % 7 else 1)).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in found.groupby("shard"))
    assert found.groupby("shard").size().between(400, 600).all() and set(found.shard) == set(range(8))
    moved = found[found.shard != found.grown_shard]
    assert set(moved.grown_shard) == {8} and 350 < len(moved) < 540
    got = sharding.shard_documents(odd)
    assert got.count() == odd.count() and got.groupBy("doc_id").agg(F.countDistinct("shard").alias("k")).where("k > 1").count() == 0
    assert sharding.shard_documents(odd.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [1, 2, 3, 5, 7, 8, 12])
def test_a_further_shard_takes_rows_only_into_itself(spark, shards):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.shard_documents(docs, shards).toPandas()
    moved = found[found.shard != found.grown_shard]
    assert set(found.shard) == set(range(shards)) and set(moved.grown_shard) == {shards}
    assert abs(len(moved) - 3000 / (shards + 1)) < 150


def test_weights_move_only_into_the_heavier_subtree(spark):
    before, after = sharding.topology(8), sharding.topology(8)
    after.children[1].children[0].children[1].own_weight = 3.0
    rows = spark.range(5000).select(sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), after).alias("b")).where("a <> b").distinct().collect()
    inside = {4, 5, 6, 7}
    assert rows and all(r["b"] in inside for r in rows)
    assert all(r["b"] == 5 for r in rows if r["a"] in (4, 5))


# 7


def test_license_places_and_templates(spark, odd):
    texts = {
        1: "All rights reserved. CC-BY CC BY 4.0; all rights reserved",
        2: "This is licensed under the GNU General Public License, version 3.",
        3: "Licensed under the Apache License Version 2.0.",
        4: "Licensed under the Apache License, Version 2.1",
        5: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        6: "cc\nby", 7: "copyright 2020 someone else. All rights reserved.", 8: None,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(docs).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (4, 0, 9, "cc-by,reserved")
    assert got[2]["labels"] == "gpl,gpl-notice" and got[3]["labels"] == "apache-2.0" and got[4]["labels"] == ""
    assert got[5]["labels"] == "gpl,gpl-notice" and got[6]["n_base"] == 1 and got[7]["labels"] == "copyright-notice,reserved"
    assert got[8]["n_words"] == 0 and got[8]["first_word"] is None and got[8]["score"] == 0
    assert license_scan.scan_licenses(odd).count() == odd.count() and license_scan.scan_licenses(odd.limit(0)).count() == 0


def test_automata():
    a = license_scan.Automaton("use <<beginOptional>>this <<beginOptional>>nice <<endOptional>><<endOptional>>software by <<var;x;1;3>> only")
    run = lambda s: a.accepts([license_scan.word_hash(w) for w in s.split()])
    assert run("use software by me only") and run("use this nice software by a b c only now") and run("use this software by x y only")
    assert not run("use nice software by me only") and not run("use software by only") and not run("use software by a b c d only")
    with pytest.raises(ValueError):
        license_scan.Automaton("<<var;x;1;2>>")


# 8


@needs_data
def test_components_equal_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    rows += [(10_000 + i, " ".join(base[: 16 - i % 5] + [f"w{i}"] * (i % 3))) for i in range(40)] + [(20_000 + i, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("token", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(docs).collect()}
    assert got == brute_components(rows)


def test_components_odd_rows(spark, odd):
    got = ngram_jaccard.jaccard_components(odd)
    assert got.count() == odd.count() and got.where("doc_id is null").head()["component_id"] is None
    assert {r["component_id"] for r in got.where("doc_id in (9, 10)").collect()} == {9}
    same = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "p q r s t"), (3, "p q r s t")], "doc_id bigint, text string")
    assert {r["component_id"] for r in ngram_jaccard.jaccard_components(same).collect()} == {1}
    assert ngram_jaccard.jaccard_components(odd.limit(0)).count() == 0


def test_connected_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 30)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}


# 9


def test_packing_ids_and_windows(spark, odd):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    extra = [(100, "It's the dog's <|endoftext|> don't 'tis x''s É À ß µ ﬁ \x1f   x́"), (101, "Word, " * 3000), (102, "a1b22c333---!!!___é×÷")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    texts = dict(enumerate(ODD)) | dict(extra) | {None: "no id at all"}
    pieces = packing.pack_documents(docs, path, window=64, with_ids=True)
    rows = pieces.collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for d, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        copies = 2 if d == 3 else 1
        assert sum(r["length"] for r in by_doc[d]) == copies * len(ids) and {r["doc_tokens"] for r in by_doc[d]} == {len(ids)}
        whole = {(r["start"], bytes(r["ids"])) for r in by_doc[d]}
        assert b"".join(x for _, x in sorted(whole)) == ids.tobytes()
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert all(len(r["ids"]) == 256 for r in packing.sequences(pieces, 64).collect())
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_best_fit_uses_the_tightest_window():
    packer = packing.Packer(10)
    placed = packer.place([7, 6, 3, 4, 25, 10])
    assert packer.sequences == 6 and sum(n for _, _, n, _, _ in placed) == 55
    tree = packing.CapacityTree(8)
    for capacity, w in ((5, 0), (3, 1), (8, 2)):
        tree.add(capacity, w)
    assert tree.take(4) == (5, 0) and tree.take(4) == (8, 2) and tree.take(4) is None and tree.take(1) == (3, 1)


# 10


def test_search_recall_scores_and_ties(spark):
    random = np.random.Generator(np.random.PCG64(3))
    x = np.concatenate([random.normal(size=(900, 16)), np.ones((300, 16))])
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))] + [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [None] * 16), (None, [1.0] * 16), (5400, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, vector array<double>").withColumn("list", F.lit(1))
    found = collections.defaultdict(list)
    for r in vector_search.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 1200, 100))
    hits = 0
    for q, got in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(x)), d))[:10].tolist()
        assert [r for r, _, _ in got] == list(range(1, 11)) and all(s == pytest.approx(d[v], abs=1e-12) for _, v, s in got)
        hits += len(set(best) & {v for _, v, _ in got})
        if q >= 900:
            assert [v for _, v, _ in got] == best
    assert hits >= 0.9 * 10 * len(found)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.5])], "vec_id bigint, vector array<double>")
    assert [tuple(r) for r in vector_search.nearest_neighbours(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0.5)]
    assert vector_search.nearest_neighbours(few.limit(0), F.lit(True)).count() == 0


def test_search_is_complete(spark):
    random = np.random.Generator(np.random.PCG64(5))
    x = np.concatenate([random.normal(size=(4000, 8)), random.normal(size=(5, 8)) + 1000])
    rows = [(i + 1, [float(v) for v in x[i]]) for i in range(len(x))] + [(4100, [float(v) for v in x[0]]), (4100, [float(v) for v in x[1]])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    found = vector_search.nearest_neighbours(vectors, F.col("vec_id").isin(4001, 4100)).toPandas()
    alone = found[found.query_id == 4001].sort_values("rank")
    assert alone["rank"].tolist() == list(range(1, 11)) and set(alone.vec_id[:4]) == {4002, 4003, 4004, 4005} and alone.vec_id.is_unique
    twice = found[found.query_id == 4100]
    assert sorted(twice["rank"].tolist()) == sorted([*range(1, 11)] * 2) and {1, 2} <= set(twice[twice["rank"] == 1].vec_id)
    nothing = spark.createDataFrame([(1, None), (None, [1.0])], "vec_id bigint, vector array<double>")
    assert vector_search.nearest_neighbours(nothing, F.lit(True)).count() == 0


@needs_data
def test_search_recall_on_the_embeddings(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = queries()["op10_vector_search"](spark, sf).toPandas()
    data = table.toPandas().dropna()
    x = np.array(data.embedding.tolist(), dtype=np.float64)
    ids = data.vec_id.to_numpy()
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = found[found.query_id == ids[q]]
        assert len(mine) == min(10, len(ids) - 1)
        hits += len(set(best) & set(mine.vec_id))
        total += len(best)
    assert hits >= 0.9 * total


# the pipeline


def test_workers_keep_one_operators_state(spark):
    """A worker that packed documents holds no encoder any more once it scores quality."""
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(40)], "doc_id bigint, text string").repartition(8)

    def kept(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([len(packing._ENCODERS)])], ["pid", "kept"])

    look = lambda: {r["pid"]: r["kept"] for r in spark.range(0, 64, 1, 32).mapInArrow(kept, "pid bigint, kept bigint").collect()}
    packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json")).collect()
    packers = {pid for pid, n in look().items() if n}
    assert packers
    for _ in range(4):
        quality_classifier.word_vectors(docs)
    assert not any(n for pid, n in look().items() if pid in packers)


@needs_data
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    source = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).select("*")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append({r["doc_id"] for r in docs.collect()})
    assert set(source) >= kept[0] >= kept[1] >= kept[2]
    assert all(not brute_base(source[d])[-1] for d in kept[1])
    brute = brute_components([(d, source[d]) for d in kept[1]])
    assert kept[2] == {d for d, (_, c) in brute.items() if d == c}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == kept[2]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == kept[2]


def test_pipeline_decides_by_row(spark):
    import corpus_pipeline

    clean = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]
    schema = "doc_id bigint, text string, lang string, row int"
    docs = spark.createDataFrame([(None, "too short", "en", 0), (None, clean[0], "en", 1), (7, clean[1], "en", 2), (7, "too short", "en", 3), (7, clean[2], "en", 4)], schema)
    ruled = corpus_pipeline.ruled(spark, docs, SF)
    assert ruled.columns == docs.columns
    assert {r["row"] for r in ruled.collect()} == {1, 2, 4}
    docs = spark.createDataFrame([(7, clean[0], "en", 0), (7, clean[1], "en", 1), (None, clean[2], "en", 2), (None, clean[2], "en", 3), (None, clean[0], "en", 4), (3, clean[1] + " end", "en", 5)], schema)
    found = corpus_pipeline.deduplicated(spark, docs, SF)
    assert found.columns == docs.columns
    rows = {r["row"] for r in found.collect()}
    assert rows - {2, 3} == {0, 5} and len(rows & {2, 3}) == 1


@needs_data
def test_every_query_returns_its_columns(spark):
    first = {"op1": ["doc_id", "held_out", "score", "predicted"], "op6": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "op10": ["query_id", "rank", "vec_id", "score"]}
    names = queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    for n, columns in first.items():
        name = next(x for x in names if x.startswith(f"{n}_"))
        assert names[name](spark, SF).columns[: len(columns)] == columns
