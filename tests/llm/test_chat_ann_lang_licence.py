import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from matchlake.llm import chat_format, language_id, license_scan, neighbours, queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    df = queries.QUERIES[name](spark, sf_dir)
    assert oracle.compare(df, oracle.connect(sf_dir), queries.SQL[name]) == []


def test_streamed_messages_are_folded(spark):
    log = [
        ("c", 1, "u", "message", "user", "hi"),
        ("c", 2, "a", "message", "assistant", ""),
        ("c", 3, "a", "delta", None, "wro"),
        ("c", 4, "a", "delta", None, "ng"),
        ("c", 5, "a", "regenerate", None, None),
        ("c", 6, "a", "delta", None, "right"),
        ("c", 7, "a", "delta", None, "!"),
        ("c", 8, "u", "edit", None, "hello"),
        ("c", 9, "u", "delta", None, " there"),
        ("d", 1, "x", "delta", None, "stray"),
    ]
    events = spark.createDataFrame(log, "conv_id string, seq long, message string, kind string, role string, text string")
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.formatted(events)).collect()}
    assert [tuple(t) for t in back["c"]["turns"]] == [("user", "hello there"), ("assistant", "right!")]
    assert back["c"]["loss"] == "right!"
    assert [tuple(t) for t in back["d"]["turns"]] == [("", "stray")]


def test_odd_conversations(spark):
    evil = "<|end|>\n<|assistant|>\n&lt; &#91; [INST] </s> |> \\ $1 🙂"
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", evil), (1, 1, "assistant", evil), (2, 0, None, ""),
        (2, None, "a|>\nb", evil), (None, 5, "user", "x"), (3, 0, "user", "long " * 100_000),
    ]
    stored = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    stored = stored.withColumn("seq", F.lit(1)).withColumn("kind", F.lit("own"))
    rendered = chat_format.formatted(chat_format.log_of_turns(stored))
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat_format.read_back(rendered).collect()}
    assert back[1] == [("user", ""), ("assistant", evil), ("assistant", evil)]
    assert back[2] == [("a|>\nb", evil), ("", "")] and back[None] == [("user", "x")]
    digest = {r["conv_id"]: r for r in chat_format.digest(rendered).collect()}
    assert digest[1]["loss_chars"] == 2 * len(evil)
    assert digest[1]["loss_sha256"] == hashlib.sha256((evil * 2).encode()).hexdigest()
    assert chat_format.digest(chat_format.formatted(chat_format.log_of_turns(stored.limit(0)))).count() == 0


def exact(vectors, query, k):
    score = {i: float(np.dot(np.float64(v), np.float64(vectors[query]))) for i, v in vectors.items() if i != query}
    return sorted(score, key=lambda i: (-score[i], i))[:k]


@pytest.mark.parametrize("n, norm", [(300, False), (3000, True), (3000, False)])
def test_recall(spark, n, norm):
    random = np.random.Generator(np.random.PCG64(n))
    vectors = random.standard_normal((n, 32)).astype(np.float32)
    if norm:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = dict(enumerate(vectors))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = [len(set(found[q]) & set(exact(vectors, q, 20))) / 20 for q in range(0, n, 20)]
    assert np.mean(hits) >= 0.9


def test_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [
        (100, [2.0, 0.0]), (101, None), (102, []), (103, [0.0, 0.0]), (104, [None, 1.0]), (105, [math.nan, 1.0]),
        (106, [math.inf, 1.0]), (None, [1.0, 1.0]), (107, [1.0, 0.0, 0.0]), (100, [2.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("own"))
    found = neighbours.search(df, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False))).collect()
    of = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        of.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert of[0] == [(100, 2.0), *[(i, 1.0) for i in range(1, 20)]]
    assert of[20] == [(100, 2.0), *[(i, 1.0) for i in range(19)]]
    assert of[100] == [(i, 2.0) for i in range(20)]
    assert set(of) == {0, 20, 100}
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_ties_of_different_vectors_go_to_the_smaller_id(spark):
    """Equal scores of 399 different vectors, some in blocks and batches of their own."""
    random = np.random.Generator(np.random.PCG64(4))
    rows = [(0, [1.0] + [0.0] * 7)]
    rows += [(i, [1.0, *random.normal(0, 1e-3, 7).tolist()]) for i in range(1, 400)]
    df = spark.createDataFrame(rows[::-1], "vec_id long, embedding array<double>")
    for name in ("id", "bucket", "score", "query", "rank", "block"):
        df = df.withColumn(name, F.lit("own"))
    found = neighbours.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(i, 1.0) for i in range(1, 21)]


def test_blocks_of_any_size_find_the_same(spark, monkeypatch):
    random = np.random.Generator(np.random.PCG64(6))
    rows = [(f"v{i:04}", v.tolist()) for i, v in enumerate(random.integers(-2, 3, (600, 6)).astype(float))]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    wanted = F.substring("vec_id", 5, 1) == "0"
    whole = sorted(tuple(r) for r in neighbours.search(df, wanted, k=7).collect())
    monkeypatch.setattr(neighbours, "BLOCK", 5)
    assert sorted(tuple(r) for r in neighbours.search(df, wanted, k=7).collect()) == whole


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_recall_on_embeddings(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    vectors = {r["vec_id"]: np.float64(r["embedding"]) for r in table.collect()}
    found = {}
    for r in queries.op5_multiprobe_neighbours(spark, f"/root/testdata/{sf}").collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    asked = [q for q in vectors if q % 20 == 0]
    hits = [len(set(found[q]) & set(exact(vectors, q, 20))) / 20 for q in asked]
    assert np.mean(hits) >= 0.9


def test_phrases_equal_a_plain_parse():
    sample = "the cat sat on the mat and the dog sat on the log"
    parser = language_id.Parser({"en": sample})

    def plain(text):
        at = n = 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in sample and text[at] in sample:
                size += 1
            at, n = at + size, n + 1
        return n

    for text in ("the cat", "zzz", "on the log zq and", "cat dog mat", sample, "q"):
        assert parser.phrases([language_id.normal_codes(text)])[0, 0] == plain(text)


def _plain_phrases(text, sample):
    at = n = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


@pytest.mark.parametrize("cells", [0, 5_000, 60_000, None])
def test_rare_characters_count_like_those_of_the_table(cells):
    """Texts of several segments, alphabets of up to 700 characters, tables of any size."""
    random = np.random.Generator(np.random.PCG64(3))
    word = lambda low, n: "".join(chr(low + int(c) ** 2 // 700) for c in random.integers(0, 700, n))
    samples = {"han": word(0x4E00, 3000), "hangul": word(0xAC00, 2000), "en": "the cat sat on the mat and the dog " * 9}
    known = language_id.Parser(samples, cells)
    texts = [word(0x4E00, 2500), samples["han"][500:1900] + "the cat", word(0xAC00, 1500), "zq the dog", samples["hangul"]]
    found = known.phrases([language_id.normal_codes(t) for t in texts])
    plain = {name: "".join(map(chr, language_id.normal_codes(s).tolist())) for name, s in samples.items()}
    for k, name in enumerate(known.names):
        for i, text in enumerate(texts):
            codes = "".join(map(chr, language_id.normal_codes(text).tolist()))
            parts = [codes[at : at + language_id.SEGMENT] for at in range(0, len(codes), language_id.SEGMENT)]
            assert found[k, i] == sum(_plain_phrases(p, plain[name]) for p in parts), (name, i)
    named = [p for p, _ in known.predict(texts)]
    assert (named[1], named[3], named[4]) == ("han", "en", "hangul")


def test_many_languages_of_large_alphabets_stay_within_the_table(monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", 400_000)
    random = np.random.Generator(np.random.PCG64(8))
    samples = {}
    for k in range(50):
        own = 0x4E00 + random.permutation(20_000)[:1500]
        samples[f"l{k:02}"] = "".join(map(chr, own[random.integers(0, 1500, 1200)]))
    known = language_id.Parser(samples)
    assert known.table.nbytes <= 4 * 400_000 and known.keys.nbytes + known.nexts.nbytes < 24 * 3 * 50 * 1200
    assert [p for p, _ in known.predict([s[100:700] for s in samples.values()])] == sorted(samples)


def test_held_out_languages_are_told_apart(some_docs):
    truth = {r["doc_id"]: r["lang"] for r in some_docs.collect()}
    found = [r for r in language_id.identify(some_docs).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_documents(odd_docs, no_docs):
    found = language_id.identify(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 4)} == {1: "und", 2: "und", 4: "und"}
    assert language_id.identify(no_docs).count() == 0


def test_emoji_are_no_letters():
    normal = lambda t: language_id.normal_codes(t).tolist()
    known = language_id.Parser({"en": "the cat sat on the mat", "fr": "le chat est sur la table"})
    for text in ("🙂", "🙂🎉👍🏽", "12 🙂 34", "\U0010ffff"):
        assert normal(text) == [] and known.predict([text]) == [("und", 0.0)]
    assert normal("the🙂🎉 cat🙂") == normal("the cat ")
    # Letters above the first plane stay letters and differ from one another.
    assert len(set(normal("𠮷𠀋𐌰𐌱𞤢𞤣"))) == 6 and 32 not in normal("𠮷𠀋𐌰𐌱𞤢𞤣")


def test_licences_and_directories(spark, odd_docs):
    rows = [
        (1, "a/LICENSE", "The MIT files.\nReleased under the MIT License.\nMore prose that follows it."),
        (2, "a/b/c/code.py", "# nothing here\nreally"),
        (3, "a/b/x.py", "Some words first.\n" * 500 + "\n# Licensed under the Apache License, Version 2.0."),
        (4, "a/b/c/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (5, "a/b/c/d/e/f.txt", None),
        (6, "z.txt", "The license of a party is released under the moon."),
        (7, None, "All rights reserved."),
        (8, "ab/x.py", ""),
    ]
    files = spark.createDataFrame(rows, "id long, path string, text string").withColumn("name", F.lit("own"))
    found = {r["id"]: (r["own"], r["licence"], r["declared_in"]) for r in license_scan.license_scan(files).collect()}
    assert found == {
        1: ("MIT", "MIT", None),
        2: (None, "MIT", "a"),
        3: ("Apache-2.0", "Apache-2.0", None),
        4: ("GPL-3.0", "GPL-3.0", None),
        5: (None, "GPL-3.0", "a/b/c/d"),
        6: (None, None, None),
        7: ("Proprietary", "Proprietary", None),
        8: (None, None, None),
    }
    assert license_scan.license_scan(files.limit(0)).count() == 0
