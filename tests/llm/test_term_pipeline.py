import math
import random
import re
from collections import Counter

import pytest

from matchlake.llm import term_pipeline

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """[(item, rank, doc, score)] of (id, text) rows, every item against every document."""
    found = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in found if c]
    documents, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, counts, n in held:
            m = 10 + 90 * n * documents // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in terms & counts.keys()
            )
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, i + 1, doc, -s) for i, (s, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows(found):
    return sorted(tuple(r) for r in found.collect())


def random_rows(rnd, number, vocabulary):
    def text():
        n = rnd.choice([0, 1, 3, 10, 40])
        return rnd.choice([" ", ", ", "\n"]).join(rnd.choices(vocabulary, range(len(vocabulary), 0, -1), k=n))

    out = [(i, text()) for i in range(number)]
    return out + out[:7] + [(None, text()), (None, None), (number, None), (3, text()), (number + 1, "common " * 4000)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_however_cut(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    vocabulary = ["common", "The", "ÉTÉ", "x1", *[f"w{i}" for i in range(60)]]
    docs, items = random_rows(rnd, 300, vocabulary), random_rows(rnd, 25, [*vocabulary, "unheard"])
    monkeypatch.setattr(term_pipeline, "BLOCK_DOCS", [17, 100, 8192][seed])
    monkeypatch.setattr(term_pipeline, "BLOCK_POSTINGS", [10**6, 300, 50][seed])
    monkeypatch.setattr(term_pipeline, "GROUP", [4, 500, 11][seed])
    monkeypatch.setattr(term_pipeline, "SLOTS", [10**6, 40, 150][seed])
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = rows(term_pipeline.search(frame, asked, k=[3, 10, 1000][seed]))
    assert got == brute(docs, items, [3, 10, 1000][seed])
    assert len(got) > 50


def test_ties_go_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(99, "else")], "doc_id long, text string")
    got = rows(term_pipeline.search(docs, docs.limit(1).selectExpr("'q' item_id", "text")))
    assert [r[2] for r in got] == list(range(1, 11)) and len({r[3] for r in got}) == 1


def test_ids_of_text_and_clashing_columns(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("concat('d', doc_id) as doc_id", "* except (doc_id)")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = docs.selectExpr("doc_id as item_id", "* except (doc_id)")
    assert rows(term_pipeline.search(docs, items)) == brute(plain, plain, 10)
    assert term_pipeline.search(no_docs, items).collect() == []
    assert term_pipeline.search(docs, no_docs.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_an_unseen_document_is_left_out_only_when_it_cannot_win(spark):
    """Rare terms settle nothing here: the document with all the frequent ones wins."""
    frequent = " ".join(f"f{i}" for i in range(30))
    docs = [(i, "rare f0") for i in range(12)] + [(50, frequent)] + [(100 + i, f"f{i % 30} pad") for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = [("q", "rare " + frequent)]
    asked = spark.createDataFrame(items, "item_id string, text string")
    got = rows(term_pipeline.search(frame, asked))
    assert got == brute(docs, items, 10) and got[0][2] == 50
