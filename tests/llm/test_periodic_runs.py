import hashlib
import random
import re
import zlib

from hypothesis import given, settings, strategies as st

from matchlake.llm import periodic_runs, queries
from matchlake.llm.common import WORD


def brute(words, least=24, times=3):
    """Every stretch that agrees with itself a period on, the shortest period of each."""
    found = {}
    for period in range(1, len(words) // times + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end > at and end + period - at >= max(least, times * period):
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted(((a, e - a, p) for (a, e), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rnd, size):
    words = [b"%d" % rnd.randrange(rnd.choice([1, 2, 3, 50, 1000])) for _ in range(size)]
    for _ in range(rnd.randint(0, 4) if size > 10 else 0):
        at, period, length = rnd.randrange(size), rnd.randint(1, size // 4), rnd.randint(1, size)
        for i in range(at, min(size, at + length)):
            words[i] = words[at + (i - at) % period]
    return words


def test_runs_of_random_texts_equal_brute_force(monkeypatch):
    rnd = random.Random(1)
    runs = 0
    for _ in range(120):
        # Small blocks take the way of long texts: only the first words of each block are sought.
        monkeypatch.setattr(periodic_runs, "CAP", rnd.choice([4, 16, 4096]))
        monkeypatch.setattr(periodic_runs, "CELLS", rnd.choice([64, 1 << 16]))
        texts = [random_text(rnd, rnd.choice([0, 1, 5, 24, 30, 100, 300, 700])) for _ in range(rnd.randint(1, 6))]
        expected = [brute(t) for t in texts]
        assert periodic_runs.runs_of(texts) == expected
        runs += sum(map(len, expected))
    assert runs > 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=90), max_size=4), st.integers(6, 30))
def test_runs_over_few_words_equal_brute_force(texts, least):
    assert periodic_runs.runs_of(texts, least) == [brute(t, least) for t in texts]


def test_long_texts():
    assert periodic_runs.runs_of([[b"w"] * 100_000, []]) == [[(0, 100_000, 1)], []]
    far = [b"%d" % (i % 9001) for i in range(40_000)]
    assert periodic_runs.runs_of([far]) == [[(0, 40_000, 9001)]]


def test_query_equals_brute_force_on_documents(spark):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    found = 0
    for doc in docs:
        words = [w.encode() for w in WORD.findall(doc["text"] or "")]
        n, h = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute(words)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == top
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs)).hexdigest()
        found += len(runs)
    assert found > 5


def test_odd_rows(spark, odd_docs, no_docs):
    got = periodic_runs.periodic_runs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["id"]: r for r in got}
    assert by_id[2]["n_words"] == 0 and by_id[2]["runs"] == [] and by_id[2]["collapsed"] == ""
    assert by_id[4]["collapsed"] == "" and by_id[1]["runs"] == []
    assert [tuple(r) for r in by_id[3]["runs"]] == [(0, 30_000, 1)]
    assert by_id[3]["collapsed"] == "word " + "endless" * 20_000
    assert re.match("Émile à la", by_id[8]["collapsed"])
    assert periodic_runs.periodic_runs(no_docs).collect() == []
