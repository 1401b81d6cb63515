import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import bitplanes, mixing, near_dedup, packing
from matchlake.llm.common import Scratch, components
from matchlake.llm import tokens
from matchlake.llm.tokens import Encoder, Memory

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_components(rows, width, percent):
    sets = {}
    for doc, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        n = max(1, len(words) - width + 1)
        sets[doc] = {tuple(words[i : i + width]) for i in range(n)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, width, percent):
    random.seed(width)
    base = [f"w{i}" for i in range(160)]
    rows = []
    for doc in range(150):
        words = list(base) if doc % 3 else [f"v{random.randrange(40)}" for _ in range(random.randrange(1, 60))]
        for _ in range(random.randrange(9)):
            words[random.randrange(len(words))] = f"x{random.randrange(9)}"
        rows.append((doc, " ".join(words)))
    rows += [(1000 + d, t.upper()) for d, t in rows[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dedup.near_duplicates(df, width=width, percent=percent).collect()
    expected = plain_components(rows, width, percent)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_sketch_never_rules_out_what_sets_confirm():
    random.seed(7)
    known = near_dedup._WordHashes()
    for _ in range(200):
        words = [f"a{random.randrange(1000)}" for _ in range(random.randrange(20, 400))]
        other = list(words)
        for _ in range(random.randrange(8)):
            other[random.randrange(len(other))] = "z"
        x, y = (near_dedup.shingle_hashes(w, 3, known) for w in (words, other))
        bits = np.bitwise_count((near_dedup.odd_sketch(x) ^ near_dedup.odd_sketch(y)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("percent", [80, 85])
def test_sketch_keeps_pairs_of_unequal_size_at_the_threshold(spark, percent):
    random = np.random.default_rng(percent)
    odd = lambda s: near_dedup.odd_sketch(np.sort(s)).tolist()
    rows = []
    for size in (400, 513, 600, 700, 1000, 3000, 5000):
        for _ in range(80):
            whole = random.integers(0, 2**64, 2 * size, np.uint64)
            a = whole[:size]
            part = a[: -(-size * percent // 100)]
            k = -(-2 * size * percent // (100 + percent))
            equal = np.concatenate([a[:k], whole[size : 2 * size - k]])
            other = random.integers(0, 2**64, size, np.uint64)
            rows += [(kind, len(a), len(b), *odd(a), *odd(b)) for kind, b in (("near", part), ("near", equal), ("far", other))]
    names = [f"{side}{c}" for side in "ab" for c in near_dedup._ODD]
    flat = spark.createDataFrame(rows, ["kind", "an", "bn", *names])
    sides = [F.struct(*[F.col(f"{x}{c}").alias(c) for c in ("n", *near_dedup._ODD)]).alias(x) for x in "ab"]
    pairs = flat.select("kind", *sides)
    found = pairs.groupBy("kind").agg(F.sum(near_dedup._possible("a", "b", percent).cast("int"))).collect()
    assert dict(map(tuple, found)) == {"near": 7 * 80 * 2, "far": 0}


def test_rounds_of_hubs_end_when_they_find_nothing(spark, monkeypatch):
    # Many share keys by a long passage, but few are alike enough for a link.
    passage = [f"p{i}" for i in range(60)]
    rows = [(d, " ".join(passage + [f"{d}x{i}" for i in range(14)])) for d in range(120)]
    rows += [(500 + d, t + " more") for d, t in rows[:3]]
    rounds, whole = [], near_dedup._round
    monkeypatch.setattr(near_dedup, "_round", lambda *given: rounds.append(1) or whole(*given))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_dedup.near_duplicates(df, width=3, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_components(rows, 3, 85)
    assert len(rounds) == 2


def test_components_of_stars_take_no_step(spark, monkeypatch):
    kept, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, name: kept.append(name) or keep(self, df, name))
    scratch = Scratch(spark, "stars")
    closed = lambda rows, name: dict(map(tuple, components(spark.createDataFrame(rows, "a long, b long"), scratch, name).collect()))
    assert closed([(3, 1), (1, 2), (2, 1), (9, 7), (5, 5)], "star") == {3: 1, 2: 1, 9: 7}
    assert kept == ["star-0"]
    chain = [(i, i + 1) for i in range(1, 30)] + [(100, 40), (100, 41)]
    assert closed(chain, "chain") == {i: 1 for i in range(2, 31)} | {41: 40, 100: 40}
    assert closed([], "none") == {}


def test_near_copies_of_odd_documents(odd_docs, no_docs):
    found = near_dedup.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    of = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found}
    assert of[1] == (0, 1, True) and of[2] == (0, 2, True) and of[4] == (0, 4, True)
    assert of[5][1] == of[6][1] == 5 and of[None][1:] == (None, True)
    left = near_dedup.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.filter("__text <> 'own __text' or key <> 'own key'").isEmpty()
    assert Counter(r["doc_id"] for r in left.collect())[5] == 1
    assert near_dedup.near_duplicates(no_docs).count() == near_dedup.drop_near_duplicates(no_docs).count() == 0


def test_rows_of_one_id_that_are_no_near_copies_stay(spark):
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (1, text("b") + " more"), (2, text("a")), (3, text("c")), (3, None)]
    rows += [(None, text("a")), (None, text("d"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_dedup.drop_near_duplicates(df).collect()
    start = lambda r: (r["doc_id"], (r["text"] or "-")[0])
    expected = [(1, "a"), (1, "b"), (3, "c"), (3, "-"), (None, "a"), (None, "d")]
    assert Counter(map(start, left)) == Counter(expected)
    found = near_dedup.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in found) == {(1, 1): 4, (2, 1): 1, (3, 3): 2, (None, None): 2}


def test_mix_meets_targets(some_docs):
    found = mixing.mix(some_docs).collect()
    source = {r["doc_id"]: r["source"] for r in some_docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in found:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
    names = sorted(sizes)
    expected = mixing.targets([sizes[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    for s, t in zip(names, expected):
        assert math.isclose(target[s], t)
        assert abs(taken[s] - t) <= 0.02 * t + 50
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(some_docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([10, 90], [9, 1]) == [30, 70]
    assert mixing.targets([0, 10], [1, 2]) == [0, 10]
    assert mixing.targets([], []) == []


def test_mix_of_odd_documents(odd_docs, no_docs):
    found = mixing.mix(odd_docs).collect()
    assert len(found) == odd_docs.count()
    rows = mixing.mixed(odd_docs)
    assert rows.columns == odd_docs.columns
    assert rows.filter("__text <> 'own __text' or key <> 'own key'").isEmpty()
    words = sum(len(WORD.findall(r["text"] or "")) for r in rows.collect())
    assert words == sum(r["taken"] for r in found)
    assert mixing.mix(no_docs).count() == mixing.mixed(no_docs).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_tokenizer(vocabulary, name, some_docs, odd_docs):
    mine, theirs = Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    texts = [r["text"] or "" for r in [*some_docs.take(100), *odd_docs.collect()]]
    texts += ["it's  I'LL 've\n\n x\ty", "ΑΣ é İ", "a<|endoftext|>b", "x \n y", "日本語 テキスト１2", "　a b"]
    for text in texts:
        ids = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert ids == theirs.encode(text, add_special_tokens=False).ids


def check_plan(counts, capacity=4096):
    places, ranks = defaultdict(list), Counter()
    for slot in packing.plan_packing(dict(counts), capacity):
        assert slot.rank == ranks[slot.length] and slot.count % slot.each == 0
        ranks[slot.length] += slot.count
        for i in range(slot.count):
            which, within = divmod(i, slot.each)
            places[slot.first + which].append((slot.offset + within * slot.length, slot.length))
    assert ranks == counts
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_plans_are_valid_and_tight():
    random.seed(10)
    assert check_plan(Counter()) == 0
    assert check_plan(Counter({4096: 3, 4095: 2, 1: 1})) == 5
    for draw in (lambda: random.randint(1, 4096), lambda: min(4096, int(random.lognormvariate(6, 1)) + 1)):
        counts = Counter(draw() for _ in range(20_000))
        bound = math.ceil(sum(n * c for n, c in counts.items()) / 4096)
        assert check_plan(counts) <= 1.05 * bound


def test_pieces_hold_all_tokens(odd_docs, no_docs, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    found = packing.pack(odd_docs, path).collect()
    encode = Tokenizer.from_file(path).encode
    expected = Counter()
    for r in odd_docs.collect():
        ids = np.array(encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for i, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[r["doc_id"], i, at, len(part), zlib.crc32(part.tobytes())] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    assert got == expected
    total = Counter()
    for r in found:
        total[r["sequence_id"]] += r["length"]
    assert max(total.values()) <= 4096
    assert packing.pack(no_docs, path).count() == 0


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    random.seed(1)
    for n in (1, 7, 8, 1000):
        ids = np.array([random.randrange(2**32) for _ in range(n)], "<u4")
        assert (bitplanes.join_planes(bitplanes.split_planes(ids, unit), n) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_token_files_round_trip(spark, odd_docs, no_docs, vocabulary, unit):
    path = vocabulary("byte_bpe_50k.json")
    root = Scratch(spark, "test").root
    bitplanes.write_tokens(odd_docs, f"{root}/a", path, unit=unit)
    found = sorted(bitplanes.digest(spark, f"{root}/a").collect(), key=lambda r: r["start"])
    encode, place = Tokenizer.from_file(path).encode, 0
    rows = sorted(odd_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    for r, f in zip(rows, found, strict=True):
        ids = np.array(encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert tuple(f) == (r["doc_id"], place, len(ids), zlib.crc32(ids.tobytes()))
        place += len(ids)
    bitplanes.write_tokens(no_docs, f"{root}/b", path)
    assert bitplanes.digest(spark, f"{root}/b").count() == 0


def test_encoder_holds_each_chunk_once_and_no_more_than_two_generations(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 20)
    encoder = Encoder(vocabulary("byte_bpe_50k.json"))
    for i in range(100):
        encoder.encode(f"some words and b{'xyz'[i % 3] * (1 + i)}")
    held = [m for m in vars(encoder).values() if isinstance(m, Memory)]
    assert sum(len(m) + len(m.old) for m in held) <= 2 * 20


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_block_merges_a_repeated_chunk_once(vocabulary, monkeypatch, name):
    monkeypatch.setattr(tokens, "MEMORY", 2)
    encoder, whole = Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    merged, merge = [], encoder.merge
    encoder.merge = lambda letters: merged.append(letters) or merge(letters)
    texts = ["one two three four five\nsix", "", "tab\there", " two  three\n\nfour ", "five"] * 20
    ids = list(encoder.encode_all(texts))
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [
        whole.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert len(merged) <= 20


def test_blocks_are_cut_by_size(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 10)
    encoder = Encoder(vocabulary("byte_bpe_50k.json"))
    texts = ["a b c d e f g h", "", "i j", "k l", "m n o p q r s t u v"]
    assert list(encoder.encode_all(texts)) == [encoder.encode(t) for t in texts]
    assert list(encoder.encode_all([])) == []


def test_odd_characters_are_told_quickly_and_alike():
    for number in [*range(0xD800), *range(0xE000, 0x110000)]:
        assert tokens._is_odd(chr(number)) == bool(tokens._ODD.search(chr(number)))
    assert tokens._is_odd("a <|b") and not tokens._is_odd("a\nb < | c")


def test_word_hashes_stay_small():
    known = near_dedup._WordHashes()
    for i in range(399_999):
        known[f"word{i}"]
    held = sys.getsizeof(known) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in known.items())
    assert held <= 40_000_000
    fresh = near_dedup._WordHashes()
    assert all(fresh[w] == known[w] for w in ("word0", "word1", "word399998"))
