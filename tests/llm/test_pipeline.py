import random

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchlake.llm import packing, quality_rules, tokens
from matchlake.llm.common import WORD
from test_near_mix_pack import plain_components
from test_quality_and_lines import plain_kept, plain_line_dedup

STAGES = dict(corpus_pipeline.STAGES)


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def planted(spark):
    """(id, text): plain documents, exact and near copies, lines many share, and bad texts."""
    rnd = random.Random(11)
    sentence = lambda n: " ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(3, 8))) for _ in range(n))
    plain = ["\n".join(sentence(rnd.randint(12, 25)) for _ in range(rnd.randint(3, 9))) for _ in range(60)]
    shared = [sentence(14) for _ in range(3)]
    texts = plain + [f"{t}\n{rnd.choice(shared)}" for t in plain[:20]]  # copies but for a line more
    texts += [t.replace(words(t)[5], "changed", 1) for t in plain[20:40]]  # a word changed
    texts += plain[40:45] * 3  # exact copies
    texts += [sentence(40) + "\n" + rnd.choice(shared) for _ in range(15)]  # clean, with a shared line
    # One long line, so that near copies outlast the line stage.
    long = [sentence(120) for _ in range(6)]
    texts += long + [" ".join([*words(t)[:60], "one", "two", "three", *words(t)[61:]]) for t in long]
    texts += ["too short", "", None, "| & " * 30 + sentence(12), "1 2 3 4 5 " * 8 + sentence(10), sentence(5) + " " + "again and again so " * 20]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")).alias("source"))


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_each_stage_equals_brute_force_on_what_it_is_given(spark, planted):
    docs = frame(spark, planted).cache()
    good = STAGES["quality rules"](spark, docs, "").cache()
    expected = [(i, t) for i, t in planted if plain_kept(t)]
    assert pairs(good) == expected and len(expected) < len(planted) - 4

    lined = STAGES["line dedup"](spark, good, "").cache()
    cut = plain_line_dedup(expected)
    left = [
        (i, cut[i])
        for i, t in expected
        if cut[i] == t or (len(words(cut[i])) >= 10 and len(words(cut[i])) >= 0.2 * len(words(t)))
    ]
    assert pairs(lined) == left and len(left) < len(expected) - 40

    alone = STAGES["near duplicates"](spark, lined, "").cache()
    component = plain_components(left, 5, 80)
    single = [(i, t) for i, t in left if component[i][1] == i]
    assert pairs(alone) == single and len(single) <= len(left) - 6

    mixed = STAGES["mixing"](spark, alone, "").cache()
    taken = pairs(mixed)
    assert set(taken) <= set(single) and max(map(taken.count, set(taken))) <= 3

    packed = STAGES["packing"](spark, mixed, "")
    sizes = {}
    for r in packed.collect():
        sizes.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sizes.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 4096
    # Of every planted original with its copies one text is left, and no stump of a copy.
    texts = [set(zip(*(words(t)[k:] for k in range(5)))) for _, t in single]
    for k, a in enumerate(texts):
        for b in texts[:k]:
            assert len(a & b) < 0.8 * len(a | b)


def test_stages_keep_columns_and_pack_what_is_left(spark, some_docs, tmp_path):
    docs = some_docs
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        if name != "packing":
            assert docs.columns == some_docs.columns
        if name in ("quality rules", "line dedup", "near duplicates"):
            assert 0 < docs.count() <= before.count()
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").isEmpty()


def test_run_gives_what_its_stages_give(spark, some_docs):
    docs = some_docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in found.select("doc_id").collect()} <= kept
    assert quality_rules.keep_good(docs).count() <= docs.count()


def test_odd_and_empty_tables_go_through(spark, odd_docs, no_docs, tmp_path):
    for k, docs in enumerate((odd_docs, no_docs)):
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}-{at}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{at}")


def test_stages_send_few_rows_at_once_whoever_reads_the_documents(spark, odd_docs):
    def rows_of_batches(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    large = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.parquet.columnarReaderBatchSize": "4096"}
    before = {name: spark.conf.get(name) for name in large}
    try:
        for name, stage in corpus_pipeline.STAGES:
            for setting, value in large.items():
                spark.conf.set(setting, value)
            stage(spark, odd_docs.select("doc_id", "text", "source"), "")
            sent = spark.range(0, 2500, numPartitions=1).mapInArrow(rows_of_batches, "rows long").collect()
            assert [r["rows"] for r in sent] == [1000, 1000, 500], name
            assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "1000", name
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)


def test_idle_workers_remember_no_chunks_of_packed_texts(spark, some_docs, vocabulary):
    def remembered(batches):
        from matchlake.llm import tokens

        held = [(len(e.chunks) + len(e.chunks.old), 1) for e in tokens._encoders.values()]
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in map(sum, zip(*held, (0, 0)))], ["chunks", "encoders"])

    docs = some_docs.coalesce(1)
    path = vocabulary("word_bpe_49k.json")
    found = [packing.pieces(docs, path, 1, 4096, "doc_id", "text").collect() for _ in range(2)]
    assert sorted(found[0]) == sorted(found[1])
    now = spark.range(0, 1, numPartitions=1).mapInArrow(remembered, "chunks long, encoders long").first()
    assert now["chunks"] == 0

    encoder = tokens.Encoder(path)
    ids = encoder.encode("one two three")
    encoder.chunks.old = {" four": b""}
    encoder.forget()
    assert not encoder.chunks and not encoder.chunks.old and encoder.encode("one two three") == ids
