"""Queries of the operators over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from matchlake.llm import (
    bitplanes,
    chat_format,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    quality_rules,
    secret_scan,
    term_pipeline,
)
from matchlake.llm.common import SPACES, Scratch, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: below their source, in directories of 64, those of 512
    in one above; every eighth is the licence file of its directory."""
    docs = table(spark, sf_dir, "documents")
    kind = F.when(F.col("doc_id") % 8 == 0, "LICENSE").otherwise("file")
    name = F.concat(kind, F.lit("."), F.col("doc_id").cast("string"))
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("none")), F.expr("doc_id div 512"), F.expr("doc_id div 64"), name
    )
    files = docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text")
    return license_scan.license_scan(files).withColumnRenamed("id", "doc_id")


def op3_token_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'bitplanes').root}/tokens"
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    bitplanes.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary, end=2)
    return bitplanes.digest(spark, path)


#: A conversation of control strings, which every template has to survive.
HOSTILE = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(
        [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], stored.schema
    )
    log = chat_format.log_of_turns(stored.union(hostile))
    return chat_format.digest(chat_format.formatted(log))


def op5_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.search(rows, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary, end=1)


def op11_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = term_pipeline.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *[number(i).alias(f"n_{rule.kind}") for i, rule in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a checksum of the id, the words from
    some place on repeat the first few of them."""
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", words.alias("w"), F.size(words).alias("n"), checksum.alias("h"))
    docs = docs.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("int(if(n > 0, g % n, 0))"))
    docs = docs.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    planted = F.expr(
        "array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)), ' ')"
    )
    return docs.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_runs(table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs)
    # Runs come by start and period, so the first of those with the greatest exponent stays.
    top = F.expr(
        "aggregate(runs, cast(null as struct<start:long,length:long,period:long>), "
        "(t, r) -> if(t is null or r.length * t.period > t.length * r.period, r, t))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", top).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_license_scan,
        op3_token_bitplanes,
        op4_chat_format,
        op5_multiprobe_neighbours,
        op6_language_id,
        op7_quality_cascade,
        op8_entropy_mixing,
        op9_near_dedup,
        op10_best_fit_packing,
        op11_term_pipeline,
        op12_secret_scan,
        op13_periodic_runs,
    )
}

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

def _secret_spans_sql() -> str:
    """Each rule on every text by itself: what stands between matches gives their places."""
    each = []
    for i, rule in enumerate(secret_scan.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        each.append(
            f"""select doc_id, {i} as number, '{rule.kind}' as kind, length(m) as size, length(g) as held,
                cast(sum(length(p) + length(m)) over (partition by doc_id order by k) as bigint) as past
            from (select doc_id, unnest(regexp_extract_all(text, {pattern})) as m,
                unnest(regexp_extract_all(text, {pattern}, {rule.group})) as g,
                unnest(list_slice(regexp_split_to_array(text, {pattern}), 1, -2)) as p,
                generate_subscripts(regexp_extract_all(text, {pattern}), 1) as k
                from documents where regexp_matches(text, {pattern}))
            qualify length(g) >= {rule.least}"""
        )
    return " union all ".join(each)


SQL: dict[str, str] = {
    "op4_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all values
                (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ),
        loss as (select *, case when role = 'assistant' then text else '' end as learnt from turns)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            cast(sum(length(learnt)) as bigint) as loss_chars,
            sha256(string_agg(learnt, '' order by turn, role, text)) as loss_sha256,
            cast(sum(length(role) + length(text) + length('<||>' || chr(10) || '<|end|>' || chr(10))
                + 4 * (length(text) - length(replace(text, '&', '')))
                + 3 * (length(text) - length(replace(text, '<', '')))
                + 4 * (length(text) - length(replace(text, '[', '')))) as bigint) as formatted_chars
        from loss group by conv_id
    """,
    "op11_term_pipeline": rf"""
        with words as (
            select doc_id, unnest({_TERMS}) as term from documents
        ),
        sizes as (select doc_id, count(*) as n from words group by doc_id),
        totals as (select count(*) as docs, cast(sum(n) as bigint) as length from sizes),
        frequencies as (select doc_id, term, count(*) as tf from words group by doc_id, term),
        weights as (
            select term, cast(floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
            from frequencies, totals group by term
        ),
        asked as (select distinct item_id, term from (select item_id, unnest({_TERMS}) as term from benchmark)),
        scores as (
            select item_id, doc_id,
                cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) as bigint) as score
            from asked join frequencies using (term) join weights using (term) join sizes using (doc_id), totals
            group by item_id, doc_id
        )
        select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank,
            doc_id, score
        from scores where score > 0
        qualify rank <= 10
    """,
    "op12_secret_scan": f"""
        with spans as (
            select doc_id, number, past - size as start, kind || ':' || (past - size) || ':' || past as span
            from ({_secret_spans_sql()})
        ),
        listed as (
            select doc_id, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access,
                count(*) filter (number = 2) as n_hex,
                string_agg(span, ',' order by start, number) filter (number < 3) as base,
                string_agg(span, ',' order by start, number) as spans
            from spans group by doc_id
        )
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
            coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from documents left join listed using (doc_id)
    """,
}
