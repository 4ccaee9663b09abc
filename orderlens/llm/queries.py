"""The registered queries: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import align, bpe, chat, idfile, packing, periods, quality, rules, secrets, sharding, simhash, topk, toxicity
from orderlens.llm.common import table
from orderlens.session import keep_stage, staging_path

#: The end mark of byte_bpe documents in the packing contract.
END_ID = 1
#: The end mark of documents in the id files.
FILE_END_ID = 0
#: A conversation whose texts are the template's own control strings (fixed by the contract).
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_docs(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    done = bpe.decode(bpe.encode(_docs(spark, sf_dir), path), path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digest(chat.format_chat(turns))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(_docs(spark, sf_dir))


def pieces(docs: DataFrame) -> DataFrame:
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.assess(_docs(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda *kinds: F.filter("found", lambda s: s.kind.isin(*kinds))
    return secrets.scan(_docs(spark, sf_dir)).select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(_listed(of(*secrets.BASE)), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_docs(spark, sf_dir))


def op11_idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = staging_path(spark, "id-files")
    keep_stage(spark, out)
    idfile.write_documents(_docs(spark, sf_dir), out, public_tokenizers.path("byte_bpe_50k.json"), FILE_END_ID)
    return idfile.read_ids(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The contract's change of the text: where the checksum of the id ends in 0, the words from ``a``
    on repeat with period ``p``. A null id changes nothing."""
    sum_ = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    asked = docs.select("doc_id", "text", sum_.alias("h"), F.when(sum_ % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    sized = asked.withColumns({"n": n, "g": g}).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = sized.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    looped = F.transform("w", lambda w, i: F.get("w", place(i)))
    return period.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))


def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.find_runs(with_planted_periods(_docs(spark, sf_dir)))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # runs come by start and period, so of equal exponents the first stays
    best = F.reduce("runs", none, lambda x, r: F.when(x.isNull() | (r.length * x.period > x.length * r.period), r).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = align.link_report(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return report.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_bpe, op3_chat, op4_topk, op5_toxicity, op6_packing, op7_rules, op8_secrets,
                            op9_quality, op10_sharding, op11_idfile, op12_periods, op13_align, pipeline)
}

_OP3 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, lag(role) OVER o AS before, row_number() OVER d AS back,
        length(replace(text, '\', '\\')) + len(regexp_extract_all(text,
            '<</SYS>>|<\|role\|>|<\|text\|>|<<SYS>>|<\|end\|>|\[/INST\]|\[INST\]|</s>|<s>')) AS escaped,
        length(replace(role, '\', '\\')) + len(regexp_extract_all(role,
            '<</SYS>>|<\|role\|>|<\|text\|>|<<SYS>>|<\|end\|>|\[/INST\]|\[INST\]|</s>|<s>')) AS named
    FROM turns
    WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text),
        d AS (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(escaped + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 23 + named END)::BIGINT AS formatted_chars,
    bool_and(CASE role WHEN 'system' THEN before IS NULL WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
        WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
        AND bool_or(back = 1 AND role = 'assistant') AS valid
FROM sized GROUP BY conv_id
"""

_OP4 = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, coalesce(score, 0) AS score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY coalesce(score, 0) DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""

ORACLES: dict[str, str] = {"op3_chat": _OP3, "op4_topk": _OP4}
