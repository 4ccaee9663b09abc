"""A corpus pipeline: toxicity, quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next one's ``docs``. All but the last return the columns of ``docs`` as they came, under whatever
names, and no others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import queries, rules, secrets, simhash, toxicity
from orderlens.llm.common import ship, stage, table
from orderlens.session import drop_stage


def _by_text(docs: DataFrame, change: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Whole rows through ``change``, built once a task; the columns stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = change()
        for batch in batches:
            if batch.num_rows:
                yield own(batch)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay. The model learns from this stage's own documents and the
    labels of its learning folds; a null or empty text has the model's bias and stays."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    weights, bias = model.weights, model.bias

    def change():
        own = toxicity.Scorer(weights, bias)
        return lambda batch: batch.filter(pa.array([own.score(t) < 0.5 for t in _texts(batch)]))

    return _by_text(docs, change)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition rules stay; null and empty texts go."""
    def kept(text):
        m = rules.measure(text)
        return not rules.base_failed(m) and rules.verdict(m)

    return _by_text(docs, lambda: lambda batch: batch.filter(pa.array([kept(t) for t in _texts(batch)])))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest doc_id stays (null ids last, then the
    first such row). Rows are told apart by position, so repeated ids do no harm."""
    row, fp = _free("row", docs), _free("fp", docs)
    marked = stage(_fingerprinted(docs, fp).withColumn(row, F.monotonically_increasing_id()), "pipeline-fingerprints")
    narrow = marked.select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"))
    parts = simhash.resolve_parts(narrow)
    # copies first fold to one row per fingerprint, so no component's rows meet in one task
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = narrow.groupBy("fp").agg(F.min(order).alias("first"))
    stay = first.join(parts, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return marked.join(stay, row, "left_semi").drop(row, fp)


def _free(name: str, docs: DataFrame) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _fingerprinted(docs: DataFrame, name: str) -> DataFrame:
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.array([simhash.signed(simhash.fingerprint(t)) for t in _texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, name])

    ship(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; spans of secrets are replaced by ``[SECRET]`` and ``n_chars``, where there
    is such a column, follows the new text. Texts without a span, null and empty ones are untouched."""
    def masked(batch):
        old = list(_texts(batch))
        new = [secrets.redact(t) for t in old]
        out = batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), pa.array(new, batch.schema.field("text").type))
        at = batch.schema.get_field_index("n_chars")
        if at >= 0:
            changed = pa.array([a != b for a, b in zip(old, new)])
            sizes = pa.array([None if t is None else len(t) for t in new], pa.int64()).cast(batch.schema.field(at).type)
            out = out.set_column(at, batch.schema.field(at), pc.if_else(changed, sizes, batch.column(at)))
        return out

    return _by_text(docs, lambda: masked)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length of every document that is left; a null text is its end mark."""
    return queries.pieces(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("secrets", mask_secrets), ("packing", pack)]

#: Learned scores, fingerprints and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, step) in enumerate(STAGES):
        done = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        if number:  # the stage before has been read for the last time
            drop_stage(docs)
        docs = done
    return docs
