"""Incremental extraction from a landing folder with Structured Streaming.

Each new export file dropped into the landing folder is read once (file source, progress kept
in the checkpoint), classified strictly (S1), numbered per file, id-normalised (P4) and written
under its micro-batch; bad lines go to a second sink. A micro-batch owns its folders and overwrites
them, so a replayed one leaves its output once. ``trigger(availableNow=True)`` processes what is there
and stops, so the same code serves batch back-fills.

With a :class:`LoadGate` the files belong to loads, and S2 decides when one is released. Records wait
in ``held`` until their load is complete: the manifest lists it with a location, no line is bad, and as
many records are there as it says (a load without a number waits for ``closed``). Then all of them go
out in one step. Bad, too long or unlisted loads stay, and are reported. What is known of each load is
one row of a small table, which every step reads from the step before and writes anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import normalize_order_ids
from ..session import drop_stage, file_system, written_stage
from ..sources.gate import load_gate
from ..sources.jsonl import ParsedLines, numbered, schema_of_strings, stage_lines


def load_of_file(path: Column) -> Column:
    """The load of a file by its name: ``orders.part-3.jsonl`` and ``orders.jsonl`` belong to ``orders``."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(F.regexp_replace(name, r"(?i)\.jsonl?$", ""), r"(?i)\.part-?\d+$", "")


@dataclass
class LoadGate:
    """``manifest`` reads the manifest as it is now: ``load_id``, ``expected_count``, ``location`` and, if
    wanted, ``closed`` (no more files will come). ``state`` is a shared folder of this stream's own."""

    manifest: Callable[[SparkSession], DataFrame]
    state: str
    load_of: Callable[[Column], Column] = field(default=load_of_file)


#: What is known of a load. ``released``: the step that let it out; ``late_lines``: lines that came after.
LOADS = ("load_id string, line_count long, parsed_count long, bad_count long, first_bad_line long, "
         "first_batch long, released string, late_lines long")


def _step(batch_id: int, part: int = 0) -> str:
    return f"b{batch_id:012d}-{part:04d}"


def _steps(spark: SparkSession, folder: str) -> list[str]:
    """Finished steps below ``folder``, in order."""
    fs, base = file_system(spark, folder)
    done = []
    for entry in fs.listStatus(base) if fs.exists(base) else []:
        name = entry.getPath().getName()
        if name.startswith("step=") and fs.exists(file_system(spark, f"{folder}/{name}/_SUCCESS")[1]):
            done.append(name.removeprefix("step="))
    return sorted(done)


def _known_loads(spark: SparkSession, gate: LoadGate, before: str | None = None) -> DataFrame:
    """The loads as the last finished step (ahead of ``before``) left them."""
    folder = f"{gate.state.rstrip('/')}/loads"
    steps = [s for s in _steps(spark, folder) if before is None or s < before]
    return spark.read.schema(LOADS).parquet(f"{folder}/step={steps[-1]}") if steps else spark.createDataFrame([], LOADS)


def _verdict(loads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Loads that are not out yet, with their gate row and ``state``: open, waiting or failed."""
    closed = F.coalesce(F.col("closed"), F.lit(False)) if "closed" in manifest.columns else F.lit(False)
    asked = manifest.select("load_id", "expected_count", "location", closed.alias("_closed"))
    waiting = loads.filter("released IS NULL")
    gated = load_gate(waiting.select("load_id", "line_count", "parsed_count", "bad_count", "first_bad_line"), asked)
    j = gated.join(asked.select("load_id", F.lit(True).alias("_listed"), "_closed"), "load_id", "left") \
        .join(loads.select("load_id", "first_batch", "first_bad_line", "released", "late_lines"), "load_id", "left")
    over = F.col("expected_count").isNotNull() & (F.col("parsed_count") > F.col("expected_count"))
    complete = F.col("ok") & F.col("data_available") & (F.col("expected_count").isNotNull() | F.col("_closed"))
    state = (F.when(F.col("released").isNotNull(), F.lit("released")).when((F.col("bad_count") > 0) | over, F.lit("failed"))
             .when(F.col("_listed") & complete, F.lit("open")).otherwise(F.lit("waiting")))
    return j.withColumn("state", state).drop("_listed", "_closed")


def landing_status(spark: SparkSession, gate: LoadGate) -> DataFrame:
    """Every load of the manifest or of the landing folder: ``load_id``, ``state`` (released, failed,
    waiting), counts, the gate's ``error``, and ``late_lines`` that came after its release."""
    loads = _known_loads(spark, gate)
    out = loads.filter("released IS NOT NULL").select("load_id", F.lit("released").alias("state"), "line_count", "parsed_count", "bad_count",
                                                      F.lit(None).cast("string").alias("error"), "late_lines")
    rest = _verdict(loads, gate.manifest(spark)).join(out.select("load_id"), "load_id", "left_anti")
    return out.unionByName(rest.select("load_id", F.when(F.col("state") == "open", "waiting").otherwise(F.col("state")).alias("state"),
                                       "line_count", "parsed_count", "bad_count", "error", F.coalesce("late_lines", F.lit(0)).alias("late_lines")))


def _held_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("file", T.StringType()), T.StructField("line_no", T.LongType()),
                         T.StructField("record", schema_of_strings(schema)), T.StructField("batch_id", T.LongType()),
                         T.StructField("load_id", T.StringType())])


def _release(spark: SparkSession, gate: LoadGate, loads: DataFrame, schema: T.StructType, records_out: str, step: str) -> None:
    """Let out what the manifest now completes. The verdict is written first, then the records, then the
    table of loads; a step that is cut short is done again whole, from the step before it."""
    verdict = written_stage(_verdict(loads, gate.manifest(spark)).select("load_id", "state"), "landing-verdict")
    opened = verdict.filter("state = 'open'").select("load_id")
    held = spark.read.schema(_held_schema(schema)).parquet(f"{gate.state.rstrip('/')}/held")
    out = normalize_order_ids(held.join(opened, "load_id", "left_semi").select("load_id", "file", "line_no", "record.*"))
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{records_out.rstrip('/')}/step={step}")
    after = loads.join(verdict, "load_id", "left").withColumn(
        "released", F.when(F.col("state") == "open", F.lit(step)).otherwise(F.col("released"))).select(loads.columns)
    after.write.mode("overwrite").parquet(f"{gate.state.rstrip('/')}/loads/step={step}")
    drop_stage(verdict)


def _gated_batch(spark: SparkSession, gate: LoadGate, lines: DataFrame, schema: T.StructType, records_out: str, batch_id: int) -> None:
    step, state = _step(batch_id), gate.state.rstrip("/")
    known = _known_loads(spark, gate, before=step)
    _drop_held(spark, gate, known, batch_id)
    own = lines.withColumn("load_id", gate.load_of(F.col("file")))
    fs, base = file_system(spark, f"{state}/held")
    fs.mkdirs(base)
    own.filter("kind = 'record'").select("load_id", "file", "line_no", "record").write.mode("overwrite").partitionBy("load_id") \
        .parquet(f"{state}/held/batch_id={batch_id}")
    new = ParsedLines(own).counts(["load_id"])
    both = known.join(new.select("load_id", *[F.col(c).alias("n_" + c) for c in new.columns if c != "load_id"]), "load_id", "full")
    late = F.col("released").isNotNull()
    zero = F.lit(0).cast("long")
    added = {c: F.when(late, F.col(c)).otherwise(F.coalesce(c, zero) + F.coalesce("n_" + c, zero))
             for c in ("line_count", "parsed_count", "bad_count")}
    loads = both.withColumns({
        **added, "first_bad_line": F.coalesce("first_bad_line", F.when(~late, F.col("n_first_bad_line"))),
        "first_batch": F.coalesce("first_batch", F.lit(batch_id).cast("long")),
        "late_lines": F.coalesce("late_lines", zero) + F.when(late, F.coalesce("n_line_count", zero)).otherwise(zero)})
    loads = written_stage(loads.select(*known.columns), "landing-loads")
    _release(spark, gate, loads, schema, records_out, step)
    drop_stage(loads)


def _drop_held(spark: SparkSession, gate: LoadGate, known: DataFrame, batch_id: int) -> None:
    """Held batches older than this one and than the first batch of every load that may still be released
    go. The step before is committed by now, so what it let out is not read again."""
    oldest = known.filter("released IS NULL AND bad_count = 0").agg(F.min("first_batch")).first()[0]
    oldest = batch_id if oldest is None else min(oldest, batch_id)
    fs, base = file_system(spark, f"{gate.state.rstrip('/')}/held")
    for entry in fs.listStatus(base) if fs.exists(base) else []:
        name = entry.getPath().getName()
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) < oldest:
            fs.delete(entry.getPath(), True)


def settle_landing(spark: SparkSession, gate: LoadGate, schema: T.StructType, records_out: str) -> None:
    """Ask the gate again without new files, for a manifest that came after them. Call it while the stream
    is not running."""
    steps = _steps(spark, f"{gate.state.rstrip('/')}/loads")
    if steps:
        batch, part = steps[-1].removeprefix("b").split("-")
        _release(spark, gate, _known_loads(spark, gate), schema, records_out, _step(int(batch), int(part) + 1))


def stream_landing(spark: SparkSession, landing: str, schema: T.StructType, records_out: str,
                   bad_out: str, checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = None,
                   gate: LoadGate | None = None):
    """Start the stream; returns the ``StreamingQuery``. Without ``gate`` every record goes out with its
    micro-batch (``batch_id=N``); with one, whole loads go out as they pass (``step=...``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = reader.load(landing).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        staged = stage_lines(batch, schema)
        try:
            parsed = ParsedLines(numbered(staged))
            parsed.bad_lines().write.mode("overwrite").json(f"{bad_out.rstrip('/')}/batch_id={batch_id}")
            if gate is not None:
                _gated_batch(batch.sparkSession, gate, parsed.classified, schema, records_out, batch_id)
            else:
                normalize_order_ids(parsed.records()).write.mode("overwrite").option("ignoreNullFields", "false") \
                    .json(f"{records_out.rstrip('/')}/batch_id={batch_id}")
        finally:
            drop_stage(staged)

    writer = src.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
