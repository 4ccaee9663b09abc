"""Sinks: records + metadata (K1), raw sidecar (K2), run metadata (K3), the extraction job (K4).

Records are written as JSON lines by every task in parallel (``ignoreNullFields=false`` so
record nulls survive); a single wrapper document would need one task, so it is not the
format. Metadata is one row written with default options (its nulls are dropped).

A run writes into a folder of its own, ``{location}/{name}/runs/{run id}``. Last of all it appends
one row to ``{location}/{name}/manifest``; readers go by that table, so they see a run whole or not at
all, and a run that fails on the way leaves the earlier one as it was. Superseded and unfinished runs
stay until :func:`drop_runs`.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.instants import format_instant, format_instant_py, known_zone, parse_iso_instant, source_window_py, window_bound_py
from ..functions.text import normalize, normalize_py
from ..operators.configs import DEFAULT_TIME_ZONE, ID_REQUIRED, ZONE_INVALID, check_usable
from ..operators.normalize import normalize_order_ids
from ..plans.catalog import ORDER_SOURCE, normalize_filters, render_search_query, resolve_field_paths
from ..session import drop_stage, file_system, path_exists
from ..sources.gate import load_gate
from ..sources.jsonl import numbered, schema_of_strings, stage_lines

# Fixed value: default result name pattern.
DEFAULT_NAME = "shopify-orders-{start}-{end}.json"


def json_name(name: str | None, fallback: str) -> str:
    """X22 (driver form): ``.json`` appended when missing."""
    n = normalize_py(name) or fallback
    return n if n.lower().endswith(".json") else n + ".json"


def jsonl_name(name: str | None, fallback: str) -> str:
    """X22 (driver form): keep ``.jsonl``; else a trailing ``.json`` becomes ``.jsonl``."""
    import re
    n = normalize_py(name) or fallback
    if n.lower().endswith(".jsonl"):
        return n
    return re.sub(r"(?i)\.json$", "", n) + ".jsonl"


# --- runs and their manifest ---------------------------------------------------------------

RUN_SCHEMA = "run_id string, committed_at timestamp, record_format string, has_metadata boolean, raw_name string"


def run_folder(location: str, name: str, run_id: str) -> str:
    return f"{location.rstrip('/')}/{name}/runs/{run_id}"


def new_run_id() -> str:
    return uuid.uuid4().hex


def commit_run(spark: SparkSession, location: str, name: str, run_id: str, record_format: str = "json",
               has_metadata: bool = False, raw_name: str | None = None) -> None:
    """Append the run to its manifest: one file, which the store shows only when it is complete."""
    row = spark.createDataFrame([(run_id, _dt.datetime.now(_dt.timezone.utc), record_format, has_metadata, raw_name)], RUN_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{location.rstrip('/')}/{name}/manifest")


def committed_runs(spark: SparkSession, location: str, name: str) -> DataFrame:
    """The manifest: one row per finished run (none where there is no manifest yet)."""
    path = f"{location.rstrip('/')}/{name}/manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def latest_run(spark: SparkSession, location: str, name: str):
    """The manifest row of the run committed last (of equal times the greater id), or None."""
    runs = committed_runs(spark, location, name)
    return runs.orderBy(F.desc("committed_at"), F.desc("run_id")).first()  # one row per run ever made


def read_run(spark: SparkSession, location: str, name: str, part: str = "records", schema=None) -> DataFrame:
    """``records``, ``metadata`` or ``raw`` (the sidecar) of the last finished run."""
    run = latest_run(spark, location, name)
    if run is None:
        raise FileNotFoundError(f"No finished run of {name} at {location}.")
    base = run_folder(location, name, run["run_id"])
    if part == "raw":
        if run["raw_name"] is None:
            raise FileNotFoundError(f"The last run of {name} at {location} has no raw lines.")
        return spark.read.text(f"{base}/{run['raw_name']}")
    if part == "metadata" and not run["has_metadata"]:
        raise FileNotFoundError(f"The last run of {name} at {location} has no metadata.")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format("json" if part == "metadata" else run["record_format"]).load(f"{base}/{part}")


def drop_runs(spark: SparkSession, location: str, name: str) -> list[str]:
    """Delete the folders of all runs but the last finished one, those under way included: call it
    while no run writes. Returns the ids of what went. The manifest keeps its rows."""
    last = latest_run(spark, location, name)
    keep = last["run_id"] if last else None
    fs, base = file_system(spark, f"{location.rstrip('/')}/{name}/runs")
    gone = []
    for entry in fs.listStatus(base) if fs.exists(base) else []:
        run_id = entry.getPath().getName()
        if run_id != keep:
            fs.delete(entry.getPath(), True)
            gone.append(run_id)
    return sorted(gone)


def write_records(records: DataFrame, location: str, name: str, metadata: DataFrame | None = None,
                  partition_by_day: str | None = None, fmt: str = "json", raw: DataFrame | None = None,
                  raw_name: str | None = None, run_id: str | None = None) -> str:
    """K1: one run with ``records`` (JSON lines, nulls kept), ``metadata`` and, where ``raw`` lines are
    given, the sidecar ``raw_name`` (K2). Committed when all of them are written; returns its folder.

    ``partition_by_day`` (``createdAt`` / ``updatedAt`` / ``processedAt``) adds the matching
    ``*_date`` column and partitions the files by it; datetime filters on a table read back from
    there get an implied date predicate (``compile_filters``) and prune whole partitions."""
    from ..operators.filters import PARTITION_DATE_COLUMNS
    run_id = run_id or new_run_id()
    base = run_folder(location, name, run_id)
    writer_df = records
    parts: list[str] = []
    if partition_by_day:
        day_col = PARTITION_DATE_COLUMNS[partition_by_day]
        # the UTC day, whatever the session's zone
        day = F.substring(format_instant(parse_iso_instant(F.col(partition_by_day))), 1, 10)
        writer_df = records.withColumn(day_col, F.to_date(day))
        parts = [day_col]
    w = writer_df.write.partitionBy(*parts)
    if fmt == "json":
        w.option("ignoreNullFields", "false").json(f"{base}/records")
    else:
        w.format(fmt).save(f"{base}/records")
    if raw is not None:
        write_raw_sidecar(raw, base, raw_name)
    if metadata is not None:
        metadata.coalesce(1).write.json(f"{base}/metadata")
    commit_run(records.sparkSession, location, name, run_id, fmt, metadata is not None, raw_name if raw is not None else None)
    return base


def write_raw_sidecar(lines: DataFrame, location: str, name: str, value_col: str = "value") -> str:
    """K2: the raw lines unmodified."""
    path = f"{location.rstrip('/')}/{name}"
    lines.select(value_col).write.text(path)
    return path


_TEXTS = T.ArrayType(T.StringType())
# Metadata keys in their order, and the constant entries.
METADATA_FIELDS = [
    ("sourceType", T.StringType()), ("extractionMode", T.StringType()), ("graphqlExecutionMode", T.StringType()),
    ("shopifyAuthConfigId", T.StringType()), ("automationId", T.StringType()), ("fileSide", T.StringType()),
    ("systemEnumId", T.StringType()), ("sourceTypeEnumId", T.StringType()), ("sourceTimeZone", T.StringType()),
    ("calendarDateNormalized", T.BooleanType()), ("exactWindowPreserved", T.BooleanType()), ("filterFields", _TEXTS),
    ("searchQueries", _TEXTS), ("windowStartUtc", T.StringType()), ("windowEndUtc", T.StringType()),
    ("bulkOperation", T.StringType()), ("bulkPollCount", T.LongType()), ("bulkStatusHistory", _TEXTS),
    ("bulkStartRetryCount", T.LongType()), ("bulkStartRetryHistory", _TEXTS), ("bulkJsonlLineCount", T.LongType()),
    ("rawJsonlFileName", T.StringType()), ("rawJsonlLocation", T.StringType()), ("extractedRecordCount", T.LongType()),
]
SOURCE_TYPE, EXTRACTION_MODE, EXECUTION_MODE, FILE_TYPE = "SHOPIFY_GRAPHQL_ORDERS", "BULK_OPERATION_DATE_FILTER", "BULK_OPERATION", "DftJson"
FILTER_FIELDS = ["created_at"]
METADATA_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in METADATA_FIELDS])


def run_metadata(spark: SparkSession, **values) -> DataFrame:
    """K3: one row; never a URL or a token (only the named fields exist). Nulls are dropped where it
    is written."""
    return spark.createDataFrame([tuple(values.get(n) for n, _ in METADATA_FIELDS)], METADATA_SCHEMA)


STATUS_SCHEMA = T.StructType([
    T.StructField("dataAvailable", T.BooleanType()), T.StructField("fileLocation", T.StringType()),
    T.StructField("fileName", T.StringType()), T.StructField("fileTypeEnumId", T.StringType()),
    T.StructField("recordCount", T.LongType()), T.StructField("requestMetadata", METADATA_SCHEMA),
    T.StructField("warnings", _TEXTS), T.StructField("errors", _TEXTS),
])


@dataclass
class Extraction:
    """``records`` are the normalised records (none on an error), ``status`` the job's one-row
    result, ``gate`` the load's gate row (None where the job stopped before reading)."""

    records: DataFrame
    status: DataFrame
    gate: DataFrame | None
    file_name: str | None
    raw_file_name: str | None


def extract_orders(spark: SparkSession, jsonl_path: str, expected_count, location_present: bool,
                   window_start, window_end, config_id: str | None = None, configs: DataFrame | None = None,
                   tenant: str | None = None, location: str | None = None, name: str | None = None,
                   preserve_instants: bool = False, write: bool = False, run: dict | None = None,
                   default_zone: str | None = None) -> Extraction:
    """K4: bounds and config check (J4) -> window in the config's zone (X5) -> strict JSONL read
    -> gate (S2) -> id normalisation (P4) -> optional write of records, sidecar and metadata (K1-K3).

    ``configs`` is the config table and ``tenant`` the asking tenant; without a table the config is
    only required to be named. The zone is the config's, else ``default_zone`` (the tenant's), else
    UTC; one that does not exist is an error of the job. The export is taken to hold what was asked
    for: created within the half-open window; records outside it are kept, and counted in a warning.
    ``run`` may carry entries of the metadata that only the caller knows (bulk operation, histories,
    automation). On any error nothing is written and ``dataAvailable`` is false; a successful run
    without records writes its metadata and an empty record list.

    The export is read once: one job classifies its lines, writes them to a stage and adds up what the
    gate and the warning need; records and sidecar come from the stage."""
    errors: list[str] = []
    bounds: dict[str, _dt.datetime] = {}
    for label, value in (("windowStart", window_start), ("windowEnd", window_end)):
        try:
            bounds[label] = window_bound_py(value)
        except ValueError as exc:
            errors.append(f"{label} {exc}")
    config, stored = normalize_py(config_id), None
    if not config:
        errors.append(ID_REQUIRED)
    elif not errors and configs is not None:
        asked = spark.createDataFrame([(0, config, normalize_py(tenant), None)],
                                      "request_id int, config_id string, trusted_tenant string, session_tenant string")
        errors += check_usable(asked, configs).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("errors"))))).first()[0]
        # an id names one row; of rows that share it the least zone counts, whatever their order
        stored = configs.filter(normalize("config_id") == config).agg(F.min(normalize("time_zone"))).first()[0]
    zone = stored or normalize_py(default_zone) or DEFAULT_TIME_ZONE
    if not errors and not known_zone(zone):
        errors.append(ZONE_INVALID.replace("{tz}", zone))
    schema = _record_schema(resolve_field_paths(ORDER_SOURCE, [], bulk=True))
    if errors:
        return _stopped(spark, schema, errors)
    start, end = source_window_py(bounds["windowStart"], bounds["windowEnd"], zone, preserve_instants)
    millis = [int((x - _dt.datetime(1970, 1, 1)) / _dt.timedelta(milliseconds=1)) for x in (start, end)]
    file_name = json_name(name, DEFAULT_NAME.format(start=millis[0], end=millis[1]))
    raw_name = jsonl_name(file_name, file_name)
    filters = normalize_filters(ORDER_SOURCE, {"createdAtFrom": format_instant_py(start), "createdAtTo": format_instant_py(end)})

    staged, seen = _staged_export(spark, jsonl_path, schema, start, end)
    first_bad = numbered(staged).filter("kind = 'bad'").agg(F.min("line_no")).first()[0] if seen["bad_count"] else None
    counts = spark.createDataFrame([(file_name, seen["line_count"], seen["parsed_count"], seen["bad_count"], first_bad)],
                                   "load_id string, line_count long, parsed_count long, bad_count long, first_bad_line long")
    manifest = spark.createDataFrame([(file_name, None if expected_count is None else str(expected_count),
                                       jsonl_path if location_present else None)],
                                     "load_id string, expected_count string, location string")
    gate = load_gate(counts, manifest)
    row = gate.first()
    if row["error"]:
        drop_stage(staged)
        stopped = _stopped(spark, schema, [row["error"]], file_name, raw_name)
        stopped.gate = gate
        return stopped
    released = staged.filter((F.col("kind") == "record") & F.lit(row["data_available"]))
    records = normalize_order_ids(released.select("record.*"))
    warnings = [f"{seen['outside']} record(s) lie outside the requested window."] if seen["outside"] and row["data_available"] else []

    base, run_id = (location.rstrip("/") if location else None), new_run_id()
    raw_location = f"{run_folder(base, file_name, run_id)}/{raw_name}" if row["line_count"] and base else None
    metadata = {
        **(run or {}),
        "sourceType": SOURCE_TYPE, "extractionMode": EXTRACTION_MODE, "graphqlExecutionMode": EXECUTION_MODE,
        "shopifyAuthConfigId": config, "sourceTimeZone": zone, "calendarDateNormalized": not preserve_instants,
        "exactWindowPreserved": preserve_instants, "filterFields": FILTER_FIELDS,
        "searchQueries": [render_search_query(ORDER_SOURCE, filters)], "windowStartUtc": format_instant_py(start),
        "windowEndUtc": format_instant_py(end), "bulkJsonlLineCount": row["line_count"],
        "rawJsonlFileName": raw_name if row["line_count"] else None, "rawJsonlLocation": raw_location,
        "extractedRecordCount": row["record_count"],
    }
    metadata = {n: metadata.get(n) for n, _ in METADATA_FIELDS}
    if write and base:
        write_records(records, base, file_name, run_metadata(spark, **metadata), raw=staged if row["line_count"] else None,
                      raw_name=raw_name, run_id=run_id)
    status = spark.createDataFrame([(row["record_count"] > 0, f"{base}/{file_name}" if base else None, file_name, FILE_TYPE,
                                     row["record_count"], tuple(metadata.values()), warnings, [])], STATUS_SCHEMA)
    return Extraction(records, status, gate, file_name, raw_name)


def _staged_export(spark: SparkSession, path: str, schema: T.StructType, start: _dt.datetime, end: _dt.datetime) -> tuple[DataFrame, dict]:
    """The written, classified lines of an export, and what the job that wrote them counted on the way:
    lines, records, bad lines, and records not created within the window."""
    created = parse_iso_instant(F.col("record.createdAt"))
    inside = (created >= F.lit(start.isoformat(sep=" ") + "Z").cast("timestamp")) & (created < F.lit(end.isoformat(sep=" ") + "Z").cast("timestamp"))
    seen = Observation()
    staged = stage_lines(spark.read.text(path), schema, seen, [
        F.count(F.lit(1)).alias("line_count"), F.count_if(F.col("kind") == "record").alias("parsed_count"),
        F.count_if(F.col("kind") == "bad").alias("bad_count"),
        F.count_if((F.col("kind") == "record") & ~F.coalesce(inside, F.lit(False))).alias("outside")])
    return staged, seen.get


def _stopped(spark: SparkSession, schema: T.StructType, errors: list[str], file_name: str | None = None,
             raw_name: str | None = None) -> Extraction:
    none = normalize_order_ids(spark.createDataFrame([], schema_of_strings(schema)))
    status = spark.createDataFrame([(False, None, None, None, 0, None, [], errors)], STATUS_SCHEMA)
    return Extraction(none, status, None, file_name, raw_name)


def _record_schema(paths: list[str]) -> T.StructType:
    """JSONL read schema from the selected paths (only they are parsed: column pruning for
    text input, where Spark cannot prune nested fields by itself)."""
    tree: dict = {}
    for p in paths:
        node = tree
        for seg in p.split("."):
            node = node.setdefault(seg, {})

    def build(sub: dict) -> T.StructType:
        return T.StructType([T.StructField(k, build(v) if v else T.StringType(), True) for k, v in sub.items()])
    return build(tree)
