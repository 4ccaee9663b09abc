"""The completeness gate, and release of data only behind it.

Per load (one export): a completed export that reports objects but has no result location
fails; no location and no/zero expected objects is a valid empty result; any bad line fails
the whole load; a parsed count different from the expected one (either way) fails and is
retryable; a non-numeric expected count skips that check.

One aggregate pass over the parsed lines (partial aggregation per load), joined to the small
manifest on the load key; the released records are a left-semi join against the passing
loads (one row per load, broadcast by AQE after its runtime size check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize

# Gate messages.
NO_LOCATION = "Shopify bulk operation completed with {n} object(s) but returned no result download URL."
PARSE_FAILED = "Shopify bulk operation result could not be parsed: {n} bad line(s), first at line {first}."
UNKNOWN_LOAD = "Records arrived for load {id}, which the manifest does not list."
INCOMPLETE = "Shopify bulk operation result was incomplete: expected {e} record(s) but parsed {p}."


def _fmt(template: str, **cols) -> F.Column:
    out = F.lit(template)
    for k, c in cols.items():
        out = F.replace(out, F.lit("{" + k + "}"), c.cast("string"))
    return out


def load_gate(counts: DataFrame, manifest: DataFrame, key: str = "load_id") -> DataFrame:
    """``counts``: key, line_count, parsed_count, bad_count, first_bad_line (``ParsedLines.counts``).
    ``manifest``: key, expected_count (text as reported), location (text or null). A load that
    only one of the two knows still gets its row: none parsed, or an error for an unlisted one."""
    m = manifest.select(key, normalize("expected_count").alias("_exp_text"), normalize("location").alias("_loc"),
                        F.lit(True).alias("_listed"))
    j = m.join(counts, key, "full")
    unlisted = F.col("_listed").isNull()
    expected = F.when(F.col("_exp_text").rlike(r"^[+-]?\d+$"), F.col("_exp_text").try_cast("long"))
    parsed = F.coalesce(F.col("parsed_count"), F.lit(0))
    bad = F.coalesce(F.col("bad_count"), F.lit(0))
    no_loc = F.col("_loc").isNull()
    error = (
        F.when(unlisted, _fmt(UNKNOWN_LOAD, id=F.coalesce(F.col(key).cast("string"), F.lit("(none)"))))
        .when(no_loc & expected.isNotNull() & (expected > 0), _fmt(NO_LOCATION, n=expected))
        .when(no_loc, F.lit(None).cast("string"))
        .when(bad > 0, _fmt(PARSE_FAILED, n=bad, first=F.col("first_bad_line")))
        .when(expected.isNotNull() & (expected != parsed), _fmt(INCOMPLETE, e=expected, p=parsed))
    )
    ok = error.isNull()
    retryable = F.coalesce(~no_loc & (bad == 0) & expected.isNotNull() & (expected != parsed), F.lit(False))
    record_count = F.when(ok & ~no_loc, parsed).otherwise(F.lit(0))
    return j.select(
        key,
        expected.alias("expected_count"),
        F.coalesce(F.col("line_count"), F.lit(0)).alias("line_count"),
        parsed.alias("parsed_count"),
        bad.alias("bad_count"),
        ok.alias("ok"),
        retryable.alias("retryable"),
        record_count.cast("long").alias("record_count"),
        (ok & (record_count > 0)).alias("data_available"),
        error.alias("error"),
    )


def release(records: DataFrame, gate: DataFrame, key: str = "load_id", mode: str = "empty") -> DataFrame:
    """Records of passing loads with data only. ``mode='empty'`` drops all others (the reference
    behaviour); ``mode='raise'`` releases the same records, and fails the job when a load in
    ``records`` failed or is not in ``gate``."""
    verdict = gate.select(key, F.col("error").alias("_gate_error"), (F.col("ok") & F.col("data_available")).alias("_gate_open"))
    if mode == "raise":
        known = records.join(verdict.withColumn("_gate_known", F.lit(True)), key, "left")
        problem = F.when(F.col("_gate_known").isNull(), _fmt(UNKNOWN_LOAD, id=F.coalesce(F.col(key).cast("string"), F.lit("(none)")))) \
            .otherwise(F.col("_gate_error"))
        # the check sits in a filter, so column pruning cannot drop it
        checked = known.filter(F.coalesce(F.when(problem.isNotNull(), F.raise_error(problem)).cast("boolean"), F.col("_gate_open")))
        return checked.drop("_gate_error", "_gate_open", "_gate_known")
    return records.join(verdict.filter("_gate_open").select(key), key, "left_semi")


def behind(rows: DataFrame, status: DataFrame | None, ok_col: str = "ok") -> DataFrame:
    """``rows`` where the one-row ``status`` says ok, nothing otherwise (no status: all rows)."""
    if status is None:
        return rows
    key = "__open"
    passed = status.filter(F.col(ok_col)).limit(1).select(F.lit(1).alias(key))  # one row: broadcast
    return rows.withColumn(key, F.lit(1)).join(F.broadcast(passed), key, "left_semi").drop(key)
