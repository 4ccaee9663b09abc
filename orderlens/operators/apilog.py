"""API-log analytics (L1-L4, A2, A3): the original's per-request retry, poll and probe logic,
re-aimed as jobs over tables of captured responses and status events.

Every rollup is one aggregation: the values at the first attempt that ends the run are a
``min_by`` per request, combined before the shuffle, so a request with millions of attempts costs
one row per task. A run ends at its policy's limit at the latest; log rows past the limit cannot
decide anything, are not parsed, and are counted in ``ignored_rows``. Histories hold at most one
entry per status and attempt below the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import (FAILED_STATUSES, THROTTLE_CODES, describe_failure, is_concurrent_message,
                                  missing_scope)
from ..functions.money import throttle_delay_millis
from ..functions.text import is_mutation, normalize
from ..sources.jsonl import with_object

# Attempt limits of the original clients.
DEFAULT_MAX_ATTEMPTS = 2
DOWNLOAD_MAX_ATTEMPTS = 3
MAX_POLL_ATTEMPTS = 60
START_RETRY_ATTEMPTS = 10

# Response and check messages.
MSG_HTTP_FAILED = "Shopify GraphQL request failed with HTTP {s}."
MSG_NOT_JSON = "Shopify GraphQL response was not valid JSON."
MSG_GRAPHQL_ERROR = "Shopify GraphQL error: "
MSG_DOWNLOAD_FAILED = "Shopify bulk operation result download failed with HTTP {s}."
MSG_NO_TOKEN = "No access token is stored for this configuration."
MSG_NOT_ATTEMPTED = "Not attempted."
MSG_VERSION_NOT_SERVED = "The shop did not serve API version {v}. Check the version and the shop URL."
MSG_ORDERS_DISABLED = "This configuration is not enabled for order reads."
MSG_ONE_ORDER = "1 order returned"
MSG_NO_ORDERS = "no orders in range"
MSG_MISSING_SCOPE = "The token is missing the read_orders scope."
MSG_NO_VALID_RESPONSE = "Shopify GraphQL request failed before a valid response was received."
MSG_OPERATION_ENDED = "Shopify bulk operation {id} ended with status {st}."
MSG_OPERATION_TIMED_OUT = "Shopify bulk operation {id} did not complete after {n} poll attempt(s)."
MSG_START_EXHAUSTED = ("Shopify bulk operation could not start because another bulk operation was still running "
                       "after {n} retry attempt(s).")
# Check keys in their order, with labels.
CHECK_LABELS = {"credential": "Credential readable", "reachable": "Shop reachable",
                "apiVersion": "API version supported", "ordersRead": "Orders readable"}


def _fill(template: str, **cols) -> Column:
    out = F.lit(template)
    for k, c in cols.items():
        out = F.replace(out, F.lit("{" + k + "}"), c.cast("string"))
    return out

# ``errors`` is kept as raw JSON text: only a list is one, and its entries, kept as text again, may
# be objects with a message or plain strings.
BODY_SCHEMA = (
    "data {data}, errors string, "
    "extensions struct<cost:struct<requestedQueryCost:string,actualQueryCost:string,"
    "throttleStatus:struct<maximumAvailable:string,currentlyAvailable:string,restoreRate:string>>>"
)


def _error_message(e: Column) -> Column:
    return F.when(F.trim(e).startswith("{"), F.get_json_object(e, "$.message")).otherwise(e)


def _error_code(e: Column) -> Column:
    return F.when(F.trim(e).startswith("{"), F.get_json_object(e, "$.extensions.code"))


def _empty_errors(text: Column) -> Column:
    """Values that count as no errors at all: absent, null, false, zero, empty text, list or object."""
    return F.coalesce(F.trim(text).isin("", "null", "false", "0", "[]", "{}"), F.lit(True))


def classify_responses(log: DataFrame, status_col: str = "status_code", body_col: str = "body",
                       attempt_col: str = "attempt", max_col: str | None = "max_attempts", data_type: str = "string") -> DataFrame:
    """L1: one classification per captured response.

    non-2xx -> not ok, retryable iff (429 or >= 500) and attempts remain; a body that is not one
    JSON object -> not ok, final; ``errors`` that is neither empty nor a list -> not ok (failure
    ``shape``), retryable while attempts remain; errors with a non-blank message -> not ok, messages prefixed,
    throttled iff a code is THROTTLED / MAX_COST_EXCEEDED, retryable iff throttled and attempts
    remain; otherwise ok (errors whose messages are all blank count as ok). ``data`` is read as
    ``data_type``, by the one parse of the body (raw JSON text where nothing else is asked for)."""
    s = F.coalesce(F.col(status_col).cast("int"), F.lit(0))
    attempt = F.col(attempt_col).cast("int")
    max_a = F.col(max_col).cast("int") if max_col else F.lit(1)
    left = attempt < max_a
    # staged: the body is parsed once, the messages and codes derived once, then every output
    # column reads those (an expensive expression used twice is not re-inlined by the optimizer)
    staged = with_object(log.withColumns({"__s": s, "__left": left}), body_col, BODY_SCHEMA.format(data=data_type), "__is_obj", "__body")
    staged = staged.withColumns({
        "__list": F.when(F.trim(F.col("__body.errors")).startswith("["), F.from_json(F.col("__body.errors"), "array<string>")),
    }).withColumns({
        "__odd": F.col("__list").isNull() & ~_empty_errors(F.col("__body.errors")),
        "__errs": F.filter(F.coalesce(F.col("__list"), F.array().cast("array<string>")), lambda e: e.isNotNull()),
    })
    staged = staged.withColumns({
        "__msgs": F.filter(F.transform(F.col("__errs"), lambda e: normalize(_error_message(e))), lambda m: m.isNotNull()),
        "__thr": F.coalesce(F.exists(F.col("__errs"), lambda e: F.coalesce(normalize(_error_code(e)).isin(*THROTTLE_CODES),
                                                                            F.lit(False))), F.lit(False)),
    })
    sc = F.col("__s")
    http_bad = (sc < 200) | (sc >= 300)
    kind = (F.when(http_bad, F.lit("http")).when(~F.col("__is_obj"), F.lit("json"))
            .when(F.col("__odd"), F.lit("shape")).when(F.size("__msgs") > 0, F.lit("graphql")).otherwise(F.lit("ok")))
    staged = staged.withColumn("__kind", kind)
    k = F.col("__kind")
    parsed_ok = (k == "graphql") | (k == "ok")
    cost = F.col("__body.extensions.cost")
    return staged.withColumns({
        "ok": k == "ok",
        "failure": F.when(k != "ok", k),
        "throttled": (k == "graphql") & F.col("__thr"),
        "retryable": F.when(k == "http", ((sc == 429) | (sc >= 500)) & F.col("__left"))
                      .when(k == "graphql", F.col("__thr") & F.col("__left"))
                      .when(k == "shape", F.col("__left"))
                      .otherwise(F.lit(False)),
        "error_text": F.when(k == "http", _fill(MSG_HTTP_FAILED, s=sc))
                       .when(k == "json", F.lit(MSG_NOT_JSON))
                       .when(k == "shape", F.lit(MSG_NO_VALID_RESPONSE))
                       .when(k == "graphql", F.array_join(F.transform("__msgs", lambda m: F.concat(F.lit(MSG_GRAPHQL_ERROR), m)), "; ")),
        "graphql_messages": F.when(k == "graphql", F.col("__msgs")).otherwise(F.array().cast("array<string>")),
        "data": F.when(k == "ok", F.col("__body.data")),
        "requested_cost": F.when(parsed_ok, cost["requestedQueryCost"]),
        "actual_cost": F.when(parsed_ok, cost["actualQueryCost"]),
        "maximum_available": F.when(parsed_ok, cost["throttleStatus"]["maximumAvailable"]),
        "currently_available": F.when(parsed_ok, cost["throttleStatus"]["currentlyAvailable"]),
        "restore_rate": F.when(parsed_ok, cost["throttleStatus"]["restoreRate"]),
    }).drop("__s", "__left", "__body", "__is_obj", "__list", "__odd", "__errs", "__msgs", "__thr", "__kind")


def _at_end(stop: Column, attempt: Column, **values) -> Column:
    """The values at the first attempt where ``stop`` holds, else at the last one."""
    row = F.struct(attempt.alias("attempt"), *[c.alias(k) for k, c in values.items()])
    return F.coalesce(F.min_by(row, F.when(stop, attempt)), F.max_by(row, attempt))


def retry_plan(log: DataFrame, key: str = "request_id", attempt_col: str = "attempt",
               doc_col: str = "query", delay_col: str | None = None,
               max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> DataFrame:
    """L2: per request the attempts used, final outcome and planned waiting time.

    Attempts count from 1. Mutations get one attempt. After a retryable failure the wait is the
    explicit delay when given, else X16 when throttled or HTTP 429, else 0. ``unfinished``: the
    attempts logged do not end the run."""
    most = max(1, max_attempts)
    a = F.col(attempt_col)
    base = log.withColumn("max_attempts", F.when(is_mutation(F.col(doc_col)), F.lit(1)).otherwise(F.lit(most)))
    # the body of an attempt past the limit is not parsed
    base = base.withColumn("body", F.when(a <= F.col("max_attempts"), F.col("body")))
    c = classify_responses(base, attempt_col=attempt_col)
    explicit = F.coalesce(F.col(delay_col).cast("long"), F.lit(0)) if delay_col else F.lit(0).cast("long")
    wait = (F.when(explicit > 0, explicit)
            .when(F.col("throttled") | (F.col("status_code") == 429),
                  throttle_delay_millis(F.col("requested_cost"), F.col("currently_available"), F.col("restore_rate")))
            .otherwise(F.lit(0)).cast("long"))
    c = c.withColumns({
        "_counts": a <= F.col("max_attempts"),
        "_stop": (a <= F.col("max_attempts")) & (F.col("ok") | ~F.col("retryable") | (a >= F.col("max_attempts"))),
    }).withColumn("_wait", F.when(F.col("_counts") & ~F.col("_stop"), wait).otherwise(F.lit(0)).cast("long"))
    counted = F.when(F.col("_counts"), a)
    agg = c.groupBy(key).agg(
        _at_end(F.col("_stop"), counted, ok=F.col("ok"), code=F.col("status_code"), error=F.col("error_text")).alias("_end"),
        F.min(F.when(F.col("_stop"), a)).alias("_first_stop"),
        # waits by attempt number, of which there are fewer than the limit
        *[F.sum(F.when(a == i, F.col("_wait"))).alias(f"_wait{i}") for i in range(1, most)],
        F.count_if(~F.col("_counts")).alias("ignored_rows"),
    )
    end = F.col("_end")
    delay = F.lit(0).cast("long")
    for i in range(1, most):
        delay = delay + F.when(F.lit(i) < end["attempt"], F.coalesce(F.col(f"_wait{i}"), F.lit(0))) \
            .when(F.col("_first_stop").isNull() & (F.lit(i) == end["attempt"]), F.coalesce(F.col(f"_wait{i}"), F.lit(0))).otherwise(F.lit(0))
    return agg.select(key, end["attempt"].alias("attempts_used"), end["ok"].alias("final_ok"), end["code"].alias("final_status_code"),
                      end["error"].alias("final_error"), delay.alias("planned_delay_ms"),
                      F.col("_first_stop").isNull().alias("unfinished"), "ignored_rows")


def download_outcomes(log: DataFrame, key: str = "download_id", attempt_col: str = "attempt",
                      status_col: str = "status_code", max_attempts: int = DOWNLOAD_MAX_ATTEMPTS) -> DataFrame:
    """L3: 2xx ok; 429 / 5xx retryable; other statuses final; at most ``max_attempts``."""
    s = F.coalesce(F.col(status_col).cast("int"), F.lit(0))
    ok = (s >= 200) & (s < 300)
    retryable = ~ok & ((s == 429) | (s >= 500))
    a = F.col(attempt_col)
    counts = a <= max_attempts
    c = log.withColumns({"_ok": ok, "_retry": retryable, "_counts": counts,
                         "_stop": counts & (ok | ~retryable | (a >= max_attempts))})
    agg = c.groupBy(key).agg(
        _at_end(F.col("_stop"), F.when(F.col("_counts"), a), ok=F.col("_ok"), retry=F.col("_retry"), code=F.col(status_col)).alias("_end"),
        F.count_if(~F.col("_counts")).alias("ignored_rows"))
    end = F.col("_end")
    return agg.select(
        key,
        end["attempt"].alias("attempts_used"),
        end["ok"].alias("ok"),
        end["retry"].alias("retryable"),
        end["code"].alias("status_code"),
        F.when(~end["ok"], _fill(MSG_DOWNLOAD_FAILED, s=F.coalesce(end["code"].cast("int"), F.lit(0)))).alias("error"),
        F.when(~end["ok"], end["attempt"]).alias("download_attempt_count"),
        "ignored_rows",
    )


def operation_rollup(events: DataFrame, key: str = "operation_id", seq_col: str = "seq",
                     status_col: str = "status", max_polls: int = MAX_POLL_ATTEMPTS) -> DataFrame:
    """A2: per bulk operation (``seq`` 0 = the start response, then one entry per poll): the
    ``status_history`` up to the first terminal status; ``poll_count`` = entries - 1; outcome
    ``COMPLETED`` / ``FAILED`` (any failed status) / ``TIMED_OUT`` after ``max_polls`` polls, with
    the failure sentence in ``error``. Equal rows are one entry."""
    st = F.upper(normalize(F.col(status_col)))
    seq = F.col(seq_col)
    counts = seq <= max_polls
    terminal = lambda c: F.coalesce((c == "COMPLETED") | c.isin(*FAILED_STATUSES), F.lit(False))
    agg = events.groupBy(key).agg(
        F.sort_array(F.collect_set(F.when(counts, F.struct(seq.alias("seq"), st.alias("status"))))).alias("_all"),
        F.min(F.when(counts & terminal(st), seq)).alias("_stop"),
        F.count_if(~counts).alias("ignored_rows"),
    )
    agg = agg.withColumn("status_history", F.filter("_all", lambda e: F.col("_stop").isNull() | (e["seq"] <= F.col("_stop"))))
    n = F.size("status_history")
    last = F.try_element_at(F.col("status_history"), F.lit(-1))["status"]
    agg = agg.withColumns({"history_length": n.cast("long"), "final_status": last})
    st = F.col("final_status")
    outcome = (F.when(st == "COMPLETED", F.lit("COMPLETED")).when(st.isin(*FAILED_STATUSES), F.lit("FAILED"))
               .when(F.col("history_length") > max_polls, F.lit("TIMED_OUT")).otherwise(F.lit("RUNNING")))
    agg = agg.withColumn("outcome", outcome)
    error = (F.when(F.col("outcome") == "FAILED", _fill(MSG_OPERATION_ENDED, id=F.col(key), st=st))
             .when(F.col("outcome") == "TIMED_OUT", _fill(MSG_OPERATION_TIMED_OUT, id=F.col(key), n=F.lit(max_polls))))
    return agg.select(key, (F.col("history_length") - 1).alias("poll_count"), "final_status", "outcome", "history_length",
                      "status_history", error.alias("error"), "ignored_rows")


def start_retry_rollup(events: DataFrame, key: str = "operation_id", attempt_col: str = "attempt",
                       ok_col: str = "ok", message_col: str = "message",
                       retries: int = START_RETRY_ATTEMPTS) -> DataFrame:
    """A3: start attempts of one operation. "Another bulk operation is running" rejections are
    retried up to ``retries`` times; a success or any other error ends the run at once.
    ``retry_history`` has the retried rejections, ``error`` the sentence of an exhausted run."""
    a = F.col(attempt_col)
    counts = a <= retries + 1
    ok = F.coalesce(F.col(ok_col), F.lit(False))
    conc = ~ok & F.coalesce(is_concurrent_message(F.col(message_col)), F.lit(False))
    e = events.withColumns({"_counts": counts, "_ok": ok, "_conc": conc, "_stop": counts & (ok | ~conc | (a >= retries + 1))})
    agg = e.groupBy(key).agg(
        _at_end(F.col("_stop"), F.when(F.col("_counts"), a), ok=F.col("_ok"), conc=F.col("_conc"), msg=F.col(message_col)).alias("_end"),
        F.min(F.when(F.col("_stop"), a)).alias("_first_stop"),
        F.sort_array(F.collect_set(F.when(F.col("_conc") & (a <= retries), F.struct(a.alias("attempt"), F.col(message_col).alias("message"))))).alias("_rejected"),
        F.count_if(~F.col("_counts")).alias("ignored_rows"),
    )
    end, open_ = F.col("_end"), F.col("_first_stop").isNull()
    history = F.filter("_rejected", lambda r: open_ | (r["attempt"] < F.col("_first_stop")))
    agg = agg.withColumn("retry_history", history)
    outcome = (F.when(open_, F.lit("PENDING"))
               .when(end["ok"], F.lit("STARTED"))
               .when(end["conc"], F.lit("EXHAUSTED"))
               .otherwise(F.lit("FAILED")))
    # an open run's latest rejection has not been retried yet
    retried = F.size("retry_history") - F.when(open_ & end["conc"], F.lit(1)).otherwise(F.lit(0))
    return agg.select(key, outcome.alias("outcome"), retried.cast("long").alias("start_retry_count"),
                      F.when(~end["ok"], end["msg"]).alias("last_error"), "retry_history",
                      F.when(outcome == "EXHAUSTED", _fill(MSG_START_EXHAUSTED, n=F.lit(retries))).alias("error"), "ignored_rows")


# --- L4: connection checks --------------------------------------------------------------

def _check(key: str, pos: int, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(key).alias("check_key"), F.lit(CHECK_LABELS[key]).alias("label"), F.lit(pos).alias("position"),
                    status.alias("status"), detail.alias("detail"))


def _duration(df: DataFrame) -> Column:
    return F.col("duration_ms").cast("long") if "duration_ms" in df.columns else F.lit(None).cast("long")


def check_rows(configs: DataFrame, connect: DataFrame, orders_probe: DataFrame, key: str = "config_id") -> DataFrame:
    """L4: per connection the ordered checks credential, reachable, apiVersion, ordersRead with
    PASS / FAIL / SKIP, from captured responses of the connect call and the orders call.

    ``configs``: key, accessToken, credential_error, shop_url, api_version, can_read_orders.
    ``connect`` / ``orders_probe``: key, status_code, body and, where captured, duration_ms, which
    the first check of a call that was made reports. Orders returned by the probe are
    the edges in its body ("1 order returned" for exactly one)."""
    c = classify_responses(connect.withColumn("attempt", F.lit(1)).withColumn("max_attempts", F.lit(1)),
                           data_type="struct<shop:struct<myshopifyDomain:string>>")
    c = c.select(key, F.col("status_code").alias("c_status"), F.col("ok").alias("c_ok"),
                 F.col("data.shop.myshopifyDomain").alias("c_domain"), _duration(connect).alias("c_ms"))
    o = classify_responses(orders_probe.withColumn("attempt", F.lit(1)).withColumn("max_attempts", F.lit(1)),
                           data_type="struct<orders:struct<edges:array<string>>>")
    edges = F.col("data.orders.edges")
    o = o.select(key, F.col("status_code").alias("o_status"), F.col("ok").alias("o_ok"),
                 F.col("graphql_messages").alias("o_msgs"), F.coalesce(F.size(edges), F.lit(0)).alias("o_count"),
                 _duration(orders_probe).alias("o_ms"))
    j = configs.join(c, key, "left").join(o, key, "left")
    cred_fail = F.coalesce(normalize(F.col("credential_error")),
                           F.when(normalize(F.col("accessToken")).isNull(), F.lit(MSG_NO_TOKEN)))
    skipped = F.lit("SKIP")
    not_tried = F.lit(MSG_NOT_ATTEMPTED)
    cs = F.coalesce(F.col("c_status").cast("int"), F.lit(0))
    disabled = F.coalesce(F.upper(normalize(F.col("can_read_orders"))) == "N", F.lit(False))
    pass_, fail = F.lit("PASS"), F.lit("FAIL")
    reach = (F.when(cred_fail.isNotNull(), _check("reachable", 2, skipped, not_tried))
             .when((cs == 404) | F.col("c_ok"), _check("reachable", 2, pass_,
                   F.when(F.col("c_ok"), F.coalesce(normalize(F.col("c_domain")), normalize(F.col("shop_url")))).otherwise(normalize(F.col("shop_url")))))
             .otherwise(_check("reachable", 2, fail, describe_failure(cs))))
    version = (F.when(cred_fail.isNotNull(), _check("apiVersion", 3, skipped, not_tried))
               .when(cs == 404, _check("apiVersion", 3, fail, _fill(MSG_VERSION_NOT_SERVED, v=normalize(F.col("api_version")))))
               .when(F.col("c_ok"), _check("apiVersion", 3, pass_, normalize(F.col("api_version"))))
               .otherwise(_check("apiVersion", 3, skipped, not_tried)))
    orders_detail = F.when(F.col("o_count") == 1, F.lit(MSG_ONE_ORDER)).otherwise(F.lit(MSG_NO_ORDERS))
    reads = (F.when(cred_fail.isNotNull() | (cs == 404) | ~F.coalesce(F.col("c_ok"), F.lit(False)),
                    _check("ordersRead", 4, skipped, not_tried))
             .when(disabled, _check("ordersRead", 4, skipped, F.lit(MSG_ORDERS_DISABLED)))
             .when(F.col("o_ok"), _check("ordersRead", 4, pass_, orders_detail))
             .when(missing_scope(F.col("o_msgs")), _check("ordersRead", 4, fail, F.lit(MSG_MISSING_SCOPE)))
             .otherwise(_check("ordersRead", 4, fail, describe_failure(F.col("o_status")))))
    cred = F.when(cred_fail.isNotNull(), _check("credential", 1, fail, cred_fail)).otherwise(
        _check("credential", 1, pass_, F.lit(None).cast("string")))
    checks = j.select(key, "c_ms", "o_ms", F.explode(F.array(cred, reach, version, reads)).alias("c")).select(key, "c.*", "c_ms", "o_ms")
    took = (F.when(F.col("status") == "SKIP", F.lit(None).cast("long"))
            .when(F.col("check_key") == "reachable", F.col("c_ms")).when(F.col("check_key") == "ordersRead", F.col("o_ms")))
    return checks.withColumn("duration_millis", took).drop("c_ms", "o_ms")
