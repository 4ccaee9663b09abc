from orderlens.operators import apilog

COST = '{"data":{"x":1},"extensions":{"cost":{"requestedQueryCost":12,"actualQueryCost":4,"throttleStatus":{"maximumAvailable":1000,"currentlyAvailable":996,"restoreRate":50}}}}'
THROTTLED = '{"errors":[{"message":"Throttled","extensions":{"code":"THROTTLED"}}],"extensions":{"cost":{"requestedQueryCost":150,"throttleStatus":{"currentlyAvailable":50,"restoreRate":50}}}}'
DENIED = '{"errors":[{"message":"Access denied for orders field."}]}'
BLANK = '{"errors":[{"message":"  "}],"data":{}}'


def classify(spark, rows):
    df = spark.createDataFrame(rows, "rid string, attempt int, max_attempts int, status_code int, body string")
    return {r["rid"]: r for r in apilog.classify_responses(df).collect()}


def test_classify(spark):
    c = classify(spark, [("ok", 1, 2, 200, COST), ("500a", 1, 2, 500, ""), ("500b", 2, 2, 500, ""),
                         ("json", 1, 2, 200, "not-json"), ("arr", 1, 2, 200, "[1]"), ("den", 1, 2, 200, DENIED),
                         ("thr", 1, 2, 200, THROTTLED), ("blank", 1, 2, 200, BLANK), ("404", 1, 2, 404, "")])
    assert c["ok"]["ok"] and c["ok"]["requested_cost"] == "12"
    assert not c["500a"]["ok"] and c["500a"]["retryable"] and not c["500b"]["retryable"]
    assert c["500a"]["error_text"] == "Shopify GraphQL request failed with HTTP 500."
    assert c["json"]["error_text"] == "Shopify GraphQL response was not valid JSON." and not c["json"]["retryable"]
    assert c["arr"]["failure"] == "json"
    assert c["den"]["error_text"] == "Shopify GraphQL error: Access denied for orders field." and not c["den"]["throttled"]
    assert c["thr"]["throttled"] and c["thr"]["retryable"]
    assert c["blank"]["ok"]
    assert not c["404"]["retryable"]


def test_retry_plan(spark):
    rows = [("q1", 1, 200, THROTTLED, "query Q { a }"), ("q1", 2, 200, COST, "query Q { a }"),
            ("m1", 1, 500, "", "# c\nmutation M { a }"), ("m1", 2, 200, COST, "# c\nmutation M { a }"),
            ("q2", 1, 429, "", "query Q { a }"), ("q2", 2, 429, "", "query Q { a }"), ("q2", 3, 200, COST, "query Q { a }")]
    df = spark.createDataFrame(rows, "request_id string, attempt int, status_code int, body string, query string")
    p = {r["request_id"]: r for r in apilog.retry_plan(df).collect()}
    assert (p["q1"]["attempts_used"], p["q1"]["final_ok"], p["q1"]["planned_delay_ms"]) == (2, True, 2000)
    assert (p["m1"]["attempts_used"], p["m1"]["final_ok"]) == (1, False)
    assert (p["q2"]["attempts_used"], p["q2"]["final_ok"], p["q2"]["planned_delay_ms"]) == (2, False, 1000)


def test_download_outcomes(spark):
    df = spark.createDataFrame([("d1", 1, 500), ("d1", 2, 200), ("d2", 1, 404), ("d3", 1, 503), ("d3", 2, 503), ("d3", 3, 429),
                                ("d3", 4, 200)], "download_id string, attempt int, status_code int")
    o = {r["download_id"]: r for r in apilog.download_outcomes(df).collect()}
    assert (o["d1"]["ok"], o["d1"]["attempts_used"]) == (True, 2)
    assert (o["d2"]["ok"], o["d2"]["retryable"], o["d2"]["download_attempt_count"]) == (False, False, 1)
    assert (o["d3"]["ok"], o["d3"]["retryable"], o["d3"]["attempts_used"]) == (False, True, 3)
    assert o["d3"]["error"] == "Shopify bulk operation result download failed with HTTP 429."


def test_operation_rollup(spark):
    rows = [("op1", 0, "CREATED"), ("op1", 1, "RUNNING"), ("op1", 2, "COMPLETED"), ("op1", 3, "RUNNING"),
            ("op2", 0, "RUNNING"), ("op2", 1, "canceled")] + [("op3", i, "RUNNING") for i in range(6)]
    df = spark.createDataFrame(rows, "operation_id string, seq int, status string")
    r = {x["operation_id"]: x for x in apilog.operation_rollup(df, max_polls=4).collect()}
    assert (r["op1"]["poll_count"], r["op1"]["outcome"]) == (2, "COMPLETED")
    assert (r["op2"]["final_status"], r["op2"]["outcome"]) == ("CANCELED", "FAILED")
    assert (r["op3"]["poll_count"], r["op3"]["outcome"]) == (4, "TIMED_OUT")


def test_start_retries(spark):
    busy = "A bulk operation for this app and shop is already in progress."
    rows = [("a", i, False, busy) for i in range(1, 4)] + [("a", 4, True, None)]
    rows += [("b", i, False, busy) for i in range(1, 5)]
    rows += [("c", 1, False, busy), ("c", 2, False, "Bulk queries cannot use that field.")]
    df = spark.createDataFrame(rows, "operation_id string, attempt int, ok boolean, message string")
    r = {x["operation_id"]: x for x in apilog.start_retry_rollup(df, retries=3).collect()}
    assert (r["a"]["outcome"], r["a"]["start_retry_count"]) == ("STARTED", 3)
    assert (r["b"]["outcome"], r["b"]["start_retry_count"]) == ("EXHAUSTED", 3)
    assert (r["c"]["outcome"], r["c"]["last_error"]) == ("FAILED", "Bulk queries cannot use that field.")


def test_check_rows(spark):
    confs = spark.createDataFrame([
        ("none", None, None, "https://a.myshopify.com", "2025-10", "Y"),
        ("v404", "t", None, "https://b.myshopify.com", "1999-01", "Y"),
        ("401", "t", None, "https://c.myshopify.com", "2025-10", "Y"),
        ("scope", "t", None, "https://d.myshopify.com", "2025-10", None),
        ("off", "t", None, "https://e.myshopify.com", "2025-10", "N"),
        ("good", "t", None, "https://f.myshopify.com", "2025-10", "Y"),
    ], "config_id string, accessToken string, credential_error string, shop_url string, api_version string, can_read_orders string")
    shop = '{"data":{"shop":{"myshopifyDomain":"x.myshopify.com"}}}'
    connect = spark.createDataFrame([("v404", 404, ""), ("401", 401, ""), ("scope", 200, shop), ("off", 200, shop), ("good", 200, shop)],
                                    "config_id string, status_code int, body string")
    probe = spark.createDataFrame([("scope", 200, '{"errors":[{"message":"Access denied for orders field."}]}', 0),
                                   ("good", 200, '{"data":{"orders":{"edges":[{"node":{"id":"1"}}]}}}', 1)],
                                  "config_id string, status_code int, body string, order_count int")
    rows = apilog.check_rows(confs, connect, probe).collect()
    got = {(r["config_id"], r["check_key"]): (r["status"], r["detail"]) for r in rows}
    assert got[("none", "credential")] == ("FAIL", "No access token is stored for this configuration.")
    assert got[("none", "ordersRead")] == ("SKIP", "Not attempted.")
    assert got[("v404", "reachable")][0] == "PASS" and got[("v404", "apiVersion")][0] == "FAIL"
    assert got[("401", "reachable")] == ("FAIL", "The access token was rejected (HTTP 401).")
    assert got[("scope", "ordersRead")] == ("FAIL", "The token is missing the read_orders scope.")
    assert got[("off", "ordersRead")] == ("SKIP", "This configuration is not enabled for order reads.")
    assert got[("good", "ordersRead")] == ("PASS", "1 order returned")
    assert all(len([r for r in rows if r["config_id"] == c]) == 4 for c in ["none", "good"])


def test_string_errors_and_edges(spark):
    c = classify(spark, [("s", 1, 2, 200, '{"errors":["plain failure", "  "]}'),
                         ("m", 1, 2, 200, '{"errors":[{"message":"x","extensions":{"code":"MAX_COST_EXCEEDED"}}]}')])
    assert c["s"]["error_text"] == "Shopify GraphQL error: plain failure" and not c["s"]["throttled"]
    assert c["m"]["throttled"] and c["m"]["retryable"]


def test_errors_that_are_no_list_and_trailing_text(spark):
    bodies = {"text": '{"errors":"Not Found"}', "object": '{"errors":{"message":"x"}}', "number": '{"errors":7}', "empty": '{"errors":[]}',
              "null": '{"errors":null,"data":{"a":1}}', "blank": '{"errors":""}', "trail": '{"data":{"a":1}} trailing', "two": '{"a":1}{"b":2}'}
    c = classify(spark, [(k, 1, 2, 200, b) for k, b in bodies.items()] + [("last", 2, 2, 200, bodies["text"])])
    for k in ("text", "object", "number"):
        assert not c[k]["ok"] and c[k]["retryable"] and c[k]["failure"] == "shape"
        assert c[k]["error_text"] == "Shopify GraphQL request failed before a valid response was received."
    assert not c["last"]["retryable"]
    assert c["empty"]["ok"] and c["blank"]["ok"] and c["null"]["ok"] and c["null"]["data"] == '{"a":1}'
    assert c["trail"]["failure"] == "json" and c["two"]["failure"] == "json"


def test_cost_block_is_returned(spark):
    r = classify(spark, [("ok", 1, 2, 200, COST)])["ok"]
    assert (r["data"], r["actual_cost"], r["maximum_available"], r["currently_available"]) == ('{"x":1}', "4", "1000", "996")


def test_histories_and_ignored_rows(spark):
    rows = [("a", 0, "created"), ("a", 1, "RUNNING"), ("a", 1, "RUNNING"), ("a", 2, "FAILED"), ("a", 3, "COMPLETED")]
    rows += [("b", i, "RUNNING") for i in range(5)] + [("b", 5, "COMPLETED")]
    df = spark.createDataFrame(rows, "operation_id string, seq int, status string")
    r = {x["operation_id"]: x for x in apilog.operation_rollup(df, max_polls=4).collect()}
    assert [(h["seq"], h["status"]) for h in r["a"]["status_history"]] == [(0, "CREATED"), (1, "RUNNING"), (2, "FAILED")]
    assert r["a"]["error"] == "Shopify bulk operation a ended with status FAILED."
    assert (r["b"]["outcome"], r["b"]["ignored_rows"], len(r["b"]["status_history"])) == ("TIMED_OUT", 1, 5)
    busy = "A bulk operation for this app and shop is already in progress."
    df = spark.createDataFrame([("a", i, False, busy) for i in range(1, 6)], "operation_id string, attempt int, ok boolean, message string")
    x = apilog.start_retry_rollup(df, retries=3).first()
    assert (x["outcome"], x["start_retry_count"], [h["attempt"] for h in x["retry_history"]], x["ignored_rows"]) == ("EXHAUSTED", 3, [1, 2, 3], 1)
    assert "after 3 retry attempt(s)" in x["error"]


def test_a_hot_request_is_one_row(spark):
    from pyspark.sql import functions as F
    hot = spark.range(1, 20001).select(F.lit("hot").alias("request_id"), F.col("id").cast("int").alias("attempt"), F.lit(500).alias("status_code"),
                                       F.lit("").alias("body"), F.lit("query Q { a }").alias("query"))
    r = apilog.retry_plan(hot, max_attempts=3).first()
    assert (r["attempts_used"], r["final_ok"], r["ignored_rows"], r["unfinished"]) == (3, False, 19997, False)


def test_check_labels_and_durations(spark):
    conf = spark.createDataFrame([("c", "t", None, "https://a.myshopify.com", "2025-10", "Y")],
                                 "config_id string, accessToken string, credential_error string, shop_url string, api_version string, can_read_orders string")
    call = spark.createDataFrame([("c", 200, '{"data":{}}', 41)], "config_id string, status_code int, body string, duration_ms long")
    rows = {r["check_key"]: (r["label"], r["duration_millis"]) for r in apilog.check_rows(conf, call, call.drop("duration_ms")).collect()}
    assert rows == {"credential": ("Credential readable", None), "reachable": ("Shop reachable", 41),
                    "apiVersion": ("API version supported", None), "ordersRead": ("Orders readable", None)}
