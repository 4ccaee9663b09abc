from pyspark.sql import functions as F

from orderlens.operators import exchange as ex

START, END = 1785196800000, 1785283200000  # [2026-07-28, 2026-07-29)
RET = "array<struct<id:string,name:string,status:string,createdAt:string,exchangeLineItems:array<struct<id:string>>>>"


def orders(spark, rows):
    return spark.createDataFrame(rows, f"legacyResourceId string, name string, returns {RET}")


def test_first_in_window_and_counts(spark):
    x = [("x1",)]
    rows = [
        ("1", "#1", [("r1", "R1", "OPEN", "2026-07-28T00:00:00Z", x)]),                       # start edge: in
        ("2", "#2", [("r2", "R2", "OPEN", "2026-07-29T00:00:00Z", x)]),                       # end edge: out
        ("3", "#3", [("r3", "R3", "OPEN", "2026-07-27T23:59:59Z", x)]),                       # before
        ("4", "#4", [("r4", "R4", "OPEN", "2026-07-28T10:00:00Z", [])]),                      # plain return
        ("5", "#5", [("r5", "R5", " canceled ", "2026-07-28T10:00:00Z", x),                   # cancelled skipped
                     ("r6", "R6", "CANCELLED", "2026-07-28T11:00:00Z", x)]),                  # other spelling counts
        ("6", "#6", [("a", "A", "OPEN", "2026-07-20T00:00:00Z", x), ("b", "B", "OPEN", "2026-07-28T05:00:00Z", x),
                     ("c", "C", "OPEN", "2026-07-28T01:00:00Z", x)]),                         # list order wins
        ("7", "#7", [("r7", "R7", "OPEN", "bad-date", x)]),
    ]
    df = orders(spark, rows).select("legacyResourceId", ex.first_in_window_return(F.col("returns"), START, END).alias("h"),
                                     ex.count_exchange_returns(F.col("returns")).alias("n"))
    got = {r["legacyResourceId"]: (r["h"]["id"] if r["h"] else None, r["n"]) for r in df.collect()}
    assert got == {"1": ("r1", 1), "2": (None, 1), "3": (None, 1), "4": (None, 0), "5": ("r6", 1), "6": ("b", 3), "7": (None, 1)}


def test_child_shapes(spark):
    df = spark.createDataFrame([('[{"id":"1","sku":"S","quantity":"2"}, 5]',), ('{"nodes":[{"id":"2"}]}',), ('"x"',), (None,)],
                               "t string")
    items, shape = ex.normalize_child_shape(F.col("t"))
    got = [(r["s"], [i["id"] for i in r["i"]]) for r in df.select(shape.alias("s"), items.alias("i")).collect()]
    assert got == [("list", ["1"]), ("connection", ["2"]), (None, []), (None, [])]


def test_exchange_state_lookup(spark):
    o = spark.createDataFrame([
        ("gid://shopify/Order/10", "10", "RETURNED", ("185.71", "USD")),
        ("gid://shopify/Order/11", None, "NO_RETURN", ("bad", "USD")),
    ], "id string, legacyResourceId string, returnStatus string, money struct<amount:string,currencyCode:string>")
    o = o.withColumn("currentTotalPriceSet", F.struct(F.col("money").alias("shopMoney"))).drop("money")
    item = "array<struct<id:string,quantity:string,lineItems:array<struct<id:string,sku:string,quantity:string>>>>"
    r = spark.createDataFrame([
        ("gid://shopify/Order/10", 1, "ret1", "CANCELED", "2026-07-28T00:00:00Z", [("e1", "1", [("l1", "2511-200G-186-G", "1")])]),
        ("gid://shopify/Order/10", 2, "ret2", "CLOSED", "2026-07-29T00:00:00Z", []),
    ], f"order_id string, pos int, id string, status string, createdAt string, exchangeLineItems {item}").withColumn("name", F.lit("n"))
    req = spark.createDataFrame([("10",), ("gid://shopify/Order/10",), ("11",), ("",)], "requested_id string")
    st = {x["order_key"]: x for x in ex.exchange_state_lookup(req, o, r, ["pos"]).collect()}
    assert set(st) == {"10", "11"}
    assert str(st["10"]["currentTotalAmount"]) == "185.7100" and st["11"]["currentTotalAmount"] is None
    assert [e["returnId"] for e in st["10"]["exchanges"]] == ["ret1"]
    assert st["10"]["exchanges"][0]["exchangeLineItems"][0]["lineItems"][0]["sku"] == "2511-200G-186-G"
    empty = spark.createDataFrame([(" ",)], "requested_id string")
    assert ex.state_lookup_ok(empty).first()["ok"] is False


def test_sweep_cap_and_truncated(spark):
    rows = [(f"gid://shopify/Order/{i}", str(i), f"#{i}", "RETURNED", f"2026-07-28T0{i % 10}:00:00Z") for i in range(25)]
    o = spark.createDataFrame(rows, "id string, legacyResourceId string, name string, returnStatus string, updatedAt string")
    x = [("x",)]
    r = spark.createDataFrame([(f"gid://shopify/Order/{i}", 1, f"r{i}", "R", "OPEN", "2026-07-28T01:00:00Z", x) for i in range(25)],
                              "order_id string, pos int, id string, name string, status string, createdAt string, exchangeLineItems array<struct<id:string>>")
    full, trunc = ex.sweep_exchanges(o, r, ["pos"], START, END)
    assert full.count() == 25 and trunc.first()["truncated"] is False
    capped, trunc = ex.sweep_exchanges(o, r, ["pos"], START, END, max_pages=2, page_size=10)
    assert capped.count() == 20 and trunc.first()["truncated"] is True
    exact, trunc = ex.sweep_exchanges(o, r, ["pos"], START, END, max_pages=5, page_size=5)
    assert exact.count() == 25 and trunc.first()["truncated"] is False


def returns_of(spark, rows, items="array<struct<id:string>>"):
    return spark.createDataFrame(rows, f"order_id string, pos int, id string, name string, status string, createdAt string, exchangeLineItems {items}")


def one_order(spark, n="1"):
    return spark.createDataFrame([(n, n, f"#{n}", "2026-07-28T00:00:00Z", "RETURNED")],
                                 "id string, legacyResourceId string, name string, updatedAt string, returnStatus string")


def test_every_return_of_an_order_is_seen(spark):
    rows = [("1", i, f"r{i}", f"R{i}", "OPEN", "2026-07-28T05:00:00Z" if i > 10 else "2026-07-01T00:00:00Z", [("x",)]) for i in range(1, 13)]
    r = returns_of(spark, rows)
    hit = ex.sweep_exchanges(one_order(spark), r, ["pos"], START, END)[0].first()
    assert (hit["returnId"], hit["exchangeReturnCount"]) == ("r11", 12)
    nested = ex.nest_returns(one_order(spark), r, ["pos"]).first()
    assert [x["id"] for x in nested["returns"]] == [f"r{i}" for i in range(1, 13)]
    cut = ex.nest_returns(one_order(spark), r, ["pos"], cap=10).first()
    assert len(cut["returns"]) == 10 and cut["returnsTruncated"]


def test_failed_lookups_yield_nothing(spark):
    r = returns_of(spark, [("1", 1, "r1", "R1", "OPEN", "2026-07-28T05:00:00Z", [("x",)])])
    for ok in (True, False):
        status = spark.createDataFrame([(ok,)], "ok boolean")
        assert ex.sweep_exchanges(one_order(spark), r, ["pos"], START, END, status=status)[0].count() == int(ok)


def test_state_reads_both_child_shapes_without_a_cap(spark):
    import json
    lines = [{"id": str(i), "sku": f"s{i}", "quantity": "1"} for i in range(25)]
    texts = [json.dumps(lines), json.dumps({"nodes": lines}), '{"edges":[]}']
    rows = [("gid://shopify/Order/1", i, f"r{i}", "R", "OPEN", "2026-07-28T05:00:00Z", [("x", "1", t)]) for i, t in enumerate(texts)]
    r = returns_of(spark, rows, "array<struct<id:string,quantity:string,lineItems:string>>")
    o = spark.createDataFrame([("gid://shopify/Order/1", "1", "RETURNED", (("5", "USD"),))],
                              "id string, legacyResourceId string, returnStatus string, currentTotalPriceSet struct<shopMoney:struct<amount:string,currencyCode:string>>")
    req = spark.createDataFrame([("1",)], "requested_id string")
    got = ex.exchange_state_lookup(req, o, r, ["pos"]).first()["exchanges"]
    assert [(e["exchangeLineItems"][0]["shape"], len(e["exchangeLineItems"][0]["lineItems"])) for e in got] == [("list", 25), ("connection", 25), (None, 0)]
    failed = spark.createDataFrame([(False,)], "ok boolean")
    assert ex.exchange_state_lookup(req, o, r, ["pos"], status=failed).count() == 0
    assert not ex.state_lookup_ok(req, status=failed).first()["ok"] and ex.state_lookup_ok(req).first()["ok"]
