from pyspark.sql import functions as F

from orderlens.operators import lookup


def primary(spark, ids):
    return spark.createDataFrame([(f"gid://shopify/Order/{i}",) for i in ids], "id string")


def test_split_found_missing(spark):
    req = spark.createDataFrame([("6902423453827",), (" 1111 ",), ("gid://shopify/Order/2222",), ("1111",), ("",),
                                 ("gid://shopify/Order/9999",)], "requested_id string")
    s = lookup.split_found_missing(req, primary(spark, [6902423453827, 2222]))
    found = sorted(r["requested_id"] for r in lookup.found_ids(s).collect())
    missing = sorted(r["requested_id"] for r in lookup.missing_ids(s).collect())
    assert found == ["6902423453827", "gid://shopify/Order/2222"]
    assert missing == ["1111", "gid://shopify/Order/9999"]
    # invariant: found + missing = distinct non-blank requested ids
    assert len(found) + len(missing) == 4


def test_failed_lookup_classifies_nothing(spark):
    req = spark.createDataFrame([("1",)], "requested_id string")
    assert lookup.split_found_missing(req, primary(spark, [1]), lookup_ok=False).count() == 0


def test_empty_requests(spark):
    req = spark.createDataFrame([], "requested_id string")
    assert lookup.split_found_missing(req, primary(spark, [1])).count() == 0


def test_batches_260(spark):
    req = spark.createDataFrame([(str(i), i) for i in range(260)] + [("5", 999)], "requested_id string, position long")
    b = lookup.batch_ids(req, size=250)
    sizes = {r["batch_no"]: r["c"] for r in b.groupBy("batch_no").agg(F.count("*").alias("c")).collect()}
    assert sizes == {0: 250, 1: 10}
    first = b.filter("id_no = 1").first()
    assert first["canonical_id"] == "gid://shopify/Order/0"
    state = lookup.batch_ids(req, size=50, state_form=True)
    assert state.agg(F.max("batch_no")).first()[0] == 5


def test_orders_by_id_and_reconcile(spark):
    orders = primary(spark, [1, 2, 3])
    ids = spark.createDataFrame([("1",), ("gid://shopify/Order/3",), ("9",), (" ",)], "requested_id string")
    assert sorted(r["id"] for r in lookup.orders_by_id(orders, ids).collect()) == ["gid://shopify/Order/1", "gid://shopify/Order/3"]
    left = spark.createDataFrame([("1",), ("2",), ("4",)], "left_id string")
    right = spark.createDataFrame([("gid://shopify/Order/1",), ("gid://shopify/Order/5",)], "right_id string")
    rec = {r["canonical_id"]: r["state"] for r in lookup.reconcile_ids(left, right).collect()}
    assert rec == {"gid://shopify/Order/1": "matched", "gid://shopify/Order/2": "missing_right",
                   "gid://shopify/Order/4": "missing_right", "gid://shopify/Order/5": "missing_left"}
    conf = {r["canonical_id"]: r["confirmed_missing"] for r in lookup.confirm_missing(lookup.reconcile_ids(left, right), orders).collect()}
    assert conf == {"gid://shopify/Order/2": False, "gid://shopify/Order/4": True}


def test_number_rows_and_hot_group(spark):
    from orderlens.operators.rownum import number_rows, top_n_per_group
    df = spark.range(0, 30000).withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7))
    for parts in (None, 5):
        n = number_rows(df, ["id"], ["g"], out="rn", num_partitions=parts)
        bad = n.groupBy("g").agg(F.count("*").alias("c"), F.max("rn").alias("mx"), F.countDistinct("rn").alias("d")) \
               .filter("c != mx or c != d")
        assert bad.count() == 0
    top = top_n_per_group(df, ["g"], [F.col("id").desc()], 3, out="pos")
    got = sorted((r["g"], r["pos"], r["id"]) for r in top.collect())
    grp = lambda i: 0 if i % 3 == 0 else i % 7
    for g in range(7):
        expect = sorted((i for i in range(30000) if grp(i) == g), reverse=True)[:3]
        assert [x[2] for x in got if x[0] == g] == expect
