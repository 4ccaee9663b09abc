"""Clustered pages, config tables by tenant, sweeps kept up to date, bucketed orders, id digests."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from orderlens.functions.ids import ORDER_GID_PREFIX
from orderlens.operators import configs as cfg, exchange as ex, lookup
from orderlens.operators.paging import encode_cursor
from orderlens.plans.spec import ReadSpec, read_orders
from orderlens.session import ensure_checkpoint_dir, scratch
from orderlens.sinks import clustered, config_table, sweep_state
from orderlens.sources import adapters as ad

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def whole_plans(spark):
    """Plans print their pushed filters whole."""
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- pages -----------------------------------------------------------------------------------

ORDERS = "id string, legacyResourceId string, name string, createdAt string, updatedAt string, processedAt string, status string"


def some_orders(spark, n=900):
    rnd = random.Random(4)
    rows = []
    for k in range(n):
        day = None if k % 31 == 0 else f"2026-{1 + k % 9:02d}-{1 + rnd.randrange(28):02d}T{k % 24:02d}:00:00Z"
        rows.append((f"{ORDER_GID_PREFIX}{10000 + k}", str(k), f"#{k}", day, "2026-12-01T00:00:00Z", day, "open" if k % 40 else "closed"))
    return spark.createDataFrame(rows, ORDERS).repartition(4)


def pages(read, **spec):
    """All pages one after another: ids, and the number of files of each page."""
    ids, files, after = [], [], None
    for _ in range(100):
        plan = read(ReadSpec(fields=["name"], page_size=60, after=after, **spec))
        rows = plan.df.collect()
        ids += [r["id"] for r in rows]
        files.append(len(plan.page.probe.inputFiles()))
        info = plan.page.info().first()
        if not info["hasNextPage"]:
            return ids, files
        after = info["endCursor"]
    raise AssertionError("the pages do not end")


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("filters", [{}, {"status": "closed"}])
def test_clustered_pages_are_the_plain_ones(spark, tmpdir_path, reverse, filters):
    orders, path = some_orders(spark), os.path.join(tmpdir_path, "c")
    # an order by creation needs a filter on it; without one the update time orders
    orders = orders.withColumn("updatedAt", F.col("createdAt"))
    clustered.write_clustered(orders, path, "UPDATED_AT", file_rows=50)
    plain, _ = pages(lambda s: read_orders(orders, s), filters=filters, reverse=reverse)
    got, files = pages(lambda s: clustered.read_clustered_page(spark, path, s), filters=filters, reverse=reverse)
    assert got == plain and len(set(got)) == len(got) == (23 if filters else 900)
    total = len(spark.read.parquet(f"{path}/data").inputFiles())
    assert total >= 18
    if not filters and not reverse:
        assert max(files) <= 4  # a page of 61 rows spans at most three files of 50


def test_a_deep_page_reads_few_files_with_the_bound(spark, tmpdir_path):
    orders, path = some_orders(spark).filter("createdAt is not null"), os.path.join(tmpdir_path, "c")
    clustered.write_clustered(orders, path, "CREATED_AT", file_rows=50)
    spec = ReadSpec(fields=["name"], filters={"createdAtFrom": "2026-01-01T00:00:00Z"}, page_size=20,
                    after=encode_cursor("2026-08-15T12:00:00Z", f"{ORDER_GID_PREFIX}10400"))
    plan = clustered.read_clustered_page(spark, path, spec)
    assert [r["id"] for r in plan.df.collect()] == [r["id"] for r in read_orders(orders, spec).df.collect()]
    text = plan_of(plan.page.probe)
    assert len(plan.page.probe.inputFiles()) <= 2 and "GreaterThanOrEqual(_ts_createdAt,2026-08-15" in text
    other = ReadSpec(fields=["name"], filters={"processedAtFrom": "2026-01-01T00:00:00Z"}, page_size=20)
    assert [r["id"] for r in clustered.read_clustered_page(spark, path, other).df.collect()] == [r["id"] for r in read_orders(orders, other).df.collect()]


def test_an_empty_clustered_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "c")
    clustered.write_clustered(some_orders(spark).limit(0), path)
    assert clustered.read_clustered_page(spark, path, ReadSpec()).df.count() == 0


@pytest.mark.parametrize("name", ["orders_page", "orders_status", "orders_sorted_desc", "orders_page_info"])
def test_no_exchange_under_a_page(spark, name):
    """Where nothing of the line items is asked for, a page is a scan and a top-k."""
    text = plan_of(E.queries()[name](spark, SF))
    assert "TakeOrderedAndProject" in text
    if name in ("orders_page_info", "orders_sorted_desc"):
        assert "hashpartitioning" not in text
    if name == "orders_page_info":
        assert "Or(GreaterThanOrEqual(o_orderdate,1996-03-01T00:00)" in text


# --- config tables -----------------------------------------------------------------------------

UPDATES = ("config_id string, description string, shop_api_url string, api_version string, time_zone string, access_token string, "
           "is_active string, can_read_orders string, position int")


def config_files(path):
    return {os.path.join(os.path.basename(d), f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_saves_rewrite_one_tenant(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "configs")
    row = lambda i, t: (i, "d", t, "u", "https://a.myshopify.com", "2025-10", None, "tok", "Y", "Y")
    table = spark.createDataFrame([row("a1", "T1"), row("a2", "T1"), row("b1", "T 2/x"), row("b2", "T 2/x"), row("free", None), row("free2", " ")],
                                  ", ".join(f"{c} string" for c in cfg.CONFIG_COLUMNS))
    config_table.write_configs(table, path)
    before = config_files(path)
    updates = spark.createDataFrame([("a1", "new", "https://n.myshopify.com", "2026-01", "", "", "Y", "Y", 1), ("b1", "x", "https://n.myshopify.com", "2026-01", "", "", "Y", "Y", 2),
                                     ("free", "taken", "https://n.myshopify.com", "2026-01", "", "", "Y", "Y", 3), ("new", "n", "https://n.myshopify.com", "2026-01", "", "t", "Y", "Y", 4)], UPDATES)
    stored = config_table.read_configs(spark, path)
    want, outcomes = cfg.merge_configs(stored, updates, "T1", "me", "position")
    want, told = sorted(map(str, want.collect())), sorted(map(str, outcomes.collect()))
    got = config_table.save_configs(spark, path, updates, "T1", "me", "position")
    assert sorted(map(str, got.collect())) == told
    assert sorted(map(str, config_table.read_configs(spark, path).collect())) == want
    after = config_files(path)
    other = {f for f in before if f.startswith("tenant_id=T 2")}
    assert other and other <= after and not {f for f in before & after if f.startswith("tenant_id=T1")}
    # a rejected save touches nothing
    config_table.save_configs(spark, path, updates.filter("config_id = 'b1'"), "T1", "me", "position")
    assert config_files(path) == after
    with pytest.raises(ValueError):
        config_table.save_configs(spark, path, updates, " ", "me", "position")
    # removals: the other tenant's files stay, an emptied partition goes
    ids = spark.createDataFrame([("a1",), ("a2",), ("free",), ("new",), ("b1",), ("zzz",)], "config_id string")
    removed = {r["requested_id"]: r["deleted"] for r in config_table.remove_configs(spark, path, ids, "T1").collect()}
    assert removed == {"a1": True, "a2": True, "free": True, "new": True, "b1": False, "zzz": False}
    assert other <= config_files(path) and not any(f.startswith("tenant_id=T1") for f in config_files(path))
    assert sorted(r["config_id"] for r in config_table.read_configs(spark, path).collect()) == ["b1", "b2", "free2"]


# --- sweeps ------------------------------------------------------------------------------------

START, END = 1775001600000, 1777593600000  # April 2026


def sweep_input(spark, days):
    """Orders as (number, day of the last update, status of returns); each has one exchange in April."""
    orders = spark.createDataFrame([(n, f"{ORDER_GID_PREFIX}{n}", str(n), f"#{n}", status, f"2026-{day}T10:00:00Z", f"2026-{day}") for n, day, status in days],
                                   "order_key long, id string, legacyResourceId string, name string, returnStatus string, updatedAt string, day string")
    returns = spark.createDataFrame([(n, f"{ORDER_GID_PREFIX}{n}", f"r{n}", f"R{n}", "CLOSED", "2026-04-10T00:00:00Z", 1) for n in range(40)],
                                    "order_number long, order_id string, id string, name string, status string, createdAt string, position int")
    items = F.array(F.struct(F.lit("x").alias("id"), F.lit("1").alias("quantity")))
    return orders, returns.withColumn("exchangeLineItems", items)


def put(orders, path, mode="append"):
    orders.repartition(1).write.mode(mode).partitionBy("day").parquet(path)


def test_a_kept_sweep_equals_the_whole_one(spark, tmpdir_path):
    path, state = os.path.join(tmpdir_path, "orders"), os.path.join(tmpdir_path, "state")

    def update(returns):
        rows, swept = sweep_state.update_sweep(spark, path, "day", returns, ["position"], START, END, state, "april", keys=("order_key", "order_number"))
        return sorted(map(tuple, rows.collect())), swept

    def whole(returns):
        table = spark.read.parquet(path)
        rows, _ = ex.sweep_exchanges(table, returns, ["position"], START, END, keys=("order_key", "order_number"))
        return sorted(map(tuple, rows.select(*sweep_state.COLUMNS).collect()))

    first, returns = sweep_input(spark, [(1, "04-02", "RETURNED"), (2, "04-02", "NO_RETURN"), (3, "04-05", "RETURNED"), (4, "03-30", "RETURNED")])
    put(first, path)
    rows, swept = update(returns)
    assert [r[0] for r in rows] == ["1", "3"] and swept == ["2026-04-02", "2026-04-05"] and rows == whole(returns)
    assert update(returns) == (rows, [])  # nothing has changed, nothing is swept
    second, _ = sweep_input(spark, [(5, "04-06", "RETURNED"), (6, "04-02", "RETURNED")])  # a new day, and a late row of an old one
    put(second, path)
    rows, swept = update(returns)
    assert [r[0] for r in rows] == ["1", "3", "5", "6"] and swept == ["2026-04-02", "2026-04-06"] and rows == whole(returns)
    # order 3 is updated again: it leaves its day, which is emptied, for another
    import shutil
    shutil.rmtree(os.path.join(path, "day=2026-04-05"))
    third, _ = sweep_input(spark, [(3, "04-07", "NO_RETURN")])
    put(third, path)
    spark.catalog.refreshByPath(path)
    rows, swept = update(returns)
    assert [r[0] for r in rows] == ["1", "5", "6"] and swept == ["2026-04-05", "2026-04-07"] and rows == whole(returns)


# --- ids ---------------------------------------------------------------------------------------

def test_equal_id_sets_meet_in_no_join(spark):
    ids = [str(k) for k in range(5000)]
    left = spark.createDataFrame([(i,) for i in ids], "left_id string")
    right = spark.createDataFrame([(ORDER_GID_PREFIX + i,) for i in reversed(ids)] + [(None,), (" ",)], "right_id string").repartition(7)
    assert lookup.changed_buckets(left, right).count() == 0 and lookup.id_differences(left, right).count() == 0
    # ids themselves are never dealt out for the digests: only buckets are
    text = plan_of(lookup.id_digests(left, "left_id"))
    dealt = [line for line in text.splitlines() if "Exchange" in line]
    assert len(dealt) == 1 and "hashpartitioning(_groupingexpression" in dealt[0] and "partial_sum" in text
    one = right.filter(F.col("right_id") != ORDER_GID_PREFIX + "77").union(spark.createDataFrame([("x1",)], "right_id string"))
    assert lookup.changed_buckets(left, one).count() == 2
    assert sorted(map(tuple, lookup.id_differences(left, one).collect())) == [(ORDER_GID_PREFIX + "77", "missing_right"), (ORDER_GID_PREFIX + "x1", "missing_left")]
    twice = left.union(left.limit(10))  # repeats differ, ids do not
    assert lookup.id_differences(twice, right).count() == 0
    none = left.limit(0)
    assert lookup.id_differences(none, right).count() == 5000 and lookup.id_differences(none, right.limit(0)).count() == 0


def test_point_reads_leave_the_orders_where_they_are(spark, tmpdir_path):
    orders = E._orders(spark, SF).select("id", "name")
    ids = spark.createDataFrame([("32",), (ORDER_GID_PREFIX + "7",), (" ",), ("999999999",)], "requested_id string")
    want = sorted(map(tuple, orders.filter(F.col("id").isin(ORDER_GID_PREFIX + "32", ORDER_GID_PREFIX + "7")).collect()))
    short = lookup.orders_by_id(orders, ids)
    assert sorted(map(tuple, short.collect())) == want and "BroadcastHashJoin" in plan_of(short)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sql("DROP TABLE IF EXISTS bucketed_orders")
    try:
        lookup.save_bucketed(orders, "bucketed_orders", 4, path=os.path.join(tmpdir_path, "b"))
        stored = spark.table("bucketed_orders")
        for df in (lookup.orders_by_id(stored, ids), lookup.found_ids(lookup.split_found_missing(ids, stored))):
            df.collect()
        text = plan_of(lookup.orders_by_id(stored, ids))
        side = text[:text.index("_gid") + 400]
        assert sorted(map(tuple, lookup.orders_by_id(stored, ids).collect())) == want
        # the requests are dealt out by id, the orders are read bucket by bucket
        assert "Bucketed: true" in text or "SelectedBucketsCount" in text, side
        assert "hashpartitioning(id" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_orders")


# --- states ------------------------------------------------------------------------------------

def test_state_takes_five_exchanges(spark):
    """Requests, orders, line totals and returns are dealt out by one number, the winners by their key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(E.q_exchange_state(spark, SF)).split("== Initial Plan")[0].count("Exchange hashpartitioning") <= 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_an_order_of_any_size_comes_in_parts(spark):
    n = 30000
    orders = spark.createDataFrame([(1, ORDER_GID_PREFIX + "1", "1", "RETURNED"), (2, ORDER_GID_PREFIX + "2", "2", "RETURNED"), (3, ORDER_GID_PREFIX + "3", "3", "NO_RETURN")],
                                   "order_key long, id string, legacyResourceId string, returnStatus string")
    orders = orders.withColumn("currentTotalPriceSet", F.struct(F.struct(F.lit("5.00").alias("amount"), F.lit("USD").alias("currencyCode")).alias("shopMoney")))
    item = F.struct(F.lit("i").alias("id"), F.lit("1").alias("quantity"), F.array(F.struct(F.lit("l").alias("id"), F.lit("s").alias("sku"), F.lit("1").alias("quantity"))).alias("lineItems"))
    returns = spark.range(n).select(F.when(F.col("id") % 100 == 0, 2).otherwise(1).cast("long").alias("order_number"), F.col("id").cast("string").alias("id"), F.lit("x").alias("name"),
                                    F.lit("CLOSED").alias("status"), F.lit("2026-04-10T00:00:00Z").alias("createdAt"),
                                    F.when(F.col("id") % 7 == 0, F.array().cast("array<struct<id:string,quantity:string,lineItems:array<struct<id:string,sku:string,quantity:string>>>>"))
                                    .otherwise(F.array(item)).alias("exchangeLineItems"), F.col("id").alias("position"))
    asked = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3), ("1", 4)], "requested_id string, position int")
    run = dict(position_col="position", keys=("order_key", "order_number"), numbered=True)
    whole = {r["order_key"]: [x["returnId"] for x in r["exchanges"]] for r in ex.exchange_state_lookup(asked, orders, returns, ["position"], **run).collect()}
    parts = ex.exchange_state_parts(asked, orders, returns, ["position"], 1000, **run).collect()
    assert max(len(r["exchanges"]) for r in parts) == 1000
    for key, ids in whole.items():
        mine = sorted((r["part"], [x["returnId"] for x in r["exchanges"]]) for r in parts if r["order_key"] == key)
        assert [p for p, _ in mine] == list(range(len(mine))) and [i for _, own in mine for i in own] == ids
    assert len(whole["1"]) > 25000 and whole["3"] == []


def test_parts_deal_the_returns_out_once(spark):
    """Returns are numbered, packed and joined to their orders where one shuffle by the order number left them."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(E.q_exchange_state_parts(spark, SF)).split("== Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") <= 3  # the orders for either join, and the returns
        assert not [f for f in set(os.listdir(folder)) - before if f.startswith("numbered-rows")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_parts_of_a_wide_order_equal_the_whole(spark, monkeypatch):
    """An order past the window's limit is numbered over ranges, the others in windows, into one result."""
    from orderlens.operators import rownum
    rows = lambda: sorted(map(tuple, E.q_exchange_state_parts(spark, SF).collect()), key=repr)
    expect = rows()
    monkeypatch.setattr(rownum, "WIDE_GROUP", 2)
    assert rows() == expect


def test_order_number_reads_either_form(spark):
    from orderlens.functions.ids import order_number, to_order_gid_state
    gid = ORDER_GID_PREFIX
    numbers = {"7": 7, " 7\n": 7, gid + "7": 7, f"\t{gid}0 ": 0, "07": None, gid + "07": None, gid + gid + "7": None, gid: None, "7 8": None, "+7": None, "": None,
               " ": None, "gid://shopify/Return/7": None, gid.lower() + "7": None, "9" * 18: int("9" * 18), "9" * 19: None, None: None}
    df = spark.createDataFrame([(k,) for k in numbers], "t string").select("t", order_number("t").alias("n"), to_order_gid_state("t").alias("gid"))
    for r in df.collect():
        assert r["n"] == numbers[r["t"]]
        assert r["n"] is None or r["gid"] == f"{gid}{r['n']}"


# --- stages ------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["jsonl_records", "id_batches", "orders_children", "exchange_state_parts", "config_saved"])
def test_no_stage_outlives_its_block(spark, name):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch(spark):
        assert E.queries()[name](spark, SF).collect()
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_a_failed_lookup_says_nothing_of_any_id(spark):
    requests, orders = spark.createDataFrame([("1",), ("2",)], "requested_id string"), spark.createDataFrame([(ORDER_GID_PREFIX + "1",)], "id string")
    told = lambda ok: spark.createDataFrame([(ok,)], "ok boolean")
    assert lookup.split_found_missing(requests, orders, status=told(False)).count() == 0
    split = lookup.split_found_missing(requests, orders, status=told(True))
    assert [r["requested_id"] for r in lookup.missing_ids(split).collect()] == ["2"]


def test_a_stage_without_rows_goes_too(spark):
    from orderlens.session import drop_stage, written_stage
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    for rows in (0, 3):
        staged = written_stage(spark.range(rows), "gone")
        assert staged.count() == rows and set(os.listdir(folder)) > before
        drop_stage(staged)
        assert set(os.listdir(folder)) == before
