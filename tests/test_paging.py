from pyspark.sql import functions as F

from orderlens.operators.paging import page
from orderlens.plans.spec import ReadSpec, read_orders


def frame(spark):
    rows = []
    for i in range(53):
        ts = None if i % 17 == 0 else f"2026-05-0{1 + i % 3}T00:00:00Z"  # many equal sort values, some null
        rows.append((f"gid://shopify/Order/{i:03d}", str(i), f"#{i}", ts, ts))
    return spark.createDataFrame(rows, "id string, legacyResourceId string, name string, createdAt string, updatedAt string")


def walk(df, size, reverse=False):
    seen, after = [], None
    for _ in range(100):
        pg = page(df, "UPDATED_AT", size, after, reverse)
        rows = pg.rows.collect()
        info = pg.info().first()
        seen += [r["id"] for r in rows]
        if not info["hasNextPage"]:
            break
        after = info["endCursor"]
    return seen


def test_walk_all_pages_equals_sorted_read(spark):
    df = frame(spark)
    full = [r["id"] for r in df.orderBy(F.col("updatedAt").asc_nulls_last(), "id").collect()]
    assert walk(df, 10) == full          # 53 rows: last page partial
    assert walk(df, 53) == full          # exact multiple
    rev = [r["id"] for r in df.orderBy(F.col("updatedAt").desc_nulls_last(), F.col("id").desc()).collect()]
    assert walk(df, 7, reverse=True) == rev


def test_read_orders_clamps_and_children(spark):
    df = frame(spark).withColumn("lineItems", F.array(*[F.struct(F.lit(f"li{j}").alias("id"), F.lit("n").alias("name"),
                                                                  F.lit("1").alias("quantity"), F.lit(f"s{j}").alias("sku"),
                                                                  F.struct(F.lit("v").alias("id"), F.lit("t").alias("title")).alias("variant"))
                                                        for j in range(5)]))
    plan = read_orders(df, ReadSpec(fields=["name", "lineItems.sku"], page_size=500, child_page_sizes={"lineItems": 2}))
    assert plan.page_size == 250 and plan.sort_key == "UPDATED_AT"
    rows = plan.df.collect()
    assert len(rows) == 53
    assert plan.df.columns == ["id", "legacyResourceId", "lineItems", "name", "hasMoreLineItems", "cursor"]
    assert [x["sku"] for x in rows[0]["lineItems"]] == ["s0", "s1"]
