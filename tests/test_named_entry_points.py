import pytest
from pyspark.sql import functions as F

from orderlens.operators.projection import select_bulk_fields, select_fields, take_children
from orderlens.operators.rownum import keep_last
from orderlens.plans.catalog import unknown_fields


def orders(spark):
    li = F.array(*[F.struct(F.lit(f"l{j}").alias("id"), F.lit("n").alias("name"), F.lit("1").alias("quantity"),
                            F.lit(f"s{j}").alias("sku"), F.struct(F.lit("v").alias("id"), F.lit("t").alias("title")).alias("variant"))
                   for j in range(120)])
    money = F.struct(F.struct(F.lit("1.00").alias("amount"), F.lit("USD").alias("currencyCode")).alias("shopMoney"))
    return spark.range(2).select(F.concat(F.lit("gid://shopify/Order/"), F.col("id").cast("string")).alias("id"),
                                 F.col("id").cast("string").alias("legacyResourceId"), F.lit("#").alias("name"),
                                 F.lit("2026-01-01T00:00:00Z").alias("createdAt"), F.lit("2026-01-02T00:00:00Z").alias("updatedAt"),
                                 money.alias("totalPriceSet"), li.alias("lineItems"))


def test_select_fields_and_children(spark):
    df = orders(spark)
    assert select_fields(df).columns == ["createdAt", "id", "legacyResourceId", "name", "updatedAt"]
    s = select_fields(df, ["totalPriceSet.shopMoney.amount", "lineItems.sku"])
    assert s.columns == ["id", "legacyResourceId", "lineItems", "totalPriceSet"]
    assert s.schema["totalPriceSet"].dataType.simpleString() == "struct<shopMoney:struct<amount:string>>"
    with pytest.raises(ValueError):
        select_bulk_fields(df, ["lineItems.sku"])
    assert [len(r["lineItems"]) for r in take_children(df).collect()] == [50, 50]
    assert [len(r["lineItems"]) for r in take_children(df, 500).collect()] == [100, 100]


def test_unknown_fields_and_keep_last(spark):
    p = spark.createDataFrame([("id",), (" rawGraphql ",), ("",), ("lineItems.sku",)], "path string")
    assert [r["path"] for r in unknown_fields(p).collect()] == ["rawGraphql"]
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, seq int, v string")
    assert sorted((r["k"], r["v"]) for r in keep_last(df, ["k"], "seq").collect()) == [("a", "z"), ("b", "q")]
