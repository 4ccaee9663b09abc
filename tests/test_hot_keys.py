"""A key holding a third of all rows: results stay exact and whole."""

from pyspark.sql import functions as F

from orderlens.operators import lookup, rownum
from orderlens.operators.projection import attach_children
from orderlens.operators.rownum import number_rows


def test_hot_requested_id(spark):
    n = 30000
    req = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(" 7 ")).otherwise(F.col("id").cast("string"))
                                .alias("requested_id"))
    primary = spark.range(0, n, 2).select(F.concat(F.lit("gid://shopify/Order/"), F.col("id").cast("string")).alias("id"))
    s = lookup.split_found_missing(req, primary)
    found, missing = lookup.found_ids(s).count(), lookup.missing_ids(s).count()
    distinct = {str(i) for i in range(n) if i % 3} | {"7"}
    assert found + missing == len(distinct)
    assert found == len({x for x in distinct if int(x) % 2 == 0})


def test_hot_parent_children_and_numbers(spark):
    kids = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("order_id"),
        F.col("id").alias("pos"))
    parents = spark.createDataFrame([("hot",), ("1",), ("2",)], "id string")
    out = attach_children(parents, kids, "id", "order_id", ["pos"], {"pos": F.col("pos")}, 5, "items")
    got = {r["id"]: [x["pos"] for x in r["items"]] for r in out.collect()}
    def owner(i):
        return "hot" if i % 3 == 0 else str(i % 500)
    for key in ("hot", "1", "2"):
        assert got[key] == [i for i in range(60000) if owner(i) == key][:5]
    numbered = number_rows(kids, ["pos"], ["order_id"], out="rn")
    hot = numbered.filter("order_id = 'hot'").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(hot) == (1, 20000, 20000)


def test_only_wide_groups_are_dealt_by_ranges(spark, monkeypatch):
    """Groups of null, of a few rows and past the limit are numbered whole; ranges take the wide ones alone."""
    staged = []
    write = rownum.written_stage
    monkeypatch.setattr(rownum, "written_stage", lambda df, name: staged.append((name, df)) or write(df, name))
    group = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string"))
    rows = spark.range(6000).select(group.alias("g"), (-F.col("id")).alias("pos"))
    expect = {}
    for i in reversed(range(6000)):
        expect.setdefault("hot" if i % 3 == 0 else str(i % 50) if i % 3 == 1 else None, []).append(-i)
    for limit, wide in ((5000, set()), (500, {"hot", None}), (1, set(expect))):
        monkeypatch.setattr(rownum, "WIDE_GROUP", limit)
        staged.clear()
        got = {}
        for r in sorted(number_rows(rows, ["pos"], ["g"], out="rn").collect(), key=lambda r: r["rn"]):
            got.setdefault(r["g"], []).append(r["pos"])
            assert r["rn"] == len(got[r["g"]])
        assert got == expect
        ranged = [df for name, df in staged if name == "numbered-rows"]
        assert {r["g"] for df in ranged for r in df.select("g").distinct().collect()} == wide and len(ranged) == bool(wide)
