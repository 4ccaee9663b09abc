import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources.gate import load_gate, release
from orderlens.sources.jsonl import read_bulk_jsonl, read_text_lines

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("legacyResourceId", T.StringType()),
                       T.StructField("name", T.StringType())])

EDGE_LINES = [
    '{"id":"gid://shopify/Order/1001","legacyResourceId":"1001","name":"#1001"}',
    "",
    '[{"id":"2"}]',
    '"bare"',
    "null",
    '{"id":"3"',
    "{'id':'4'}",
    '{"id": 5, "name": "#5"}',
    '{"id":"a","id":"b"}',
    "   ",
    '{"id":"gid://shopify/Order/1002","legacyResourceId":"1002","name":"#1002"}',
]


def write(path, lines, trailing=True):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + ("\n" if trailing else ""))


def test_edge_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.jsonl")
    write(p, EDGE_LINES)
    parsed = read_bulk_jsonl(spark, p, SCHEMA)
    recs = {r["line_no"]: r for r in parsed.records().collect()}
    assert sorted(recs) == [1, 8, 9, 11]
    assert recs[8]["id"] == "5" and recs[9]["id"] == "b"
    bad = {r["line_no"]: r["error"] for r in parsed.bad_lines().collect()}
    assert bad == {
        3: "Shopify bulk operation JSONL line 3 was not a JSON object.",
        4: "Shopify bulk operation JSONL line 4 was not a JSON object.",
        5: "Shopify bulk operation JSONL line 5 was not a JSON object.",
        6: "Shopify bulk operation JSONL line 6 was not valid JSON.",
        7: "Shopify bulk operation JSONL line 7 was not valid JSON.",
    }
    c = parsed.counts().first()
    assert (c["line_count"], c["parsed_count"], c["bad_count"], c["first_bad_line"]) == (11, 4, 5, 3)


def test_many_splits_and_files(spark, tmpdir_path):
    """One file read in many splits plus a second file: numbers restart per file and every
    line is numbered exactly once, in file order."""
    n = 20000
    lines = [f'{{"id":"{i}","name":"#{i}"}}' if i % 1000 else "oops" for i in range(1, n + 1)]
    big = os.path.join(tmpdir_path, "big.jsonl")
    write(big, lines)
    small = os.path.join(tmpdir_path, "small.jsonl")
    write(small, ['{"id":"x"}', "[1]"], trailing=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    try:
        assert spark.read.text(big).rdd.getNumPartitions() >= 8
        numbered = read_text_lines(spark, [big, small])
        rows = numbered.groupBy("file").agg(F.count("*").alias("c"), F.min("line_no").alias("mn"),
                                            F.max("line_no").alias("mx"), F.countDistinct("line_no").alias("d")).collect()
        by = {os.path.basename(r["file"]): r for r in rows}
        assert (by["big.jsonl"]["c"], by["big.jsonl"]["mn"], by["big.jsonl"]["mx"], by["big.jsonl"]["d"]) == (n, 1, n, n)
        assert (by["small.jsonl"]["c"], by["small.jsonl"]["mx"]) == (2, 2)
        # the number matches the content (line i holds id i)
        wrong = numbered.filter(F.col("file").endswith("big.jsonl")).filter(
            F.col("value").contains('"id"') & (F.get_json_object("value", "$.id").cast("long") != F.col("line_no")))
        assert wrong.count() == 0
        parsed = read_bulk_jsonl(spark, [big, small], SCHEMA)
        bad = sorted((os.path.basename(r["file"]), r["line_no"]) for r in parsed.bad_lines().collect())
        assert bad == [("big.jsonl", i) for i in range(1000, n + 1, 1000)] + [("small.jsonl", 2)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _gate(spark, counts, manifest):
    c = spark.createDataFrame(counts, "load_id string, line_count long, parsed_count long, bad_count long, first_bad_line long")
    m = spark.createDataFrame(manifest, "load_id string, expected_count string, location string")
    return {r["load_id"]: r for r in load_gate(c, m).collect()}


def test_gate_cases(spark):
    g = _gate(spark,
              [("eq", 2, 2, 0, None), ("low", 2, 2, 0, None), ("high", 3, 3, 0, None), ("txt", 2, 2, 0, None),
               ("null", 2, 2, 0, None), ("bad", 3, 2, 1, 2)],
              [("eq", "2", "u"), ("low", "3", "u"), ("high", "2", "u"), ("txt", "abc", "u"), ("null", None, "u"),
               ("bad", "2", "u"), ("noloc", "5", None), ("empty0", "0", None), ("emptyN", None, None)])
    assert g["eq"]["ok"] and g["eq"]["data_available"] and g["eq"]["record_count"] == 2
    assert not g["low"]["ok"] and g["low"]["retryable"] and "expected 3 record(s) but parsed 2" in g["low"]["error"]
    assert not g["high"]["ok"] and g["high"]["retryable"]
    assert g["txt"]["ok"] and g["null"]["ok"]
    assert not g["bad"]["ok"] and not g["bad"]["retryable"] and "first at line 2" in g["bad"]["error"]
    assert not g["noloc"]["ok"] and "5 object(s) but returned no result download URL" in g["noloc"]["error"]
    assert g["empty0"]["ok"] and not g["empty0"]["data_available"] and g["empty0"]["record_count"] == 0
    assert g["emptyN"]["ok"]


def test_release_modes(spark):
    recs = spark.createDataFrame([("a", 1), ("b", 2)], "load_id string, v int")
    gate = spark.createDataFrame([("a", True, True, None), ("b", False, False, "boom")],
                                 "load_id string, ok boolean, data_available boolean, error string")
    assert [r["v"] for r in release(recs, gate).collect()] == [1]
    import pytest
    with pytest.raises(Exception, match="boom"):
        release(recs, gate, mode="raise").collect()


def test_text_after_the_object_is_bad(spark):
    from pyspark.sql import types as T
    from orderlens.sources.jsonl import classify_lines
    texts = ['{"id":"1"}', '{"id":"1"}{"id":"2"}', '{"id":"4"},', '{"id":"5"} x', '{"id":"6"}]', '{"id":"7"}}', '{"id":"8"},"b":2', " "]
    df = spark.createDataFrame(list(enumerate(texts, 1)), "line_no long, value string")
    p = classify_lines(df, T.StructType([T.StructField("id", T.StringType())]))
    assert [r["id"] for r in p.records().collect()] == ["1"]
    assert sorted(r["line_no"] for r in p.bad_lines().collect()) == [2, 3, 4, 5, 6, 7]
    assert {r["kind"] for r in p.lines.filter("line_no IN (1, 8)").collect()} == {"record", "blank"}


def test_unknown_loads_and_one_release_rule(spark):
    counts = spark.createDataFrame([("a", 1, 1, 0, None), ("stray", 1, 1, 0, None)],
                                   "load_id string, line_count long, parsed_count long, bad_count long, first_bad_line long")
    manifest = spark.createDataFrame([("a", "1", "x"), ("nowhere", None, None)], "load_id string, expected_count string, location string")
    gate = load_gate(counts, manifest)
    rows = {r["load_id"]: r for r in gate.collect()}
    assert rows["a"]["ok"] and rows["nowhere"]["ok"] and not rows["nowhere"]["data_available"]
    assert not rows["stray"]["ok"] and "does not list" in rows["stray"]["error"]
    known = spark.createDataFrame([("a", 1), ("nowhere", 2)], "load_id string, v int")
    for mode in ("empty", "raise"):
        assert [r["v"] for r in release(known, gate, mode=mode).collect()] == [1]
    with pytest.raises(Exception, match="does not list"):
        release(spark.createDataFrame([("other", 1)], "load_id string, v int"), gate, mode="raise").collect()


def test_lines_are_read_in_one_scan(spark, tmpdir_path):
    """Scans that would cut the files differently, by other sizes or core counts, lose nothing: offsets
    and lines come from the same pass."""
    path, n = os.path.join(tmpdir_path, "big.jsonl"), 60000
    with open(path, "w") as fh:
        fh.writelines(f'{{"id":"{i}","name":"{"x" * 90}"}}\n' for i in range(1, n + 1))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    settings = [("1m", "4", "4m"), ("1m", "12", "64k"), ("300k", "3", "64k"), ("64m", "40", "1k")]

    def use(values):
        for k, v in zip(keys, values):
            spark.conf.set(k, v)

    try:
        for made, used in zip(settings, settings[1:] + settings[:1]):
            use(made)
            lines, parsed = read_text_lines(spark, path), read_bulk_jsonl(spark, path, SCHEMA)
            use(used)
            for df, number in ((lines, F.get_json_object("value", "$.id")), (parsed.records(), F.col("id"))):
                got = df.agg(F.count("*"), F.countDistinct("line_no"), F.min("line_no"), F.max("line_no"),
                             F.count_if(number.cast("long") != F.col("line_no"))).first()
                assert tuple(got) == (n, n, 1, n, 0)
            assert parsed.counts().first()["line_count"] == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_load_of_many_files_is_numbered_through(spark, tmpdir_path):
    for load, part, lines in (("x", 0, ["[1]", '{"id":"2"}']), ("x", 1, ['{"id":"3"}', "", "oops"]), ("y", 0, ['{"id":"1"}'])):
        folder = os.path.join(tmpdir_path, f"load={load}", f"part={part}")
        os.makedirs(folder)
        write(os.path.join(folder, "lines.txt"), lines)
    parsed = read_bulk_jsonl(spark, tmpdir_path, SCHEMA, load_col="load")
    assert sorted((r["load"], r["line_no"], r["id"]) for r in parsed.records().collect()) == [("x", 2, "2"), ("x", 3, "3"), ("y", 1, "1")]
    assert sorted((r["load"], r["line_no"]) for r in parsed.bad_lines().collect()) == [("x", 1), ("x", 5)]
    assert {r["load"]: r["line_count"] for r in parsed.counts(["load"]).collect()} == {"x": 5, "y": 1}


NESTED = T.StructType([T.StructField("id", T.StringType()), T.StructField("money", T.StructType([T.StructField("amount", T.StringType())])),
                       T.StructField("tags", T.ArrayType(T.StringType()))])
HOSTILE = ['{"id":"1"}],[{"id":"2"}', '{"id":"1"}] {"id":"2"}', '{"id":"1"},{"__seal":"0"}', '{"id":"1"},{"id":"2"}', '{"id":"1"', '{"a":[{"b":1}',
           '{"id":"9","money":5}', '{"id":"8","money":{"amount":5.10}}', '{"id":7,"tags":[1,"a",{"b":2}]}', '{"id":"6","tags":5}', '{}', '{"__seal":"x"}',
           '{"id":{"a":1}}', '{"id":"a","id":"b"}', '{"id":"\\u0041"}', '{"id":"\x01"}', '{"id":NaN}', '{"id":01}', '{"id":null}', "{'id':'4'}", '{id:"1"}',
           '{"id":"1"}//', ' {"id":"3"} \t', '\ufeff{"id":"1"}', '[{"id":"1"}]', '{"id":"1"}]', '{"id":"1"}}', '{"id":"1"},', '1', 'true', '""', '{"id":tru}']


def test_the_one_parse_agrees_with_the_strict_probe(spark):
    from orderlens.functions.text import trimmed
    from orderlens.sources.jsonl import _STRICT, classified, schema_of_strings, whole_json
    df = spark.createDataFrame(list(enumerate(HOSTILE)), "n int, value string").repartition(3)
    got = {r["n"]: (r["kind"], r["record"]) for r in classified(df, NESTED).collect()}
    text = trimmed(F.col("value"))
    probe = df.select("n", F.when(whole_json(text, "struct<_probe:string>"), "record").otherwise("bad").alias("kind"),
                      F.from_json(text, schema_of_strings(NESTED), _STRICT).alias("record"))
    want = {r["n"]: (r["kind"], r["record"] if r["kind"] == "record" else None) for r in probe.collect()}
    for n, text in enumerate(HOSTILE):
        assert got[n] == want[n], text
    assert {HOSTILE[n] for n, (kind, _) in got.items() if kind == "record"} >= {'{"id":"9","money":5}', "{}", '{"id":"a","id":"b"}'}


def test_one_parse_a_line(spark, tmpdir_path):
    """The job that writes the lines parses each once; the two strict probes stand behind its refusals."""
    from orderlens.sources.jsonl import classified, placed
    path = os.path.join(tmpdir_path, "a.jsonl")
    write(path, EDGE_LINES)
    plan = classified(placed(spark.read.text(path)), SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1, plan
