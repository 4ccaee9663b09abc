import os

import pytest
from pyspark.sql import types as T

from orderlens.sinks import files
from orderlens.sinks.files import committed_runs, drop_runs, extract_orders, json_name, jsonl_name, read_run
from orderlens.streaming import stream_landing

LINES = ['{"id":"gid://shopify/Order/1001","legacyResourceId":"1001","name":"#1001"}',
         '{"id":"gid://shopify/Order/1002","legacyResourceId":null,"name":"#1002","email":null}']


def test_names():
    assert json_name(None, "shopify-orders-1-2.json") == "shopify-orders-1-2.json"
    assert json_name("run", "x") == "run.json"
    assert jsonl_name("run.json", "x") == "run.jsonl"
    assert jsonl_name("run.jsonl", "x") == "run.jsonl"


def test_extract_round_trip(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "export.jsonl")
    with open(src, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    out = os.path.join(tmpdir_path, "out")
    ex = extract_orders(spark, src, expected_count=2, location_present=True, window_start="2026-04-01",
                        window_end="2026-04-02T00:00:00Z", location=out, write=True, config_id="cfg")
    st = ex.status.first()
    assert st["dataAvailable"] and st["recordCount"] == 2 and st["errors"] == []
    assert ex.file_name == "shopify-orders-1775001600000-1775088000000.json"
    meta = st["requestMetadata"]
    assert meta["searchQueries"] == ["created_at:>='2026-04-01T00:00:00Z' created_at:<'2026-04-02T00:00:00Z'"]
    assert meta["filterFields"] == ["created_at"] and st["fileLocation"] == os.path.join(out, ex.file_name)
    assert st["fileTypeEnumId"] == "DftJson" and st["warnings"] == ["2 record(s) lie outside the requested window."]
    recs = read_run(spark, out, ex.file_name)
    got = sorted((r["id"], r["shopifyGid"]) for r in recs.collect())
    assert got == [("1001", "gid://shopify/Order/1001"), ("1002", "gid://shopify/Order/1002")]
    assert sorted(r["value"] for r in read_run(spark, out, ex.file_name, "raw").collect()) == sorted(LINES)
    assert spark.read.text(meta["rawJsonlLocation"]).count() == 2
    meta = read_run(spark, out, ex.file_name, "metadata").first().asDict()
    assert meta["extractedRecordCount"] == 2 and "accessToken" not in meta and meta["shopifyAuthConfigId"] == "cfg"
    assert meta["sourceType"] == "SHOPIFY_GRAPHQL_ORDERS" and meta["rawJsonlFileName"] == ex.raw_file_name
    # null record values survive; null metadata entries are dropped
    folder = files.run_folder(out, ex.file_name, committed_runs(spark, out, ex.file_name).first()["run_id"]) + "/records"
    text = "".join(open(os.path.join(folder, f)).read() for f in os.listdir(folder) if f.endswith(".json"))
    assert '"email":null' in text
    assert "bulkStartRetryCount" not in meta


def test_extract_incomplete_and_bad_window(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "short.jsonl")
    with open(src, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    ex = extract_orders(spark, src, expected_count=3, location_present=True, window_start="1", window_end="2", config_id="c")
    st = ex.status.first()
    assert not st["dataAvailable"] and st["recordCount"] == 0 and "incomplete" in st["errors"][0]
    assert ex.records.count() == 0
    ex2 = extract_orders(spark, src, expected_count=2, location_present=True, window_start=" ", window_end="2", config_id="c")
    st2 = ex2.status.first()
    assert st2["errors"][0] == "windowStart is required." and not st2["dataAvailable"]


CONFIG = "config_id string, description string, tenant_id string, created_by string, shop_api_url string, api_version string, time_zone string, access_token string, is_active string, can_read_orders string"


def configs(spark):
    return spark.createDataFrame([("chi", "d", "T1", "u", "https://a.myshopify.com", "2025-10", "America/Chicago", "t", "Y", "Y"),
                                  ("off", "d", "T1", "u", "https://a.myshopify.com", "2025-10", None, "t", "N", "Y")], CONFIG)


def test_extract_checks_the_config_and_uses_its_zone(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "export.jsonl")
    with open(src, "w") as fh:
        fh.write('{"id":"gid://shopify/Order/1","createdAt":"2026-04-01T05:00:00Z"}\n{"id":"gid://shopify/Order/2","createdAt":"2026-04-01T04:59:59Z"}\n')
    run = dict(expected_count=2, location_present=True, window_start="2026-04-01", window_end="2026-04-02", configs=configs(spark))
    ex = extract_orders(spark, src, config_id="chi", tenant="T1", **run)
    st = ex.status.first()
    meta = st["requestMetadata"]
    assert (meta["windowStartUtc"], meta["windowEndUtc"], meta["sourceTimeZone"]) == ("2026-04-01T05:00:00Z", "2026-04-02T05:00:00Z", "America/Chicago")
    assert meta["calendarDateNormalized"] and not meta["exactWindowPreserved"] and st["warnings"] == ["1 record(s) lie outside the requested window."]
    kept = extract_orders(spark, src, config_id="chi", tenant="T1", preserve_instants=True, **run).status.first()["requestMetadata"]
    assert kept["windowStartUtc"] == "2026-04-01T00:00:00Z" and kept["exactWindowPreserved"]
    for config, tenant, word in ((None, "T1", "required"), ("chi", "T2", "automation tenant"), ("off", "T1", "inactive"), ("x", "T1", "not found")):
        bad = extract_orders(spark, src, config_id=config, tenant=tenant, **run)
        st = bad.status.first()
        assert word in st["errors"][0] and not st["dataAvailable"] and bad.records.count() == 0


def test_extract_empty_run_writes_metadata(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "empty.jsonl"), os.path.join(tmpdir_path, "out")
    open(src, "w").close()
    ex = extract_orders(spark, src, expected_count=0, location_present=True, window_start="2026-04-01", window_end="2026-04-02",
                        config_id="c", location=out, write=True)
    st = ex.status.first()
    assert st["errors"] == [] and not st["dataAvailable"] and st["recordCount"] == 0
    assert read_run(spark, out, ex.file_name, "metadata").first()["extractedRecordCount"] == 0
    assert read_run(spark, out, ex.file_name, schema="id string").count() == 0
    with pytest.raises(FileNotFoundError, match="no raw lines"):
        read_run(spark, out, ex.file_name, "raw")


def test_a_run_cut_short_leaves_the_earlier_one(spark, tmpdir_path, monkeypatch):
    """A reader sees a whole run: the first stays while a second one fails, wherever it fails."""
    src, out = os.path.join(tmpdir_path, "export.jsonl"), os.path.join(tmpdir_path, "out")
    run = dict(location_present=True, window_start="2026-04-01", window_end="2026-04-02", config_id="c", location=out, name="daily", write=True)

    def export(lines):
        with open(src, "w") as fh:
            fh.write("\n".join(lines) + "\n")

    def ids():
        return sorted(r["id"] for r in read_run(spark, out, "daily.json").collect())

    with pytest.raises(FileNotFoundError, match="No finished run"):
        read_run(spark, out, "daily.json")
    export(LINES)
    extract_orders(spark, src, 2, **run)
    assert ids() == ["1001", "1002"]
    export(['{"id":"gid://shopify/Order/9"}'])
    for step in ("write_raw_sidecar", "commit_run"):
        with monkeypatch.context() as m:
            m.setattr(files, step, lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError, match="killed"):
                extract_orders(spark, src, 1, **run)
        assert ids() == ["1001", "1002"] and read_run(spark, out, "daily.json", "metadata").first()["extractedRecordCount"] == 2
        assert committed_runs(spark, out, "daily.json").count() == 1
    extract_orders(spark, src, 1, **run)
    assert ids() == ["9"] and read_run(spark, out, "daily.json", "raw").first()["value"] == '{"id":"gid://shopify/Order/9"}'
    assert len(drop_runs(spark, out, "daily.json")) == 3 and ids() == ["9"]
    assert committed_runs(spark, out, "daily.json").count() == 2


def test_an_unknown_zone_is_an_error_of_the_job(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "export.jsonl")
    with open(src, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    table = configs(spark).replace("America/Chicago", "Bogus/Zone", "time_zone")
    run = dict(expected_count=2, location_present=True, window_start="2026-04-01", window_end="2026-04-02")
    st = extract_orders(spark, src, config_id="chi", configs=table, tenant="T1", **run).status.first()
    assert st["errors"] == ["Shopify timezone 'Bogus/Zone' is not valid."] and not st["dataAvailable"]
    # rows that share an id: the same zone in any order of the rows
    twice = configs(spark).union(table).filter("config_id = 'chi'")
    for rows in (twice.orderBy("time_zone"), twice.orderBy(twice["time_zone"].desc())):
        st = extract_orders(spark, src, config_id="chi", configs=rows, tenant="T1", **run).status.first()
        assert st["requestMetadata"]["sourceTimeZone"] == "America/Chicago"
    st = extract_orders(spark, src, config_id="any", default_zone="Asia/Tokyo", **run).status.first()
    assert st["requestMetadata"]["windowStartUtc"] == "2026-03-31T15:00:00Z"


def test_an_extraction_reads_its_export_once(spark, tmpdir_path, monkeypatch):
    """Gate, warning, records and sidecar come from one pass: a file changed after it changes nothing."""
    src, out = os.path.join(tmpdir_path, "export.jsonl"), os.path.join(tmpdir_path, "out")
    with open(src, "w") as fh:
        fh.write("\n".join(LINES) + "\n")
    gate = files.load_gate

    def changed(*args):
        with open(src, "w") as fh:
            fh.write("[1]\n" * 7)
        return gate(*args)

    monkeypatch.setattr(files, "load_gate", changed)
    ex = extract_orders(spark, src, 2, True, "2026-04-01", "2026-04-02", config_id="c", location=out, write=True)
    assert ex.status.first()["recordCount"] == 2
    assert sorted(r["value"] for r in read_run(spark, out, ex.file_name, "raw").collect()) == sorted(LINES)


def persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_a_completed_download_passes_in_the_same_session(spark, tmpdir_path):
    src, before = os.path.join(tmpdir_path, "grown.jsonl"), persisted(spark)
    run = dict(expected_count=2, location_present=True, window_start="1", window_end="2", config_id="c")
    with open(src, "w") as fh:
        fh.write(LINES[0] + "\n")
    assert "parsed 1" in extract_orders(spark, src, **run).status.first()["errors"][0]
    with open(src, "a") as fh:
        fh.write(LINES[1] + "\n")
    ex = extract_orders(spark, src, **run)
    assert ex.status.first()["recordCount"] == 2 and sorted(r["id"] for r in ex.records.collect()) == ["1001", "1002"]
    assert persisted(spark) == before


def test_grown_folders_are_read_whole(spark, tmpdir_path):
    from orderlens.operators.rownum import number_rows
    from orderlens.sources.jsonl import read_bulk_jsonl
    folder, table, before = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "t"), persisted(spark)
    os.makedirs(folder)
    schema = T.StructType([T.StructField("id", T.StringType())])
    for n in (1, 2):
        with open(os.path.join(folder, f"{n}.jsonl"), "w") as fh:
            fh.write("".join(f'{{"id":"{n}-{i}"}}\n' for i in range(3)))
        assert read_bulk_jsonl(spark, folder, schema).records().count() == 3 * n
        spark.range(n * 3).write.mode("overwrite").parquet(table)
        assert sorted(r["n"] for r in number_rows(spark.read.parquet(table), ["id"], out="n").collect()) == list(range(1, 3 * n + 1))
    assert persisted(spark) == before


def test_streaming_landing(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.jsonl"), "w") as fh:
        fh.write("\n".join(LINES + ["[1]", ""]) + "\n")
    with open(os.path.join(landing, "b.jsonl"), "w") as fh:
        fh.write('{"id":"gid://shopify/Order/7"}\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "legacyResourceId", "name")])
    q = stream_landing(spark, landing, schema, os.path.join(tmpdir_path, "recs"), os.path.join(tmpdir_path, "bad"),
                       os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    recs = spark.read.json(os.path.join(tmpdir_path, "recs"))
    assert sorted(r["id"] for r in recs.collect()) == ["1001", "1002", "7"]
    assert not spark.sparkContext._jsc.getPersistentRDDs().size()
    bad = spark.read.json(os.path.join(tmpdir_path, "bad")).collect()
    assert [(os.path.basename(r["file"]), r["line_no"]) for r in bad] == [("a.jsonl", 3)]


SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "legacyResourceId", "name")])


class Landing:
    """A landing folder, its manifest and the outputs of the gated stream."""

    def __init__(self, spark, folder):
        from orderlens.streaming.landing import LoadGate
        self.spark, self.folder = spark, folder
        self.landing, self.records, self.bad = (os.path.join(folder, n) for n in ("landing", "recs", "bad"))
        os.makedirs(self.landing)
        self.manifest: list[tuple] = []
        self.gate = LoadGate(lambda s: s.createDataFrame(self.manifest, "load_id string, expected_count string, location string, closed boolean"),
                             os.path.join(folder, "state"))

    def land(self, name, lines):
        with open(os.path.join(self.folder, "tmp"), "w") as fh:
            fh.write("".join(x + "\n" for x in lines))
        os.rename(os.path.join(self.folder, "tmp"), os.path.join(self.landing, name))

    def run(self, **options):
        q = stream_landing(self.spark, self.landing, SCHEMA, self.records, self.bad, os.path.join(self.folder, "ckpt"), gate=self.gate, **options)
        q.awaitTermination(180)
        assert q.exception() is None

    def released(self):
        if not os.path.isdir(self.records):
            return []
        schema = "load_id string, id string, step string"
        return sorted((r["load_id"], r["id"], r["step"]) for r in self.spark.read.schema(schema).json(self.records).collect())

    def states(self):
        from orderlens.streaming.landing import landing_status
        return {r["load_id"]: r for r in landing_status(self.spark, self.gate).collect()}


def order(n):
    return f'{{"id":"gid://shopify/Order/{n}"}}'


def test_a_load_split_over_batches_goes_out_once_and_whole(spark, tmpdir_path):
    at = Landing(spark, tmpdir_path)
    at.manifest = [("a", "5", "x", None), ("short", "3", "x", None), ("broken", "2", "x", None), ("long", "1", "x", None)]
    for n, lines in enumerate(([1, 2], [3], [4, 5]), 1):
        at.land(f"a.part-{n}.jsonl", [order(x) for x in lines])
        if n == 1:
            at.land("short.jsonl", [order(10), "", order(11)])
            at.land("broken.jsonl", [order(20), "[1]"])
            at.land("long.jsonl", [order(30), order(31)])
            at.land("stranger.jsonl", [order(40)])
        at.run()
        assert {x[0] for x in at.released()} == ({"a"} if n == 3 else set())
    assert [x[1] for x in at.released()] == ["1", "2", "3", "4", "5"] and len({x[2] for x in at.released()}) == 1
    states = at.states()
    assert {k: r["state"] for k, r in states.items()} == {"a": "released", "short": "waiting", "broken": "failed", "long": "failed", "stranger": "waiting"}
    assert "expected 3 record(s) but parsed 2" in states["short"]["error"] and "first at line 2" in states["broken"]["error"]
    assert "does not list" in states["stranger"]["error"]
    # lines that come later: to a released load, and the rest of a short one
    at.land("a.part-4.jsonl", [order(6)])
    at.land("short.part-2.jsonl", [order(12)])
    at.run()
    assert [x[1] for x in at.released()] == ["1", "2", "3", "4", "5", "10", "11", "12"]
    assert at.states()["a"]["late_lines"] == 1 and at.states()["short"]["state"] == "released"
    bad = spark.read.json(at.bad).collect()
    assert [(os.path.basename(r["file"]), r["line_no"]) for r in bad] == [("broken.jsonl", 2)]


def test_one_file_a_batch_and_a_late_manifest(spark, tmpdir_path):
    from orderlens.streaming.landing import settle_landing
    at = Landing(spark, tmpdir_path)
    for n in range(3):
        at.land(f"b.part-{n}.jsonl", [order(n)])
    at.land("free.jsonl", [order(7)])
    at.run(max_files_per_trigger=1)
    assert at.released() == []
    at.manifest = [("b", "3", "x", None), ("free", None, "x", False), ("none", "0", None, None)]
    settle_landing(spark, at.gate, SCHEMA, at.records)
    assert [x[:2] for x in at.released()] == [("b", "0"), ("b", "1"), ("b", "2")]
    at.manifest = [("b", "3", "x", None), ("free", "n/a", "x", True)]
    settle_landing(spark, at.gate, SCHEMA, at.records)
    settle_landing(spark, at.gate, SCHEMA, at.records)
    assert [x[:2] for x in at.released()] == [("b", "0"), ("b", "1"), ("b", "2"), ("free", "7")]
    assert {k: r["state"] for k, r in at.states().items()} == {"b": "released", "free": "released"}


@pytest.mark.parametrize("cut", ["records", "loads", "done"])
def test_a_replayed_batch_leaves_its_output_once(spark, tmpdir_path, monkeypatch, cut):
    """The step dies after its verdict, after its records, or before its batch is committed."""
    import shutil
    from orderlens.streaming import landing as module
    at = Landing(spark, tmpdir_path)
    at.manifest = [("a", "2", "x", None), ("b", "2", "x", None)]
    at.land("a.part-1.jsonl", [order(1)])
    at.land("b.part-1.jsonl", [order(3), order(4)])
    at.run()
    assert [x[:2] for x in at.released()] == [("b", "3"), ("b", "4")]
    at.land("a.part-2.jsonl", [order(2)])
    release = module._release

    def dying(spark, gate, loads, schema, records_out, step):
        if cut == "records":
            raise OSError("killed")
        release(spark, gate, loads, schema, records_out, step)
        if cut == "loads":  # the records are there, the table of loads is not
            shutil.rmtree(os.path.join(gate.state, "loads", f"step={step}"))
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(module, "_release", dying)
        with pytest.raises(Exception, match="killed"):
            at.run()
    at.run()
    assert [x[:2] for x in at.released()] == [("a", "1"), ("a", "2"), ("b", "3"), ("b", "4")]
    assert {r["state"] for r in at.states().values()} == {"released"}
    at.land("c.jsonl", [order(5)])
    at.run()  # what has gone out is no longer held
    assert sorted(os.listdir(os.path.join(at.gate.state, "held")))[-1].startswith("batch_id=2")
    assert len([n for n in os.listdir(os.path.join(at.gate.state, "held")) if n.startswith("batch_id=")]) == 1


def test_partitioned_records_prune(spark, tmpdir_path):
    import __spark_entry__ as E
    from orderlens.operators.filters import apply_filters
    from orderlens.plans.catalog import ORDER_SOURCE, normalize_filters
    from orderlens.sinks.files import write_records
    o = E._orders(spark, "/root/testdata/sf0.001").select("id", "name", "createdAt", "updatedAt")
    base = write_records(o, tmpdir_path, "part-test", partition_by_day="createdAt", fmt="parquet")
    back = spark.read.parquet(os.path.join(base, "records"))
    f = normalize_filters(ORDER_SOURCE, {"createdAtFrom": "1996-03-01T00:00:00Z", "createdAtTo": "1996-04-01T00:00:00Z"})
    got = apply_filters(back, ORDER_SOURCE, f)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan and "created_date#" in plan
    want = apply_filters(o, ORDER_SOURCE, f)
    assert sorted(r["id"] for r in got.select("id").collect()) == sorted(r["id"] for r in want.select("id").collect())
    assert got.count() > 0
