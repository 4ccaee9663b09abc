from orderlens.operators import configs as cfg

COLS = "config_id string, description string, tenant_id string, created_by string, shop_api_url string, api_version string, time_zone string, access_token string, is_active string, can_read_orders string"


def table(spark):
    return spark.createDataFrame([
        ("chi", "Chicago shop", "T1", "u1", "https://chi.myshopify.com", "2025-10", "America/Chicago", "secret1", None, None),
        ("la", "LA shop", "T2", "u2", "https://la.myshopify.com", "2025-10", "America/Los_Angeles", "secret2", "N", "Y"),
        ("chi2", "chicago 100%", "T1", "u1", "https://c2.myshopify.com", "2025-10", None, None, "Y", "Y"),
    ], COLS)


def test_list_scoped_search_redacted(spark):
    rows, pages = cfg.list_configs(table(spark), "T1", "CHICAGO", page_index=0, page_size=500)
    out = rows.collect()
    assert [r["config_id"] for r in out] == ["chi", "chi2"]
    assert "access_token" not in rows.columns
    assert out[0]["has_access_token"] and not out[1]["has_access_token"]
    assert out[0]["is_active"] == "Y" and out[1]["time_zone"] == "UTC" and out[0]["can_read_orders"] is False
    p = pages.first()
    assert (p["total_count"], p["page_size"], p["page_count"]) == (2, 200, 1)
    assert cfg.list_configs(table(spark), None)[0].count() == 0
    assert cfg.list_configs(table(spark), "T1", "%", page_index=5)[0].count() == 0


def test_usable(spark):
    req = spark.createDataFrame([(1, "chi", "T1", None), (2, "la", None, "T2"), (3, "la", "T1", None), (4, " ", "T1", None),
                                 (5, "zzz", None, "T1"), (6, "chi", None, "T2")],
                                "request_id int, config_id string, trusted_tenant string, session_tenant string")
    r = {x["request_id"]: x["errors"] for x in cfg.check_usable(req, table(spark)).collect()}
    assert r[1] == ["Shopify auth config chi is not enabled for order reads."]
    assert r[2] == ["Shopify auth config la is inactive."]
    assert r[3] == ["Shopify auth config 'la' is not available in this automation tenant."]
    assert r[4] == ["Shopify auth config ID is required."]
    assert r[5] == ["Shopify auth config 'zzz' was not found."]
    assert r[6] == ["Shopify auth config 'chi' is not available in your active tenant."]


def test_merge(spark):
    upd = spark.createDataFrame([
        ("chi", "new desc", "https://chi.myshopify.com/", "2026-01", "", "", "", "yes", 1),
        ("la", "x", "https://la.myshopify.com", "2025-10", None, "t", "Y", "Y", 2),
        ("new1", "n", "https://n.myshopify.com", "2025-10", "Central", "tok", "Y", "Y", 3),
        ("new2", "n", "https://n.myshopify.com", "2025-10", None, None, "Y", "Y", 4),
        ("new3", "n", "http://n.myshopify.com", "2025-10", None, "tok", "Y", "Y", 5),
        ("new4", "n", "https://n.myshopify.com", "2025-10", None, "tok", None, None, 6),
    ], "config_id string, description string, shop_api_url string, api_version string, time_zone string, access_token string, is_active string, can_read_orders string, position int")
    merged, out = cfg.merge_configs(table(spark), upd, "T1", "admin", position_col="position")
    o = {r["config_id"]: (r["action"], r["errors"]) for r in out.collect()}
    assert o["chi"] == ("updated", [])
    assert o["la"][0] == "rejected" and "not available in your active tenant" in o["la"][1][0]
    assert o["new1"] == ("rejected", ["Shopify timezone 'Central' is not valid."])
    assert o["new2"] == ("rejected", ["Access token is required for new Shopify auth configs."])
    assert o["new3"] == ("rejected", ["Shop/API URL: URL must use https."])
    assert o["new4"] == ("inserted", [])
    m = {r["config_id"]: r for r in merged.collect()}
    assert set(m) == {"chi", "la", "chi2", "new4"}
    assert m["chi"]["access_token"] == "secret1" and m["chi"]["shop_api_url"] == "https://chi.myshopify.com"
    assert m["chi"]["time_zone"] == "America/Chicago" and m["chi"]["created_by"] == "u1"
    assert (m["chi"]["is_active"], m["chi"]["can_read_orders"]) == ("Y", "Y")
    assert (m["new4"]["tenant_id"], m["new4"]["created_by"], m["new4"]["time_zone"], m["new4"]["is_active"],
            m["new4"]["can_read_orders"]) == ("T1", "admin", "UTC", "Y", "N")


def test_delete(spark):
    ids = spark.createDataFrame([("chi",), ("la",), ("nope",), ("",)], "config_id string")
    remaining, out = cfg.delete_configs(table(spark), ids, "T1")
    o = {r["requested_id"]: (r["deleted"], r["error"]) for r in out.collect()}
    assert o["chi"] == (True, None)
    assert o["la"] == (False, "Shopify auth config 'la' is not available in your active tenant.")
    assert o["nope"] == (False, "Shopify auth config 'nope' was not found.")
    assert o[""] == (False, "Shopify auth config ID is required.")
    assert sorted(r["config_id"] for r in remaining.collect()) == ["chi2", "la"]


UPDATE = "config_id string, description string, shop_api_url string, api_version string, time_zone string, access_token string, is_active string, can_read_orders string, position int"


def update(config, n, url="https://n.myshopify.com", zone=None, token=None):
    return (config, f"d{n}", url, "2025-10", zone, token, "Y", "Y", n)


def test_updates_of_one_key_are_saved_one_after_another(spark):
    rows = [update("new", 1), update("new", 2, zone="Asia/Kolkata", token="t2"), update("new", 3, zone="Nowhere"), update("new", 4),
            update("new", 5, url="http://n.myshopify.com"), update("chi", 6, zone="Europe/Berlin"), update("chi", 7, url=" "), update(None, 8), update(" ", 9)]
    merged, out = cfg.merge_configs(table(spark), spark.createDataFrame(rows, UPDATE), "T1", "admin", "position")
    assert {r["position"]: r["action"] for r in out.collect()} == {
        1: "rejected", 2: "inserted", 3: "rejected", 4: "updated", 5: "rejected", 6: "updated", 7: "rejected", 8: "rejected", 9: "rejected"}
    m = {r["config_id"]: r for r in merged.collect()}
    assert (m["new"]["description"], m["new"]["time_zone"], m["new"]["access_token"]) == ("d4", "Asia/Kolkata", "t2")
    assert (m["chi"]["description"], m["chi"]["time_zone"], m["chi"]["access_token"]) == ("d6", "Europe/Berlin", "secret1")
    assert set(m) == {"chi", "la", "chi2", "new"}


def test_permission_flag_is_a_parameter(spark):
    req = spark.createDataFrame([(1, "chi", "T1", None)], "request_id int, config_id string, trusted_tenant string, session_tenant string")
    assert cfg.check_usable(req, table(spark), permission_col=None).first()["usable"]
    flagged = table(spark).selectExpr("*", "'n' AS can_write")
    assert cfg.check_usable(req, flagged, permission_col="can_write").first()["errors"] == ["Shopify auth config chi is not enabled for can_write."]
