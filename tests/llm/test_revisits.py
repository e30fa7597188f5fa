from deskstar.llm import revisits

SCHEMA = "id long, url string, at long, revisit boolean, etag string, headers map<string,string>"


def test_resolve(spark):
    rows = [(1, "HTTP://A.com:80#x", 1, False, "e", {"type": "t", "date": "1"}), (2, "http://a.com/", 9, True, 'W/e', {"date": "2", "type": "no"}),
            (3, "http://a.com/", 20, True, "f", None), (4, "http://a.com/", 25, None, "f", {}), (5, "http://a.com/", 47, True, "f", None),
            (6, None, 5, True, "e", None), (7, "http://a.com/", None, True, "e", None), (8, "http://b.com/", 9, True, "e", None)]
    found = {r["id"]: r for r in revisits.resolve(spark.createDataFrame(rows, SCHEMA), stretch=10).collect()}
    assert {k: r["response_id"] for k, r in found.items()} == {1: 1, 2: 1, 3: None, 4: 4, 5: 4, 6: None, 7: None, 8: None}
    assert found[2]["headers"] == {"type": "t", "date": "2"}
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_last_modified_and_ports(spark):
    rows = [(1, "http://h/", 1, False, None, "m", {}), (2, "http://h:80/", 2, True, None, "m", {"last-modified": "m"}),
            (3, "http://h:443/", 3, True, None, "m", {}), (4, "https://h:443", 4, False, "e", "m", {}),
            (5, "https://h/", 5, True, "f", "m", {}), (6, "https://h/", 6, True, None, "m", {}),
            (7, "https://h:80/", 7, True, "e", None, {}), (8, "https://h/", 8, True, None, "o", {})]
    schema = SCHEMA.replace("headers", "last_modified string, headers")
    found = {r["id"]: r for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r["response_id"] for k, r in found.items()} == {1: 1, 2: 1, 3: None, 4: 4, 5: None, 6: 4, 7: None, 8: None}
    assert found[2]["headers"] == {"last-modified": "m"}


def test_names_in_any_case_ties_and_repeats(spark):
    rows = [(1, "http://a?q", 1, False, "e", {"Date": "1", "Expires": "1", "Server": "s"}),
            (2, "http://a/?q", 2, True, "e", {"date": "2", "expires": "2", "server": "t"}),
            (3, "http://b/", 5, False, "e", {}), (4, "http://b/", 5, False, "f", {}), (5, "http://b/", 5, True, "f", {}),
            (6, "http://b/", 6, True, "f", {}), (6, "http://b/", 6, True, "f", {})]
    found = [(r["id"], r["response_id"], r["headers"]) for r in revisits.resolve(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert (2, 1, {"Server": "s", "date": "2", "expires": "2"}) in found
    assert sorted(f[:2] for f in found) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 4), (6, 4)]
