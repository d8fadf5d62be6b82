from guideloom.llm import urls
from guideloom.llm.queries import URL_RULES

PAGES = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?q#f", "http://example.org/en/19", "http://a.example.org/en/2", "http://notexample.org/es/", "http://xorg/", "https://x.org", "https://x.com/fr/a", "https://com/de/a", "https://x.com/de/a?utm_source=f", "http://x.net/a/?b=1&utm_x=2", "http://www.x.net/a?b=1", "http://u@x.net:80/a?utm_a=1#z", "http://x.net/é?a#b?c", "http://x.net?q/://y.org/"]


def verdicts(spark, listed, pages=PAGES, **options):
    table = spark.createDataFrame([(k, u, "h", "p") for k, u in enumerate(pages)], "page_id long, url string, host string, path string")
    return {r["page_id"]: r for r in urls.url_filter(table, spark.createDataFrame([(x,) for x in listed], "canon string"), URL_RULES, **options).collect()}


def test_rules_and_list(spark):
    rows = verdicts(spark, ["x.net/a?b=1", None, "x.net/é?a"])
    got = [(r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) for _, r in sorted(rows.items())]
    assert got == [
        ("", "", None, "allow", False), ("", "", None, "allow", False), ("", "", None, "allow", False), ("", "", None, "allow", False),
        ("www.example.org", "/es/x", "example.org/es/", "block", False), ("example.org", "/en/19", "example.org/en/1", "block", False), ("a.example.org", "/en/2", "org/", "allow", False), ("notexample.org", "/es/", "org/", "allow", False),
        ("xorg", "/", None, "allow", False), ("x.org", "", None, "allow", False), ("x.com", "/fr/a", "com/fr/", "allow", False), ("com", "/de/a", "com/de/", "block", False), ("x.com", "/de/a", "com/de/", "block", False),
        ("x.net", "/a/", None, "block", True), ("www.x.net", "/a", None, "block", True), ("u@x.net:80", "/a", None, "allow", False), ("x.net", "/é", None, "block", True), ("x.net", "", None, "allow", False),
    ]


def test_filter_passes_all_listed(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS canon")
    rows = spark.range(6000).selectExpr("concat('k', id) AS canon", "id")
    exact = urls.listed_flags(rows, keys, "canon")
    assert {r["id"] for r in exact.filter("listed").collect()} == set(range(3000)) and exact.count() == 6000
    beyond = urls.listed_flags(rows, keys, "canon", max_filter_bytes=0)
    assert sorted(map(tuple, beyond.select("id", "listed").collect())) == sorted(map(tuple, exact.select("id", "listed").collect()))


def test_shuffled_filter_and_rows_without_a_key(spark):
    table = spark.createDataFrame([(k, None if k % 3 else f"k{k}") for k in range(300)], "id long, canon string")
    keys = spark.createDataFrame([("k0",), ("k3",)], "canon string")
    for most in (0, 1 << 20):
        assert sorted(r["id"] for r in urls.listed_flags(table, keys, "canon", max_filter_bytes=most).filter("listed").collect()) == [0, 3]
        assert urls.listed_flags(table, keys, "canon", max_filter_bytes=most).count() == 300
    plan = urls.listed_flags(table, keys, "canon", max_filter_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan  # the filter is there whatever its size


def test_rules_of_equal_length(spark):
    rows = spark.createDataFrame([("a.com", "/b/c")], "h string, p string")
    for rules in ([("block", "com", "/b/"), ("allow", "com", "/b/")], [("allow", "com", "/b/"), ("block", "com", "/b/")]):
        rule, verdict = urls.rule_of(rows["h"], rows["p"], rules)
        assert rows.select(rule, verdict).first()== ("com/b/", "allow")  # the same rule twice: the first verdict in order


def test_odd_tables(spark):
    assert verdicts(spark, [], []) == {}
    assert [r["verdict"] for r in verdicts(spark, [], ["http://a.net/"] * 3).values()] == ["allow"] * 3
