import duckdb

from saleshouse.llm import url_filter as u

PAGES = [
    (1, "http://a.example.com/en/1", None),
    (2, "https://WWW.example.com/en/1#x", '<link rel="canonical" href="http://other.org/z">'),
    (3, "http://other.org/z?q=1", "<html><LINK href='/z' REL='Canonical'></html>"),
    (4, "http://other.org/z", '<meta http-equiv="refresh" content="0; url=http://b.net/es/9">'),
    (5, "http://b.net/es/9", ""),
    (6, "http://b.net/en/9", '<link rel=canonical href=//c.info/p>'),
    (7, "http://c.info/p", '<link rel="stylesheet" href="http://b.net/es/9">'),
    (8, None, '<link rel="canonical" href="http://b.net/es/9">'),
    (9, "no scheme", None),
    (10, "http://d.info", '<meta http-equiv=refresh content="5;URL=\'page.html?a=1&amp;b=2\'">'),
    (11, "http://d.info/page.html?a=1&b=2", '<link rel="canonical" href="http://example.com/en/?x"><link rel="canonical" href="#t">'),
    (12, "http://notexample.com/en/1", None),
    (13, "x://y://z.net/fr/", None),
    (14, "http://deep.www.example.com/en/", None),
    (14, "http://deep.www.example.com/en/", None),
    (15, "http://e.info/1", '<link href="http://a.net/es/x"\n  rel="canonical">'),
    (16, "http://e.info/2", '<meta content="0; url=http://a.net/es/x"\r\n http-equiv="refresh">'),
]


def test_aliases_against_sql(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "'h' AS host", "1 AS label", "2 AS node")
    got = sorted(map(tuple, u.judged(df, u.RULES).collect()), key=repr)
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert got == sorted(db.execute(u.SQL).fetchall(), key=repr)
    verdict = {r[0]: r[4] for r in got}
    assert [verdict[i] for i in (1, 2, 3, 4, 5)] == ["block", "allow", "block", "block", "block"]  # 2 is allowed by its own rule
    assert [verdict[i] for i in (6, 7, 8, 9, 10, 11)] == ["allow", "allow", "allow", "allow", "block", "block"]
    assert [verdict[i] for i in (15, 16)] == ["block", "block"]
    assert [verdict[i] for i in (12, 13, 14)] == ["allow", "allow", "allow"]


def test_no_pages(spark):
    assert u.judged(spark.createDataFrame([], "page_id bigint, url string, html string"), u.RULES).count() == 0
