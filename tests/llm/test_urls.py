import __spark_entry__ as E
from llm_cases import SF
from oracle_compare import compare, duck
from slipflow.llm import url_filter as U

SCHEMA = "page_id long, url string, html string, host string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x") for i, u, h in rows], SCHEMA)


def judged(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}


def test_query_and_oracle(spark):
    assert not compare(E.queries()["op7_url_filter"](spark, SF), duck(SF), E.oracle_sql()["op7_url_filter"])[2]


def test_parts_and_rules(spark):
    rows = [(1, "HTTPS://WWW.Example.COM/en/x?y#z", None), (2, "http://a.example.com/en/", None),
            (3, "http://example.com", None), (4, "http://b.net/es/q", None), (5, "http://b.net/de/q", None),
            (6, "no scheme", None), (7, None, None), (8, "x://notcom/", None), (9, "a://b.com?u=c://d.net/es/", None),
            (10, "http://éÉ.net/fr/\n2", None), (11, "", None), (12, "http://sub.www.example.com/en/a", None),
            (13, "http://example.com/EN/", None), (14, "://host.net/fr/", None)]
    got = judged(U.judge_urls(frame(spark, rows)))
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("example.com", "", None, "allow")
    assert got[4] == ("b.net", "/es/q", "net/es/", "block")
    assert got[5] == ("b.net", "/de/q", None, "allow")
    assert got[6] == got[7] == got[11] == ("", "", None, "allow")
    assert got[8] == ("notcom", "/", None, "allow")
    assert got[9] == ("b.com", "", None, "allow")
    assert got[10] == ("éÉ.net", "/fr/\n2", "net/fr/", "block")
    assert got[12][2] == "www.example.com/en/" and got[13][2] == "com/" and got[14][2] == "net/fr/"


CANON = '<link rel="canonical" href="{}">'
REFRESH = "<meta http-equiv='refresh' content='0; url={}'>"


def brute(rows):
    """Verdicts by repeated relaxation over the alias edges."""
    import re
    address = lambda u: (re.sub(r"^(www|m)\.", "", re.match(r"(?s).*?://([^/?#]*)", u)[1].lower()) + "/"
                         + re.sub(r"^/", "", re.sub(r"(\.html|/+)$", "", re.match(r"(?s).*?://[^/?#]*([^?#]*)", u)[1])))
    at = {i: address(u) for i, u, _ in rows}
    group = {a: a for a in at.values()}
    edges = []
    for i, _, h in rows:
        for t in re.findall(r"(?:href=\"|url=)([^\"'>]+)", h or ""):
            group.setdefault(address(t), address(t))
            edges.append((at[i], address(t)))
    for _ in range(len(group)):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    return {i: group[a] for i, a in at.items()}


def test_decisions_travel_over_aliases(spark):
    rows = [(1, "http://one.org/a", CANON.format("http://b.net/es/1")),  # alias of a blocked page
            (2, "http://b.net/es/1", None),
            (3, "http://two.org/b", REFRESH.format("https://three.org/c.html")),
            (4, "http://m.three.org/c/?q=1", CANON.format("http://c.com/x")),  # alias of an allowed page
            (5, "http://c.com/x", CANON.format("http://d.net/fr/9")),  # and of a blocked one: allow wins
            (6, "http://d.net/fr/9", None),
            (7, "http://four.org/", None), (8, "https://www.one.org/a.html#top", None)]
    rows += [(100 + i, f"http://chain.org/{i}", CANON.format(f"http://chain.org/{i + 1}")) for i in range(20)]
    rows += [(120, "http://chain.org/20", CANON.format("http://e.net/es/end")), (121, "http://e.net/es/end", None)]
    got = U.judge_urls(frame(spark, rows))
    verdict = {i: v[3] for i, v in judged(got).items()}
    assert verdict[1] == verdict[8] == verdict[2] == "block"
    assert verdict[3] == verdict[4] == verdict[5] == "allow" and verdict[6] == "block"  # an own rule stays
    assert verdict[7] == "allow" and all(verdict[100 + i] == "block" for i in range(21))
    assert {r.page_id: r.component for r in got.collect()} == brute(rows)


def test_odd_cases(spark):
    rows = [(None, "http://b.net/es/1", None), (1, "http://b.net/es/1", ""), (1, "http://b.net/es/1", "x" * 5000),
            (2, None, CANON.format("http://b.net/es/1")), (3, "http://z.org/", CANON.format("/es/1")),
            (4, "http://z.org/q", CANON.format("//b.net/es/1")), (5, "http://z.org/w", '<link rel="canonical">')]
    got = U.judge_urls(frame(spark, rows))
    assert got.count() == len(rows)
    assert judged(got)[4][3] == "block" and judged(got)[2][3] == "allow"
    assert U.judge_urls(frame(spark, [])).count() == 0
    assert {r.verdict for r in U.judge_urls(frame(spark, rows), rules=()).collect()} == {"allow"}


RELATIVE = [
    (1, "http://a.example.org/x/p.html", CANON.format("q.html")), (2, "http://a.example.org/x/q.html", None),
    (3, "http://a.example.org/x/y/r", CANON.format("../../z/s/./t")), (4, "http://a.example.org/z/s/t/", None),
    (5, "http://a.example.org/u?p=1", CANON.format("?p=2")), (6, "http://a.example.org", CANON.format("top.html#x")),
    (7, "https://www.a.example.org/top", None), (8, "http://a.example.org/v/w", CANON.format("../../../../k")),
    (9, "http://a.example.org/k", None), (10, "http://a.example.org/l/", CANON.format("m/") + REFRESH.format("/n/../o")),
    (11, "http://a.example.org/l/m", None), (12, "http://a.example.org/o.html", None),
    (13, "http://a.example.org/mail", CANON.format("mailto:x")), (14, "http://a.example.org/two", CANON.format("//b.net/es/two")),
    (15, "http://b.net/es/two", None), (16, "no scheme", CANON.format("q.html")), (17, None, None),
    (18, "http://c.org/a/b", REFRESH.format("c") + REFRESH.format("../d") + CANON.format("#e")), (19, "http://c.org/a/c", None),
    (20, "http://c.org/d", CANON.format("HTTP://B.NET/es/two?x")), (21, "http://q.org/a//b", CANON.format(".//c")),
    (22, "http://q.org/a//c", None), (23, "http://q.org/a///c", None)]


def test_relative_targets(spark):
    got = {r.page_id: (r.component, r.verdict) for r in U.judge_urls(frame(spark, RELATIVE)).collect()}
    for a, b in ((1, 2), (3, 4), (6, 7), (8, 9), (10, 11), (10, 12), (18, 19), (18, 20), (14, 15), (21, 23)):
        assert got[a] == got[b], (a, b)
    assert got[5][0] == "a.example.org/u" and got[13][0] == "a.example.org/mail" and got[16][0] is None
    assert {got[i][1] for i in (14, 15, 18, 19, 20)} == {"block"} and got[1][1] == "allow"


def test_sql_on_pages_with_links(spark):
    """The SQL on pages with every kind of link, which the given pages do not hold."""
    import duckdb
    rows = RELATIVE + [(100 + i, f"http://chain.org/{i}", CANON.format(f"{i + 1}")) for i in range(12)]
    rows += [(112, "http://chain.org/12", CANON.format("http://e.net/es/end")), (113, "http://e.net/es/end", None),
             (114, "http://f.com/x", REFRESH.format("http://chain.org/3")), (115, "http://chain.org/3.html", "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert not compare(U.judge_urls(frame(spark, rows)), con, U.OP7_SQL)[2]
