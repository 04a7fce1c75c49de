"""The SQL counterparts give the operators' rows, on fixtures with what the given tables lack."""

import duckdb
import pytest

from pelagia.llm import hosts, oracles, templates


def both(df, sql, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t.toArrow())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr), sorted(cur.fetchall(), key=repr)


def test_links_spread_trust_and_distrust_alike(spark):
    def page(k, url, *links):
        return k, url, " ".join(f'<a class="x" href="https://{h}/p">t</a>' for h in links) or None

    rows = [page(1, "http://a.org/fr/x", "b.com"), page(2, "http://b.com/x?q", "d.com", "B.com"), page(3, "https://c.com", "bad.net", "bad.net", "b.com"),
            page(4, "http://bad.net/", "e.com"), page(5, "http://d.com/#f", "c.com"), page(6, "x://EXAMPLE.net/en/y"), page(7, None), page(8, "no scheme"),
            page(9, "http://www.example.net/de"), page(9, "http://www.example.net/de"), page(None, "http://f.com/a", "d.com"), page(11, "http:///nohost", "a.org")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = ["example.net/en/", "org/fr/"], ["net/", "example.com/de/"]
    got, want = both(hosts.filter_urls(pages, *rules), oracles.host_graph_sql(*rules), pages=pages)
    assert got == want and len(got) == len(rows)
    assert {r[4] for r in got if r[1] == "c.com"} == {"block"}  # no rule fits it: more distrust than trust comes along links
    empty = pages.limit(0)
    assert both(hosts.filter_urls(empty, *rules), oracles.host_graph_sql(*rules), pages=empty) == ([], [])


@pytest.mark.parametrize("at_once", [True, False])
def test_template_windows_alike(spark, at_once):
    item = "the grocer packs 12 boxes of 3.5 kg each and then Maria carries 12 boxes to the cold store before noon"
    docs = [(1, "Intro. " + item + " end"), (2, item.replace("12", "40").replace("Maria", "Yusuf")), (3, item.replace("12", "40", 1)), (4, None), (5, ""), (5, item), (5, item),
            (6, item.upper()), (None, "so " + item.replace("3.5", "1,2,3").replace(" kg", " miles")), (7, "plain words " * 40), (8, item.replace("12 boxes", "12th boxes")),
            (9, "short question has 5 Plain words 7 km"), (10, "short question has 6 Plain words 8  km"), (11, "so; Anna, Bert; Carl Dora met_us at 1.2.3 m")]
    items = [(1, item), (2, "short question has 5 Plain words 7 km"), (3, None), (4, "four plain words only"), (None, "so; Anna, Bert; Carl Dora met us at 1.2.3 m")]
    d = spark.createDataFrame(docs if at_once else docs[:0], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got, want = both(templates.contaminated(d, b), oracles.template_leaks_sql(), documents=d, benchmark=b)
    assert got == want and bool(got) == at_once
