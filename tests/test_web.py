import random
from html.parser import HTMLParser

import duckdb
import pytest

from dirspark.functions.markup import tokens
from dirspark.plans.queries import QUERIES, SQL
from dirspark.sources import web


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append((tag, {k: v or "" for k, v in reversed(attrs)}))


def starts(page):
    return [(name, attributes) for kind, name, attributes in tokens(page) if kind == "start"]


def test_tags_of_whole_pages(spark):
    for (page,) in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        plain = Plain()
        plain.feed(page)
        assert starts(page) == plain.seen


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<a href=x/y?a=1&amp;b=2>", [("a", {"href": "x/y?a=1&b=2"})]), ("<A HREF = 'a\"b' disabled data-x=\"'\">", [("a", {"href": 'a"b', "disabled": "", "data-x": "'"})]), ("<p title='a>b'>", [("p", {"title": "a>b"})]),
        ("<!-- <a> --><b>", [("b", {})]), ("<!--><b>", [("b", {})]), ("<!-- <b>", []), ("<!doctype html><?x <y>?><b/>", [("b", {})]), ("<script>if (a<b) '<a>'</SCRIPT ><i>", [("script", {}), ("i", {})]), ("<script><a>", [("script", {})]),
        ("<a <b>", [("a", {"<b": ""})]), ("1 < 2 <3> <", []), ("<a href='x", []), ("<a href=", []), ("</a x='>'><b>", [("b", {})]), ("<a =x==y>", [("a", {"=x": "=y"})]), ("<a x=1 X=2>", [("a", {"x": "1"})]), ("", []),
    ],
)
def test_broken_mark_up(page, want):
    assert starts(page) == want


def test_any_text_ends_and_keeps_its_order():
    rng = random.Random(3)
    for _ in range(3000):
        page = "".join(rng.choice(["<", ">", "a", "/", "=", '"', "'", " ", "!", "--", "<script>", "</script", "&amp;", "<!--", "-->", "é"]) for _ in range(rng.randrange(30)))
        assert all(kind in ("start", "end", "text") for kind, _, _ in tokens(page))
    assert [v for k, v, _ in tokens("a<b>c&lt;</b>d") if k == "text"] == ["a", "c<", "d"]


def test_long_pages_take_linear_time():
    for unit in ("<", "<a ", "<a '", '<a x="', "<!--", "</", "<script>", "a=' ", "<a\n\n\n"):
        assert sum(1 for _ in tokens(unit * 50_000)) <= 100_000


def test_contacts(spark):
    ld = '<script type="application/ld+json">%s</script>'
    store = '{"@type":"Store","telephone":"12","phone":"+91 98470 00001","email":["e@x.in"],"openingHours":"Mo"}'
    pages = [
        ("a", ld % store, "text/html; charset=utf-8"), ("b", ld % store, "application/pdf"), ("c", None, "text/html"), ("d", "", None), ("e", ld % '{"@type":"Person","telephone":"+91 9847000001"}' + "<a href=tel:04027000001>", "TEXT/HTML"),
        ("f", ld % "{" + ld % ("[" * 100_000) + ld % '{"x":[{"@type":["A","Hotel"],"openingHoursSpecification":[3,{"dayOfWeek":"Monday","opens":"9"},{"dayOfWeek":["x/Monday",null],"opens":"9","closes":"10"}]}]}', "html"),
        ("g", "x" * 500 + "é" * 500 + ld % store, "html"), ("h", "<a href='tel:1'>" * 5 + "<a href='tel:9847000001'>", "html"),
    ]
    df = spark.createDataFrame(pages, "external_id string, html string, content_type string")
    got = {r.external_id: tuple(r)[1:] for r in web.from_pages(df).collect()}
    assert got["a"] == ("+919847000001", "Mo", "e@x.in") and got["b"] == got["c"] == got["d"] == got["h"] == (None, None, None)
    assert got["e"] == ("+914027000001", None, None) and got["f"] == (None, "Mo 9-10", None) and got["g"] == got["a"]
    assert {r.external_id: r.public_phone for r in web.from_pages(df, 1501).collect()}["g"] is None
    assert web.from_pages(df.where("false")).count() == 0
    assert web.page_marks(df.where("external_id = 'e'")).first().links == ["tel:04027000001"]
    assert web.from_pages(df.drop("content_type").where("external_id = 'b'")).first().public_phone == "+919847000001"


def twin(spark, name, folder, tables):
    """Rows of a query and of its SQL over the given tables."""
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    got = QUERIES[name](spark, str(folder))
    with duckdb.connect() as con:
        for table in tables:
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
        found = con.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
    return sorted(map(tuple, got.collect()), key=str), sorted(found, key=str)


def test_contacts_of_made_up_numbers_agree_with_sql(spark, tmp_path):
    """Page 88888 makes 9847888888: the operator refuses six equal digits, unless they are allowed."""
    pages = [(88888, "<p>"), (111112, "<p>"), (3333330, None), (88889, "<p>"), (12, "<p>")]
    got, want = twin(spark, "f42_page_contacts", tmp_path, {"pages": spark.createDataFrame(pages, "page_id long, html string")})
    assert got == want and ("88888", "+919847888888", "Mo,Tu 09:00-18:00", "a@example.com") in got
    df = spark.createDataFrame([("a", "<a href='tel:9847888888'><a href='tel:1800123456'>"), ("b", "<a href='tel:1800123456'>")], "external_id string, html string")
    assert [r.public_phone for r in web.from_pages(df).collect()] == [None, None]
    assert [r.public_phone for r in web.from_pages(df, repeats=True).collect()] == ["+919847888888", None]


def test_marks_of_cut_off_references_agree_with_sql(spark, tmp_path):
    """Titles cut off inside a reference, other references, in targets too; pages without a title, null pages."""
    title = "<html><title>%s</title><p>x</p><a href=\"/y\">z</a></html>"
    pages = [(1, title % "a &amp; b&amp"), (2, title % "token = &quot;77&lt;"), (3, title % "R&ampD &copy 1 &#65;"), (4, '<p><a href="/a?b&amp;c">x</a><a href="/&quot;">'), (5, None), (6, ""), (7, title % "")]
    got, want = twin(spark, "s13_page_marks", tmp_path, {"pages": spark.createDataFrame(pages, "page_id long, html string")})
    assert got == want and ("1", "a & b&amp", 1, 1, 0, "/y") in got
    df = spark.createDataFrame([("1", title % "a&amp")], "external_id string, html string")
    assert [web.page_marks(df, as_written=x).first().title for x in (False, True)] == ["a&", "a&amp"]
