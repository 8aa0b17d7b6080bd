"""Listing pages, links and archive names."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F
from tabularium.functions import entity_name, file_name, hrefs, snapshot_month
from tabularium.operators import extract_links, latest_snapshot, newest_link, wanted_files


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links = []

    def handle_starttag(self, tag, attributes):
        if tag == "a":
            named = {k: v or "" for k, v in attributes}
            if "href" in named:
                self.links.append(named["href"])


def parsed(html):
    parser = Anchors()
    parser.feed(html)
    parser.close()
    return parser.links


PAGES = [
    '<a href="x">',
    '<a  href = "x" >',
    "<A HREF=x>",
    "<a href=x/>",
    "<a href>",
    '<a href="">',
    "<a name=q>",
    '<abbr href="x">',
    '<a data-href="x">',
    '<a title="see href=foo" href="bar">',
    '<a title="a>b" href="x">',
    "<a title=it's href='q'>",
    '<a href="x" href="y">',
    '<a/href="x">',
    '<!-- <a href="x"> --><a href="y">',
    "<script>var a=\"<a href='q'>\";</script><a href=z>",
    '<style>a{}</style><a href="t">',
    '<script><a href="n">',
    '<a href="a&amp;b">',
    '<a href="a&amp;lt;b">',
    '<a href="a&#38;lt;b&#x26;amp;c&amp;&amp;d&">',
    '<a href="&#x2F;p&#47;&#233;&#xE9;&#x1F600;&#128512;&#0;&#xD800;&#x110000;">',
    '<a href="mailto:&#109;&#X6D;?a=1&b=2&c;&apos;&quot;&#;&#x;&#39;">',
    '<a href="&nbsp;&eacute;&eacute&amp b&ampx=1&notit;&notin;&copy2&NotEqualTilde;&bogus;&x">',
    '<a href="&#00000038;&#x0000026;&#128;&#x96;&#13;&#1;&#xFFFF;&#xFDD0;&#99999999999;&#xFFFFFFFF;&#38">',
    '<a href="&#xZ;&#0000;&lt&gt&LT&AMP&quot&aelig&AElig;&fjlig;&acE;">',
    '<a\nhref="x"\n>',
    '<a href="x"><a href="y">',
    "<a class=c href=/p/q?x=1&y=2 >",
    '<a href="x',
    '<a href="x>y</a><a href="z">',
    "<a href='it\"s'>",
    '<a href="  x ">',
    '<a href="ção/é">',
    '<a checked href="x">',
    '<a =href="x">',
    '<a href="x"/>',
    '<a href="x"class="y">',
    '<a href=""x"">',
    "<div data-tip='<a href=\"x\">'><a href=y>",
    '<a href="k"<p><a href="l">',
    '<b <a href="q">',
    '<a<a href="q">',
    '<!--><a href="q">',
    '<script src="a>b">var x = "<a href=1>"</script ><a href="z">',
    "text <b>no</b>",
    "",
]


def soups():
    """Markup strung together at random, without comments, quotes or tags that stay open."""
    random.seed(5)
    pieces = (
        "<a |<a|<A\t|</a>|>| href=| HREF = |href|=|x|2024-01/| |/|<p>|<b |class=c|<!-- <a href=n> -->"
        "|<script><a href=n></script>|<style>a{}</style>|&amp;|&lt;|&#38;|&#x3C;|&|#|;|\n|<abbr |/>|text"
        "|data-href=\"z\"|href=\"k\"|href='m'|href=u|<a href=\"q\">|title=\"<a href='n'>\""
    ).split("|")
    for _ in range(20_000):
        yield "".join(random.choices(pieces, k=random.randint(1, 14))) + ">"


def test_hrefs_equal_an_html_parser_on_hand_written_pages(spark):
    pages = spark.createDataFrame(list(enumerate(PAGES)), "i int, html string")
    for row in pages.select("html", hrefs(F.col("html")).alias("links")).collect():
        assert row.links == parsed(row.html), row.html


def test_hrefs_equal_an_html_parser_on_tag_soup(spark):
    pages = spark.createDataFrame([(soup,) for soup in set(soups())], "html string")
    rows = pages.select("html", hrefs(F.col("html")).alias("links")).collect()
    wrong = [row.html for row in rows if row.links != parsed(row.html)]
    assert not wrong, wrong[:5]


def test_hrefs_equal_an_html_parser_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", hrefs(F.col("html")).alias("links")).collect()
    assert all(row.links == parsed(row.html) for row in rows)
    assert sum(len(row.links) for row in rows) > 1000


@pytest.mark.parametrize(
    "html", ["<a " + "w " * 300_000, '<a href="x" ' * 20_000, '<a x="' * 20_000, "<!--" * 50_000]
)
def test_broken_pages_neither_fail_nor_hang(spark, html):
    page = spark.createDataFrame([(html,)], "html string")
    assert page.select(hrefs(F.col("html"))).first()[0] == []


def test_extract_links(spark):
    pages = spark.createDataFrame(
        [(1, "u", '<a href="b"><a name="n"><a href="a">'), (2, "v", None), (3, "w", "<p>")],
        "page_id int, url string, html string",
    )
    links = extract_links(pages)
    assert links.columns == ["page_id", "url", "pos", "href"]
    assert [tuple(r) for r in links.collect()] == [(1, "u", 0, "b"), (1, "u", 1, "a")]


SNAPSHOTS = [
    (["2024-09/", "2024-11/", "2024-10/"], "2024-11/"),
    (["2024-11/a/", "2024-11/b/"], "2024-11/a/"),
    (["2024-13/", "2024-01/"], "2024-01/"),
    (["0000-05/"], None),
    (["docs/", "20-11/"], None),
    (["x2023-12y/2099-01/", "2022-01/"], "x2023-12y/2099-01/"),
    ([], None),
]


def test_latest_snapshot(spark):
    pages = [
        (i, "".join(f'<a href="{link}">' for link in links)) for i, (links, _) in enumerate(SNAPSHOTS)
    ]
    rows = latest_snapshot(spark.createDataFrame(pages, "page_id int, html string"), "h/").collect()
    expected = [link and f"h/{link}" for _, link in SNAPSHOTS]
    assert [r.snapshot_url for r in sorted(rows, key=lambda r: r.page_id)] == expected


def test_latest_snapshot_keeps_the_pages_own_columns(spark):
    pages = spark.createDataFrame(
        [(1, "u", "m", '<a href="2024-01/">')], "rank int, url string, month string, html string"
    )
    (row,) = latest_snapshot(pages, "h/").collect()
    assert (row.rank, row.url, row.month, row.snapshot_url) == (1, "u", "m", "h/2024-01/")


def test_newest_link_chooses_as_latest_snapshot_does(spark):
    links = [
        (i, pos, link) for i, (links, _) in enumerate(SNAPSHOTS) for pos, link in enumerate(links)
    ]
    rows = newest_link(
        spark.createDataFrame(links, "site int, pos int, href string"), "h/", "site"
    ).collect()
    expected = {i: link and f"h/{link}" for i, (links, link) in enumerate(SNAPSHOTS) if links}
    assert {r.site: r.snapshot_url for r in rows} == expected


def test_wanted_files(spark):
    names = ["Cnaes.zip", "CNAES.ZIP", "motivos.txt", "ESTABELECIMENTOS3.zip", "Empresas0.zip"]
    links = spark.createDataFrame([(n,) for n in [*names, None]], "href string")
    rows = wanted_files(links, "https://h/2024-11/").collect()
    assert [(r.url, r.file_name) for r in rows] == [
        ("https://h/2024-11/Cnaes.zip", "Cnaes.zip"),
        ("https://h/2024-11/ESTABELECIMENTOS3.zip", "ESTABELECIMENTOS3.zip"),
    ]
    only = wanted_files(links, "", entities=["empresas"]).collect()
    assert [r.href for r in only] == ["Empresas0.zip"]
    assert wanted_files(links, "", entities=[]).isEmpty()


def test_names(spark):
    links = [
        ("https://h/a/Estabelecimentos0.zip", "Estabelecimentos0.zip", "Estabelecimentos"),
        ("Cnaes.zip", "Cnaes.zip", "Cnaes"),
        ("a/ESTABELECIMENTOS33.zip", "ESTABELECIMENTOS33.zip", "ESTABELECIMENTOS"),
        ("a/b2c4.txt", "b2c4.txt", "b2c4.txt"),
        ("a/", "", ""),
    ]
    rows = spark.createDataFrame(links, "link string, name string, entity string")
    for row in rows.withColumn("n", file_name(F.col("link"))).select("*", entity_name(F.col("n")).alias("e")).collect():
        assert (row.n, row.e) == (row.name, row.entity)


def test_snapshot_month(spark):
    cases = {"a/2024-02-03/": "2024-02-01", "2024-00": None, "x": None, None: None}
    rows = spark.createDataFrame([(c,) for c in cases], "s string")
    months = rows.select("s", snapshot_month(F.col("s")).cast("string")).collect()
    assert {r[0]: r[1] for r in months} == cases
