"""Feed readers on small landed files (golden) and the registry landing."""

import json
import os
import uuid

import pytest

from tradewind.session import scratch_path
from tradewind.sources.feeds import (read_rss, read_search, read_timeline, rejects, rss_items,
                                     search_items, timeline_items)


def _land(spark, name, text):
    d = scratch_path(spark, f"feeds-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    os.makedirs(f"{d}/{os.path.dirname(name)}", exist_ok=True)
    with open(f"{d}/{name}", "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def test_search_items_one_by_one(spark):
    hits = {"hits": [
        {"objectID": "1", "title": "A &amp; B", "url": None, "story_text": "<p>body</p>",
         "created_at": "2024-01-01T23:30:00-05:00", "points": 7},   # url built, local date
        5,                                                          # not an object
        {"objectID": "2", "title": "", "story_title": "Fallback", "url": "http://x/2",
         "created_at": "2024-01-02T10:00:00Z", "comment_text": "c", "points": "many"},
        {"objectID": None, "title": "", "story_title": "", "url": ""}]}
    d = _land(spark, "source_id=s1/p.json", json.dumps(hits) + "\n" + "not json\n")
    rows = {r.position: r for r in read_search(spark, d).collect()}
    assert set(rows) == {0, 2}
    assert rows[0].url == "https://news.ycombinator.com/item?id=1" and rows[0].title == "A & B"
    assert rows[0].content == "body" and str(rows[0].published_date) == "2024-01-01"
    assert rows[0].external_guid == "hn_1" and rows[2].title == "Fallback"
    assert rows[2].content == "c" and rows[2].language_code == "en" and rows[0].source_id == "s1"
    raw = json.loads(rows[0].raw_payload)
    assert raw["source_api"] == "hacker_news_algolia" and raw["points"] == 7 and raw["url"] is None
    # the number, the item without a link, and the line that is no JSON
    got = {(r.reject_reason, r.rejected) for r in rejects(search_items(spark, d)).collect()}
    assert got == {("not an item", 2), ("no link", 1)}


def test_search_pretty_printed(spark):
    d = _land(spark, "source_id=s1/p.json", json.dumps(
        {"hits": [{"objectID": str(i), "title": f"t{i}"} for i in range(3)]}, indent=2))
    assert sorted(r.title for r in read_search(spark, d).collect()) == ["t0", "t1", "t2"]


def test_timeline_items_one_by_one(spark):
    items = [{"id": "1", "url": "http://m/1", "content": "<p>" + "x" * 300 + "</p>",
              "created_at": "2024-01-01T10:00:00Z", "account": None}, 5,
             {"id": "2", "url": "http://m/2", "content": ""},
             {"id": "3", "url": "http://m/3", "content": "hi", "language": "de",
              "account": {"acct": "u3", "bot": False}}]
    d = _land(spark, "source_id=s2/t.json", json.dumps(items, indent=1))
    rows = {r.position: r for r in read_timeline(spark, d).collect()}
    assert set(rows) == {0, 3}
    assert len(rows[0].title) == 120 and rows[0].language_code == "en"
    assert rows[0].author_name is None and rows[3].author_name == "u3"
    assert rows[3].language_code == "de" and rows[3].external_guid == "mastodon_3"
    assert json.loads(rows[3].raw_payload)["account"] == {"acct": "u3", "bot": False}
    got = {(r.reject_reason, r.rejected) for r in rejects(timeline_items(spark, d)).collect()}
    assert got == {("not an item", 1), ("no title", 1)}


def test_rss_namespaces_dates_and_order(spark):
    xml = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"
     xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><language>fr</language>
<item><title>T &amp;amp; x</title><link>http://a/1</link><guid isPermaLink="false">g1</guid>
 <pubDate>Tue, 02 Jan 2024 23:30:00 -0500</pubDate><category>oil</category><category>opec</category>
 <description>&lt;b&gt;S&lt;/b&gt;</description>
 <content:encoded>&lt;p&gt;Whole &lt;i&gt;text&lt;/i&gt;&lt;/p&gt;</content:encoded>
 <dc:creator>Ann</dc:creator></item>
<item><title></title><link>http://a/2</link></item>
<item><title>Same</title><link>http://a/1</link><pubDate>2024-01-05T10:00:00Z</pubDate></item>
</channel></rss>"""
    d = _land(spark, "source_id=r1/f.xml", xml)
    rows = {r.position: r for r in read_rss(spark, d).collect()}
    assert set(rows) == {0, 2}
    r = rows[0]
    assert (r.title, r.summary, r.content, r.language_code) == ("T & x", "S", "Whole text", "fr")
    assert (r.author_name, r.external_guid, r.tags, r.links) == (
        "Ann", "g1", ["oil", "opec"], ["http://a/1"])
    assert str(r.published_date) == "2024-01-03"          # feed times are UTC
    assert str(rows[2].published_date) == "2024-01-05" and rows[2].external_guid is None
    assert json.loads(r.raw_payload)["tags"] == ["oil", "opec"]
    assert [(x.reject_reason, x.rejected) for x in rejects(rss_items(spark, d)).collect()] == [
        ("no title", 1)]


def test_atom(spark):
    xml = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xml:lang="de">
<entry><title>One</title><id>urn:1</id><link rel="self" href="http://a/self"/>
 <link href="http://a/1"/><updated>2024-02-01T08:00:00+01:00</updated><summary>Sum</summary>
 <content type="html">&lt;p&gt;Body&lt;/p&gt;</content><author><name>Bo</name></author>
 <category term="oil"/></entry></feed>"""
    d = _land(spark, "source_id=a1/f.xml", xml)
    (r,) = read_rss(spark, d).collect()
    assert (r.title, r.url, r.external_guid, r.author_name, r.language_code) == (
        "One", "http://a/1", "urn:1", "Bo", "de")
    assert (r.summary, r.content, r.tags) == ("Sum", "Body", ["oil"])
    assert r.published_at.isoformat() == "2024-02-01T07:00:00" and len(r.links) == 2


HEAD = '<?xml version="1.0"?><rss version="2.0"><channel><language>en</language>'
GOOD = "<item><title>Good {0}</title><link>http://a/{0}</link></item>"
TAIL = "</channel></rss>"
RDF = ('<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
       'xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">'
       '<channel rdf:about="http://a/"><title>c</title><dc:language>fr</dc:language><items><rdf:Seq>'
       '<rdf:li resource="http://a/1"/></rdf:Seq></items></channel>')


@pytest.mark.parametrize("body,titles,rejected", [
    # a bare ampersand, an entity that XML does not know, a control character, a bare "<"
    (HEAD + GOOD.format(1) + "<item><title>R & D a=1&b=2</title><link>http://a/?x=1&y=2</link></item>"
     + GOOD.format(3) + TAIL, ["Good 1", "R & D a=1&b=2", "Good 3"], 0),
    (HEAD + GOOD.format(1) + "<item><title>x&nbsp;y &eacute;&#11;</title><link>http://a/2</link></item>"
     + GOOD.format(3) + TAIL, ["Good 1", "x y é", "Good 3"], 0),
    (HEAD + GOOD.format(1) + "<item><title>a \x02 1 < 2</title><link>http://a/2</link></item>"
     + GOOD.format(3) + TAIL, ["Good 1", "a 1 < 2", "Good 3"], 0),
    # an item that cannot be mended loses nothing but itself
    (HEAD + GOOD.format(1) + "<item><title>bad</link></item>" + GOOD.format(3) + TAIL,
     ["Good 1", "Good 3"], 1),
    (HEAD + GOOD.format(1) + "<item><title>no end</title>" + GOOD.format(3) + TAIL,
     ["Good 1", "Good 3"], 1),
    # cut off behind an item, inside one, inside a CDATA section
    (HEAD + GOOD.format(1) + GOOD.format(2), ["Good 1", "Good 2"], 0),
    (HEAD + GOOD.format(1) + GOOD.format(2) + "<item><title>Half", ["Good 1", "Good 2"], 1),
    (HEAD + GOOD.format(1) + "<item><title>T</title><description><![CDATA[<p>x</item>", ["Good 1"], 1),
    # items beside the channel; the channel's <items> is none
    (RDF + '<item rdf:about="http://a/1"><title>One</title><link>http://a/1</link></item>'
     "<item><title>Bad</item>" + "<item><title>Two</title><link>http://a/2</link></item></rdf:RDF>",
     ["One", "Two"], 1),
    # markup in CDATA and comments does not cut items
    (HEAD + "<!-- <item> --><item><title><![CDATA[A <item> & </item> &amp; B]]></title>"
     "<link>http://a/1</link></item>" + TAIL, ["A & & B"], 0),
    # no feed at all; Spark's readers pass over files of no bytes
    ("", [], 0), (" \n", [], 1), ("<html><body>404</body></html>", [], 1), ("not xml < at & all", [], 1),
    (HEAD, [], 1), (HEAD + TAIL, [], 0), (HEAD + "<item/>" + GOOD.format(2) + TAIL, ["Good 2"], 1),
])
def test_rss_bodies_in_the_wild(spark, body, titles, rejected):
    d = _land(spark, "source_id=w/f.xml", body)
    items = rss_items(spark, d)
    assert [r.title for r in read_rss(spark, d).orderBy("position").collect()] == titles
    assert sum(r.rejected for r in rejects(items).collect()) == rejected


def test_rdf_fields(spark):
    d = _land(spark, "source_id=w/f.xml", RDF + '<item rdf:about="http://a/1"><title>One</title>'
              "<link>http://a/1</link><dc:date>2024-03-01T10:00:00+02:00</dc:date></item></rdf:RDF>")
    (r,) = read_rss(spark, d).collect()
    assert (r.external_guid, r.language_code, r.source_id) == ("http://a/1", "fr", "w")
    assert r.published_at.isoformat() == "2024-03-01T08:00:00"


@pytest.mark.parametrize("encoding", ["iso-8859-1", "utf-16", "utf-8"])
def test_declared_encodings(spark, encoding):
    text = HEAD.replace('"1.0"?', f'"1.0" encoding="{encoding}"?') + (
        "<item><title>Café “x”</title><link>http://a/1</link></item>") + TAIL
    d = _land(spark, "source_id=w/f.xml", "")
    with open(f"{d}/source_id=w/f.xml", "wb") as fh:
        fh.write(text.encode("cp1252" if encoding == "iso-8859-1" else encoding))
    assert [r.title for r in read_rss(spark, d).collect()] == ["Café “x”"]


def test_long_feed_bodies(spark):
    """Long texts and many items neither overflow a stack nor take long."""
    long = "<item><title>t</title><link>http://a/9</link><description>" + "x &lt;p&gt; y " * 60000 + (
        "</description></item>")
    d = _land(spark, "source_id=w/f.xml", HEAD + long + "".join(GOOD.format(i) for i in range(3000)) + TAIL)
    assert read_rss(spark, d).count() == 3001


def test_registered_feeds_parse_every_landed_item(spark):
    from tradewind.registry import QUERIES
    from .conftest import SF_SMALL
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    assert QUERIES["feed_items_rss"](spark, SF_SMALL).count() == pages
