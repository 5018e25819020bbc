"""Statuses and fallbacks of pages, and forms of structured data."""

import datetime as dt

from marketloom.operators import articles


def test_every_branch(spark):
    t = dt.datetime(2024, 5, 1, 12)
    ld = lambda s: f'<html lang="en"><script type="application/ld+json">{s}</script><p>Body.</p></html>'
    pages = [
        (1, "u", None), (2, "u", "<html></html>"), (3, "u", "<p>Only text.</p>"), (4, "u", '<time datetime="2024-05-01T14:00:00+02:00">x</time>'),
        (5, "u", ld('{"@type":"Person"}').replace("<p>", '<meta property="og:title" content="From meta"><p>')), (6, "u", ld('{"@type":["X","Article"],"headline":"H","datePublished":"2024-05-01","author":[{"name":"A"},"B",{"name":"A"},null,3],"mainEntityOfPage":"v"}')),
        (7, "u", ld("not json") + ld('[1,null,{"@graph":[{"@graph":[{"@type":"NewsArticle","headline":"deep","datePublished":"2024-05-01T12:00:00Z","isAccessibleForFree":"true","mainEntityOfPage":{"@id":"u"}}]}]}]')),
        (8, "u", ld('{"@type":"NewsArticle","headline":7,"datePublished":5,"dateModified":"x","articleSection":["a"]}').replace("<p>", '<meta content="turned" name="og:title"><h1>No <b>b</b></h1><p>')), (9, "u", '<h1>A <i>head</i></h1>'),
    ]
    got = {r.page_id: r for r in articles.structured(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert {k: r.status for k, r in got.items()} == {1: "failed", 2: "failed", 3: "no_timestamp", 4: "ok", 5: "no_timestamp", 6: "ok", 7: "ok", 8: "no_timestamp", 9: "no_timestamp"}
    assert (got[4].published, got[4].time_source) == (t, "time tag")
    assert got[5].title == "From meta" and got[8].title == "turned" and got[9].title == "A head" and got[8].section is None
    assert (got[6].title, got[6].published, got[6].author, got[6].original_url) == ("H", dt.datetime(2024, 5, 1), "A; B", "v")
    assert (got[7].title, got[7].published, got[7].free, got[7].original_url, got[7].lang) == ("deep", t, True, None, "en")


def test_listing_reasons(spark):
    story = lambda url, more="": '{"asset":{"__typename":"Story","title":"T","contentAttributes":{"clickthroughUrl":"%s","isHosted":true,"pubDate":"2024-01-02T03:04:05"}%s}}' % (url, more)
    rows = [(1, '{"s":[%s]}' % ",".join([story("https://h/a1?x"), '{"asset":{}}', story("https://h/a1"), story("https://o/b"), story("https://h/a2", ',"isLiveBlog":true'), story("https://h/a3").replace("true", "false"), story("https://h/a4", ',"finance":{"stockTickers":[{"symbol":"B"},{},{"symbol":"A"},{"symbol":"B"}]}')])), (2, "broken"), (3, None), (4, '{"s":{}}')]
    out = articles.listed(spark.createDataFrame(rows, "payload_id long, json string"), "$.s", "https://h/a[0-9]")
    got = {(r.payload_id, r.at): r for r in out.collect()}
    assert {k[1]: r.reason for k, r in got.items() if k[0] == 1} == {0: None, 1: "unknown", 2: "repeated", 3: "not an article", 4: "live blog", 5: "not hosted", 6: None}
    assert got[1, 6].tickers == ["B", "A"] and got[1, 0].url == "https://h/a1" and got[1, 0].published == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert {k for k in got if k[0] != 1} == {(4, 0)}
    assert {r.payload_id: (r.entries, r.stories) for r in articles.listing_summary(out).collect()} == {1: (7, 2), 4: (1, 0)}
