"""Queries of articles and listings. Structured data is written into the given pages, in six forms by page number; listings hold twenty pages each."""

from pyspark.sql import functions as F

from marketloom.operators import articles
from marketloom.plans.base import query, read

_TIME = "TIMESTAMP '2024-01-01' + to_minutes(page_id::INT * 7)"


def with_data(spark, d):
    """pages with JSON-LD: 0 one object; 1 a list whose second member is the article, two authors; 2 an article in @graph with a list of types; 3 broken data and a time tag;
    4 an object of another kind; 5 an article without a date."""
    p = read(spark, d, "pages")
    at = F.timestamp_add("MINUTE", (F.col("page_id") * 7).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    head = F.concat(F.lit("Page "), F.col("page_id"))
    person = lambda n: F.struct(F.lit("Person").alias("@type"), F.concat(F.lit(n), F.col("page_id") % 3).alias("name"))
    news = lambda kind, author, **more: F.struct(kind.alias("@type"), head.alias("headline"), *[c.alias(k) for k, c in more.items()], author.alias("author"), F.struct(F.lit("Desk").alias("name")).alias("provider"), F.struct(F.col("url").alias("@id")).alias("mainEntityOfPage"))
    site = F.struct(F.lit("WebSite").alias("@type"), F.lit("A site").alias("name"))
    one = F.to_json(news(F.lit("NewsArticle"), person("A"), datePublished=F.concat(iso, F.lit("Z")), dateModified=F.concat(iso, F.lit("+01:00")), articleSection=F.lit("markets"), isAccessibleForFree=F.lit(True)))
    two = F.concat(F.lit("["), F.to_json(site), F.lit(","), F.to_json(news(F.lit("Article"), F.array(person("A"), person("B"), person("A")), datePublished=iso, isAccessibleForFree=F.lit("False"))), F.lit("]"))
    three = F.to_json(F.struct(F.array(F.struct(F.array(F.lit("Thing"), F.lit("BlogPosting")).alias("@type"), head.alias("headline"), iso.alias("datePublished"), F.lit(" Solo ").alias("author"))).alias("@graph")))
    six = F.to_json(news(F.lit("NewsArticle"), F.lit(None).cast("string"), datePublished=F.lit("soon")))
    form = F.col("page_id") % 6
    data = F.when(form == 0, one).when(form == 1, two).when(form == 2, three).when(form == 3, F.lit('{"@type": "NewsArticle", ')).when(form == 4, F.to_json(site)).otherwise(six)
    tag = F.when(form == 3, F.concat(F.lit('<time datetime="'), iso, F.lit('Z">then</time>'))).otherwise(F.lit(""))
    script = F.concat(F.lit('<script type="application/ld+json">'), data, F.lit("</script>"))
    return p.select("page_id", "url", F.concat(F.regexp_replace("html", "</head>", ""), script, tag).alias("html"))


@query(rf"""WITH p AS (SELECT *, page_id % 6 AS f, {_TIME} AS t, trim(regexp_replace(regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'gs')) AS h FROM pages)
 SELECT page_id, CASE WHEN f IN (3, 4) THEN nullif(h, '') ELSE 'Page ' || page_id END AS title, CASE WHEN f <= 3 THEN t END AS published, CASE WHEN f = 0 THEN t - INTERVAL 1 HOUR END AS modified,
 CASE WHEN f <= 2 THEN 'linked data' WHEN f = 3 THEN 'time tag' END AS time_source, CASE f WHEN 0 THEN 'A' || page_id % 3 WHEN 1 THEN 'A' || page_id % 3 || '; B' || page_id % 3 WHEN 2 THEN 'Solo' END AS author,
 CASE WHEN f IN (0, 1, 5) THEN 'Desk' END AS provider, CASE WHEN f = 0 THEN 'markets' END AS section, CASE f WHEN 0 THEN true WHEN 1 THEN false END AS free, regexp_extract(html, '<html[^>]*\blang="([^"]*)"', 1) AS lang, CASE WHEN f <= 3 THEN 'ok' ELSE 'no_timestamp' END AS status FROM p""")
def o220_structured_articles(spark, d):
    return articles.structured(with_data(spark, d)).drop("original_url")


_KINDS = "CASE page_id % 7 WHEN 1 THEN 'video' WHEN 2 THEN 'live blog' WHEN 3 THEN 'not hosted' WHEN 4 THEN 'not an article' END"
_LISTED = f"""l AS (SELECT page_id // 20 AS payload_id, (page_id % 20)::INT AS i, CASE WHEN page_id % 7 <> 4 THEN 'https://news.example.com/story/' || page_id // 3 END AS url, 'Page ' || page_id AS title, page_id % 5 = 0 AS premium, ['T' || page_id % 4, 'T' || page_id % 3] AS tk,
 CASE WHEN page_id % 9 <> 8 THEN {_TIME} END AS published, {_KINDS} AS why FROM pages), m AS (SELECT *, min(i) FILTER (WHERE why IS NULL) OVER (PARTITION BY payload_id, url) AS f FROM l)"""


def payloads(spark, d):
    p = read(spark, d, "pages")
    k = F.col("page_id") % 7
    at = F.timestamp_add("MINUTE", (F.col("page_id") * 7).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    url = F.concat(F.when(k == 4, "https://other.example.org/story/").otherwise("https://news.example.com/story/"), F.floor(F.col("page_id") / 3).cast("string"), F.lit("?from=list"))
    symbol = lambda n: F.struct(F.concat(F.lit("T"), F.col("page_id") % n).alias("symbol"))
    attributes = F.struct(url.alias("clickthroughUrl"), (k != 3).alias("isHosted"), F.when(F.col("page_id") % 9 == 8, "yesterday").otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("pubDate"), F.struct(F.lit("Desk").alias("displayName")).alias("provider"))
    asset = F.struct(F.when(k == 1, "Video").otherwise("Story").alias("__typename"), (k == 2).alias("isLiveBlog"), F.concat(F.lit("Page "), F.col("page_id")).alias("title"), (F.col("page_id") % 5 == 0).alias("isPremiumNews"), attributes.alias("contentAttributes"), F.struct(F.array(symbol(4), symbol(3), F.struct(F.lit("").alias("symbol"))).alias("stockTickers")).alias("finance"))
    lists = p.groupBy(F.floor(F.col("page_id") / 20).alias("payload_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("page_id", asset.alias("asset")))), lambda x: F.struct(x["asset"].alias("asset"))).alias("stream"))
    return lists.select("payload_id", F.to_json(F.struct(F.struct(F.col("stream").alias("stream")).alias("data"))).alias("json"))


def entries(spark, d):
    return articles.listed(payloads(spark, d), "$.data.stream", r"https://news\.example\.com/story/[0-9]+")


@query(f"WITH {_LISTED} SELECT payload_id, i AS \"at\", url, title, 'Desk' AS publisher, premium, array_to_string(CASE WHEN tk[1] = tk[2] THEN tk[1:1] ELSE tk END, ',') AS tickers, published, CASE WHEN why IS NULL AND i <> f THEN 'repeated' ELSE why END AS reason FROM m")
def o220b_listing_entries(spark, d):
    return entries(spark, d).withColumn("tickers", F.array_join("tickers", ","))


@query(f"WITH {_LISTED} SELECT payload_id, count(*) AS entries, count(*) FILTER (WHERE why IS NULL AND i = f) AS stories, min(published) AS oldest FROM m GROUP BY payload_id")
def o220b_listing_summary(spark, d):
    return articles.listing_summary(entries(spark, d))
