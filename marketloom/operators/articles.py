"""Articles and listings from stored payloads: structured data by VARIANT, fallbacks in the page, drop reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types of structured data that are articles.
TYPES = ["NewsArticle", "Article", "ReportageNewsArticle", "BlogPosting"]


def _list(v: Column, path: str = "$") -> Column:
    """A value as an array of variants: its elements if it is a list, itself if it is anything else, none if it is absent or null."""
    own = F.try_variant_get(v, path, "variant")
    return F.when(own.isNull() | F.is_variant_null(own), F.array().cast("array<variant>")).otherwise(F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array(own)))


def text_of(v: Column, path: str) -> Column:
    """A string at a path, NULL if there is something else."""
    own = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(own) == "STRING", F.try_variant_get(v, path, "string"))


def moment(text: Column) -> Column:
    """An ISO-8601 time; one without a zone is UTC (the session's zone), anything else NULL."""
    return F.when(F.btrim(text).rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.btrim(text).try_cast("timestamp"))


def names_of(v: Column, path: str) -> Column:
    """Names of a person or organisation, or of each in a list (objects with a name, or strings), joined with '; ', each once."""
    name = F.transform(_list(v, path), lambda x: F.btrim(F.coalesce(text_of(x, "$.name"), text_of(x, "$"))))
    joined = F.array_join(F.array_distinct(F.filter(name, lambda x: x.isNotNull() & (x != ""))), "; ")
    return F.when(joined != "", joined)


def linked_data(html: Column) -> Column:
    """The page's first article object in its JSON-LD scripts, as a variant: top-level objects and members of lists first, then members of their @graph, two levels deep.

    Scripts that can't be parsed are passed over.
    """
    scripts = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    graph = lambda objects: F.flatten(F.transform(objects, lambda o: _list(o, '$["@graph"]')))

    def of_script(s: Column) -> Column:
        top = _list(F.try_parse_json(s))
        return F.concat(top, graph(top), graph(graph(top)))

    is_article = lambda o: F.arrays_overlap(F.transform(_list(o, '$["@type"]'), lambda t: text_of(t, "$")), F.array(*[F.lit(t) for t in TYPES]))
    return F.get(F.filter(F.flatten(F.transform(scripts, of_script)), is_article), F.lit(0))


def structured(pages: DataFrame) -> DataFrame:
    """O-220: (page_id, title, published, modified, time_source, author, provider, section, original_url, free, lang, status) of pages (page_id, url, html).

    Structured data first, then what the page says: a time tag, og:title or a heading. status: failed (no text), no_timestamp, or ok.
    """
    html = F.coalesce("html", F.lit(""))
    first = lambda pattern: F.when(F.regexp_extract(html, pattern, 1) != "", F.regexp_extract(html, pattern, 1))
    meta = lambda key: F.coalesce(first(rf'(?is)<meta[^>]*(?:property|name)="{key}"[^>]*content="([^"]*)"'), first(rf'(?is)<meta[^>]*content="([^"]*)"[^>]*(?:property|name)="{key}"'))
    ld = pages.select("page_id", "url", html.alias("html"), linked_data(html).alias("ld"))
    html, v = F.col("html"), F.col("ld")
    heading = F.btrim(F.regexp_replace(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"(?s)<[^>]*>", ""))
    own, tag = moment(text_of(v, "$.datePublished")), moment(first(r'(?is)<time[^>]*\bdatetime="([^"]*)"'))
    body = F.btrim(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1>", " "), r"(?s)<[^>]*>", " "))
    free = F.coalesce(F.try_variant_get(v, "$.isAccessibleForFree", "boolean"), text_of(v, "$.isAccessibleForFree").try_cast("boolean"))
    canonical = F.coalesce(text_of(v, '$.mainEntityOfPage["@id"]'), text_of(v, "$.mainEntityOfPage"))
    published = F.coalesce(own, tag)
    return ld.select(
        "page_id", F.coalesce(text_of(v, "$.headline"), meta("og:title"), F.when(heading != "", heading)).alias("title"), published.alias("published"), moment(text_of(v, "$.dateModified")).alias("modified"),
        F.when(own.isNotNull(), "linked data").when(tag.isNotNull(), "time tag").alias("time_source"), names_of(v, "$.author").alias("author"), names_of(v, "$.provider").alias("provider"),
        text_of(v, "$.articleSection").alias("section"), F.when(canonical != F.coalesce("url", F.lit("")), canonical).alias("original_url"), free.alias("free"), first(r'<html[^>]*\blang="([^"]*)"').alias("lang"),
        F.when(body == "", "failed").when(published.isNull(), "no_timestamp").otherwise("ok").alias("status"),
    )


def listed(payloads: DataFrame, stream: str, article: str) -> DataFrame:
    """O-220b: one row for each entry of listing payloads (payload_id, json), in display order: payload_id, at, url, title, publisher, premium, tickers, published, reason.

    stream: the path of the entries; article: a pattern that a hosted article's url begins with. reason is NULL for stories that are kept; others say why they are dropped: their kind in lower
    case (a video, say), 'live blog', 'not hosted', 'not an article', or 'repeated' for a url that came before in the payload.
    """
    # In order of the payload: the place in the list is part of each entry.
    e = payloads.select("payload_id", F.posexplode(_list(F.try_parse_json("json"), stream)).alias("at", "e"))
    v = F.col("e")
    kind = F.coalesce(text_of(v, "$.asset.__typename"), F.lit("unknown"))
    yes = lambda path: F.coalesce(F.try_variant_get(v, path, "boolean"), F.lit(False))
    url = F.regexp_extract(F.coalesce(text_of(v, "$.asset.contentAttributes.clickthroughUrl"), F.lit("")), f"^({article})", 1)
    tickers = F.array_distinct(F.filter(F.transform(_list(v, "$.asset.finance.stockTickers"), lambda t: text_of(t, "$.symbol")), lambda s: s.isNotNull() & (s != "")))
    why = F.when(kind != "Story", F.lower(kind)).when(yes("$.asset.isLiveBlog"), "live blog").when(~yes("$.asset.contentAttributes.isHosted"), "not hosted").when(url == "", "not an article")
    rows = e.select(
        "payload_id", "at", F.when(url != "", url).alias("url"), text_of(v, "$.asset.title").alias("title"), text_of(v, "$.asset.contentAttributes.provider.displayName").alias("publisher"),
        yes("$.asset.isPremiumNews").alias("premium"), tickers.alias("tickers"), moment(text_of(v, "$.asset.contentAttributes.pubDate")).alias("published"), why.alias("reason"),
    )
    kept = rows.filter("reason IS NULL").groupBy("payload_id", "url").agg(F.min("at").alias("__first"))
    out = rows.join(kept, ["payload_id", "url"], "left")
    return out.select("payload_id", "at", "url", "title", "publisher", "premium", "tickers", "published", F.when(F.col("reason").isNull() & (F.col("at") != F.col("__first")), "repeated").otherwise(F.col("reason")).alias("reason"))


def listing_summary(entries: DataFrame) -> DataFrame:
    """O-220b: for each payload the entries, the stories kept, and the oldest time of any entry."""
    return entries.groupBy("payload_id").agg(F.count("*").alias("entries"), F.count_if(F.isnull("reason")).alias("stories"), F.min("published").alias("oldest"))
