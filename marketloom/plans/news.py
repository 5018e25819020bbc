"""Queries over documents and pages as news."""

from pyspark.sql import functions as F

from marketloom.operators import news
from marketloom.plans.base import query, read, rounded


@query(r"""SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '^www\.', '') AS site, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title,
 regexp_extract(html, '<html[^>]*\blang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1))::INT AS n_links FROM pages""")
def o220_articles(spark, d):
    # The body is left out here: its tag removal uses a back reference, which DuckDB's expressions lack (tested by itself).
    return news.articles(read(spark, d, "pages")).drop("body")


@query()
def o20k_body_status(spark, d):
    """Bodies of pages by status; the tag removal uses a back reference, which DuckDB's expressions lack."""
    return news.articles(read(spark, d, "pages")).withColumn("status", news.body_status("body")).groupBy("lang", "status").agg(F.count("*").alias("n"), F.avg(F.length("body")).alias("mean_chars"))


# The universe: items of the benchmark, named by their first three words; every word is positive or negative by the items that use it.
_TOKENS = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda x: x <> '')"
_NAMES = f"nm AS (SELECT item_id::BIGINT AS symbol, want[1:3] AS want, upper(regexp_extract(text, '^([A-Za-z]{{1,5}})', 1)) AS ticker FROM (SELECT *, {_TOKENS.format('text')} AS want FROM benchmark) WHERE len(want) > 0)"
_LINKS = rf"""{_NAMES}, w AS (SELECT doc_id, {_TOKENS.format("coalesce(text, '')")} AS w FROM documents), ah AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(w)), lambda i: w[i:i+2])) AS nx FROM w WHERE len(w) > 0)
 , links AS (SELECT DISTINCT doc_id, symbol, 'phrase' AS kind FROM ah JOIN nm ON ah.nx[1] = nm.want[1] AND ah.nx[1:len(nm.want)] = nm.want UNION
 SELECT DISTINCT doc_id, symbol, 'cashtag' FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '\$([A-Z]{{1,5}})\b', 1)) AS ticker FROM documents) JOIN nm USING (ticker))"""
_SCORES = """lx AS (SELECT word, sign(sum(CASE WHEN item_id % 2 = 0 THEN 1 ELSE -1 END)) AS polarity FROM (SELECT item_id, unnest(string_split_regex(lower(trim(text)), '\\s+')) AS word FROM benchmark) GROUP BY word)
 , sc AS (SELECT doc_id, p - n AS score_agg, p, n, CASE WHEN p - n > 0.02 THEN 'positive' WHEN p - n < -0.02 THEN 'negative' ELSE 'neutral' END AS label FROM (
 SELECT doc_id, count(*) FILTER (WHERE polarity > 0) / count(*)::DOUBLE AS p, count(*) FILTER (WHERE polarity < 0) / count(*)::DOUBLE AS n
 FROM (SELECT doc_id, unnest(string_split_regex(lower(trim(coalesce(text, ''))), '\\s+')) AS word FROM documents) LEFT JOIN lx USING (word) GROUP BY doc_id))"""


def _links(spark, d):
    b = read(spark, d, "benchmark")
    words = F.filter(F.split(F.lower("text"), r"[^a-z0-9]+"), lambda x: x != "")
    first = F.upper(F.regexp_extract("text", r"^([A-Za-z]{1,5})", 1))
    names = b.select(F.col("item_id").cast("long").alias("symbol"), F.array_join(F.slice(words, 1, 3), " ").alias("name"), F.when(first != "", first).alias("ticker"))
    return news.attribute(read(spark, d, "documents"), names)


def _lexicon(spark, d):
    words = read(spark, d, "benchmark").select("item_id", F.explode(F.split(F.lower(F.btrim("text")), r"\s+")).alias("word"))
    return words.groupBy("word").agg(F.signum(F.sum(F.when(F.col("item_id") % 2 == 0, 1).otherwise(-1))).alias("polarity"))


@query(f"WITH {_LINKS} SELECT doc_id, symbol, kind FROM links")
def o223_attribution(spark, d):
    return _links(spark, d)


# Companies: items of the benchmark by their whole text (names of any length), tickers by their first letters; the feed's tag is the number of the source.
_VERIFIED = r"""WITH co AS (SELECT symbol, array_to_string(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ({0})), ' ') AS name, ticker FROM (SELECT item_id::BIGINT AS symbol, text, upper(regexp_extract(text, '^([A-Za-z]{{1,5}})', 1)) AS ticker FROM benchmark WHERE item_id % 2 = 1
 UNION ALL SELECT item_id, array_to_string((string_split(text, ' '))[1:2], ' ') || ' Inc.', upper(regexp_extract(text, '^([A-Za-z]{{1,5}})', 1)) FROM benchmark WHERE item_id % 2 = 0)),
 dc AS (SELECT doc_id, coalesce(text, '') AS text, TRY_CAST(regexp_extract(source, '(\d+)', 1) AS BIGINT) AS tag, ' ' || array_to_string(list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> ''), ' ') || ' ' AS body FROM documents),
 tk AS (SELECT doc_id, list_transform(regexp_extract_all(text, '\$([A-Za-z]{{1,5}})(?:\.[A-Za-z]+)?\b', 1), lambda x: upper(x)) AS cash, list_filter(string_split_regex(text, '[^A-Za-z0-9]+'), lambda x: regexp_full_match(x, '[A-Z]{{1,5}}')) AS bare FROM dc),
 cd AS (SELECT t.doc_id, c.symbol, list_contains(t.cash, t.ticker) AS cashtag, list_contains(t.bare, t.ticker) AND t.ticker NOT IN ({1}) AS bare FROM (SELECT *, unnest(list_distinct(list_concat(cash, bare))) AS ticker FROM tk) t JOIN co c ON c.ticker = t.ticker AND c.ticker <> ''
 UNION ALL SELECT doc_id, tag, false, false FROM dc WHERE tag IS NOT NULL),
 ca AS (SELECT doc_id, symbol, bool_or(cashtag) AS cashtag, bool_or(bare) AS bare FROM cd GROUP BY ALL),
 nm AS (SELECT ca.*, coalesce(bool_or(length(co.name) > 2 AND contains(dc.body, ' ' || co.name || ' ')), false) AS named FROM ca JOIN dc USING (doc_id) LEFT JOIN co USING (symbol) GROUP BY ALL)
 SELECT doc_id, symbol, CASE WHEN named AND bare THEN 'ticker+name' WHEN named THEN 'name' WHEN cashtag THEN 'cashtag' ELSE 'rejected' END AS method FROM nm""".format(*[", ".join(f"'{x}'" for x in xs) for xs in (news.SUFFIXES, news.WORD_TICKERS)])


@query(_VERIFIED)
def o223_verified(spark, d):
    """Candidates by feed tag, cashtag and bare ticker, each accepted or rejected by the text."""
    ticker = F.upper(F.regexp_extract("text", r"^([A-Za-z]{1,5})", 1))
    short = F.concat(F.array_join(F.slice(F.split("text", " "), 1, 2), " "), F.lit(" Inc."))
    companies = read(spark, d, "benchmark").select(F.col("item_id").cast("long").alias("symbol"), F.when(F.col("item_id") % 2 == 1, F.col("text")).otherwise(short).alias("name"), F.when(ticker != "", ticker).alias("ticker"))
    return news.verified(read(spark, d, "documents").withColumn("tag", F.regexp_extract("source", r"(\d+)", 1).try_cast("long")), companies)


@query(f"WITH {_SCORES} SELECT doc_id, f32(p) AS score_pos, f32(n) AS score_neg, f32(score_agg) AS score_agg, label FROM sc")
def o224_lexicon_scores(spark, d):
    return rounded(news.lexicon_scores(read(spark, d, "documents"), _lexicon(spark, d)))


@query(f"WITH {_LINKS}, {_SCORES}, l AS (SELECT DISTINCT doc_id, symbol FROM links) SELECT symbol, count(*) AS n_articles, f32(avg(score_agg)) AS mean_score, count(*) FILTER (WHERE label = 'positive') AS pos, count(*) FILTER (WHERE label = 'negative') AS neg, count(*) FILTER (WHERE label = 'neutral') AS neu FROM l JOIN sc USING (doc_id) GROUP BY symbol")
def o48_daily_sentiment(spark, d):
    return rounded(news.daily_sentiment(news.lexicon_scores(read(spark, d, "documents"), _lexicon(spark, d)), _links(spark, d).select("doc_id", "symbol").distinct()))


@query(f"WITH {_SCORES} SELECT doc_id, f32(p) AS score_pos, f32(n) AS score_neg, f32(score_agg) AS score_agg, label FROM sc WHERE doc_id % 4 <> 0")
def o242_pluggable_scorer(spark, d):
    """A scorer given as a function (here the lexicon's) over the documents that have no score yet."""
    docs, lexicon = read(spark, d, "documents").select("doc_id", "text"), _lexicon(spark, d)
    return rounded(news.score_with(docs, docs.filter("doc_id % 4 = 0"), lambda rest: news.lexicon_scores(rest, lexicon)))


@query("WITH b AS (SELECT md5(coalesce(text, '')) AS k, doc_id FROM documents WHERE source <> 'src1'), kn AS (SELECT DISTINCT md5(coalesce(text, '')) AS k FROM documents WHERE source = 'src1') SELECT k, max(doc_id) AS doc_id FROM b WHERE k NOT IN (SELECT k FROM kn) GROUP BY k")
def o221_incremental_dedup(spark, d):
    docs = read(spark, d, "documents").select("source", "doc_id", F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("k"))
    known = docs.filter("source = 'src1'").select("k").distinct()
    return news.new_articles(docs.filter("source <> 'src1'"), known, "k", [F.desc("doc_id")]).select("k", "doc_id")


@query("SELECT page_id, substr(sha1(url || '|' || page_id), 1, 16) AS article_id FROM pages")
def o101_article_ids(spark, d):
    return read(spark, d, "pages").select("page_id", news.article_id("url", "page_id").alias("article_id"))
