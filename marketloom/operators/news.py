"""News: pages to articles, attribution to symbols, scoring and daily sentiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.staging import small_side, written

# Corporate suffixes, and phrases of closed articles.
SUFFIXES = ["inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "plc", "llc", "lp", "sa", "ag", "nv", "holdings", "holding", "group", "the", "class", "common", "stock", "ordinary", "shares"]
# Tickers that are common words.
WORD_TICKERS = [
    "A", "I", "AN", "AS", "AT", "BE", "BY", "DO", "GO", "IF", "IN", "IS", "IT", "ON", "OR", "SO", "TO", "UP", "US", "WE", "ALL", "AND", "ANY", "ARE", "BIG", "CEO", "FOR",
    "GET", "HAS", "NEW", "NOW", "ONE", "OUT", "SEE", "THE", "WHO", "YOU", "CAN", "USA", "PM", "AM",
]
PAYWALLS = "subscribe to read|sign in to continue|for subscribers only"


def articles(pages: DataFrame) -> DataFrame:
    """O-220: title, language, links and body text of stored pages, by regular expressions inside the JVM."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1>", " ")
    body = F.btrim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))
    return pages.select(
        "page_id",
        F.regexp_replace(F.regexp_extract(F.col("url"), r"^[a-z]+://([^/:?#]+)", 1), r"^www\.", "").alias("site"),
        F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract(html, r'<html[^>]*\blang="([^"]*)"', 1).alias("lang"),
        F.size(F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))).alias("n_links"),
        body.alias("body"),
    )


def body_status(body: str) -> Column:
    """O-20k: missing, paywalled, short (under 100 words) or full."""
    text = F.btrim(F.coalesce(body, F.lit("")))
    return F.when(text == "", "missing").when(F.lower(text).rlike(PAYWALLS), "paywalled").when(F.size(F.split(text, r"\s+")) < 100, "short").otherwise("full")


def normal_name(name: str) -> Column:
    """O-100: a company name in lower case without punctuation and suffix words."""
    bare = F.regexp_replace(F.lower(name), r"[^a-z0-9 ]", " ")
    return F.btrim(F.regexp_replace(F.regexp_replace(bare, rf"\b({'|'.join(SUFFIXES)})\b", " "), r"\s+", " "))


def tokens(text: str) -> Column:
    """O-100: distinct lower-case words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+"), lambda x: x != ""))


def _words(text) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+"), lambda x: x != "")


def named_in(docs: DataFrame, names: DataFrame) -> DataFrame:
    """O-100: (doc_id, symbol) where all words of a name, however many, stand in a text in order and side by side.

    docs: doc_id (one row each), text; names: symbol, name. A name is looked up by the word of it that is in the fewest texts: an equality join of
    the texts' distinct words, so a common word that every name has costs nothing unless a name has no other. What it finds is gathered by
    document, and the whole name is then looked for in the text itself. The words of a universe of bounded size go to the texts, so the texts' words are not shuffled; a text meets what it begins as it is, and
    is cut into words after that.
    """
    known = names.select("symbol", _words(F.col("name")).alias("want")).filter(F.size("want") > 0).select("symbol", F.array_join("want", " ").alias("phrase"))
    words = docs.select("doc_id", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    parts = known.select("symbol", "phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("word"))
    counts = words.join(small_side(parts.select("word").distinct()), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = parts.join(counts, "word", "left").groupBy("symbol", "phrase").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))
    rarest = small_side(written(rarest, "rarest-words"))
    begun = words.join(rarest, "word").groupBy("doc_id").agg(F.collect_set(F.struct("symbol", "phrase")).alias("c"))
    held = docs.select("doc_id", "text").join(begun, "doc_id").withColumn("body", F.concat(F.lit(" "), F.array_join(_words(F.col("text")), " "), F.lit(" ")))
    return held.select("doc_id", F.explode(F.filter("c", lambda x: F.contains(F.col("body"), F.concat(F.lit(" "), x["phrase"], F.lit(" "))))).alias("x")).select("doc_id", "x.symbol").distinct()


def attribute(docs: DataFrame, names: DataFrame) -> DataFrame:
    """O-100, O-223: (doc_id, symbol, kind) for each symbol that a text names: 'phrase' if all words of a name stand there in order, 'cashtag' for
    '$' and the ticker in upper case. A cashtag that is no known ticker, and a name that is only begun, are rejected.

    names: symbol, name (any number of words), ticker or NULL; a universe.
    """
    phrase = named_in(docs, names).select("doc_id", "symbol", F.lit("phrase").alias("kind"))
    tags = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\$([A-Z]{1,5})\b"), F.lit(1)))).alias("ticker"))
    cash = tags.join(names.filter("ticker IS NOT NULL").select("symbol", "ticker"), "ticker").select("doc_id", "symbol", F.lit("cashtag").alias("kind"))
    return phrase.union(cash).distinct()


def verified(docs: DataFrame, names: DataFrame) -> DataFrame:
    """O-223: (doc_id, symbol, method) of candidates and what the text says for them: 'ticker+name', 'name', 'cashtag', or 'rejected'.

    docs: doc_id (one row each), text, tag (the feed's own symbol, or NULL). names: symbol, name (NULL: unknown), ticker. Candidates are the feed's tag,
    cashtags, and standalone upper-case words of at most five letters that are tickers; a ticker inside another word is none. A feed's tag or a bare word
    without the company's name in the text is rejected; so is a name of one or two letters. Common words in WORD_TICKERS are no sign of a company by themselves.
    """
    text = F.coalesce("text", F.lit(""))
    cash = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\$([A-Za-z]{1,5})(?:\.[A-Za-z]+)?\b"), F.lit(1)), F.upper))
    bare = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z0-9])([A-Z]{1,5})(?![A-Za-z0-9])"), F.lit(1)))
    read = docs.select("doc_id", "text", "tag", cash.alias("cash"), bare.alias("bare"))
    tickers = names.filter("ticker IS NOT NULL").select("symbol", F.upper("ticker").alias("ticker"))
    seen = read.select("doc_id", F.explode(F.array_union("cash", "bare")).alias("ticker"), "cash", "bare")
    by_text = seen.join(tickers, "ticker").select("doc_id", "symbol", F.array_contains("cash", F.col("ticker")).alias("cashtag"), (F.array_contains("bare", F.col("ticker")) & ~F.col("ticker").isin(WORD_TICKERS)).alias("bare"))
    by_tag = read.filter("tag IS NOT NULL").select("doc_id", F.col("tag").alias("symbol"), F.lit(False).alias("cashtag"), F.lit(False).alias("bare"))
    candidates = by_text.union(by_tag).groupBy("doc_id", "symbol").agg(F.bool_or("cashtag").alias("cashtag"), F.bool_or("bare").alias("bare"))
    # Only names of candidates are looked for.
    asked = names.select("symbol", normal_name("name").alias("name")).filter(F.length("name") > 2).join(candidates.select("symbol").distinct(), "symbol", "left_semi")
    has = named_in(docs, asked).withColumn("named", F.lit(True))
    out = candidates.join(has, ["doc_id", "symbol"], "left")
    method = F.when(F.col("named") & F.col("bare"), "ticker+name").when(F.col("named"), "name").when(F.col("cashtag"), "cashtag").otherwise("rejected")
    return out.select("doc_id", "symbol", method.alias("method"))


def lexicon_scores(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """O-224: (doc_id, shares of positive and negative words, their difference, label); the default of a pluggable scorer.

    lexicon: word and polarity (1 or -1), one row for each word. A lexicon of a bounded size goes to the words, which are summed in their task, so a row for each document is shuffled; to a larger one they
    are shuffled, counted before they meet it.
    """
    words = docs.select("doc_id", F.explode(F.split(F.lower(F.btrim(F.coalesce("text", F.lit("")))), r"\s+")).alias("word"))
    known = small_side(lexicon)
    counted = words.withColumn("n", F.lit(1).cast("long")) if known is not lexicon else words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    counted = counted.join(known, "word", "left")
    share = lambda sign: F.sum(F.when(F.col("polarity") == sign, F.col("n")).otherwise(0)) / F.sum("n")
    rows = counted.groupBy("doc_id").agg(share(1).alias("score_pos"), share(-1).alias("score_neg"))
    agg = F.col("score_pos") - F.col("score_neg")
    return rows.withColumns({"score_agg": agg, "label": F.when(agg > 0.02, "positive").when(agg < -0.02, "negative").otherwise("neutral")})


def score_with(docs: DataFrame, done: DataFrame, scorer, schema: str | None = None) -> DataFrame:
    """O-224, O-242: a scorer over the documents that aren't in done yet: a function from a DataFrame to one (built from columns, such as lexicon_scores with its lexicon), or, with the schema of
    what it returns, an iterator of pandas frames to one."""
    # Only ids are hashed, and texts stream by: a merge join would sort them.
    rest = docs.join(done.select("doc_id").hint("shuffle_hash"), "doc_id", "left_anti")
    return scorer(rest) if schema is None else rest.mapInPandas(scorer, schema)


def daily_sentiment(scores: DataFrame, links: DataFrame) -> DataFrame:
    """O-48: articles, mean score and counts of labels for each symbol."""
    count = lambda label: F.count_if(F.col("label") == label)
    return links.join(scores, "doc_id").groupBy("symbol").agg(F.count("*").alias("n_articles"), F.avg("score_agg").alias("mean_score"), count("positive").alias("pos"), count("negative").alias("neg"), count("neutral").alias("neu"))


def new_articles(batch: DataFrame, known: DataFrame, key: str, newest: list[Column]) -> DataFrame:
    """O-221: articles of a batch that aren't known, the newest of each key."""
    w = Window.partitionBy(key).orderBy(*newest)
    return batch.join(known.select(key), key, "left_anti").withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def age_minutes(text: str) -> Column:
    """O-102: minutes of a relative age such as '21h ago' or '3d ago'."""
    n = F.regexp_extract(text, r"(\d+)\s*([mhd])", 1).try_cast("int")
    unit = F.regexp_extract(text, r"(\d+)\s*([mhd])", 2)
    return n * F.when(unit == "m", 1).when(unit == "h", 60).when(unit == "d", 1440)


def age_bounds(text: str) -> Column:
    """O-102: (least, most) minutes that a relative age stands for: '21h ago' is 21 hours or more and less than 22."""
    n, unit = F.regexp_extract(text, r"(\d+)\s*([mhd])", 1).try_cast("int"), F.regexp_extract(text, r"(\d+)\s*([mhd])", 2)
    size = F.when(unit == "m", 1).when(unit == "h", 60).when(unit == "d", 1440)
    return F.struct((n * size).alias("least"), ((n + 1) * size).alias("most"))


def reconciled(seen: str, age: str, stated: str) -> Column:
    """O-102: whether a stated time agrees with the relative age that was seen: agrees, future (stated after it was seen), differs, or NULL where either is unknown."""
    bounds, at = age_bounds(age), F.col(stated)
    inside = (at <= F.timestamp_add("MINUTE", -bounds["least"], F.col(seen))) & (at > F.timestamp_add("MINUTE", -bounds["most"], F.col(seen)))
    return F.when(at.isNull() | bounds["least"].isNull(), None).when(inside, "agrees").when(at > F.col(seen), "future").otherwise("differs")


def article_id(*parts: str) -> Column:
    """O-101: a stable id of an article."""
    return F.substring(F.sha1(F.encode(F.concat_ws("|", *parts), "UTF-8")), 1, 16)


def listing_report(items: DataFrame) -> DataFrame:
    """O-222: listed = stored + new + duplicate + failed, for each listing page and over all, in one pass. items: page, fate."""
    fates = [F.count_if(F.col("fate") == f).alias(f) for f in ("stored", "new", "duplicate", "failed")]
    out = items.groupingSets([["page"], []], "page").agg(F.count("*").alias("listed"), *fates, F.grouping("page").alias("__all"))
    return out.withColumn("page", F.when(F.col("__all") == 1, F.lit("all")).otherwise(F.col("page"))).drop("__all")
