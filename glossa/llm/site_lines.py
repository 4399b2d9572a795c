"""Line dedup by site-relative frequency: lines that stand on a large share of a host's pages are boilerplate.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import stage

#: A line goes if it stands on more than this share of its host's pages, and on MIN_PAGES of them at least.
MAX_SHARE = 0.3
MIN_PAGES = 3

# What of a page's markup is never text, and the tags that end a line.
HIDDEN = (r"(?is)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?is)<head\b.*?</head\s*>")
BREAKS = (r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main"
          r"|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>")
TAG = r"<[^>]*>"
BLANKS = r"[\x20\x09\x0B\x0C\x0D]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def lines_of(html: Column) -> Column:
    """The lines of a page's text: cut at the tags that break lines and at line feeds, blanks joined, empty ones left out."""
    text = F.coalesce(html, F.lit(""))
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, "\n")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAG, "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, BLANKS, " ")))
    return F.filter(lines, lambda x: x != "")


def dedup_lines(pages: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, host, n_lines, n_dropped, text for every row of ``pages``: the lines that stay, joined by line feeds.

    Every row is a page, repeated page_ids too; a line counts once for each page that it stands on.  Pages without a
    URL share the host ''.  A null or empty page has no lines and text ''; a host of fewer than ``min_pages`` pages
    loses nothing, nor does a line on fewer pages go whatever its share; empty tables give an empty result.  Other columns are ignored.

    The lines are cut once and staged; from there they are counted and compared by two 64-bit hashes, so their texts
    cross the network once, with their page.  Counts are pre-aggregated before they are shuffled, and only lines on
    ``min_pages`` pages meet their host's total.  Lines meet the boilerplate by (host, line), so a large host spreads
    over its lines; a very common line's rows are an inner join's splittable side.
    """
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"), F.monotonically_increasing_id().alias("row"))
    rows = stage(cut.withColumn("keys", F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))), "lines")
    totals = rows.groupBy(F.col("host").alias("_h")).agg(F.count("*").alias("total"))
    counts = (rows.select("host", F.explode(F.array_distinct("keys")).alias("k")).groupBy("host", "k.a", "k.b").agg(F.count("*").alias("n"))
              .where(F.col("n") >= min_pages))
    boilerplate = (counts.join(totals, F.col("host") == F.col("_h")).where(F.col("n") / F.col("total") > max_share)
                   .select(F.col("host").alias("_host"), F.col("a").alias("_a"), F.col("b").alias("_b")))
    each = rows.select("row", "host", F.posexplode("keys").alias("pos", "k"))
    met = each.join(boilerplate, (F.col("host") == F.col("_host")) & (F.col("k.a") == F.col("_a")) & (F.col("k.b") == F.col("_b")))
    gone = met.groupBy(F.col("row").alias("_row")).agg(F.collect_set("pos").alias("gone"))  # a page's own lines
    dropped = F.coalesce("gone", F.array().cast("array<int>"))
    out = rows.select("row", "page_id", "host", "lines").join(gone, F.col("row") == F.col("_row"), "left").withColumn("gone", dropped)
    return out.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
                      F.array_join(F.filter("lines", lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n").alias("text"))
