"""Line dedup by site-relative frequency, in DataFrame functions only.

A line's frequency is the number of pages of a host that contain it, divided by the host's pages.
Lines whose frequency exceeds ``max_ratio`` are boilerplate of that host and are dropped wherever
they occur on its pages. A line on fewer than ``min_pages`` pages of the host is never boilerplate, so
that hosts of a few pages keep their texts. Lines are compared after trimming white space.

The lines to drop are few: those of one host number at most the lines of its average page divided by
``max_ratio``. They are gathered per host, written, and joined to the pages by host: as a broadcast if the
written table is below Spark's own size limit, else by a shuffle whose hot hosts Spark splits.

Defined results: pages without a host (null) form one site; null texts have no lines and stay null;
empty lines are never dropped; repeated rows are pages of their own; an empty table has no lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.staging import Workspace, columns_of, fresh

MAX_RATIO = 0.1
MIN_PAGES = 3
#: The ratio where the site is a document's source: a source mixes many sites, so its boilerplate is rarer than a host's.
SOURCE_RATIO = 0.05

#: Tags that end a line, and text between tags that is none (fixed values).
_SILENT = r"(?is)<(script|style)\b.*?</(script|style)>|<!--.*?-->"
_BLOCK = r"(?i)</?(p|div|li|ul|ol|h[1-6]|br|tr|td|th|table|article|section|nav|footer|header|title|body|head|html|main|aside|form|pre|blockquote)\b[^>]*>"
_TAG = r"<[^>]*>"


def url_host(url: Column) -> Column:
    """The host of an absolute URL in small letters, or null."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """The visible text of a page, a line per block element."""
    text = F.regexp_replace(F.regexp_replace(html, _SILENT, " "), _BLOCK, "\n")
    return F.regexp_replace(text, _TAG, "")


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """site, and the keys of its lines above the ratio; ``pages`` has ``site`` and ``text``."""
    lines = pages.select(
        "site",
        F.explode(
            F.array_append(
                F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), _key)),
                F.lit(None).cast("bigint"),  # stands for the page itself
            )
        ).alias("line"),
    )
    # Both tables are small and read more than once or joined, so they are written: then Spark knows their size.
    work = Workspace(pages.sparkSession, "lines")
    counts = work.keep(
        lines.groupBy("site", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("line").isNull() | (F.col("n") >= min_pages))
    )
    totals = counts.where("line IS NULL").select(F.col("site").alias("of"), F.col("n").alias("total"))
    return work.keep(
        counts.where("line IS NOT NULL")
        .join(totals, F.col("site").eqNullSafe(F.col("of")))
        .where(F.col("n") > F.col("total") * F.lit(max_ratio))
        .groupBy("site")
        .agg(F.collect_list("line").alias("dropped"))
    )


def without_boilerplate(
    pages: DataFrame, site: Column, text: Column, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """The pages with three more columns: ``kept_text``, ``n_lines`` and ``n_dropped``, renamed where pages have such columns."""
    own, of, lines, dropped, kept, kept_text, n_lines, n_dropped = fresh(
        pages, "site", "line_site", "lines", "dropped", "kept", "kept_text", "n_lines", "n_dropped"
    )
    found = boilerplate(pages.select(site.alias("site"), text.alias("text")), max_ratio, min_pages)
    found = found.select(F.col("site").alias(own), F.col("dropped").alias(dropped))
    joined = pages.withColumns({of: site, lines: F.split(text, "\n")}).join(found, F.col(of).eqNullSafe(F.col(own)), "left")
    stays = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(dropped, _key(x)))
    return (
        joined.withColumn(kept, F.when(F.col(dropped).isNull(), F.col(lines)).otherwise(stays))
        .withColumns(
            {
                kept_text: F.array_join(kept, "\n"),
                n_lines: F.coalesce(F.size(lines), F.lit(0)).cast("bigint"),
                n_dropped: F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).cast("bigint"),
            }
        )
        .drop(own, of, lines, dropped, kept)
    )


def lines_deduplicated(docs: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The documents with the boilerplate lines of their source gone from ``text``; ``n_chars`` follows, if there."""
    # The added columns may clash with columns of the documents; those come through as a struct.
    rest = "row"
    packed = docs.select(F.struct(*columns_of(docs)).alias(rest), F.col("source").alias("site"), F.col("text").alias("whole"))
    found = without_boilerplate(packed, F.col("site"), F.col("whole"), max_ratio, min_pages)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("whole"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast(kind)).otherwise(F.col(f"{rest}.n_chars"))
    return found.select(*[changed.get(c, F.col(f"{rest}.`{c}`")).alias(c) for c in docs.columns])
