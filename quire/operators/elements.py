"""Element and block projections, predicates and sort keys. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import squash

# Kinds of elements by source type.
KINDS = {"Title": "heading", "Header": "header", "Footer": "footer", "Table": "table", "ListItem": "list", "Image": "image", "PageNumber": "page_number", "FigureCaption": "caption"}
# Headings that open the end matter of a book.
ENDMATTER = "(?i)^(index|appendix|acknowledge?ments|about the author|bibliography|also available)"


def kind_of(c: Column) -> Column:
    """Element kind of a source type; text by default."""
    table = F.create_map(*[x for k, v in KINDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(table[c], F.lit("text"))


def reduced(df: DataFrame, text: str) -> DataFrame:
    """Elements with text, white space brought to one form."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "\\r\\n?", "\n"), "[ \\t]+", " "), " ?\\n ?", "\n"))
    return df.withColumn(text, clean).where(F.length(text) > 0)


def alignment(x: Column, width: Column) -> Column:
    """Horizontal place of an element's centre on the page."""
    r = x / width
    return F.when(r < 0.35, "left").when(r > 0.65, "right").otherwise("center")


def in_pages(df: DataFrame, page: Column, low: int, high: int) -> DataFrame:
    """Rows whose page (a number, or an id such as 012L) lies in a range."""
    n = F.regexp_extract(page.cast("string"), "^([0-9]+)", 1).try_cast("int")
    return df.where(n.between(low, high))


def skipped(kind: Column, text: Column) -> Column:
    """Blocks that carry no running text: edges, images, page numbers, end matter."""
    t = F.trim(text)
    return kind.isin("header", "footer", "image", "page_number") | t.rlike("^[-–~\\[( ]*[0-9]{1,4}[-–~\\]) |]*$") | t.rlike(ENDMATTER)


def truncated_line(line: Column, least: int = 60) -> Column:
    """A long line that ends in the middle of a sentence."""
    return (F.length(line) >= least) & ~line.rlike("([.!?:;,\"')\\]-]|\\.\\.\\.|[A-Z])$")


def wrong_number(section: Column, text: Column) -> Column:
    """A numbered section whose text starts with another number."""
    first = F.regexp_extract(F.trim(F.regexp_extract(text, "^([^\\n]*)", 1)), "^([0-9]+)$", 1)
    return section.rlike("^[0-9]+$") & (first != "") & (first != section)


def without_number_lines(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\\n"), lambda x: ~x.rlike("^[ ]*[0-9]+[ ]*$")), "\n")


def gibberish(line: Column) -> Column:
    """A line mostly of signs, or long without a vowel."""
    n = F.greatest(F.length(line), F.lit(1))
    letters = F.regexp_count(line, F.lit("[A-Za-z]"))
    return (F.length(line) >= 4) & ((letters / n < 0.4) & (F.regexp_count(line, F.lit("[0-9]")) / n < 0.5) | (letters >= 8) & (F.regexp_count(line, F.lit("[AEIOUaeiouy]")) == 0))


def without_prefix(text: Column) -> Column:
    """The text without a number alone on its first line."""
    return F.regexp_replace(text, "^[ ]*[0-9]+[ ]*\\n", "")


# Lines of a title page that are no title.
NO_TITLE = r"(?i)^(adventure gamebooks?$|gamebook\s+[0-9]+$|presents?$|book\s+[0-9]+$|[0-9]+$)"


def heading_score(text: Column, page: Column, place: Column) -> Column:
    """How much a line looks like the book's title: early pages and places, two to five words, capitals, short; 0 for lines that are none."""
    t = squash(text)
    words = F.size(F.split(t, " "))
    score = (
        (6 - page) * 10
        + (10 - F.least(place, F.lit(9))) * 2
        + F.when(words.between(2, 5), 20).when(words == 1, 5).when(words <= 10, 10).otherwise(0)
        + F.when(t.rlike("^\\p{Lu}.*\\p{Lu}"), 15).otherwise(0)
        + F.when(F.length(t) <= 50, 10).when(F.length(t) <= 100, 5).otherwise(0)
    )
    return F.when((t == "") | t.rlike(NO_TITLE), 0).otherwise(score).cast("int")


def centred(df: DataFrame, page: list[str], left: Column, right: Column, out: str, least: float = 0.02, alone: float = 0.05) -> DataFrame:
    """Adds whether a line's centre is as far from the mean centre of its page's lines as two standard deviations at most (``least`` at
    least; ``alone`` for a single line). Only sums are shuffled, so a page's lines never gather in a task."""
    d = df.withColumn("__c", (left + right) / 2)
    sums = d.groupBy(*page).agg(F.avg("__c").alias("__m"), F.stddev_samp("__c").alias("__s"))
    reach = F.when(F.col("__s").isNull(), F.lit(alone)).otherwise(F.greatest(F.lit(least), 2 * F.col("__s")))
    return d.join(sums, list(page)).withColumn(out, F.abs(F.col("__c") - F.col("__m")) <= reach).drop("__c", "__m", "__s")


def section_sort_key(section: Column) -> list[Column]:
    """Background first, numbers by value, the rest by text."""
    return [F.when(section == "background", 0).when(section.rlike("^[0-9]+$"), 1).otherwise(2), section.try_cast("int"), section]


def page_bounds(df: DataFrame, group: list[str], page: str) -> DataFrame:
    return df.groupBy(*group).agg(F.min(page).alias("first_page"), F.max(page).alias("last_page"))


def squashed(c: Column) -> Column:
    return F.lower(squash(c))
