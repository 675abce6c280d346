"""Column functions on text: quality metrics, references, repairs, headings. All built-in expressions, inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash(c: Column) -> Column:
    """White space collapsed, outer spaces removed."""
    return F.trim(F.regexp_replace(c, "[ \\t\\r\\n\\f]+", " "))


def strip_tags(c: Column) -> Column:
    """Markup replaced by spaces."""
    return squash(F.regexp_replace(c, "<[^>]+>", " "))


def html_lines(c: Column) -> Column:
    """Readable lines of markup without a parser: a line per closed block, tags as spaces, white space in one form."""
    lines = F.regexp_replace(F.regexp_replace(c, "</(?:p|h[1-6]|li|tr|dt|dd)>|<br>", "\n"), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(lines, "[ \\t\\r\\f]+", " "), " ?\\n ?", "\n"))


_SETS = {"[A-Za-z]": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "[0-9]": "0123456789"}


def ratio(c: Column, pattern: str) -> Column:
    """Matches of a one-character pattern over the length; 0 for empty text. Plain classes are counted by deletion, which is far cheaper than a regex."""
    chars = _SETS.get(pattern)
    n = F.length(c) - F.length(F.translate(c, chars, "")) if chars else F.regexp_count(c, F.lit(pattern))
    return F.round(n / F.greatest(F.length(c), F.lit(1)), 4)


def mean_word_length(c: Column) -> Column:
    """Mean length of the words between white space; 0 without words."""
    t = squash(c)
    words = F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.translate(t, " ", "")) + 1)
    return F.round(F.length(F.translate(t, " ", "")) / F.greatest(words, F.lit(1)), 4)


def garble_reasons(c: Column, short: int = 40, alpha: float = 0.5, digits: float = 0.3) -> Column:
    """Why a text looks garbled, in fixed order."""
    return F.array_compact(
        F.array(
            F.when(F.length(c) < short, F.lit("short")),
            F.when(ratio(c, "[A-Za-z\\p{L}]") < alpha, F.lit("low_alpha")),
            F.when(ratio(c, "[0-9]") > digits, F.lit("digit_heavy")),
            F.when(F.contains(c, F.lit("�")), F.lit("replacement_char")),
        )
    )


def corruption_score(c: Column) -> Column:
    """0..1: the largest of weighted signs of damage (a maximum of parts, not their sum)."""
    bars = F.least(F.lit(1.0), F.regexp_count(c, F.lit("[|][0-9]|[0-9][|]")) / F.lit(5.0))
    runs = F.least(F.lit(1.0), F.regexp_count(c, F.lit("[^A-Za-z0-9 \\t\\r\\n]{3,}")) / F.lit(10.0))
    alpha = F.when(F.length(c) >= 40, F.greatest(F.lit(0.0), F.lit(0.6) - ratio(c, "[A-Za-z]"))).otherwise(F.lit(0.0))
    return F.round(F.greatest(0.6 * bars, 0.8 * runs, alpha), 4)


def lines_of(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(c, "\\r", ""), "\\n"), lambda x: F.trim(x)), lambda x: x != "")


def duplicate_line_share(c: Column) -> Column:
    """1 - distinct/all over non-empty lines; 0 without lines."""
    x = lines_of(c)
    return F.when(F.size(x) == 0, F.lit(0.0)).otherwise(F.round(1 - F.size(F.array_distinct(x)) / F.size(x), 4))


def fragmented(c: Column) -> Column:
    """Text in fragments: over half of the lines short and a mean line under 20 characters."""
    x = F.transform(lines_of(c), F.length)
    n = F.greatest(F.size(x), F.lit(1))
    short = F.size(F.filter(x, lambda v: v < 15)) / n
    mean = F.aggregate(x, F.lit(0), lambda a, v: a + v) / n
    return (F.size(x) >= 3) & (short > 0.5) & (mean < 20)


def references(c: Column, pattern: str, low: int = 1, high: int = 400) -> Column:
    """Distinct numbers in [low, high] that a pattern's first group captures, in order."""
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda x: x.cast("int"))
    return F.array_distinct(F.filter(found, lambda x: (x >= low) & (x <= high)))


TURN_TO = "(?i)(?:turn|go|refer)[ ]+to[ ]+([0-9]{1,4})"
ANCHOR = "<a[^>]*href=[\"']#([0-9]+)[\"']"


def number_token(c: Column) -> Column:
    """A section number as scanned, letters taken for digits put right; null unless all digits then."""
    t = F.translate(F.trim(c), "OoDQIl!SsZB", "00001115528")
    return F.when(t.rlike("^[0-9]+$"), t)


def reflow_hyphens(c: Column) -> Column:
    """Words divided at line ends joined, other line ends kept."""
    return F.regexp_replace(c, "([A-Za-z])-[ ]*\\r?\\n[ ]*([a-z])", "$1$2")


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\\n{3,}", "\n\n")


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def all_caps_heading(c: Column) -> Column:
    letters = F.regexp_count(c, F.lit("[A-Za-z]"))
    return (letters >= 4) & (F.length(c) <= 60) & (F.regexp_count(c, F.lit("[A-Z]")) >= 0.9 * letters) & ~F.contains(c, F.lit("="))


def element_label(c: Column, kind: Column) -> Column:
    """Layout label by an ordered rule cascade."""
    t = F.trim(c)
    return (
        F.when(kind == "table", "Table")
        .when(t.rlike("^[0-9]{1,3}$"), "Section-header")
        .when(t.rlike("\\.{4,}[ ]*[0-9]+"), "List-item")
        .when(t.rlike("^([-*•–]|o|[0-9]{1,2}[.)])[ ]"), "List-item")
        .when(t.rlike("[|\\t]"), "Table")
        .when(all_caps_heading(t), "Title")
        .otherwise("Text")
    )


def ending_kind(c: Column) -> Column:
    """How an ending section ends: victory phrases before death, which is also the default."""
    low = F.lower(c)
    return F.when(low.rlike("victor|triumph|success|congratulations|you have won"), "victory").otherwise("death")
