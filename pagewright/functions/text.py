"""Column functions on text: whitespace, slugs, numerals, markers, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outline title patterns.  Digits and white space are Unicode-aware, as titles come from any script.
PART = r"(?iU)^PART\s+([IVXLCDM]+)\b"
CHAPTER = r"(?U)^(\d+)\.\s+(.+)"
APPENDIX = r"(?iU)^Appendix\s+([IVXLCDM]+)\s*:\s*(.+)"
SPACES = r"(?U)\s+"


def present(c: Column | str) -> Column:
    """True where a value is there in the sense of the gates: null, zero and empty text are missing."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~c.cast("string").isin("", "0")


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))  # most texts have none there and need no search
    return F.when(F.rlike(ends, F.lit(r"(?U)\s")), F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def trim_spaces(c: Column | str) -> Column:
    """Without Unicode spaces (category Zs) at both ends; tabs and line ends stay, and null stays null."""
    return F.regexp_replace(c, r"^\p{Zs}+|\p{Zs}+$", "")


def normalize_text(c: Column | str) -> Column:
    """Runs of Unicode white space as one space, none at the ends; null as empty text."""
    return F.coalesce(F.trim(F.regexp_replace(c, SPACES, " ")), F.lit(""))


def slugify(c: Column | str, limit: int = 48) -> Column:
    """Lower-case ASCII letters and digits joined by underscores, at most `limit` characters, never empty."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_|_$", "")
    slug = F.regexp_replace(F.substring(slug, 1, limit), "_$", "")
    return F.when(F.coalesce(slug, F.lit("")) == "", F.lit("untitled")).otherwise(slug)


def roman_to_int(c: Column | str) -> Column:
    """Lenient value of a Roman numeral, null where another character occurs; read from the right, a smaller digit than the one before is subtracted."""
    values = F.create_map(*[F.lit(x) for pair in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in pair])
    digits = F.reverse(F.split(F.upper(c), ""))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))

    def step(acc: Column, digit: Column) -> Column:
        value = F.element_at(values, digit)
        return F.struct((acc["total"] + F.when(value < acc["last"], -value).otherwise(value)).alias("total"), value.alias("last"))

    return F.aggregate(F.filter(digits, lambda d: d != ""), start, step, lambda acc: acc["total"])


def infer_marker(marker: Column | str, orig: Column | str, text: Column | str) -> Column:
    """The list marker: the given one, else a leading number with a full stop."""
    given = normalize_text(marker)
    raw = normalize_text(F.coalesce(F.nullif(F.col(orig) if isinstance(orig, str) else orig, F.lit("")), text))
    return F.when(given != "", given).otherwise(F.regexp_extract(raw, r"(?U)^(\d+\.)\s+", 1))


def with_marker(marker: Column, text: Column | str, clean=normalize_text, always: bool = False) -> Column:
    """Text behind its marker, unless it starts with it; with `always` then as well, and marker and space stay before blank text.  `clean` is what is done to the text itself."""
    plain = clean(text)
    if always:
        return F.when(marker != "", F.concat(marker, F.lit(" "), plain)).otherwise(plain)
    return F.when((marker != "") & ~F.startswith(plain, marker), strip(F.concat_ws(" ", marker, plain))).otherwise(plain)


def word_tokens(c: Column | str) -> Column:
    """Number of white-space separated words: the token counter that needs no vocabulary."""
    c = F.col(c) if isinstance(c, str) else c
    # a word starts behind white space or is the first: much cheaper than to match whole words
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\s\S")) + F.rlike(F.left(c, F.lit(1)), F.lit(r"(?U)\S")).cast("int"), F.lit(0))


def word_tail(c: Column | str, limit: int) -> Column:
    """The last `limit` words; the text itself if it has no more, or if the limit is 0."""
    words = F.array(F.split(normalize_text(c), " "))
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    if limit <= 0:
        return c
    # the words are bound once, as a lambda's argument
    return F.get(F.transform(words, lambda w: F.when(F.size(w) <= limit, c).otherwise(F.array_join(F.slice(w, F.greatest(F.size(w) - limit + 1, F.lit(1)), limit), " "))), F.lit(0))


def progress_bar(done: Column | str, total: Column | str, detail: Column | str) -> Column:
    """A bar of 28 signs, percentage, counts and detail; an empty total counts as complete."""
    done, total = (F.col(c) if isinstance(c, str) else c for c in (done, total))
    ratio = F.when(total == 0, F.lit(1.0)).otherwise(done / F.nullif(total, F.lit(0)))
    filled = F.bround(ratio * 28).cast("int")
    return F.format_string("[%s%s] %5.1f%% (%d/%d) %s", F.repeat(F.lit("#"), filled), F.repeat(F.lit("-"), F.lit(28) - filled), ratio * 100, done, total, detail)


def overlap_ratio(block: Column, table: Column) -> Column:
    """Share of a block's area that lies in a table; boxes are structs of x0, y0, x1, y1."""
    width = F.greatest(F.lit(0.0), F.least(block["x1"], table["x1"]) - F.greatest(block["x0"], table["x0"]))
    height = F.greatest(F.lit(0.0), F.least(block["y1"], table["y1"]) - F.greatest(block["y0"], table["y0"]))
    return width * height / F.greatest(F.lit(1e-6), (block["x1"] - block["x0"]) * (block["y1"] - block["y0"]))


def distinct_matches(c: Column | str, patterns: tuple[str, ...], limit: int) -> Column:
    """Distinct matches, pattern by pattern in order of occurrence, at most `limit`."""
    c = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in patterns])
    return F.slice(F.array_distinct(found), 1, limit)
