"""Document fingerprints by I-Match.

Terms whose document frequency lies in a band are kept, sorted and distinct, and hashed once for each of several
randomised lexicon subsets.  The band's floor is a share of all documents, so the lexicon has at most
(mean distinct terms of a document / floor) terms at any corpus size.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The band of inverse document frequency, as document shares: terms in fewer or more documents are dropped.
LOW_SHARE, HIGH_SHARE = 0.01, 0.25
#: A subset keeps one term in so many.  All subsets of the first sparsity are used, so that every term of the lexicon is in one; there are PER_SPARSITY of each other.
SPARSITIES, PER_SPARSITY = (32, 128), 8
SUBSETS = [(i, r) for i, s in enumerate(SPARSITIES) for r in range(PER_SPARSITY if i else s)]
#: Hash cells of the first counting pass.
CELLS = 1 << 16
SEED = 41


def terms_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order, with repeats."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def band_lexicon(texts: DataFrame, text_col: str, low: float = LOW_SHARE, high: float = HIGH_SHARE, total: int | None = None) -> list[str]:
    """Terms whose document frequency, over all rows, lies within the band; sorted.

    Two passes keep the shuffle small and the counts exact: the first counts (document, term) pairs by hash cell,
    and only cells that reach the floor can hold a term that does; the second counts the terms of those cells.
    At most 1/low times the mean number of distinct terms of a document come back.  total is the number of rows, if known.
    """
    total = texts.count() if total is None else total
    floor = max(2.0, low * total)
    pairs = texts.select(F.explode(F.array_distinct(terms_of(F.col(text_col)))).alias("term")).filter("term != ''")
    cell = F.pmod(F.xxhash64(F.lit(SEED), "term"), F.lit(CELLS)).cast("int")
    full = pairs.groupBy(cell.alias("cell")).count().filter(F.col("count") >= floor).select("cell")
    open_ = sorted(r["cell"] for r in full.collect())  # at most CELLS numbers
    found = pairs.filter(cell.isin(open_)) if open_ else pairs.limit(0)
    counted = found.groupBy("term").count().filter((F.col("count") >= floor) & (F.col("count") <= max(high * total, floor)))
    return sorted(r["term"] for r in counted.select("term").collect())


def fingerprint_of(text: Column, lexicon: list[str]) -> Column:
    """The fingerprint as text: 8 hexadecimal digits for each subset, '-' for a subset without terms.

    A text without any term of the lexicon has '=' and the SHA-256 of the text instead, so that only equal texts match.
    """
    kept = F.array_sort(F.array_distinct(F.filter(terms_of(text), lambda t: t.isin(lexicon)))) if lexicon else F.array().cast("array<string>")
    hashed = F.transform(kept, lambda t: F.struct(t.alias("t"), F.pmod(F.xxhash64(F.lit(SEED), t), F.lit(1 << 30)).alias("h")))

    def hash_of(terms: Column) -> Column:
        return F.when(F.size(terms) == 0, F.lit("-")).otherwise(F.lpad(F.lower(F.hex(F.xxhash64(F.lit(SEED), F.transform(terms, lambda x: x["t"])).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))

    def subset(terms: Column, level: int, residue: int) -> Column:
        return F.filter(terms, lambda x: F.pmod(F.shiftright(x["h"], 7 * level), F.lit(SPARSITIES[level])) == residue)

    def parts(terms: Column) -> Column:
        return F.array_join(F.array(*[hash_of(subset(terms, i, r)) for i, r in SUBSETS]), " ")

    whole = F.concat(F.lit("="), F.sha2(F.encode(text, "UTF-8"), 256))
    # the lambda binds the term array once for all subsets
    return F.element_at(F.transform(F.array(hashed), lambda terms: F.when(F.size(terms) == 0, whole).otherwise(parts(terms))), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that hold terms in either fingerprint; 0 or 1 where a text had no term."""
    plain = F.startswith(a, F.lit("=")) | F.startswith(b, F.lit("="))
    pairs = F.filter(F.arrays_zip(F.split(a, " ").alias("a"), F.split(b, " ").alias("b")), lambda x: (x["a"] != "-") | (x["b"] != "-"))
    same = F.size(F.filter(pairs, lambda x: x["a"] == x["b"]))
    return F.when(a == b, F.lit(1.0)).when(plain, F.lit(0.0)).otherwise(same / F.greatest(F.size(pairs), F.lit(1)))


def fingerprint(docs: DataFrame, text_col: str = "text", low: float = LOW_SHARE, high: float = HIGH_SHARE) -> DataFrame:
    """All columns of docs plus fingerprint, in which equal texts are equal; null counts as empty.

    The lexicon comes from all rows.  An input column named fingerprint is replaced; an empty table gives an empty result.
    """
    docs = docs.drop("fingerprint")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("fingerprint", fingerprint_of(text, band_lexicon(docs.select(text_col), text_col, low, high)))


def ranges_of(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """At most n ids of rows that cut all ids into ranges of near equal counts, ascending, the least id first; null counts as the least long."""
    key = F.coalesce(F.col(id_col), F.lit(-(1 << 63)))
    row = docs.select(key.cast("long").alias("k")).agg(F.min("k").alias("least"), F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10 * n).alias("cuts")).first()
    return [] if row["least"] is None else sorted({row["least"], *row["cuts"]})


def with_next(docs: DataFrame, id_col: str, columns: list[str], n_ranges: int) -> DataFrame:
    """Adds next_<c> for each of columns: its value in the next row by ascending id; after the last comes the first.

    Ids are cut into ranges at ids of rows, so the first row of each range is known; it is dealt to the range
    before as well, where it only serves as the next row.  Ties in the id are ordered by the given columns.
    One shuffle, no global sort.
    """
    cuts = ranges_of(docs, id_col, n_ranges)
    if not cuts:
        return docs.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in columns])
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    bounds = F.array(*[F.lit(c) for c in cuts])
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    # binary search: how many bounds are at most the key
    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when((at + s <= len(cuts)) & (F.element_at(bounds, F.least(at + s, F.lit(len(cuts)))) <= F.col("__key")), at + s).otherwise(at))
    rows = docs.withColumn("__key", key).withColumn("__range", place)
    before = F.when(F.col("__range") == 1, F.lit(len(cuts))).otherwise(F.col("__range") - 1)
    is_cut = F.element_at(bounds, F.col("__range")) == F.col("__key")
    own = F.struct(F.col("__range").alias("at"), F.lit(0).alias("kind"))
    # the least row also follows the last one
    borrowed = F.struct(before.alias("at"), F.lit(1).alias("kind"))
    dealt = rows.withColumn("__place", F.explode(F.when(is_cut, F.array(own, borrowed)).otherwise(F.array(own))))
    window = Window.partitionBy("__place.at").orderBy("__place.kind", "__key", *columns)
    followed = dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
    return followed.filter("__place.kind = 0").drop("__key", "__range", "__place")
