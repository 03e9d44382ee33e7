"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length; every source takes as many whole copies of itself as its target holds,
and a bounded-knapsack dynamic program over the length counts fits the rest of the budget.  Within one length
the documents that get the extra copy are those of lowest seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, word_count

WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: The dynamic program fits the last so many words of a budget; the rest is shared over lengths in proportion.
EXACT_WORDS = 1 << 16


def fit_budget(sizes: Sequence[int], counts: Sequence[int], budget: int, exact: int = EXACT_WORDS) -> list[int]:
    """How many documents of each size to take, at most `counts`, so that the words come as near below budget as found.

    First in proportion to the counts, then by descending size down to about `exact` words, then by a bounded
    subset sum over bit sets, in which counts are split into powers of two.
    """
    sizes, counts = [int(x) for x in sizes], [int(x) for x in counts]
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    if budget >= total:
        return counts
    take = [n * max(0, budget - exact) // total for n in counts]
    rest = budget - sum(s * k for s, k in zip(sizes, take, strict=True))
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if sizes[i] > 0:
            more = min(counts[i] - take[i], max(0, rest - exact) // sizes[i])
            take[i] += more
            rest -= more * sizes[i]
    # each sum keeps the item that first reached it, so memory is that of the sums, whatever the number of items
    reach, full, goal = 1, (1 << rest + 1) - 1, 1 << rest
    by_size, by_step = np.zeros(rest + 1, np.int64), np.zeros(rest + 1, np.int64)
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        left, step = counts[i] - take[i], 1
        while left > 0 and 0 < sizes[i] <= rest and not reach & goal:
            step = min(step, left)
            new = (reach << step * sizes[i]) & full & ~reach
            if new:
                sums = np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(rest // 8 + 1, "little"), np.uint8), bitorder="little"))
                by_size[sums], by_step[sums] = i, step
                reach |= new
            left, step = left - step, step * 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    while at:
        i, step = int(by_size[at]), int(by_step[at])
        take[i] += step
        at -= step * sizes[i]
    return take


def source_targets(lengths: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from counts by (source, size).

    Sources in code point order, null last, weigh `weights`, repeating, and share all words; a target stops at
    `most` times its source's size and the excess goes to the others by weight.  In order of cap over weight,
    the sources before the first whose share fits are the capped ones, so one pass settles all.
    The windows run over one row a source.
    """
    sized = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1)
    ranked = sized.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = ranked.withColumn("level", level).withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
    chosen = F.coalesce(F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"], F.lit(0.0))
    return filled.select("source", "source_size", F.least(F.col("cap"), chosen * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = 29) -> DataFrame:
    """Rows (doc_id, size, source_size, target, copies), one for each row of docs; copies is 0 to `most`.

    Size is the number of words; null and empty texts have none and get no extra copy.  A null source is a
    source of its own.  Equal ids with equal texts may be taken in any order, which no result shows.  Other
    columns are not read.  Documents of one source and size are ranked by hash cells, about as many as a cell
    has rows, so no task holds a whole group.
    """
    base = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h")), "mix-sizes")
    lengths = materialize(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    targets = source_targets(lengths, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    budgets = targets.withColumn("whole", whole).withColumn("budget", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        rows["extra"] = np.array(fit_budget(rows["size"], rows["n"], int(rows["budget"].iloc[0])), np.int64)
        return rows

    same = lambda a, b, *more: [a["source"].eqNullSafe(b["source"]), *(a[c] == b[c] for c in more)]
    joined = lengths.join(budgets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = materialize(joined.groupBy("source").applyInPandas(fit, "source string, size long, n long, source_size long, target double, whole int, budget long, extra long"), "mix-plan")
    cells = F.ceil(F.sqrt("n")).cast("long")
    b, p = base.alias("b"), plan.alias("p")
    rows = b.join(p, same({"source": F.col("b.source"), "size": F.col("b.size")}, {"source": F.col("p.source"), "size": F.col("p.size")}, "size")).select("b.*", "n", "source_size", "target", "whole", "extra", F.pmod("h", cells).alias("cell"))
    settled = (F.col("extra") <= 0) | (F.col("extra") >= F.col("n")) | (F.col("size") == 0)
    sure = rows.filter(settled).withColumn("copies", F.col("whole") + F.when((F.col("extra") > 0) & (F.col("size") > 0), 1).otherwise(0))
    open_ = rows.filter(~settled)
    counted = open_.groupBy("source", "size", "cell").agg(F.count(F.lit(1)).alias("held"))
    running = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("earlier", F.coalesce(F.sum("held").over(running), F.lit(0))).drop("held")
    o, c = open_.alias("o"), counted.alias("c")
    ranked = o.join(c, same({"source": F.col("o.source"), "size": F.col("o.size"), "cell": F.col("o.cell")}, {"source": F.col("c.source"), "size": F.col("c.size"), "cell": F.col("c.cell")}, "size", "cell")).select("o.*", "earlier")
    place = F.col("earlier") + F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("h", "doc_id"))
    ranked = ranked.withColumn("copies", F.col("whole") + F.when(place <= F.col("extra"), 1).otherwise(0))
    columns = ["doc_id", "size", "source_size", "target", F.col("copies").cast("int").alias("copies")]
    return sure.select(*columns).unionByName(ranked.select(*columns))


def apply_mix(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mixed corpus: every row of docs as often as its copies say, in docs' columns.

    Rows that share an id take the most copies that any of them got; a null id matches null.
    """
    chosen = mix.groupBy("doc_id").agg(F.max("copies").alias("__copies")).withColumnRenamed("doc_id", "__id").filter("__copies > 0")
    return docs.join(chosen, F.col(id_col).eqNullSafe(F.col("__id"))).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
