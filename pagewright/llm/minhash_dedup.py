"""MinHash near-duplicate documents with sequential Bayesian verification.

Rows are numbered and written once; equal word sequences are one class.  Classes that share a band of their signatures are candidates; a candidate's
signatures are compared batch by batch and it is given up once the posterior chance of the wanted similarity
falls below the chosen miss probability; survivors are confirmed on full shingle sets.

A bucket of m classes is first compared with its least class only, m - 1 pairs.  Where that leaves several
components in a bucket, its classes go through an exact prefix-filtered join across components, so no link
between components is lost, a group of copies costs pairs in proportion to its size, and classes that merely
share a common passage are told apart by bounds before any pair is made.  Before that join, where it would make
more pairs than it reads rows, classes that share a shingle are compared with a few of them drawn by hash, round
after round while that leaves far fewer pairs across.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, released, settled, slices
from .components import connected_components
from .suffix_tree import bit_map, inside
from .shingles import jaccard_counts, minhash, shingle_hashes, word_hashes

BANDS, ROWS = 25, 5
#: Cells of the table of shingle counts that orders shingles from rare to common.
CELLS = 1 << 18
#: Chance that a pair of the wanted similarity is given up.
MISS = 1e-5
#: Classes of a bucket with which all of it is compared in one round across components, and the share of the pairs
#: across that a round may leave for another to follow.
HUBS, WORTH = 4, 0.5
#: 64-bit words of a set's sketch: for each of 64 * 8 cells of the hashes, whether the set has an odd number of shingles there.
SKETCH = [f"s{i}" for i in range(8)]
MEMBER = ["class_id", "component", "place", "n", *SKETCH]


def least_matches(n: int, similarity: float, miss: float = MISS) -> int:
    """The fewest of n equal signature values at which the similarity may still be reached.

    With a uniform prior the posterior after m of n is Beta(m + 1, n - m + 1), and its mass above s is the
    binomial chance of at most m successes in n + 1 draws of chance s.
    """
    mass = 0.0
    for m in range(n + 1):
        mass += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        if mass >= miss:
            return m
    return n


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, keep: list[str] = ()) -> DataFrame:
    """(row, doc_id, text, kept, class_id, n_shingles, signature): row numbers the rows, kept holds the columns `keep`, class_id identifies the word sequence and is null without words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.struct(F.lit(0).alias("_"), *keep).alias("kept"))
    names = [*rows.columns, "class_id", "n_shingles", "signature"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = [t or b"" for t in part.column(2).to_pylist()]
            words, offsets, _, _ = word_hashes(texts)
            same, count, signed = [], [], []
            for i in range(len(texts)):
                own = words[offsets[i] : offsets[i + 1]]
                found = shingle_hashes(own, k)
                count.append(len(found))
                same.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True) if len(own) else None)
                signed.append(minhash(found, BANDS * ROWS).view(np.int32) if len(found) else None)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(same, pa.int64()), pa.array(count, pa.int64()), pa.array(signed, pa.list_(pa.int32()))], names)

    kind = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id long, text binary, kept {kind}, class_id long, n_shingles long, signature array<int>")


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set: of two sets at least as many shingles are in one only as bits of their sketches differ."""
    odd = np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def among(rows: DataFrame, keys: DataFrame, *key: str) -> DataFrame:
    """Rows whose key columns may be those of a row of keys, by a bit map that travels to every task; an exact join is to follow.

    Of wide rows only those that the join will keep are then shuffled for it; a full bit map costs shuffle, never results.
    """
    columns = rows.columns
    shared = rows.sparkSession.sparkContext.broadcast(bit_map(keys.select(F.xxhash64(*key).alias("gram"))))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = inside(shared.value, batch.column(batch.num_columns - 1).to_numpy())
            yield batch.filter(pa.array(there)).select(columns)

    return rows.withColumn("__cell", F.xxhash64(*key)).mapInArrow(run, rows.schema)


def likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that sequential comparison of their signatures does not give up."""
    n = BANDS * ROWS
    ends = list(range(BANDS, n + 1, BANDS))
    floors = [least_matches(e, similarity) for e in ends]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (batch.column(i).flatten().to_numpy().reshape(-1, n) for i in (2, 3))
            alive, matched, start = np.arange(len(x)), np.zeros(len(x), np.int64), 0
            for end, floor in zip(ends, floors, strict=True):
                matched[alive] += (x[alive, start:end] == y[alive, start:end]).sum(axis=1)
                alive, start = alive[matched[alive] >= floor], end
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    side = lambda c: classes.select(F.col("class_id").alias(c), F.col("signature").alias(f"s{c}"))
    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full shingle sets of texts (class_id, text)."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for part in slices(batches, "ta", 1 << 20):
            a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
            texts = {i: t for c, d in ((a, 2), (b, 3)) for i, t in zip(c, part.column(d).to_pylist(), strict=True) if i not in held}
            new = list(texts)
            words, offsets, _, _ = word_hashes([texts[i] or b"" for i in new])
            sets = held | {i: shingle_hashes(words[offsets[j] : offsets[j + 1]], k) for j, i in enumerate(new)}
            good = []
            for i in range(part.num_rows):
                shared, union = jaccard_counts(sets[a[i]], sets[b[i]])
                good.append(100 * shared >= percent * union > 0)
            held = {b[-1]: sets[b[-1]]}
            yield pa.RecordBatch.from_arrays([part.column(i).filter(pa.array(good)) for i in (0, 1)], ["a", "b"])

    side = lambda c: texts.select(F.col("class_id").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def across_components(open_: DataFrame, texts: DataFrame, k: int, percent: int, tested: DataFrame, test: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (a, b) between the components of open_ (class_id, component) that leave no link across components; test gives the links among pairs (a, b), a > b, and is not asked for those in tested.

    Exact: shingles have one order for all classes, from rare to common, and two sets of the wanted similarity
    share one among the first n - ceil(percent % of n) + 1 of each.  At the first shared one, what is left of
    either set bounds their intersection, and the cells where their sketches differ each hold a shingle of one set
    only; a pair is made only if both bounds allow the similarity.  Classes
    that a round of hubs has linked are one component in the next, and in the join that makes all pairs left.
    """
    texts = materialize(texts.join(open_, "class_id"), "minhash-open-texts")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        for part in slices(batches, "text"):
            words, offsets, _, _ = word_hashes([t or b"" for t in part.column(1).to_pylist()])
            yield part, [shingle_hashes(words[x:y], k) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for _, found in sets(batches):
            total += np.bincount(np.concatenate(found).astype(np.uint64) % np.uint64(CELLS), minlength=CELLS).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counted = texts.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    common = np.zeros(CELLS, np.int64)
    common[counted["cell"].to_numpy()] = counted["n"].to_numpy()

    @released
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in sets(batches):
            owner, shingle, place, size, sketch = [], [], [], [], []
            for i, own in enumerate(found):
                n = len(own)
                first = own[np.lexsort((own, common[own % np.uint64(CELLS)]))][: n - -(-percent * n // 100) + 1]
                owner.append(np.full(len(first), i))
                shingle.append(first.view(np.int64))
                place.append(np.arange(len(first)))
                size.append(np.full(len(first), n))
                sketch.append(sketch_of(own))
            owner = np.concatenate(owner).astype(np.int64)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (shingle, place, size)), *(pa.array(x) for x in np.stack(sketch)[owner].T)], names)

    names = ["class_id", "component", "shingle", "place", "n", *SKETCH]
    found = materialize(texts.select("class_id", "text", "component").mapInArrow(prefixes, ", ".join(f"{c} long" for c in names)), "minhash-prefixes")
    tested = tested.select("a", "b")
    links, draw, last, rows = tested.limit(0), 0, None, None
    while True:
        # the pairs across components that the buckets hold, at most
        sizes = found.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("m")).groupBy("shingle").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
        sizes = materialize(sizes.filter("m * m > own"), "minhash-sizes")
        open_pairs = sizes.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2)).first()[0] or 0
        if rows is None:
            # components only grow, so a shingle that one of them has to itself makes no pair later either
            rows, found = found.count(), materialize(among(found, sizes, "shingle"), "minhash-prefixes")
        if open_pairs <= rows or last is not None and open_pairs > WORTH * last:
            break
        last = open_pairs
        hub = F.struct(*MEMBER)
        hubs = [F.min_by(hub, F.xxhash64("class_id", "shingle", F.lit(draw + i))) for i in range(HUBS)]
        hubs = found.groupBy("shingle").agg(F.array_distinct(F.array(*hubs)).alias("hubs"), F.min("component").alias("low"), F.max("component").alias("high"))
        hubs = materialize(hubs.filter("low < high").select("shingle", "hubs"), "minhash-hubs")
        draw += HUBS
        pairs = found.join(hubs, "shingle").select(F.struct(*MEMBER).alias("x"), F.explode("hubs").alias("y"))
        pairs = _untested(pairs.filter("x.component <> y.component"), percent, tested)
        new = test(pairs)
        links, tested = links.unionAll(new), tested.unionAll(pairs)
        ends = found.select("class_id", "component").distinct()
        edges = ends.unionAll(new.select("a", "b")).toDF("a", "b")
        components = materialize(connected_components(edges), "minhash-components")
        found = found.drop("component").join(components.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
        found = materialize(found.select(*names), "minhash-prefixes")
    pairs = found.alias("x").join(found.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") < F.col("y.component")) & _reachable(percent))
    return links.unionAll(test(_untested(pairs, percent, tested)))


def _reachable(percent: int) -> Column:
    """Whether x and y, which share no shingle before the one at their places, may have the wanted similarity; both bounds are exact."""
    left, total = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")), F.col("x.n") + F.col("y.n")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in SKETCH])
    return (100 * left >= percent * (total - left)) & (100 * (total - apart) >= percent * (total + apart))


def _untested(pairs: DataFrame, percent: int, tested: DataFrame) -> DataFrame:
    """The pairs (a, b), a > b, of the classes of x and y that may have the wanted similarity and are not in tested."""
    named = pairs.filter(_reachable(percent)).select(F.greatest("x.class_id", "y.class_id").alias("a"), F.least("x.class_id", "y.class_id").alias("b"))
    return materialize(named.distinct().join(tested, ["a", "b"], "left_anti"), "minhash-pairs")


def _components(base: DataFrame, k: int, percent: int) -> DataFrame:
    """(class_id, node, component_id): the least class and the least doc_id of every class's component."""
    linkable = base.filter("class_id is not null and doc_id is not null")
    classes = materialize(linkable.groupBy("class_id").agg(F.min("doc_id").alias("least_id"), F.first(F.struct("row", "signature")).alias("one")).select("class_id", "least_id", "one.*"), "minhash-classes")
    band = F.explode(F.array(*[F.xxhash64(F.lit(i), F.slice("signature", i * ROWS + 1, ROWS)) for i in range(BANDS)]))
    banded = classes.select("class_id", band.alias("band"))
    # what a join needs of its keys is written first here and below, so that the join stands alone and a hot key can be split
    shared = materialize(banded.groupBy("band").agg(F.min("class_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "minhash-bands")
    members = materialize(banded.join(shared, "band"), "minhash-members")
    wanted = materialize(members.select("class_id").distinct(), "minhash-wanted")
    classes_of = classes.select("class_id", "row", "signature")
    signed = materialize(among(classes_of, wanted, "class_id").join(wanted.hint("merge"), "class_id"), "minhash-signed")
    # the only time that whole texts are shuffled
    rows = signed.select("class_id", "row")
    texts = materialize(among(base.select("row", "text"), rows, "row").join(rows.hint("merge"), "row").select("class_id", "text"), "minhash-texts")

    def test(pairs: DataFrame) -> DataFrame:
        survivors = materialize(likely(pairs, signed, percent / 100), "minhash-likely")
        return materialize(confirmed(survivors, texts, k, percent), "minhash-links")

    tested = materialize(members.filter("class_id <> least").select(F.col("class_id").alias("a"), F.col("least").alias("b")).distinct(), "minhash-pairs")
    links = test(tested)
    components = materialize(connected_components(links), "minhash-components")
    placed = materialize(members.join(components, F.col("class_id") == F.col("node"), "left").select("band", "class_id", F.coalesce("component", "class_id").alias("component")), "minhash-placed")
    split = materialize(placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("band"), "minhash-split")
    open_ = materialize(placed.join(split, "band", "left_semi").select("class_id", "component").distinct(), "minhash-open")
    more = across_components(open_, texts, k, percent, tested, test)
    # the first components are one star each, so the second round of linking starts from them
    stars = components.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    components = connected_components(stars.unionAll(more))
    placed = materialize(classes.select("class_id", "least_id").join(components, F.col("class_id") == F.col("node"), "left").select("class_id", "least_id", F.coalesce("component", "class_id").alias("node")), "minhash-found")
    least = materialize(placed.groupBy("node").agg(F.min("least_id").alias("component_id")), "minhash-least")
    return placed.join(least, "node").select("class_id", "node", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of docs.

    Documents are linked when their sets of k-word shingles have 100 * intersection >= percent * union; a
    component_id is the least doc_id reachable, itself included, and kept says that it is the row's own.
    Texts without words, null ones too, are linked with nothing.  A null id is linked with nothing, has a null
    component and is kept.  Rows that share an id but not their words are documents of their own.  Other columns
    are not read.
    """
    base = materialize(signatures(docs, id_col, text_col, k), "minhash-signatures")
    found = settled(docs.sparkSession, lambda: _components(base, k, percent), "minhash-found")
    rows = base.select("doc_id", "class_id", "n_shingles")
    linked = rows.filter("class_id is not null and doc_id is not null").join(found, "class_id").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("class_id is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Docs, in docs' columns, with one row of each component of near duplicates: of its least doc_id.

    Of several such rows with different words the one of the least hash of them stays, of rows with equal words
    any one.  Rows that share an id but not their words are documents of their own, so no text is lost with
    another's id.  Texts without words and rows with a null id stay.
    """
    others = [c for c in docs.columns if c != text_col]
    base = materialize(signatures(docs, id_col, text_col, k, others), "minhash-signatures")

    def dropped() -> DataFrame:
        linkable = base.filter("class_id is not null and doc_id is not null").select("row", "doc_id", "class_id")
        found = materialize(linkable.join(_components(base, k, percent), "class_id"), "minhash-found")
        firsts = found.filter("doc_id = component_id").groupBy("node", "class_id").agg(F.min("row").alias("row")).groupBy("node").agg(F.min_by("row", "class_id").alias("row"))
        return found.select("row").join(firsts.select("row"), "row", "left_anti")

    # what goes is the smaller part, so it is what is joined
    kept = base.select("row", "kept", "text").join(settled(docs.sparkSession, dropped, "minhash-dropped"), "row", "left_anti")
    kind = docs.schema[text_col].dataType
    return kept.select(*[F.col("text").cast(kind).alias(c) if c == text_col else F.col("kept")[c].alias(c) for c in docs.columns])
