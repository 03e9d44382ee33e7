"""Embedding near-dedup by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the signed axis
it lies nearest to.  A table joins several hashes; each vector also probes the buckets of its second-nearest
axes.  How many hashes a table has follows from the number of vectors, how many tables from the recall wanted
at the threshold, found by simulation.

Buckets are first screened by sketches of SKETCH sign bits, 16 bytes a row: only rows with a near partner go on,
with their vector and their codes of all tables.  There every candidate pair's cosine is computed in double
precision, and a pair counts in the first of its buckets only, so links are counted without writing pairs down.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, released
from .components import connected_components
from .shingles import mix

#: Recall wanted for pairs right at the threshold, and rows of a bucket that meet in one block.
RECALL, BLOCK = 0.999, 2048
#: Sign bits of a sketch, and how many standard deviations above a pair's mean at the threshold its distance may be.
SKETCH, SPREAD = 128, 6.0
#: Pairs looked at in one go.
PAIRS = 1 << 18
#: Tables have fewer hashes, and so fuller buckets, where a pair at the threshold would meet in a table less often than this.
LEAST_CHANCE = 0.05


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of rows whose length is a power of two, scaled to keep norms."""
    n, d = x.shape
    x = x.copy()
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


@cache
def _signs(seed: int, d: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, d])).choice([-1.0, 1.0], (3, d)).astype(np.float32)


def codes(x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """Buckets of unit vectors, as 32-bit hashes: (rows, tables, 1 + hashes), the home bucket and one probe for each hash moved to its second axis."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d), np.float32)
    padded[:, :dim] = x
    out = np.empty((n, tables, 1 + hashes), np.int64)
    row = np.arange(n)
    for t in range(tables):
        best = np.empty((hashes, n), np.int64)
        second = np.empty((hashes, n), np.int64)
        for k in range(hashes):
            y = padded
            for signs in _signs(t * 64 + k, d):
                y = hadamard(y * signs)
            size = np.abs(y)
            a = size.argmax(axis=1)
            best[k] = 2 * a + (y[row, a] < 0)
            size[row, a] = -1
            b = size.argmax(axis=1)
            second[k] = 2 * b + (y[row, b] < 0)
        place = (2 * d) ** np.arange(hashes, dtype=np.int64)[:, None]
        home = (best * place).sum(axis=0)
        out[:, t, 0] = home
        out[:, t, 1:] = (home + (second - best) * place).T
    return (mix(out.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


@cache
def _planes(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([13, dim])).normal(size=(dim, SKETCH))


def sketches(x: np.ndarray) -> np.ndarray:
    """(rows, SKETCH / 64) words of sign bits."""
    return np.packbits(x @ _planes(x.shape[1]) > 0, axis=1).view(np.int64)


def farthest(cosine: float) -> int:
    """The most sign bits that a pair at the cosine may differ in."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return math.floor(SKETCH * p + SPREAD * math.sqrt(SKETCH * p * (1 - p)))


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by their first n_keys columns, with the group end of every row."""
    held: list[pa.RecordBatch] = []
    for batch in _and_end(batches):
        if batch is not None and batch.num_rows:
            held.append(batch)
        if not held or (batch is not None and not batch.num_rows):
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for i in range(n_keys):
            x = table.column(i).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        starts = np.flatnonzero(new)
        done = table.num_rows if batch is None else int(starts[-1]) if len(starts) else 0
        if done:
            ends = np.concatenate([starts[starts < done], [done]])
            yield table.slice(0, done), np.repeat(ends, np.diff(np.concatenate([[0], ends])))
        held = table.slice(done).to_batches() if done < table.num_rows else []


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def pairs_of(ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j), i < j, of rows of one group, about PAIRS at a time."""
    counts = ends - np.arange(len(ends)) - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(at, to), counts[at:to])
        yield i, i + 1 + np.arange(len(i)) - (total[i] - total[at])
        at = to


def meet(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of two code arrays (.., 1 + hashes) are candidates: equal homes, or one's home among the other's probes."""
    return (x[..., :1] == y).any(axis=-1) | (y[..., :1] == x).any(axis=-1)


def first_meeting(x: np.ndarray, y: np.ndarray, table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether a table's bucket is the first in which pairs of rows with codes x and y are candidates: no earlier table has them, and of the at most two buckets they share it is the lower."""
    first = meet(x, y).argmax(axis=1)
    rows = np.arange(len(x))
    x, y = x[rows, table].astype(np.int64), y[rows, table].astype(np.int64)
    most = np.iinfo(np.int64).max
    of_x = np.where((y == x[:, :1]).any(axis=1), x[:, 0], most)
    of_y = np.where((x == y[:, :1]).any(axis=1), y[:, 0], most)
    return (first == table) & (np.minimum(of_x, of_y) == bucket)


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (places of rows) after rows i and j of each pair have come together; the lesser label stays."""
    a, b = label[i], label[j]
    apart = a != b
    a, b = a[apart], b[apart]
    if not len(a):
        return label
    root = np.arange(len(label))
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        root = root[root]
        if (root == before).all():
            return root[label]


@cache
def plan(n: int, dim: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(tables, hashes): buckets outnumber n vectors eightfold unless pairs would hardly meet, and tables, however many, reach the recall for pairs at the cosine."""
    d = 1 << max(1, (dim - 1).bit_length())
    hashes = max(1, math.ceil(math.log(8 * max(n, 2), 2 * d)))
    draw = np.random.Generator(np.random.PCG64(7))
    x = draw.normal(size=(1000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = draw.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine**2)) * z
    met = lambda k: meet(codes(x, 4, k), codes(y, 4, k)).mean()
    while (chance := met(hashes)) < LEAST_CHANCE and hashes > 1:
        hashes -= 1
    # where no drawn pair meets, the chance is taken as that of one in all draws
    chance = min(0.9999, max(1 / (4 * len(x)), chance))
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - chance))), hashes


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of vectors.

    Vectors are linked when their cosine is at least `cosine`; n_links counts the other rows linked directly,
    component_id is the least vec_id reachable.  Null, empty and zero vectors, vectors with null or non-finite
    components, and rows with a null id link with nothing.  Vectors of other lengths are only compared among
    themselves.  Equal vectors are one class, compared once and counted by its rows.  Rows that share an id are
    rows of their own and not linked by it; a component's id is the least of its rows' ids.  Other columns are
    not read.
    """

    @released
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, np.float64) if v and None not in v else None
                keys.append(x.tobytes() if x is not None and np.isfinite(x).all() and np.isfinite(s := float(np.linalg.norm(x / (np.abs(x).max() or 1)))) and s > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["vec_id", "vector"])

    base = materialize(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(clean, "vec_id long, vector binary"), "vectors")
    good = base.filter("vec_id is not null and vector is not null")
    # numbered as they are written: equal ids do not make classes equal
    classes = materialize(good.groupBy("vector").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n")).withColumn("class_id", F.monotonically_increasing_id()), "vector-classes")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.octet_length("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a vector length
    plans = {d: plan(n, d // 8, cosine) for d, n in sizes.items()}
    limit = farthest(cosine)

    def unit(keys: list[bytes]) -> np.ndarray:
        x = np.frombuffer(b"".join(keys), np.float64).reshape(len(keys), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    @released
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys = batch.column(1).to_pylist()
            lengths = np.fromiter(map(len, keys), np.int64, len(keys))
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                for start in range(0, len(at), 2048):
                    part = at[start : start + 2048]
                    x = unit([keys[i] for i in part])
                    found, signs = codes(x, *plans[int(d)]), sketches(x)
                    n, tables, each = found.shape
                    listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * tables * each), pa.array(found.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(np.full(n, d)), pa.array(np.full(n, each, np.int32)), pa.array(signs[:, 0].copy()), pa.array(signs[:, 1].copy()), listed], ["class_id", "d", "each", "s", "r", "codes"])

    coded = materialize(classes.select("class_id", "vector").mapInArrow(hashed, "class_id long, d long, each int, s long, r long, codes array<int>"), "vector-codes")
    key = ["d", "t", "bucket"]
    dealt = coded.select("class_id", "d", "each", "s", "r", F.posexplode("codes").alias("at", "bucket"))
    dealt = dealt.select("class_id", "d", F.floor(F.col("at") / F.col("each")).cast("int").alias("t"), "bucket", (F.col("at") % F.col("each") == 0).alias("home"), "s", "r")
    # written first, so that the join stands alone and a full bucket can be split
    shared = materialize(dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("held"), F.count_if("home").alias("homes")).filter("held > 1 and homes > 0").select(*key, F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")), "vector-shared")
    own = F.pmod(F.xxhash64(F.lit(11), "class_id"), "blocks").cast("int")
    contended = dealt.join(shared, key).withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*key, "low", "high"]
    paired = contended.select(*key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "home", "class_id", "s", "r")
    together = lambda df: df.repartition(*group).sortWithinPartitions(*group)

    def candidates(table: pa.Table, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of one bucket of which one is at home there; of two blocks, one of each."""
        block, home = table["block"].to_numpy(), table["home"].to_numpy(zero_copy_only=False)
        single = table["low"].to_numpy() == table["high"].to_numpy()
        for i, j in pairs_of(ends):
            use = (home[i] | home[j]) & (single[i] | (block[i] != block[j]))
            yield i[use], j[use]

    @released
    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in whole_groups(batches, len(group)):
            s, r = table["s"].to_numpy(), table["r"].to_numpy()
            near = np.zeros(table.num_rows, bool)
            for i, j in candidates(table, ends):
                close = np.bitwise_count((s[i] ^ s[j]).view(np.uint64)).astype(np.int32) + np.bitwise_count((r[i] ^ r[j]).view(np.uint64)) <= limit
                near[i[close]] = near[j[close]] = True
            yield from table.select([*group, "block", "home", "class_id"]).filter(pa.array(near)).to_batches()

    alive = materialize(together(paired).mapInArrow(screen, "d long, t int, bucket int, low int, high int, block int, home boolean, class_id long"), "vector-alive")
    whole = alive.join(coded.select("class_id", "each", "codes"), "class_id").join(classes.select("class_id", "n", "vector"), "class_id").select(*group, "block", "home", "class_id", "n", "each", "codes", "vector")

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for joined, all_ends in whole_groups(batches, len(group)):
            lengths = joined["d"].to_numpy()
            for d in np.unique(lengths):  # sorted by it
                at, to = np.searchsorted(lengths, [d, d + 1])
                table, ends = joined.slice(at, to - at), all_ends[at:to] - at
                ids, counts, bucket, t = (table[c].to_numpy() for c in ("class_id", "n", "bucket", "t"))
                x = unit(table["vector"].to_pylist())
                found = table["codes"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1, table["each"][0].as_py())
                # links are counted and merged as they are found: a full bucket's are never held together
                linked, label = np.zeros(len(ids)), np.arange(len(ids))
                for i, j in candidates(table, ends):
                    for start in range(0, len(i), 1 << 12):
                        u, v = i[start : start + (1 << 12)], j[start : start + (1 << 12)]
                        good = np.einsum("ij,ij->i", x[u], x[v]) >= cosine
                        u, v = u[good], v[good]
                        new = first_meeting(found[u], found[v], t[u], bucket[u])
                        linked += np.bincount(u, counts[v] * new, len(ids)) + np.bincount(v, counts[u] * new, len(ids))
                        label = merge_labels(label, u, v)
                least = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(least, label, ids)
                label = least[label]
                keep = np.flatnonzero((linked > 0) | (label < ids))
                yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(linked[keep].astype(np.int64)), pa.array(label[keep])], ["class_id", "links", "label"])

    links = materialize(together(whole).mapInArrow(compare, "class_id long, links long, label long"), "vector-links")
    components = connected_components(links.select(F.col("class_id").alias("a"), F.col("label").alias("b")))
    counted = links.groupBy("class_id").agg(F.sum("links").alias("links"))
    found = classes.join(counted, "class_id", "left").join(components, F.col("class_id") == F.col("node"), "left")
    found = materialize(found.select("vector", "least_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("node")), "vector-found")
    least = materialize(found.groupBy("node").agg(F.min("least_id").alias("component_id")), "vector-least")
    settled = materialize(found.join(least, "node").select("vector", "n_links", "component_id"), "vector-settled")
    linked = good.join(settled, "vector").select("vec_id", "n_links", "component_id")
    alone = base.filter("vec_id is null or vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
