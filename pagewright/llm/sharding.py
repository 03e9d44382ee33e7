"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash; pass two shuffles each bucket
in memory by Fisher-Yates.  The buckets in order form one uniformly random permutation of all records, which is
cut into shards whose row counts differ by at most one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import partitions_for

#: Text bytes that one bucket should hold, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 256


def _scatter(id_col: str, text_col: str, seed: int) -> Column:
    """The seeded hash that scatters, of id and text: an id that many texts share is no hot bucket."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), F.col(text_col).isNull(), F.col(id_col).isNull())


def shuffle_into_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of docs plus shard (int, from 0) and slot (long, gapless from 0 in each shard).

    Shards' row counts are at most one apart.  The order depends on seed, ids and the number of buckets only,
    not on partitioning.  Null ids and texts are kept and scatter as values of their own.  Rows with equal ids and
    texts fall into one bucket, where any order serves; if they are more than a bucket's share of all rows, they
    are dealt over all buckets by their place in the input.  An empty table gives an empty result.  Input columns
    named shard or slot are replaced.  Text moves through one shuffle; bucket sizes come from a scan before it.
    """
    docs = docs.drop("shard", "slot")
    sizes = docs.agg(F.sum(F.octet_length(text_col)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n_buckets = partitions_for(sizes["b"] or 0, bucket_bytes, LEAST_BUCKETS)
    # rows that are more than one bucket's share: fewer than there are buckets
    scattered = _scatter(id_col, text_col, seed)
    hot = [r["h"] for r in docs.groupBy(scattered.alias("h")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(64, sizes["n"] // n_buckets)).select("h").collect()]
    if hot:
        scattered = F.when(scattered.isin(hot), F.xxhash64(F.lit(seed + 1), scattered, F.monotonically_increasing_id())).otherwise(scattered)
    bucket = F.pmod(scattered, F.lit(n_buckets)).cast("int")
    counts = docs.select(bucket.alias("__bucket")).groupBy("__bucket").count()
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"), F.sum("count").over(Window.partitionBy()).alias("__total"))
    keep = docs.columns
    rows = docs.select(F.struct(*keep).alias("kept"), scattered.alias("hash")).withColumn("__bucket", F.pmod("hash", F.lit(n_buckets)).cast("int")).join(offsets, "__bucket")

    def shuffle(table: pa.Table) -> pa.Table:
        columns = table["kept"].combine_chunks().flatten()
        base = {"hash": table["hash"], "tie": pc.fill_null(columns[keep.index(text_col)].cast(pa.large_binary()), b"")}
        order = pc.sort_indices(pa.table(base), sort_keys=[("hash", "ascending"), ("tie", "ascending")]).to_numpy()
        number, offset, total = (table[c][0].as_py() for c in ("__bucket", "__offset", "__total"))
        dealt = order[np.random.Generator(np.random.PCG64([seed, number])).permutation(table.num_rows)]  # Fisher-Yates
        place = offset + np.arange(table.num_rows, dtype=np.int64)
        shard = ((place + 1) * n_shards - 1) // total
        return pa.Table.from_arrays(columns, keep).take(pa.array(dealt)).append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(place - shard * total // n_shards))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.groupBy("__bucket").applyInArrow(shuffle, f"{schema}, shard int, slot long")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder a shard.  Buckets are contiguous in the permutation, so a task opens few folders."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shard(spark, path: str, shard: int) -> Iterator[dict]:
    """One shard's rows in slot order, streamed to the caller."""
    for row in spark.read.parquet(f"{path}/shard={shard}").orderBy("slot").toLocalIterator():
        yield row.asDict()
