"""Language-model scoring by a probabilistic suffix tree over words.

Contexts are the last 1 to DEPTH words of a text, from its start on.  A context that occurs LEAST_CONTEXT times is
kept if its next-word distribution diverges from its parent's, the longest kept suffix of it, by more than a
description-length bound.  A kept context gives each successor seen LEAST_PAIR times its discounted share and
leaves the rest to its parent, scaled so that all sums to one; below all contexts stands the unigram model.  A
token's probability is that in the longest suffix kept.

The tree is a table, not an object: with q the probability of a successor in a context and r the factor on what the
context leaves to its parent, log q - log q of the parent - log r belongs to the word sequence context + successor
and log r to the context itself, zero where a context is not kept.  A token's log probability over its unigram one
is then the sum over the word sequences that end in it and the contexts before it, so a text's score is a sum over
its word sequences of 1 to DEPTH + 1 words, looked up by hash.  Words, contexts and successors have least counts,
the same for every input, so the table grows with it.  The HEAD most frequent entries travel to every task; a bit map of fixed size drops most sequences that
are in no table, and the rest is joined.  A full bit map costs shuffle, never results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, released, settled, slices
from .shingles import mix, word_hashes

DEPTH = 3
#: Least counts of a context and of a successor within a context.
LEAST_CONTEXT, LEAST_PAIR = 20, 3
#: The tree's words occur at least LEAST_WORD times, whatever the size of the input: no share of the root of its tokens.
LEAST_WORD, SHARE_OF_ROOT = 5, 0.0
DISCOUNT, NOVEL = 0.5, 1.0
#: At most so many words, and so many entries of the tree, travel to every task.
HEAD = 3 << 20
#: At most 2 ** GATE_BITS bits of a map of hash cells, and CELLS_A_KEY bits for each key below that.
GATE_BITS, CELLS_A_KEY = 27, 32
END_WORD = -(1 << 62) + 12345
START_WORD = -(1 << 62) + 54321
_U = np.uint64
_FOLD = _U(0xD1342543DE82EF95)
TALLY_ROWS = 1 << 20


def gram_of_word(words: np.ndarray) -> np.ndarray:
    """The hash of a sequence of one word."""
    return mix(words.view(_U) + _U(0x9E3779B97F4A7C15))


def joined_gram(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The hash of a sequence from those of all but its last and all but its first word."""
    return mix(context.view(_U) * _FOLD + suffix.view(_U))


START_GRAM = int(gram_of_word(np.full(1, START_WORD, np.int64)).view(np.int64)[0])
END_GRAM = int(gram_of_word(np.full(1, END_WORD, np.int64)).view(np.int64)[0])


def sequences(texts: list[bytes], longest: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes, by length from 1 to `longest`, of the word sequences that end at each place of the texts, each between a start and an end; the place within its text; each place's text.

    A sequence of length n is there where the place is at least n - 1.
    """
    hashes, offsets, _, _ = word_hashes(texts)
    n = len(texts)
    counts = np.diff(offsets) + 2
    owner = np.repeat(np.arange(n), counts)
    begins = np.cumsum(counts) - counts
    place = np.arange(len(owner)) - begins[owner]
    stream = np.full(len(owner), START_WORD, np.int64)
    stream[(place > 0) & (place < counts[owner] - 1)] = hashes.view(np.int64)
    stream[begins + counts - 1] = END_WORD
    found = [gram_of_word(stream)]
    for _ in range(1, longest):
        longer = np.zeros_like(found[0])
        longer[1:] = joined_gram(found[-1][:-1], found[-1][1:])
        found.append(longer)
    return [x.view(np.int64) for x in found], place, owner


def inside(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both cells of each key, one by its low and one by its high bits, are set in a bit map."""
    k = keys.view(_U)
    last = _U(len(bits) - 1)
    low = (bits[(k >> _U(6)) & last] >> (k & _U(63)) & _U(1)).astype(bool)
    at = np.flatnonzero(low)
    k = k[at]
    low[at] = (bits[(k >> _U(36)) & last] >> (k >> _U(58)) & _U(1)).astype(bool)
    return low


def bit_map(keys: DataFrame) -> np.ndarray:
    """The bit map of the cells of a column `gram`; at most 2 ** (GATE_BITS - 6) rows come back."""
    bits = min(GATE_BITS, max(6, (CELLS_A_KEY * keys.count()).bit_length()))
    cell = lambda shift, bit: F.struct(F.shiftrightunsigned("gram", shift).bitwiseAND(F.lit((1 << bits - 6) - 1)).alias("cell"), F.expr(f"shiftleft(1L, cast({bit} as int))").alias("bit"))
    cells = keys.select(F.inline(F.array(cell(6, "gram & 63L"), cell(36, "shiftrightunsigned(gram, 58)"))))
    found = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return out.view(_U)


class Tally:
    """Counts by key, with other columns that the key determines, merged now and then; `take` empties it."""

    def __init__(self, limit: int = TALLY_ROWS):
        self.limit, self.held, self.parts = limit, 0, []

    def add(self, key: np.ndarray, *more: np.ndarray) -> bool:
        """Whether the tally has outgrown its limit even when merged."""
        if more:
            self.parts.append((key, np.ones(len(key), np.int64), *more))
        else:
            self.parts.append(np.unique(key, return_counts=True))
        self.held += len(self.parts[-1][0])
        if self.held > 2 * self.limit:
            self.parts = [self._merged()]
            self.held = len(self.parts[0][0])
        return self.held > self.limit

    def _merged(self) -> tuple[np.ndarray, ...]:
        key, n, *more = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        if not len(key):
            return (key, n, *more)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return (key[first], np.add.reduceat(n[order], first), *(x[order[first]] for x in more))

    def take(self) -> tuple[np.ndarray, ...] | None:
        out = self._merged() if self.parts else None
        self.parts, self.held = [], 0
        return out


def _tally(docs: DataFrame, text_col: str, keys_of: Callable[[list[bytes]], tuple[np.ndarray, ...]], keys: list[str]) -> DataFrame:
    """(*keys, n): how often keys_of(texts) gives each combination over all of docs, summed in the worker before the shuffle.

    keys_of gives one array that tells all combinations apart, and the keys where there are several.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def out() -> Iterator[pa.RecordBatch]:
            found = tally.take()
            if found:
                own, n, *more = (pa.array(x) for x in found)
                yield pa.RecordBatch.from_arrays([*(more or [own]), n], [*keys, "n"])

        for part in slices(batches, "text"):
            if tally.add(*keys_of([t or b"" for t in part.column(0).to_pylist()])):
                yield from out()
        yield from out()

    rows = docs.select(F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*keys, "n"])).groupBy(*keys).agg(F.sum("n").alias("n"))


def with_gram(counted: DataFrame) -> DataFrame:
    """Adds the hash of each counted sequence (context, suffix, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, suffix = (batch.column(i).to_numpy() for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(joined_gram(context, suffix).view(np.int64))], ["context", "suffix", "n", "gram"])

    return counted.select("context", "suffix", "n").mapInArrow(run, "context long, suffix long, n long, gram long")


def word_tally(docs: DataFrame, text_col: str) -> DataFrame:
    """(gram, n): counts of all words, and of ends, over all of docs."""

    def words(texts: list[bytes]) -> tuple[np.ndarray]:
        found, place, _ = sequences(texts, 1)
        return (found[0][place > 0],)

    return _tally(docs, text_col, words, ["gram"])


class Lookup:
    """Values by 64-bit hash: sorted keys with the place of every leading bit pattern."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.view(_U)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        bits = min(22, (2 * len(keys) + 1).bit_length())
        self.shift = _U(64 - bits)
        self.starts = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=_U)).astype(np.int32)
        self.most = int(np.diff(self.starts).max(initial=0))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys, and whether they are there."""
        keys = keys.view(_U)
        top = (keys >> self.shift).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        found = np.full(len(keys), -1, np.int32)
        open_ = np.flatnonzero(at < end)
        for step in range(self.most):
            here = at[open_] + step
            hit = self.keys[here] == keys[open_]
            found[open_[hit]] = here[hit]
            open_ = open_[~hit & (here + 1 < end[open_])]
            if not len(open_):
                break
        return found, found >= 0


def tree_table(training: DataFrame, text_col: str, words: DataFrame, scale: float, least_word: float = LEAST_WORD, depth: int = DEPTH, least_context: int = LEAST_CONTEXT, least_pair: int = LEAST_PAIR) -> DataFrame:
    """(gram, n, gain): the tree of all of training, as log10 contributions of word sequences that occur n times.

    A context of one word has the complement of its hash as gram, as a word's own hash stands for its unigram count.
    Each level is one pass of the text.  A sequence is counted if what comes before its last word occurs
    `least_context` times and what comes after its first `least_pair` times, so every counted one has both in
    the level before.  Levels stay in the shared folder.
    """
    spark = training.sparkSession
    starts = words.filter(F.col("gram") == END_GRAM).select(F.lit(START_GRAM).cast("long").alias("gram"), "n", F.lit(1.0).alias("q"))
    level = words.filter(F.col("n") >= least_word).select("gram", "n", ((F.col("n") + 0.5) / F.lit(scale)).alias("q")).unionAll(starts)
    parts = []
    for length in range(2, depth + 2):
        contexts = level.filter(F.col("n") >= least_context)
        shared = spark.sparkContext.broadcast((bit_map(contexts), bit_map(level)))

        def keys_of(texts: list[bytes], shared=shared, length=length) -> tuple[np.ndarray, ...]:
            before, after = shared.value
            found, place, _ = sequences(texts, length)
            at = np.flatnonzero(place >= length - 1)
            at = at[inside(before, found[-2][at - 1])]
            at = at[inside(after, found[-2][at])]
            return found[-1][at], found[-2][at - 1], found[-2][at]

        counted = with_gram(_tally(training, text_col, keys_of, ["context", "suffix"]).filter(F.col("n") >= least_pair))
        joined = counted.join(contexts.select(F.col("gram").alias("context"), F.col("n").alias("total")), "context")
        joined = joined.join(level.select(F.col("gram").alias("suffix"), F.col("q").alias("parent")), "suffix")
        joined = materialize(joined.select("gram", "context", "n", "total", "parent", ((F.col("n") - DISCOUNT) / (F.col("total") + NOVEL)).alias("share")), "suffix-counts")
        shared.destroy()  # its copies lie on the disks of the driver and of all executors
        sums = joined.groupBy("context").agg(F.max("total").alias("total"), F.sum("n").alias("listed"), F.count(F.lit(1)).alias("k"), F.sum("share").alias("share"), F.sum("parent").alias("parent"), F.sum(F.col("n") * F.log(F.col("share") / F.col("parent"))).alias("gain"))
        sums = sums.withColumn("rest", (1 - F.col("share")) / F.greatest(1 - F.col("parent"), F.lit(1e-9)))
        gain = F.col("gain") + (F.col("total") - F.col("listed")) * F.log("rest")
        kept = materialize(sums.filter(gain > 0.5 * (F.col("k") + 1) * F.log(F.greatest("total", F.lit(2)))).select("context", "total", "rest"), "suffix-contexts")
        entries = joined.join(kept.select("context", "rest"), "context", "left")
        is_kept = F.col("rest").isNotNull()
        own = F.when(is_kept, F.log10("share") - F.log10("parent") - F.log10("rest"))
        level = materialize(entries.select("gram", "n", F.when(is_kept, F.col("share")).otherwise(F.col("parent")).alias("q"), own.alias("gain")), "suffix-level")
        key = F.bitwise_not(F.col("context")) if length == 2 else F.col("context")
        parts += [level.filter("gain is not null").select("gram", "n", "gain"), kept.select(key.alias("gram"), F.col("total").alias("n"), F.log10("rest").alias("gain"))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole.groupBy("gram").agg(F.max("n").alias("n"), F.sum("gain").alias("gain"))


def head_of(table: DataFrame, most: int = HEAD) -> int:
    """The least n such that at most `most` rows of a table have it or more, in steps of an eighth of a doubling."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    counted = sorted(((r["step"], r["held"]) for r in table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("held")).collect()), reverse=True)  # a few hundred rows
    floor, total = None, 0
    for at, held in counted:
        total += held
        if total > most:
            break
        floor = at
    return 1 << 62 if floor is None else max(1, int(np.ceil(2 ** (floor / 8) - 1e-6)))


def score_texts(docs: DataFrame, training: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of docs but its text, plus n_tokens, n_known, train_tokens (long), base_score and score (double).

    The model and the word counts come from every row of `training`.  Tokens are words, A-Z lower-cased, and one
    end a text; null and empty texts are the end alone.  Words and word sequences are told apart by 64-bit hashes.
    base_score is the unigram score, score the tree's.  Equal texts score alike; input columns with these names
    are replaced.  With no training text all tokens have probability one by the unigram rule.
    """
    spark = docs.sparkSession
    words = materialize(word_tally(training, text_col), "suffix-words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(sums["n"]), int(sums["v"])
    scale = n + 0.5 * (v + 1)
    tree = settled(spark, lambda: tree_table(training, text_col, words, scale), "suffix-tree")
    common_word, common_gram = head_of(words), head_of(tree)
    base = F.log10((F.col("n") + 0.5) / F.lit(scale))

    def head(table: DataFrame, least: int, gain: Column) -> Lookup:
        found = table.filter(F.col("n") >= least).select("gram", gain.alias("gain")).toArrow()  # at most HEAD rows
        return Lookup(found["gram"].to_numpy(), found["gain"].to_numpy())

    rare = tree.filter(F.col("n") < common_gram)
    shared = spark.sparkContext.broadcast(([head(words, common_word, base), head(tree, common_gram, F.col("gain"))], bit_map(rare)))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, entries), gate = shared.value
        names = ["row", "kept", "gram", "is_word", "times", "n_tokens", "n_head", "head_score", "gain"]
        for part in slices(batches, "text"):
            rows = part.column(0).to_numpy()
            found, place, owner = sequences([t or b"" for t in part.column(1).to_pylist()], DEPTH + 1)
            size = part.num_rows
            tokens, own = found[0][place > 0], owner[place > 0]
            at, there = known.find(tokens)
            score = np.bincount(own[there], known.values[at[there]], size)
            left = [(own[~there], tokens[~there])]
            gain = np.zeros(size)
            for length, grams in enumerate(found, 1):
                use = place >= length - 1 if length > 1 else np.concatenate([place[1:] > 0, [False]])
                keys, of = (grams if length > 1 else ~grams)[use], owner[use]
                at, hit = entries.find(keys)
                gain += np.bincount(of[hit], entries.values[at[hit]], size)
                keys, of = keys[~hit], of[~hit]
                open_ = inside(gate, keys)
                left.append((of[open_], keys[open_]))
            none = pa.nulls(size, pa.int64())
            n_tokens, n_head = np.bincount(own, minlength=size), np.bincount(own[there], minlength=size)
            yield pa.RecordBatch.from_arrays([pa.array(rows), part.column(2), none, pa.nulls(size, pa.bool_()), none, pa.array(n_tokens), pa.array(n_head), pa.array(score.astype(np.float64)), pa.array(gain.astype(np.float64))], names)
            for word, (of, keys) in ((True, left[0]), (False, tuple(np.concatenate(x) for x in zip(*left[1:], strict=True)))):
                order = np.lexsort((keys, of))
                of, keys = of[order], keys[order]
                first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])) if len(of) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([first, [len(of)]]))
                no, nd = pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(rows[of[first]]), pa.nulls(len(first), part.column(2).type), pa.array(keys[first]), pa.array(np.full(len(first), word)), pa.array(times), no, no, nd, nd], names)

    keep = [c for c in docs.columns if c not in (text_col, "n_tokens", "n_known", "train_tokens", "base_score", "score")] or [F.lit(None).cast("string").alias("_")]
    # rows are numbered and their columns carried in one pass: a second one might number them otherwise
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("binary").alias("text"), F.struct(*keep).alias("kept"))
    kind = numbered.schema["kept"].dataType.simpleString()
    scored = materialize(numbered.mapInArrow(run, f"row long, kept {kind}, gram long, is_word boolean, times long, n_tokens long, n_head long, head_score double, gain double"), "suffix-scores")
    shared.destroy()
    values = words.filter(F.col("n") < common_word).select("gram", F.lit(True).alias("is_word"), base.alias("value")).unionAll(rare.select("gram", F.lit(False).alias("is_word"), F.col("gain").alias("value")))
    tail = scored.filter("gram is not null").select("row", "gram", "is_word", "times").join(values, ["gram", "is_word"])
    unseen = F.log10(F.lit(0.5 / scale))
    of_words = lambda value: F.coalesce(F.sum(F.when(F.col("is_word"), value)), F.lit(0))
    tail = tail.groupBy("row").agg(of_words(F.col("times") * F.col("value")).alias("tail_score"), of_words(F.col("times")).alias("n_tail"), F.sum(F.when(~F.col("is_word"), F.col("times") * F.col("value"))).alias("tail_gain"))
    whole = scored.filter("gram is null").drop("gram", "is_word", "times").join(tail, "row", "left")
    n_known = F.col("n_head") + F.coalesce("n_tail", F.lit(0))
    base_score = F.col("head_score") + F.coalesce("tail_score", F.lit(0.0)) + (F.col("n_tokens") - n_known) * unseen
    score = base_score + F.col("gain") + F.coalesce("tail_gain", F.lit(0.0))
    return whole.select("kept.*", "n_tokens", n_known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base_score.alias("base_score"), score.alias("score"))
