"""Substring dedup by paragraph MinHash banding.

Two kinds of passages are compared.  Paragraphs (lines) of at least MIN_WORDS words meet by MinHash bands tuned
for high recall and are confirmed by exact Jaccard.  Runs of RUN words, chosen by winnowing, meet by content, so
that a passage inside other paragraphs is found as well: any MIN_WORDS equal words in a row share a chosen run.
Equal passages are one class; confirmed pairs of classes are clustered into components; each component keeps
its first occurrence, by document id and place.  Every other occurrence is a repeat; repeats in a row are joined
and extended, word by word, as far as they equal what is kept.

Copies within one slice of input are joined there, and a task remembers what it has sent, so a passage that most
documents share reaches the shuffle once a task; in a bucket every passage is compared with the first and with the one before it.  Where that leaves
several components in a bucket, its lines go through an exact prefix-filtered join across components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pieces, released, settled, slices
from .components import connected_components
from .minhash_dedup import across_components, among
from .shingles import jaccard_counts, minhash, range_hashes, shingle_hashes, word_hashes, mix
from .suffix_tree import bit_map, inside

MIN_WORDS, SHINGLE, PERCENT = 50, 5, 80
#: Words of a run; winnowing looks at MIN_WORDS - RUN + 1 neighbouring runs.
RUN = 32
#: With 6 bands of 2 rows a pair of similarity 0.8 meets with a chance of 0.998, one of 0.9 with 0.99995.
BANDS, ROWS = 6, 2
#: Bytes on each side of a repeat within which it is extended at first, and how much wider the next try is where they hold
#: too few words: winnowing leaves fewer than MIN_WORDS - RUN + 1 of them.
CONTEXT, WIDER = 1024, 64
#: Passages that a task remembers as seen in an earlier slice; forgetting one costs a row, never a result.
SEEN = 1 << 18
OWN = ["e", "doc", "sub", "start", "end", "wa", "wb"]
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def winnowed(words: np.ndarray, offsets: np.ndarray, run: int, window: int) -> np.ndarray:
    """First words of the chosen runs: in every `window` neighbouring runs of one text, one of least hash."""
    n = len(words)
    if n < run + window - 1:
        return np.zeros(0, np.int64)
    hashes = range_hashes(words, np.arange(n - run + 1), np.arange(run, n + 1))
    ends = np.repeat(offsets[1:], np.diff(offsets))[: n - run + 1]
    hashes[np.arange(n - run + 1) + run > ends] = np.uint64((1 << 64) - 1)
    inside = np.flatnonzero(np.arange(n - run - window + 2) + run + window - 1 <= ends[: n - run - window + 2])
    least = np.lib.stride_tricks.sliding_window_view(hashes, window)
    chosen = np.zeros(n - run + 1, bool)
    for i in range(0, len(inside), 1 << 16):
        part = inside[i : i + (1 << 16)]
        chosen[part + least[part].argmin(axis=1)] = True
    return np.flatnonzero(chosen)


def passages(texts: list[bytes], min_words: int = MIN_WORDS, run: int = RUN) -> tuple[np.ndarray, ...]:
    """All passages of some texts as (owner, first word, end word, is_line), and the texts' word arrays (hashes, offsets, starts, ends)."""
    hashes, offsets, starts, ends = word_hashes(texts)
    n = len(hashes)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool), hashes, offsets, starts, ends
    data = np.frombuffer(b"".join(texts), np.uint8)
    base = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])[:-1]
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    line = np.cumsum(data == 10)[base[owner] + starts]
    breaks = np.flatnonzero(np.concatenate([(line[1:] != line[:-1]) | (owner[1:] != owner[:-1]), [True]])) + 1
    begin = np.concatenate([[0], breaks[:-1]])
    whole = breaks - begin >= min_words
    chosen = winnowed(hashes, offsets, run, min_words - run + 1)
    at = np.concatenate([chosen, begin[whole]])
    to = np.concatenate([chosen + run, breaks[whole]])
    is_line = np.concatenate([np.zeros(len(chosen), bool), np.ones(int(whole.sum()), bool)])
    return owner[at], at, to, is_line, hashes, offsets, starts, ends


def _listed(docs: DataFrame, min_words: int) -> DataFrame:
    """Every passage: doc and sub, bytes start to end, words wa to wb, content hash e, band hashes of lines, whether the task holds an equal one (repeated), and whether it is the first of its content that the task sends (fresh)."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, None] = {}
        for part in slices(batches, "text"):
            owner, at, to, is_line, hashes, offsets, starts, ends = passages([t or b"" for t in part.column(2).to_pylist()], min_words)
            if not len(owner):
                continue
            e = range_hashes(hashes, at, to)
            ids, subs = (part.column(i).to_numpy()[owner] for i in (0, 1))
            order = np.lexsort((starts[at], subs, ids, e))
            owner, at, to, is_line, e, ids, subs = (x[order] for x in (owner, at, to, is_line, e, ids, subs))
            new = np.concatenate([[True], e[1:] != e[:-1]])
            group = np.cumsum(new) - 1
            repeated = np.bincount(group)[group] > 1
            lined = np.bincount(group, is_line) > 0
            bands: list[np.ndarray | None] = [None] * len(e)
            for i in np.flatnonzero(new & lined[group]):
                signed = minhash(shingle_hashes(hashes[at[i] : to[i]], SHINGLE), BANDS * ROWS).astype(np.uint64).reshape(BANDS, ROWS)
                bands[i] = (mix(signed[:, 0] << np.uint64(32) | signed[:, 1]) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            places = [starts[at], ends[to - 1], at - offsets[owner], to - offsets[owner]]
            known = np.fromiter((x in sent for x in e[new].tolist()), bool, int(new.sum()))
            for x in e[new & repeated].tolist():
                sent[x] = None
            while len(sent) > SEEN:
                del sent[next(iter(sent))]
            repeated, new = repeated | known[group], new & ~known[group]
            columns = [pa.array(e.view(np.int64)), pa.array(ids), pa.array(subs), *(pa.array(x.astype(np.int32)) for x in places), pa.array(bands, pa.list_(pa.int64())), pa.array(repeated), pa.array(new)]
            yield pa.RecordBatch.from_arrays(columns, [*OWN, "bands", "repeated", "fresh"])

    return docs.mapInArrow(run, "e long, doc long, sub long, start int, end int, wa int, wb int, bands array<long>, repeated boolean, fresh boolean")


def _candidates(rows: DataFrame, min_words: int) -> DataFrame:
    """Passages of _listed that are lines or repeated, or that share a key, with the keys that others may share (none unless fresh).

    A key is a content or band hash.  Most are of one passage only, so they are counted without it, and a bit map
    of those of several drops nearly all others before passages are shuffled; a full one costs shuffle, never results.
    """
    listed = materialize(_listed(rows, min_words), "paragraphs")
    keys = F.explode(F.when(F.col("bands").isNull(), F.array("e")).otherwise(F.concat(F.array("e"), "bands")))
    counted = listed.filter("fresh").select(keys.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    shared = rows.sparkSession.sparkContext.broadcast(bit_map(materialize(counted.filter("n > 1").select("gram"), "paragraph-keys")))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands, n = batch.column("bands"), batch.num_rows
            lined, fresh, repeated = (x.to_numpy(zero_copy_only=False) for x in (bands.is_valid(), batch.column("fresh"), batch.column("repeated")))
            keys = np.concatenate([batch.column("e").to_numpy(), bands.flatten().to_numpy()])
            at = np.concatenate([np.arange(n), np.repeat(np.flatnonzero(lined), BANDS)])
            hit = inside(shared.value, keys) & fresh[at]
            at, keys = at[hit], keys[hit]
            count = np.bincount(at, minlength=n)
            ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[np.argsort(at, kind="stable")]))
            kept = pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "keys"])
            yield kept.filter(pa.array((count > 0) | lined | repeated))

    return listed.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listed.schema) + ", keys array<long>")


def told_apart(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column, bool]:
    """(doc, sub, text) of rows with an id, the expression of sub, and whether rows share an id: texts that share one have hashes of their own in sub.

    Where no id is shared, sub is 0 throughout and costs next to nothing on the way.
    """
    ids = docs.filter(F.col(id_col).isNotNull())
    shared = not ids.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    sub = F.xxhash64(F.col(text_col).cast("string")) if shared else F.lit(0).cast("long")
    return ids.select(F.col(id_col).cast("long").alias("doc"), sub.alias("sub"), F.col(text_col).cast("binary").alias("text")), sub, shared


def _cut(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """(e, t): the passages wanted (e, doc, sub, start, end), as they stand in texts."""
    wanted = materialize(wanted, "paragraph-wanted")
    return materialize(among(texts, wanted, "doc", "sub").join(wanted, ["doc", "sub"]).select("e", F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")).alias("t")).dropDuplicates(["e"]), "paragraph-lines")


def _confirmed(named: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose shingle sets, of their passages in cut (e, t), have 100 * intersection >= percent * union."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "ta", 1 << 20):
            sets = []
            for column in (2, 3):
                words, offsets, _, _ = word_hashes([t or b"" for t in part.column(column).to_pylist()])
                sets.append([shingle_hashes(words[x:y], SHINGLE) for x, y in zip(offsets[:-1], offsets[1:], strict=True)])
            counts = [jaccard_counts(x, y) for x, y in zip(*sets, strict=True)]
            good = pa.array([100 * shared >= percent * union > 0 for shared, union in counts], pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(i).filter(good) for i in (0, 1)], ["a", "b"])

    side = lambda c: cut.select(F.col("e").alias(c), F.col("t").alias(f"t{c}"))
    return named.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def _across(lines: DataFrame, tested: DataFrame, texts: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components that lines of one band bucket are still in, by an exact join, as many as it takes to leave none across; none of the pairs in tested."""
    # a band key that no other passage has splits nothing, nor does the content's
    shared = lines.withColumn("keys", F.filter("keys", lambda k: k != F.col("e"))).filter(F.size("keys") > 0)
    classes = shared.groupBy("e").agg(F.min(F.struct("doc", "sub", "start", "end")).alias("w"), F.first("keys").alias("keys"))
    placed = materialize(classes.join(components, F.col("e") == F.col("node"), "left").select("e", "w", "keys", F.coalesce("component", "e").alias("component")), "paragraph-members")
    banded = placed.select(F.explode("keys").alias("key"), "e", "component")
    split = materialize(banded.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key"), "paragraph-split")
    held = materialize(among(banded, split, "key").join(split, "key", "left_semi").select("e").distinct(), "paragraph-held")
    open_ = materialize(placed.select("e", "w", "component").join(held, "e", "left_semi"), "paragraph-open")
    if open_.isEmpty():
        return tested.limit(0)
    cut = _cut(open_.select("e", "w.*"), texts)
    seen = tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("e"))
    # written first here and in _tried: a stage with two passes of Python starts two workers a task, and Spark keeps all of them, and uses them in turn, ever after
    test = lambda pairs: materialize(_confirmed(pairs, materialize(among(cut, ends(pairs), "e"), "paragraph-ends"), percent), "paragraph-links")
    return across_components(open_.select(F.col("e").alias("class_id"), "component"), cut.select(F.col("e").alias("class_id"), F.col("t").alias("text")), SHINGLE, percent, seen, test)


PLACE = ["doc", "sub", "fdoc", "fsub"]


@released
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of one document and one first document, joined where they touch: where the joined one starts and ends in both, and where the first one's kept occurrence ends (stop)."""
    names = [*PLACE, "start", "end", "wa", "wb", "fstart", "fend", "stop"]
    for batch in pieces(batches):
        spans = batch.column("spans")
        row = np.repeat(np.arange(batch.num_rows), spans.value_lengths().to_numpy())
        if not len(row):
            continue
        kind = spans.type.value_type
        own = dict(zip((kind.field(i).name for i in range(kind.num_fields)), (x.to_numpy() for x in spans.flatten().flatten()), strict=True))
        # spans stand in order of wa; each row's words lie above those of the row before
        lift = row * (np.int64(1) << 32)
        most = np.maximum.accumulate(lift + own["wb"])
        first = np.concatenate([[True], lift[1:] + own["wa"][1:] > most[:-1]])
        longest = np.flatnonzero(first | np.concatenate([[True], most[1:] > most[:-1]]))
        first = np.flatnonzero(first)
        last = longest[np.concatenate([np.searchsorted(longest, first[1:]), [len(longest)]]) - 1]
        of = pa.array(row[first])
        taken = [("start", first), ("end", last), ("wa", first), ("wb", last), ("fstart", first), ("fend", last), ("fend", first)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in PLACE), *(pa.array(own[c][at].astype(np.int32)) for c, at in taken)], names)


def equal_left(x: bytes, y: bytes, whole: bool = True) -> tuple[int, int]:
    """(words, bytes) by which two contexts agree backwards from their ends; unless they are whole, a first word may be cut and is not used."""
    a, b = (t.translate(_LOWER).split()[0 if whole else 1 :] for t in (x, y))
    n, at = 0, len(x)
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    low = x.translate(_LOWER)
    for word in a[len(a) - n :][::-1]:
        at = low.rfind(word, 0, at)
    return n, len(x) - at


def equal_right(x: bytes, y: bytes, whole: bool = True) -> tuple[int, int]:
    """(words, bytes) by which two contexts agree forwards; unless they are whole, a last word may be cut and is not used."""
    a, b = (t.translate(_LOWER).split()[: None if whole else -1] for t in (x, y))
    n, at = 0, 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    low = x.translate(_LOWER)
    for word in a[:n]:
        at = low.find(word, at) + len(word)
    return n, at


def _extended(joined: DataFrame, texts: DataFrame, enough: int) -> DataFrame:
    """Joined repeats (doc, sub, start, end, wa, wb, fdoc), extended as far as they equal what is kept, by `enough` words at least.

    Contexts are some bytes wide; where one ends before `enough` words were compared and all of them agree, the
    repeat is tried again with contexts WIDER times as wide, which few are.  Within one document the left context
    ends at the kept occurrence, and the kept one's right context at the extended repeat; where repeats that touch
    reach over their own kept occurrences, the text goes on equal to itself and the right context is as it is.
    """
    columns = [*PLACE, "start", "end", "wa", "wb", "fstart", "fend", "stop"]
    done, width, left_over = None, CONTEXT, joined
    while True:
        found = materialize(_tried(left_over, texts, width, enough, columns), "paragraph-extended")
        good = found.filter("settled").select("doc", "sub", "start", "end", "wa", "wb", "fdoc")
        done = good if done is None else done.unionAll(good)
        left_over = found.filter("not settled").select(*columns)
        if left_over.isEmpty():
            return done
        width *= WIDER


def _tried(joined: DataFrame, texts: DataFrame, width: int, enough: int, columns: list[str]) -> DataFrame:
    around = lambda s, e: (F.substring("text", F.greatest(F.col(s) + 1 - width, F.lit(1)), F.least(F.col(s), F.lit(width))), F.substring("text", F.col(e) + 1, width))
    first_texts = texts
    if width > CONTEXT:  # few are tried again
        first_texts = materialize(among(texts, joined.select(F.col("fdoc").alias("doc"), F.col("fsub").alias("sub")), "doc", "sub"), "paragraph-wider")
        texts = materialize(among(texts, joined, "doc", "sub"), "paragraph-wider")
    left, right = around("start", "end")
    own = joined.join(texts, ["doc", "sub"]).withColumn("left", left).withColumn("right", right).drop("text")
    left, right = around("fstart", "fend")
    both = own.join(first_texts.withColumnRenamed("doc", "fdoc").withColumnRenamed("sub", "fsub"), ["fdoc", "fsub"]).withColumn("fleft", left).withColumn("fright", right)
    both = both.select(*columns, "left", "fleft", "right", "fright")
    schema = pa.schema([*((c, pa.int64() if c in PLACE else pa.int32()) for c in columns), ("settled", pa.bool_())])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for doc, sub, fdoc, fsub, start, end, wa, wb, fstart, fend, stop, left, fleft, right, fright in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = [start <= width and fstart <= width, len(right) < width and len(fright) < width]
                # a context of `width` bytes may cut a word, one that stops at the other occurrence does not
                if (doc, sub) == (fdoc, fsub):
                    left = left[max(0, len(left) - (start - stop)) :]
                more, before = equal_left(left, fleft, ends[0])
                if (doc, sub) == (fdoc, fsub) and fend <= start:
                    fright = fright[: max(0, start - before - fend)]
                yet, after = equal_right(right, fright, ends[1])
                seen = [n < enough and not end and n + 1 >= min(len(x.split()), len(y.split())) for n, end, x, y in ((more, ends[0], left, fleft), (yet, ends[1], right, fright))]
                if any(seen):
                    out.append((doc, sub, fdoc, fsub, start, end, wa, wb, fstart, fend, stop, False))
                else:
                    out.append((doc, sub, fdoc, fsub, start - before, end + after, wa - more, wb + yet, fstart, fend, stop, True))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema.names)

    return both.mapInArrow(run, ", ".join(f"{c} {'long' if c in PLACE else 'int'}" for c in columns) + ", settled boolean")


def _merged(extended: DataFrame, min_words: int) -> DataFrame:
    """Ranges of one document that touch as one (doc_id, sub, start, end, first_doc_id), of at least min_words words."""
    schema = pa.schema([("doc_id", pa.int64()), ("sub", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("first_doc_id", pa.int64())])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out: list[tuple] = []
            for doc, sub, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start, end, wa, wb, first = spans[0].values()
                for s in [*spans[1:], None]:
                    if s and s["wa"] <= wb:
                        end, wb, first = max(end, s["end"]), max(wb, s["wb"]), min(first, s["fdoc"])
                    else:
                        if wb - wa >= min_words:
                            out.append((doc, sub, start, end, first))
                        if s:
                            start, end, wa, wb, first = s.values()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema.names)

    grouped = extended.groupBy("doc", "sub").agg(F.array_sort(F.collect_set(F.struct("start", "end", "wa", "wb", "fdoc"))).alias("spans"))
    return grouped.mapInArrow(run, "doc_id long, sub long, start int, end int, first_doc_id long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, sub, start, end, first_doc_id): byte ranges of texts that repeat a passage kept in first_doc_id.

    Words differ by more than the case of A-Z.  The first occurrence of a component, by id and place, is never
    listed, nor is a passage that overlaps it in the same document.  Null and empty texts and texts of fewer than
    `min_words` words have no passage; rows with a null id are left alone.  Rows that share an id are documents of
    their own if their texts differ, told apart by sub, and one document if not.  Ranges of one document that touch are one row with the least
    first_doc_id, and a row has at least `min_words` words.
    """
    spark = docs.sparkSession
    rows, _, shared = told_apart(docs, id_col, text_col)
    listed = settled(spark, lambda: _candidates(rows, min_words), "paragraph-candidates")
    keyed = listed.select(F.explode("keys").alias("key"), *OWN)
    group = Window.partitionBy("key").orderBy("doc", "sub", "start", "end", "e")
    place = F.struct(*OWN)
    met = keyed.withColumn("p", F.first(place).over(group.rowsBetween(Window.unboundedPreceding, 0))).withColumn("q", F.lag(place).over(group)).filter("q is not null")
    other = F.explode(F.when((F.col("p") == F.col("q")) | (F.col("p.e") == F.col("e")), F.array("p")).otherwise(F.array("p", "q")))
    met = materialize(met.withColumn("other", other).select(*OWN, *[F.col(f"other.{c}").alias(f"p{c}") for c in OWN]), "paragraph-pairs")
    involved = met.select("doc", "sub").unionAll(met.select("pdoc", "psub")).unionAll(listed.filter("repeated").select("doc", "sub")).distinct()
    involved = materialize(involved, "paragraph-involved")
    texts = among(rows, involved, "doc", "sub")
    # joins read them, so a few too many do no harm; repeated rows are one
    texts = materialize(_once(texts.join(involved, ["doc", "sub"], "left_semi")) if shared else texts, "paragraph-texts")
    joined = settled(spark, lambda: _repeats(listed, met, texts, min_words, percent), "paragraph-joined")
    return _merged(_extended(joined, texts, min_words - RUN + 1), min_words)


def _repeats(listed: DataFrame, met: DataFrame, texts: DataFrame, min_words: int, percent: int) -> DataFrame:
    """Every repeat of a component's first occurrence, as _joined has them, from the passages listed and the pairs that met."""
    equal, near = met.filter("e = pe"), met.filter("e <> pe").distinct()
    sides = [near.select(*[F.col(f"{p}{c}").alias(c) for c in OWN[:5]]) for p in ("", "p")]
    wanted = sides[0].unionAll(sides[1]).groupBy("e").agg(F.min(F.struct(*OWN[1:5])).alias("w")).select("e", "w.*")
    tested = near.select(F.col("e").alias("a"), F.col("pe").alias("b")).distinct()
    links = materialize(_confirmed(tested, _cut(wanted, texts), percent), "paragraph-links")
    components = materialize(connected_components(links), "paragraph-components")
    lines = listed.filter("fresh and bands is not null")
    more = settled(listed.sparkSession, lambda: _across(lines, tested, texts, components, percent), "paragraph-more")
    if not more.isEmpty():
        components = materialize(connected_components(links.unionAll(more)), "paragraph-components")
    linked = near.join(links, (F.col("e") == F.col("a")) & (F.col("pe") == F.col("b")), "left_semi")
    firsts_of = [F.col(f"p{c}").alias(c) for c in OWN]
    late = lines.select(*OWN).join(more.select(F.explode(F.array("a", "b")).alias("e")).distinct(), "e", "left_semi")
    found = [equal.select(*OWN), equal.select(*firsts_of), linked.select(*OWN), linked.select(*firsts_of), late]
    # an occurrence may be listed twice here; minima and sets below take it once
    occurrences = reduce(DataFrame.unionAll, found).distinct().unionAll(listed.filter("repeated").select(*OWN))
    # links are between lines, and shorter passages are runs
    is_line = F.col("wb") - F.col("wa") >= min_words
    of_lines = occurrences.filter(is_line).join(components, F.col("e") == F.col("node"), "left").select(F.coalesce("component", "e").alias("c"), *OWN[1:])
    placed = materialize(of_lines.unionAll(occurrences.filter(~is_line).select(F.col("e").alias("c"), *OWN[1:])), "paragraph-occurrences")
    firsts = placed.groupBy("c").agg(F.min(F.struct("doc", "sub", "start", "end")).alias("f")).select("c", *[F.col(f"f.{c}").alias(f"f{c}") for c in ("doc", "sub", "start", "end")])
    firsts = materialize(firsts, "paragraph-firsts")  # written first, so that the join stands alone and a component of any size can be split
    extra = placed.join(firsts, "c").filter("doc <> fdoc or sub <> fsub or start >= fend")
    spans = extra.groupBy(*PLACE).agg(F.array_sort(F.collect_set(F.struct("wa", "wb", "start", "end", "fstart", "fend"))).alias("spans"))
    return spans.mapInArrow(_joined, "doc long, sub long, fdoc long, fsub long, start int, end int, wa int, wb int, fstart int, fend int, stop int")


def _once(texts: DataFrame) -> DataFrame:
    """Texts without rows that repeat the one before; a join leaves equal keys side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1)
            if len(key):
                new[0] = last is None or (key[0] != last).any()
                last = key[-1]
            yield batch.filter(pa.array(new))

    return texts.sortWithinPartitions("doc", "sub").select("doc", "sub", "text").mapInArrow(run, "doc long, sub long, text binary")


def remove_passages(docs: DataFrame, repeats: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Docs with the byte ranges of repeats cut out of their texts, in docs' columns.

    Texts without a range are unchanged, null and empty ones too; a text of which only white space is left is
    dropped with its row.  Rows that share an id and a text are cut alike.
    """
    _, sub, _ = told_apart(docs, id_col, text_col)
    cuts = repeats.groupBy(F.col("doc_id").alias("__id"), F.col("sub").alias("__sub")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    joined = docs.join(cuts, (F.col(id_col).cast("long") == F.col("__id")) & (sub == F.col("__sub")), "left")
    raw = F.col(text_col).cast("binary")
    ends = F.concat(F.transform("__cuts", lambda c: c["start"]), F.array(F.octet_length(text_col)))
    begins = F.concat(F.array(F.lit(0)), F.transform("__cuts", lambda c: c["end"]))
    kept = F.transform(F.arrays_zip(begins.alias("s"), ends.alias("e")), lambda r: F.decode(F.substring(raw, r["s"] + 1, F.greatest(r["e"] - r["s"], F.lit(0))), "UTF-8"))
    cut = joined.withColumn(text_col, F.when(F.col("__cuts").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "")))
    return cut.filter(F.col("__cuts").isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
