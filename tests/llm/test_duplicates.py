"""Near duplicates of texts and vectors, repeated passages, components, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pagewright.llm.components import connected_components
from pagewright.llm.embedding_dedup import codes, hadamard, meet, near_duplicate_vectors, plan
from pagewright.llm.minhash_dedup import drop_near_duplicates, least_matches, near_duplicates
from pagewright.llm.paragraph_dedup import equal_left, equal_right, passages, remove_passages, repeated_passages
from pagewright.llm.shingles import jaccard_counts, shingle_hashes, word_hashes

from .conftest import SCHEMA, sentences, words


def merged(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, merged(sets, links)


def near_copies(seed, base, n, edits):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        w = base.split(" ")
        for _ in range(edits):
            w[draw.randrange(len(w))] = words(draw.random(), 1)
        out.append(" ".join(w))
    return out


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 240)] + [(5, 5), (7, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if b is not None]
    expected = merged({x for pair in real for x in pair}, real)
    assert all(found.get(n, n) == c for n, c in expected.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(make, k):
    base, other, passage = words(1, 160), words(2, 60), words(3, 120)
    texts = [base, base, base.upper(), *near_copies(4, base, 25, 2), *near_copies(5, base, 12, 6), *near_copies(6, other, 12, 3), "one two", "two one", "ONE\ttwo", "", None, " "]
    texts += [words(100 + i, 30 + 3 * i) + " " + passage for i in range(20)] + [words(300 + i, 50) for i in range(30)]
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in near_duplicates(make(rows), k=k).collect()}
    sets, expected = brute(rows, k, 80)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {i: (len(sets[i]), expected[i], expected[i] == i) for i in sets}


def test_near_copies_do_not_become_all_pairs(make, monkeypatch):
    """Texts of two changed words link through those of one only, so a bucket's least text leaves nearly all alone."""
    from pagewright.llm import minhash_dedup

    draw, base = random.Random(8), words(800, 112).split()

    def edited(n, i):
        own = list(base)
        for j in range(n):
            own[draw.randrange(112)] = f"changed{i}x{j}"
        return " ".join(own)

    rows = [(i, edited(1 if i % 10 == 0 else 2, i)) for i in range(300)]
    shingles = {i: {tuple(t.split()[j : j + 4]) for j in range(109)} for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in shingles:
        for j in range(i):
            if 100 * len(shingles[i] & shingles[j]) >= 80 * len(shingles[i] | shingles[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    made, real = [], minhash_dedup.materialize

    def counted(df, name):
        out = real(df, name)
        if name == "minhash-pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash_dedup, "materialize", counted)
    found = {r.doc_id: r.component_id for r in near_duplicates(make(rows), k=4).collect()}
    assert found == {i: root(i) for i in shingles}
    assert sum(made) < 300 * 16


def test_texts_just_under_the_threshold_do_not_become_pairs(spark):
    """Every two of these share most of their shingles and few reach the threshold, so no round of links joins them."""
    from pagewright.llm import minhash_dedup

    draw, base, member = random.Random(9), words(801, 112).split(), getattr(minhash_dedup, "MEMBER", ["class_id", "component", "place", "n"])
    sets, rows = {}, []
    for i in range(60):
        own = list(base)
        for j in draw.sample(range(112), 2 if i % 9 else 1):
            own[j] = f"changed{i}x{j}"
        hashes, _, _, _ = word_hashes([" ".join(own).encode()])
        sets[i] = shingle_hashes(hashes, 4)
        sketch = minhash_dedup.sketch_of(sets[i]).tolist() if hasattr(minhash_dedup, "sketch_of") else []
        rows.append((i, i, 0, len(sets[i]), *sketch))
    found = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in member))
    pairs = found.alias("x").crossJoin(found.alias("y")).filter("x.class_id > y.class_id")
    made = {(r.a, r.b) for r in minhash_dedup._untested(pairs, 80, spark.createDataFrame([], "a long, b long")).collect()}
    counts = {(a, b): jaccard_counts(sets[a], sets[b]) for a in sets for b in range(a)}
    real = {pair for pair, (shared, union) in counts.items() if 100 * shared >= 80 * union}
    assert real and real <= made
    assert len(made) < 0.2 * len(counts) + len(real)


def test_sketches_bound_the_difference():
    from pagewright.llm.minhash_dedup import sketch_of

    draw = np.random.default_rng(4)
    for n, own in ((1, 0), (5, 3), (300, 20), (5000, 4000)):
        both, x, y = (draw.integers(0, 1 << 64, m, np.uint64) for m in (n, own, 2 * own))
        differ = sketch_of(np.concatenate([both, x])) ^ sketch_of(np.concatenate([both, y]))
        assert 0 <= sum(int(v).bit_count() for v in differ.view(np.uint64)) <= 3 * own
        assert len(differ) == 8 and (own == 0) == (not differ.any())


def test_near_duplicates_of_odd_rows(odd, odd_rows, spark):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].component_id == by[3].component_id == 1 and by[15].component_id == 14 and by[4].kept and by[5].n_shingles == 0
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_duplicates_of_shared_ids(make):
    one, two = words(21, 120), words(22, 120)
    rows = [(1, one), (1, two), (2, near_copies(1, one, 1, 1)[0]), (3, near_copies(2, two, 1, 1)[0]), (5, words(23, 90)), (5, words(24, 90)), (5, words(24, 90)), (6, words(23, 90)), (4, words(24, 90))]
    for table in (make(rows), make(rows[::-1])):
        found = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(table).collect())
        assert found == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (5, 4, False), (5, 5, True), (6, 5, False)]
        kept = sorted((r.doc_id, r.text) for r in drop_near_duplicates(table).collect())
        assert kept == sorted([(1, one), (1, two), (4, words(24, 90)), (5, words(23, 90))])


def test_posterior_bound():
    draw = np.random.default_rng(1)
    floor = least_matches(50, 0.8, 1e-3)
    assert 20 < floor < 40 and (draw.binomial(50, 0.8, 100_000) < floor).mean() < 2e-3


def test_shingle_counts():
    hashes, offsets, starts, ends = word_hashes([b"a b c d e", b"", b" A  b\tc d x "])
    sets = [shingle_hashes(hashes[a:b], 4) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert [len(s) for s in sets] == [2, 0, 2] and jaccard_counts(sets[0], sets[2]) == (1, 3)
    assert (starts[5], ends[5]) == (1, 2)


def test_hadamard_keeps_angles():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(x) @ hadamard(x).T, x @ x.T)


def test_vectors(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 32))
    vectors = [c + s * draw.normal(size=32) * np.linalg.norm(c) / 5.7 for c in centres for s in (0, 0.1, 0.2, 0.3, 0.45)] + [centres[0] * 2.0, centres[0]] * 3 + list(centres[1] + 0.01 * draw.normal(size=(400, 32)))
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)]
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(x @ x.T >= 0.9), strict=True) if a < b]
    degree, component = np.zeros(len(x), int), merged(range(len(x)), links)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    bad = [(1000, None, 0), (1001, [0.0] * 32, 0), (1002, [1.0, None] + [0.0] * 30, 0), (1003, [float("nan")] * 32, 0), (1004, [float("inf")] + [1.0] * 31, 0), (1005, [], 0), (1006, [1.0, 2.0], 0), (1007, [2.0, 4.0], 0), (None, [1.0, 2.0], 0)]
    found = {r.vec_id: r for r in near_duplicate_vectors(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n int").repartition(4)).collect()}
    right = sum(found[i].n_links == degree[i] for i in range(len(x)))
    assert right >= 0.99 * len(x) and sum(found[i].component_id == component[i] for i in range(len(x))) >= 0.99 * len(x)
    assert all(found[i].n_links <= degree[i] for i in range(len(x)))
    assert all(found[i].n_links == 0 and found[i].kept for i in (1000, 1001, 1002, 1003, 1004, 1005, None))
    assert found[1007].component_id == 1006 and found[1006].n_links == 1
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_vectors_of_shared_ids(spark):
    x, y = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, x), (1, y), (2, [1.0, 0.1, 0.0, 0.0]), (3, [0.1, 1.0, 0.0, 0.0]), (4, [0.1, 1.0, 0.1, 0.0])]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert found == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False)]


@pytest.mark.parametrize(("n", "dim"), [(1_000_000, 64), (100_000_000, 64), (4_000_000, 32)])
def test_recall_at_every_size(n, dim):
    tables, hashes = plan(n, dim, 0.9)
    draw = np.random.default_rng(11)
    x, z = draw.normal(size=(2, 1000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    assert meet(codes(x, tables, hashes), codes(y, tables, hashes)).any(axis=1).mean() >= 0.996


def cut_texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def runs(text, n=51):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_repeated_passages(make):
    passage, loose = sentences(1, 7), words(2, 56)
    rows = [(i, sentences(100 + i, 6) + " " + passage + " " + sentences(200 + i, 5)) for i in range(8)]
    rows += [(20 + i, words(300 + i, 45) + " " + loose + " " + words(400 + i, 20)) for i in range(4)]
    rows += [(40, passage.upper()), (41, sentences(5, 4) + "\n" + passage + "\n" + sentences(6, 4)), (50, sentences(7, 30)), (51, sentences(8, 30)), (52, words(9, 30) + " " + words(10, 44)), (53, words(11, 30) + " " + words(10, 44))]
    line = words(12, 80)
    rows += [(60, sentences(13, 3) + "\n" + line), (61, sentences(14, 3) + "\n" + near_copies(1, line, 1, 1)[0])]
    docs = make(rows)
    repeats = repeated_passages(docs).cache()
    marked = {r.doc_id for r in repeats.collect()}
    assert marked == {*range(1, 8), 21, 22, 23, 40, 41, 61}
    cut = cut_texts(remove_passages(docs, repeats))
    original = dict(rows)
    assert 40 not in cut and all(cut[i] == original[i] for i in (0, 20, 50, 51, 52, 53, 60))
    assert all(cut[i] == original[i].replace(passage, "") for i in range(1, 8))
    left = [runs(t) for t in cut.values()]
    assert sum(map(len, left)) == len(set().union(*left))
    assert {r.first_doc_id for r in repeats.collect()} == {0, 20, 60}


def test_lines_that_share_a_template(make):
    """Two near copies of each line, of which most band buckets hold lines of many families between."""
    draw = random.Random(8)
    template = words(40, 100).split(" ")
    families, copies = [], []
    for i in range(300):
        w = list(template)
        for at in draw.sample(range(0, 100, 5), 2):
            w[at] = f"z{draw.randrange(10**6)}x{i}"
        families.append(" ".join(w))
        copies.append(" ".join(w[:-1] + [f"y{i}"]))
    rows = list(enumerate(families + copies))
    sets, expected = brute(rows, 5, 80)
    found = {r.doc_id: r.first_doc_id for r in repeated_passages(make(rows)).collect() if r.end - r.start > 300}
    assert all(len(sets[i] & sets[300 + i]) * 100 >= 80 * len(sets[i] | sets[300 + i]) for i in range(300))
    assert {*found} >= {i for i, c in expected.items() if c != i}


def test_passages_repeated_within_one_line(make):
    rows = []
    for i in range(51, 71):
        passage = words(500 + i, i)
        rows.append((i, f"{words(600 + i, 60)} {passage} {words(700 + i, 30)} {passage} {words(800 + i, 40)}"))
        rows.append((100 + i, f"{words(900 + i, 20)} {words(950 + i, i)} {words(950 + i, i)} {words(1000 + i, 20)}"))
    rows.append((300, " ".join([words(1100, 60)] * 4)))
    docs = make(rows)
    repeats = repeated_passages(docs).cache()
    assert {r.doc_id for r in repeats.collect()} == {i for i, _ in rows} and all(r.doc_id == r.first_doc_id for r in repeats.collect())
    cut = cut_texts(remove_passages(docs, repeats))
    for i, text in rows:
        gone = 180 if i == 300 else i % 100
        assert len(cut[i].split()) == len(text.split()) - gone and len(runs(cut[i], 50)) == len(cut[i].split()) - 49


def test_repeated_passages_of_odd_rows(odd, odd_rows, spark):
    repeats = repeated_passages(odd).cache()
    cut = remove_passages(odd, repeats)
    assert cut.columns == odd.columns
    kept = {(r.doc_id, r.text) for r in cut.collect()}
    assert {(4, None), (5, ""), (6, " \n\t "), (None, None), (8, "a" * 30000)} <= kept and (1, odd_rows[0][1]) in kept
    assert {r.doc_id for r in repeats.collect()} >= {2, 3, 13, 15}
    assert repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passages_of_one_place_are_not_shuffled(make):
    """Of the listed passages only those travel that are lines, repeated or share a key, each with the keys it shares."""
    from pagewright.llm import paragraph_dedup

    shared = words(70, 90)
    rows = [(i, "\n".join([words(71 + 3 * i, 30), shared if i in (2, 9) else words(72 + 3 * i, 45), words(73 + 3 * i, 40)])) for i in range(24)]
    texts = paragraph_dedup.told_apart(make(rows), "doc_id", "text")[0]
    every = paragraph_dedup._listed(texts, 50).collect()
    held = {}
    for r in every:
        for key in [r.e, *(r.bands or [])] if r.fresh else []:
            held.setdefault(key, []).append(r)
    found = {(r.doc, r.wa, r.wb): r for r in paragraph_dedup._candidates(texts, 50).collect()}
    for r in every:
        keys = {k for k in [r.e, *(r.bands or [])] if r.fresh and len(held[k]) > 1}
        kept = found.get((r.doc, r.wa, r.wb))
        assert kept is not None if keys or r.repeated or r.bands else kept is None or kept["keys"]
        assert kept is None or keys <= set(kept["keys"])
    assert {2, 9} <= {doc for doc, _, _ in found} and len(found) < 0.3 * len(every)


def test_winnowing_promise():
    shared = words(1, 50)
    texts = [(words(10 + i, i * 3) + " " + shared + " " + words(50 + i, 7)).encode() for i in range(12)]
    owner, at, to, line, hashes, offsets, *_ = passages(texts)
    found = [{tuple(hashes[a:b]) for o, a, b, w in zip(owner, at, to, line, strict=True) if o == i and not w} for i in range(12)]
    assert all(found[0] & f for f in found)


def test_passages_of_long_words_and_shared_ids(make):
    long = " ".join(words(2000 + i, 20).replace(" ", "")[:80].ljust(80, "q") for i in range(50))
    own = words(30, 70)
    rows = [(i, f"{words(1200 + i, 30)} {long} {words(1300 + i, 30)}") for i in range(7)]
    rows += [(20, f"{words(1400, 40)} {own} {words(1401, 9)}"), (20, f"{own} {words(1402, 60)}"), (20, f"{own} {words(1402, 60)}"), (21, f"{words(1403, 8)} {own}")]
    docs = make(rows)
    repeats = repeated_passages(docs).cache()
    assert sorted({r.doc_id for r in repeats.collect()}) == [*range(1, 7), 20, 21]
    cut = remove_passages(docs, repeats).collect()
    assert sum(long in r.text for r in cut) == 1 and len({r.text for r in cut if own in r.text}) == 1


def test_contexts():
    assert equal_left(b"x Aa b ", b"y aa  B ") == (2, 5) and equal_right(b" a b c", b" A b d") == (2, 4)
    assert equal_left(b"", b"a") == (0, 0) == equal_left(b"b a", b"a", False)


def test_spans_are_read_a_few_rows_at_a_time():
    import tracemalloc

    import pyarrow as pa

    from pagewright.llm.paragraph_dedup import PLACE, _joined

    n, spans = 10000, [{"wa": 40 * i, "wb": 40 * i + 32, "start": 300 * i, "end": 300 * i + 250, "fstart": 0, "fend": 250} for i in range(8)]
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in spans[0]]))
    batch = pa.RecordBatch.from_arrays([*(pa.array(range(n), pa.int64()) for _ in PLACE), pa.array([spans] * n, kind)], [*PLACE, "spans"])
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in _joined(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 8 * n and most < 10e6


def test_spans_are_joined_as_one_by_one():
    import pyarrow as pa

    from pagewright.llm.paragraph_dedup import PLACE, _joined

    draw = random.Random(5)
    rows, expected = [], []
    for doc in range(700):
        spans = sorted({(a := draw.randrange(300), a + draw.randrange(1, 40), *(draw.randrange(1000) for _ in range(4))) for _ in range(draw.randrange(1, 12))})
        rows.append([dict(zip(("wa", "wb", "start", "end", "fstart", "fend"), x, strict=True)) for x in spans])
        own = []
        for wa, wb, start, end, fstart, fend in spans:
            if own and wa <= own[-1][3]:
                if wb > own[-1][3]:
                    own[-1][1], own[-1][3], own[-1][5] = end, wb, fend
            else:
                own.append([start, end, wa, wb, fstart, fend, fend])
        expected += [(doc, 1, 2, 3, *x) for x in own]
    kind = pa.list_(pa.struct([(c, pa.int32()) for c in rows[0][0]]))
    places = [pa.array(range(700), pa.int64()), *(pa.array([i] * 700, pa.int64()) for i in (1, 2, 3))]
    batch = pa.RecordBatch.from_arrays([*places, pa.array(rows, kind)], [*PLACE, "spans"])
    found = [tuple(r.values()) for b in _joined(iter([batch.slice(0, 500), batch.slice(500)])) for r in b.to_pylist()]
    assert found == expected


def test_only_what_others_share_is_joined_across(make, monkeypatch):
    """Lines whose bands nobody else has reach no join across components, nor do texts go through a join where no id is shared."""
    from pagewright.llm import minhash_dedup, paragraph_dedup

    held = {}

    def seen(df, name, materialize=paragraph_dedup.materialize):
        out = materialize(df, name)
        held.setdefault(name, []).append((out.count(), df._jdf.queryExecution().executedPlan().toString() if name == "paragraph-texts" else ""))
        return out

    monkeypatch.setattr(paragraph_dedup, "materialize", seen)
    monkeypatch.setattr(minhash_dedup, "materialize", seen)
    line = words(3000, 90)
    rows = [(i, words(3001 + i, 80)) for i in range(60)] + [(100, line), (101, near_copies(2, line, 1, 1)[0])]
    assert {r.doc_id for r in repeated_passages(make(rows)).collect()} == {101}
    (members, _), *_ = held["paragraph-members"]
    assert members <= 10 and not any("Join" in plan for _, plan in held["paragraph-texts"])


def test_shingles_of_one_component_reach_no_join(spark, monkeypatch):
    from pagewright.llm import minhash_dedup

    held = {}

    def seen(df, name, materialize=minhash_dedup.materialize):
        out = materialize(df, name)
        held.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(minhash_dedup, "materialize", seen)
    a, b = words(3100, 120), words(3101, 120)
    texts = [(1, a), (2, a + " x"), (3, b), (4, words(3102, 120)), (5, words(3103, 120))]
    open_ = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)], "class_id long, component long")
    pairs = minhash_dedup.across_components(open_, spark.createDataFrame([(i, t.encode()) for i, t in texts], "class_id long, text binary"), 5, 80, spark.createDataFrame([], "a long, b long"), lambda p: p)
    assert [(r.a, r.b) for r in pairs.collect()] == [(2, 1)]
    assert held["minhash-prefixes"][-1] < 0.5 * held["minhash-prefixes"][0]


def test_a_stage_has_one_pass_of_python(make, monkeypatch):
    """Two passes in one stage start two workers a task, all of which an executor keeps."""
    from pagewright.llm import minhash_dedup, paragraph_dedup

    held = {}

    def passes(node) -> tuple[int, int]:
        if node.nodeName() == "AdaptiveSparkPlan":
            return passes(node.initialPlan())
        below = [passes(node.children().apply(i)) for i in range(node.children().size())]
        own, most = sum(x for x, _ in below) + ("MapIn" in node.nodeName()), max((x for _, x in below), default=0)
        return (0 if "Exchange" in node.nodeName() else own), max(own, most)

    def seen(df, name, materialize=paragraph_dedup.materialize):
        held.setdefault(name, []).append(passes(df._jdf.queryExecution().executedPlan())[1])
        return materialize(df, name)

    monkeypatch.setattr(paragraph_dedup, "materialize", seen)
    monkeypatch.setattr(minhash_dedup, "materialize", seen)
    draw, template = random.Random(8), words(40, 100).split(" ")
    rows = []
    for i in range(40):
        w = list(template)
        for at in draw.sample(range(0, 100, 5), 2):
            w[at] = f"z{draw.randrange(10**6)}x{i}"
        rows += [(i, " ".join(w)), (100 + i, " ".join(w[:-1] + [f"y{i}"]))]
    long = " ".join(words(2000 + i, 20).replace(" ", "")[:80].ljust(80, "q") for i in range(50))
    rows += [(200 + i, f"{words(1200 + i, 30)} {long} {words(1300 + i, 30)}") for i in range(3)]
    assert {201, 202} <= {r.doc_id for r in repeated_passages(make(rows)).collect()}
    assert len(held["paragraph-links"]) > 1 < len(held["paragraph-extended"]) and held["minhash-prefixes"]
    assert max(map(max, held.values())) == 1
