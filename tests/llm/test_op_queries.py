"""Every query of the ten operators over a small folder of odd rows, against plain Python."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pagewright.llm import imatch, queries, source_mixing, suffix_tree, token_counts, toxicity

from .conftest import sentences, words
from .test_counts_and_codes import poured
from .test_duplicates import brute, near_copies
from .test_models import brute_tree, tokens

crc = lambda t: zlib.crc32(t.encode())


@pytest.fixture(scope="module")
def rows():
    base = sentences(1, 12)
    found = [(1, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\t "), (7, sentences(2, 60)), (8, "a" * 3000), (9, "one two"), (10, "one  two"), (11, "é ß ▁x <s> 　 😀\n\n▁▁ tail  "), (12, near_copies(5, words(20, 300), 1, 1)[0]), (13, words(20, 300)), (14, "the " * 300)]
    for i in range(15, 60):
        found.append((i, sentences(i, 4 + i % 9) + (" zorgqa you" if i % 3 == 0 else "")))
    return [(*r, ("a", "b", None, "hot")[r[0] % 4]) for r in found]


@pytest.fixture(scope="module")
def folder(make, rows, spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("ops")
    make(rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(15, 60)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    draw = np.random.default_rng(2)
    x = draw.normal(size=(20, 16))
    vectors = [(int(i), [float(v) for v in x[i % 20] + 0.05 * (i // 20) * draw.normal(size=16)]) for i in range(60)] + [(60, None), (61, [0.0] * 16), (62, [float(v) for v in x[0]])]
    spark.createDataFrame([(i, v, i % 2) for i, v in vectors], "vec_id long, embedding array<double>, label int").write.parquet(f"{at}/embeddings.parquet")
    return str(at), vectors


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_op1(spark, folder, rows):
    found = by_id(queries.op1_sharding(spark, folder[0]))
    assert {i: (r.size, r.text_crc32, r.law, r.grown_shard) for i, r in found.items()} == {i: (len((t or "").encode()) + 1, crc(t or ""), "rows", None) for i, t, _ in rows}
    held = Counter(r.shard for r in found.values())
    assert set(held) == set(range(16)) and max(held.values()) - min(held.values()) <= 1
    assert all(sorted(r.slot for r in found.values() if r.shard == s) == list(range(n)) for s, n in held.items())


def test_op2(spark, folder):
    found = by_id(queries.op2_embedding_dedup(spark, folder[0]), "vec_id")
    x = {i: np.array(v) / np.linalg.norm(v) for i, v in folder[1] if v and any(v)}
    links = {i: {j for j in x if j != i and x[i] @ x[j] >= 0.9} for i in x}
    assert {i: r.n_links for i, r in found.items()} == {i: len(links.get(i, ())) for i, _ in folder[1]}
    assert all(r.component_id == min([i, *links.get(i, ())]) and r.kept == (r.component_id == i) for i, r in found.items())


def test_op3_and_op9(spark, folder, rows):
    sp = token_counts.processor(token_counts.MODEL)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    coded, counted = by_id(queries.op3_piece_codec(spark, folder[0])), by_id(queries.op9_token_counts(spark, folder[0]))
    for i, t, _ in rows:
        ids = sp.encode(t or "")
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(sp.decode(ids)))
        assert (counted[i].n_bytes, counted[i].n_tokens, counted[i].over_limit) == (len((t or "").encode()), len(ids), len(ids) > 4096)


def test_op4(spark, folder, rows):
    sets, component = brute([r[:2] for r in rows], 4, 80)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in by_id(queries.op4_minhash_dedup(spark, folder[0])).items()} == {i: (len(sets[i]), component[i], component[i] == i) for i in sets}


def test_op5(spark, folder, rows):
    found = by_id(queries.op5_toxicity(spark, folder[0]))
    seen = [(i, t or "") for i, t, _ in rows if 15 <= i < 60 and crc(str(i)) % 5]
    toxic = sum(i % 3 == 0 for i, _ in seen) / len(seen)
    model = toxicity.train([t for _, t in seen], [int(i % 3 == 0) for i, _ in seen], (1 - toxic, toxic))
    for i, t, _ in rows:
        text, clear = t or "", 1 - model["leak"]
        for m in toxicity.SENTENCE.finditer(text.lower()):
            held = {f for w in toxicity.TOKEN.findall(m[0]) for f in toxicity.word_features(w) if f in model}
            if held:
                clear *= 1 - 1 / (1 + math.exp(-(model["bias"] + sum(model[f] for f in held))))
        r = found[i]
        assert (r.held_out, r.predicted) == (crc(str(i)) % 5 == 0, int(r.score >= 0.5)) and r.score == pytest.approx(1 - clear, abs=1e-4)
        assert all("zorgqa" in text[s.start : s.end] for s in r.offending)


def test_op6(spark, folder, rows):
    found = by_id(queries.op6_suffix_tree(spark, folder[0]))
    train = [t for i, t, _ in rows if crc(str(i)) % 5 != 1]
    counts = Counter(x for t in train for x in tokens(t))
    n = sum(counts.values())
    log_q, _, root = brute_tree(train, suffix_tree.DEPTH, max(suffix_tree.LEAST_WORD, suffix_tree.SHARE_OF_ROOT * n**0.5), suffix_tree.LEAST_CONTEXT, suffix_tree.LEAST_PAIR)
    for i, t, _ in rows:
        r, own = found[i], tokens(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(str(i)) % 5 == 1, len(own), sum(counts.get(x, 0) > 0 for x in own), n)
        s = ["<start>", *own]
        assert r.base_score == pytest.approx(sum(math.log10(root(x)) for x in own)) and r.score == pytest.approx(sum(log_q(s, k) for k in range(1, len(s))))


def test_op7(spark, folder, rows):
    found = by_id(queries.op7_imatch(spark, folder[0]))
    ordered = sorted((i, t or "") for i, t, _ in rows)
    prints = {t: {found[i].fingerprint for i, x in ordered if x == t} for _, t in ordered}
    assert all(len(v) == 1 for v in prints.values())

    def alike(a, b):
        if a == b:
            return 1.0
        if a[0] == "=" or b[0] == "=":
            return 0.0
        pairs = [p for p in zip(a.split(" "), b.split(" "), strict=True) if p != ("-", "-")]
        return sum(x == y for x, y in pairs) / len(pairs)

    for k, (i, t) in enumerate(ordered):
        j, other = ordered[(k + 1) % len(ordered)]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + other[:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(r.fingerprint, r.edited_fingerprint)) and r.near_next == pytest.approx(alike(r.fingerprint, found[j].fingerprint))
        assert r.fingerprint[0] == "=" or len(r.fingerprint.split(" ")) == len(imatch.SUBSETS)


def test_op8(spark, folder, rows):
    found = queries.op8_paragraph_dedup(spark, folder[0]).collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} >= {(2, 1), (3, 1), (13, 12), (14, 14)} and all(r.n_bytes == r.end_byte - r.start_byte > 0 for r in found)
    assert {r.doc_id for r in found} == {2, 3, 13, 14}


def test_op10(spark, folder, rows):
    found = by_id(queries.op10_source_mixing(spark, folder[0]))
    size = {i: len(tokens(t)) - 1 for i, t, _ in rows}
    source = Counter()
    for i, _, s in rows:
        source[s] += size[i]
    target, taken = poured(source), Counter()
    for i, _, s in rows:
        r = found[i]
        assert (r.size, r.source_size) == (size[i], source[s]) and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= source_mixing.MOST_COPIES * size[i] and (not size[i] or r.taken % size[i] == 0)
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 12 for s in source)


def test_every_query_is_registered():
    assert len(queries.queries()) == 10 and not queries.oracle_sql()
