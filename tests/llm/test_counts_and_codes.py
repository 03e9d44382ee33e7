"""Sharding, source mixing, token counts and the piece codec."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm import piece_codec, token_counts
from pagewright.llm.sharding import read_shard, shuffle_into_shards, write_shards
from pagewright.llm.source_mixing import apply_mix, fit_budget, mix_sources, source_targets

from .conftest import SCHEMA, sentences, words


@pytest.fixture(scope="module")
def sp():
    return token_counts.processor(token_counts.MODEL)


def test_shards(spark, odd, odd_rows):
    rows = shuffle_into_shards(odd, 3).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in rows))) == sorted(map(repr, ((r[0], r[1]) for r in odd_rows)))
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(3)}
    assert all(slots == list(range(len(slots))) for slots in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    keyed = odd.filter("doc_id is not null")
    first = sorted((r.doc_id, r.shard, r.slot) for r in shuffle_into_shards(keyed, 3).collect())
    assert first == sorted((r.doc_id, r.shard, r.slot) for r in shuffle_into_shards(keyed.repartition(7), 3).collect())
    assert first != sorted((r.doc_id, r.shard, r.slot) for r in shuffle_into_shards(keyed, 3, seed=5).collect())
    assert shuffle_into_shards(spark.createDataFrame([], SCHEMA), 3).count() == 0


def test_shards_move_a_text_once(odd):
    found = shuffle_into_shards(odd.select("doc_id", "text"), 3)
    node = found._jdf.queryExecution().analyzed()
    while "FlatMapGroupsInArrow" not in node.nodeName():
        node = node.children().head()
    assert node.children().head().schema().catalogString().count("string") == 1


def test_shards_are_uniform(make):
    rows = shuffle_into_shards(make([(i, str(i)) for i in range(2000)]), 4, bucket_bytes=64).collect()
    low = Counter(r.shard for r in rows if r.doc_id < 1000)
    assert all(200 < n < 300 for n in low.values())


def test_shard_files(make, spark, tmp_path):
    write_shards(shuffle_into_shards(make([(i, str(i)) for i in range(50)]), 4), str(tmp_path / "shards"))
    assert sorted(r["doc_id"] for s in range(4) for r in read_shard(spark, str(tmp_path / "shards"), s)) == list(range(50))


def test_token_counts(odd, odd_rows, sp, spark):
    found = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd).collect())
    assert found == Counter((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t, *_ in odd_rows)
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab ▁\n\té", max_size=60), st.integers(1, 12))
def test_safe_pieces(sp, text, limit):
    assert sum(len(sp.encode(p)) for p in token_counts.safe_pieces(text, limit)) == len(sp.encode(text))


def test_codec(odd, odd_rows, sp, spark):
    encoded = piece_codec.encode_pieces(odd)
    found = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in piece_codec.decode_pieces(encoded).collect())
    assert found == Counter((i, tuple(sp.encode(t or "")), sp.decode(sp.encode(t or ""))) for i, t, *_ in odd_rows)
    assert found == Counter((r.doc_id, tuple(r.ids), r.decoded) for r in piece_codec.round_trip(odd).collect())
    for empty in (piece_codec.decode_pieces(piece_codec.encode_pieces(spark.createDataFrame([], SCHEMA))), piece_codec.round_trip(spark.createDataFrame([], SCHEMA))):
        assert empty.count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aeTh .▁\n\r\t\x00éß😀<s>", max_size=40), max_size=6))
def test_chunk_table_equals_library(sp, texts):
    ends, flat = piece_codec.encode_texts(texts, sp)
    assert [flat[a:b].tolist() for a, b in itertools.pairwise(ends)] == sp.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_budget_fit_is_best(lengths, budget):
    sizes, counts = zip(*lengths, strict=True)
    take = fit_budget(sizes, counts, budget)
    sums = {sum(s * k for s, k in zip(sizes, ks, strict=True)) for ks in itertools.product(*(range(n + 1) for n in counts))}
    assert all(0 <= k <= n for k, n in zip(take, counts, strict=True))
    assert sum(s * k for s, k in zip(sizes, take, strict=True)) == max(x for x in sums if x <= budget)


def test_budget_fit_of_large_counts():
    draw = random.Random(1)
    sizes = sorted(draw.sample(range(1, 9000), 400))
    counts = [draw.randint(1, 5000) for _ in sizes]
    budget = sum(s * n for s, n in zip(sizes, counts, strict=True)) // 3
    take = fit_budget(sizes, counts, budget)
    assert abs(sum(s * k for s, k in zip(sizes, take, strict=True)) - budget) <= 1 and all(k <= n for k, n in zip(take, counts, strict=True))


def poured(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: share.get(s, 3 * sizes[s]) for s in order}
        capped |= over


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, None: 5}, {"é": 1, "z": 100, "b": 3, "a": 2, "c": 0}, {"a": 0}):
        rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, n long")
        found = {r.source: r.target for r in source_targets(rows).collect()}
        assert found == pytest.approx(poured(sizes)) if sum(sizes.values()) else found == {"a": 0.0}


def test_mix(make, spark):
    rows = [(i, sentences(i, 1 + i % 7) if i % 9 else None, f"s{i % 4}" if i % 5 else None) for i in range(300)] + [(300 + i, "same three words", "hot") for i in range(400)]
    docs = make(rows)
    mix = mix_sources(docs).cache()
    found = {r.doc_id: r for r in mix.collect()}
    size = lambda t: len((t or "").split())
    assert len(found) == 700 and all(found[r[0]].size == size(r[1]) and 0 <= found[r[0]].copies <= 3 for r in rows)
    sources = Counter()
    taken = Counter()
    for i, t, s in rows:
        sources[s] += size(t)
        taken[s] += found[i].size * found[i].copies
    for s, target in poured(sources).items():
        assert abs(taken[s] - target) < 9  # sizes are multiples of 9 in most sources
    assert {i: r.copies for i, r in found.items()} == {r.doc_id: r.copies for r in mix_sources(docs.repartition(5)).collect()}
    mixed = apply_mix(docs, mix)
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == +Counter({i: r.copies for i, r in found.items()})
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_sources(empty).count() == 0


def test_mix_of_odd_rows(odd, odd_rows):
    mix = mix_sources(odd).cache()
    assert mix.count() == len(odd_rows)
    apply_mix(odd, mix).count()
    assert words(1, 3)
