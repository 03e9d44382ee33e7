"""Toxicity, suffix tree and I-Match."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest

from pagewright.llm import imatch, suffix_tree, toxicity
from pagewright.llm.queries import op7_imatch

from .conftest import SCHEMA, sentences, words


@pytest.fixture(scope="module")
def labelled():
    """Documents of clean sentences, some with one that holds an inflected bad stem."""
    draw = random.Random(1)
    rows = []
    for i in range(700):
        text = sentences(i, draw.randint(2, 10))
        toxic = i % 5 == 0
        if toxic:
            parts = text.split(". ")
            at = draw.randrange(len(parts))
            parts[at] += f" zorgq{words(draw.random(), 1)} you"
            text = ". ".join(parts)
        rows.append((i, text, int(toxic)))
    return rows


def test_toxicity(labelled, make, spark):
    docs = make([r[:2] for r in labelled] + [(900, None), (901, ""), (902, labelled[0][1])])
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled if i % 7] + [(5000, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = [(rows[i].toxicity, y) for i, _, y in labelled if i % 7 == 0]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.97 * len(held)
    bad = rows[0]
    assert all("zorgq" in bad.text[s.start : s.end] for s in bad.offending) and len(bad.offending) == 1
    assert rows[902].toxicity == rows[0].toxicity and rows[900].toxicity == rows[901].toxicity < 0.5
    assert all(0 <= r.toxicity <= 1 for r in rows.values())
    again = toxicity.fit_toxicity(docs.repartition(5), labels)
    assert again == pytest.approx(model)


def test_toxicity_of_odd_rows(odd, odd_rows, spark):
    none = toxicity.fit_toxicity(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    rows = toxicity.score_toxicity(odd, none).collect()
    assert len(rows) == len(odd_rows) and all(r.toxicity == 0 for r in rows)
    assert toxicity.score_toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
    lonely = toxicity.fit_toxicity(odd, spark.createDataFrame([(1, 1), (7, 1)], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(odd, lonely).count() == len(odd_rows)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) + [None]


def test_suffix_tree(make):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(("alpha beta gamma", "beta beta alpha", words(draw.randrange(30), 2))) for _ in range(draw.randint(0, 40)))) for i in range(300)] + [(300, None), (301, "ALPHA unseenword")]
    docs = make(rows)
    scored = suffix_tree.score_texts(docs, docs.filter("doc_id % 5 <> 1"))
    assert "text" not in scored.columns and "lang" in scored.columns
    found = {r.doc_id: r for r in scored.collect()}
    counts = Counter(t for i, text in rows if i % 5 != 1 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    base = lambda t: math.log10((counts.get(t, 0) + 0.5) / (n + 0.5 * (v + 1)))
    for i, text in rows:
        r, own = found[i], tokens(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts.get(t, 0) > 0 for t in own), n)
        assert r.base_score == pytest.approx(sum(map(base, own)))
    held = [found[i] for i, _ in rows if i % 5 == 1 and i < 300]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def brute_tree(training, depth, least_word, least_context, least_pair):
    """log10 probability of a token after a context, by dictionaries: contexts level by level, the longest kept suffix at last."""
    streams = [["<start>", *tokens(t)] for t in training]
    unigram = Counter(x for s in streams for x in s[1:])
    n, v = sum(unigram.values()), len(unigram)
    root = lambda x: (unigram.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))
    words = {x for x, c in unigram.items() if c >= least_word} | {"<start>"}
    kept = {}

    def q(context, x):
        for i in range(len(context)):
            own = kept.get(context[i:])
            if own:
                return own[0][x] if x in own[0] else own[1] * q(context[i + 1 :], x)
        return root(x)

    for d in range(1, depth + 1):
        seen, total = {}, Counter()
        for s in streams:
            for i in range(d, len(s)):
                context = tuple(s[i - d : i])
                total[context] += 1
                if words.issuperset(s[i - d : i + 1]):
                    seen.setdefault(context, Counter())[s[i]] += 1
        level = {}
        for context, found in seen.items():
            found = {x: c for x, c in found.items() if c >= least_pair}
            if total[context] < least_context or not found:
                continue
            share = {x: (c - 0.5) / (total[context] + 1) for x, c in found.items()}
            parent = {x: q(context[1:], x) for x in found}
            rest = (1 - sum(share.values())) / max(1 - sum(parent.values()), 1e-9)
            gain = sum(c * math.log(share[x] / parent[x]) for x, c in found.items()) + (total[context] - sum(found.values())) * math.log(rest)
            if gain > 0.5 * (len(found) + 1) * math.log(max(total[context], 2)):
                level[context] = (share, rest)
        kept |= level
    return lambda s, i: math.log10(q(tuple(s[max(0, i - depth) : i]), s[i])), kept, root


def test_tree_is_that_of_dictionaries(make, monkeypatch):
    draw = random.Random(5)
    after = {k: draw.choice("abcdef") for k in itertools.product("abcdef", repeat=3)}

    def text(n):
        out = draw.choices("abcdef", k=3)
        for _ in range(n):
            out.append(after[tuple(out[-3:])] if draw.random() < 0.7 else draw.choice(["a", "b", "c", "d", "e", "f", words(draw.randrange(60), 1)]))
            if out[-1] not in "abcdef":
                out += draw.choices("abcdef", k=3)
        return " ".join(out)

    rows = [(i, text(draw.randint(0, 60))) for i in range(150)] + [(200, None)]
    docs = make(rows)
    for head in (1 << 20, 16):  # all entries in the head, or most of them joined
        monkeypatch.setattr(suffix_tree, "HEAD", head)
        monkeypatch.setattr(suffix_tree.head_of, "__defaults__", (head,))
        found = {r.doc_id: r.score for r in suffix_tree.score_texts(docs, docs.filter("doc_id % 5 <> 1")).collect()}
        log_q, kept, _ = brute_tree([t for i, t in rows if i % 5 != 1], suffix_tree.DEPTH, 5, suffix_tree.LEAST_CONTEXT, suffix_tree.LEAST_PAIR)
        assert {len(c) for c in kept} == {1, 2, 3}
        for i, t in rows:
            s = ["<start>", *tokens(t)]
            assert found[i] == pytest.approx(sum(log_q(s, k) for k in range(1, len(s))))


def test_tree_sums_to_one():
    draw = random.Random(5)
    texts = [" ".join(draw.choice("abcabcde") for _ in range(50)) for _ in range(80)]
    log_q, kept, root = brute_tree(texts, 3, 5, 20, 3)
    symbols = [*"abcde", None, "unseen"]
    for context in (("<start>",), ("a", "b", "c"), ("<start>", "a"), ("unseen",) * 3, ("c", "c")):
        assert sum(10 ** log_q([*context, x], len(context)) for x in symbols) == pytest.approx(1)
    assert sum(map(root, symbols)) == pytest.approx(1)


def test_tree_does_not_depend_on_the_size(make):
    pairs = [(i, "left right") for i in range(20)]
    scored = []
    for filler in (1, 50):
        rows = pairs + [(100 + i, "the " * 1000) for i in range(filler)]
        docs = make(rows)
        found = {r.doc_id: r for r in suffix_tree.score_texts(docs, docs).collect()}
        log_q, kept, _ = brute_tree([t for _, t in rows], suffix_tree.DEPTH, suffix_tree.LEAST_WORD, suffix_tree.LEAST_CONTEXT, suffix_tree.LEAST_PAIR)
        s = ["<start>", *tokens("left right")]
        assert ("left",) in kept and found[0].score == pytest.approx(sum(log_q(s, k) for k in range(1, len(s))))
        scored.append(found[0].score - found[0].base_score)
    assert scored[1] > scored[0] > 3


def test_suffix_tree_of_odd_rows(odd, odd_rows, spark):
    assert suffix_tree.score_texts(odd, odd).count() == len(odd_rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_tree.score_texts(empty, empty).count() == 0
    assert all(r.base_score <= 0 and r.train_tokens == 0 for r in suffix_tree.score_texts(odd, empty).collect())


def test_lexicon_is_exact(make):
    draw = random.Random(6)
    texts = [" ".join(f"w{int(draw.expovariate(0.05))}" for _ in range(60)) for _ in range(400)]
    docs = make(list(enumerate(texts)))
    df = Counter(w for t in texts for w in set(t.split()))
    assert imatch.band_lexicon(docs.select("text"), "text", 0.02, 0.3) == sorted(w for w, n in df.items() if 8 <= n <= 120)


def test_fingerprints(odd, odd_rows, spark):
    rows = imatch.fingerprint(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {}
    for r in rows:
        by.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())
    assert imatch.fingerprint(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_term_is_outside_all_subsets(make):
    terms = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(terms[j % 60] for j in range(i, i + 1 + i // 60))) for i in range(180)]
    found = imatch.fingerprint(make(rows), low=0.01, high=0.9).collect()
    assert imatch.band_lexicon(make(rows).select("text"), "text", 0.01, 0.9) == sorted(terms)
    assert len({r.fingerprint for r in found}) == len({frozenset(r.text.split()) for r in found}) == 180


def test_next_rows(make):
    draw = random.Random(7)
    ids = draw.sample(range(10**12), 200) + [-5, 0]
    docs = make([(i, f"t{i}") for i in ids]).select("doc_id", "text")
    for n in (1, 7, 64):
        found = {r.doc_id: r.next_text for r in imatch.with_next(docs, "doc_id", ["text"], n).collect()}
        ordered = sorted(ids)
        assert found == {i: f"t{ordered[(k + 1) % len(ordered)]}" for k, i in enumerate(ordered)}
    single = make([(3, "only")]).select("doc_id", "text")
    assert imatch.with_next(single, "doc_id", ["text"], 8).first().next_text == "only"
    assert imatch.with_next(docs.limit(0), "doc_id", ["text"], 8).count() == 0


def test_imatch_query(make, spark, tmp_path):
    rows = [(i, sentences(i % 40, 8 + i % 3)) for i in range(120)] + [(500, None), (501, "")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in op7_imatch(spark, str(tmp_path)).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(ordered):
        other = ordered[(k + 1) % len(ordered)][1]
        f = len(t) // 4
        edited = t[: len(t) - f] + other[:f]
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    mean = lambda c: sum(r[c] for r in found.values()) / len(found)
    assert mean("near_edited") > mean("near_next") + 0.2
    assert found[500].near_edited >= 0
