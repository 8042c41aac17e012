"""Near duplicates by shingles against the Jaccard similarity of all pairs."""

import itertools
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, docs, odd, sample  # noqa: F401
from test_dedup import brute_components

import corpus_pipeline
from forecourt.llm import jaccard


def brute_shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    """(id, smallest id of its component) of every row."""
    sets = [brute_shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] == sets[j] or (both := len(sets[i] & sets[j])) and Fraction(both, len(sets[i] | sets[j])) >= Fraction(4, 5)
    ]
    label, ids = brute_components(links), defaultdict(list)
    for n, (i, _) in enumerate(rows):
        ids[label.get(n, n)] += [] if i is None else [i]
    return sorted(((i, min(ids[label.get(n, n)], default=None)) for n, (i, _) in enumerate(rows)), key=str)


def copies(rng, base, n, first, edits):
    """``n`` texts that each differ from ``base`` in up to ``edits`` words."""
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(0, edits + 1)):
            words[at] = f"e{rng.integers(1 << 40)}"
        out.append((first + k, " ".join(words)))
    return out


def cases():
    rng, line = np.random.default_rng(11), "a line that very many of the texts have in common with each other"
    rows = copies(rng, [f"w{i}" for i in range(150)], 60, 1000, 8)
    for g in range(12):
        rows += copies(rng, [f"g{g}x{i}" for i in range(int(rng.integers(4, 90)))], 5, 2000 + 10 * g, 3)
    return rows + [(3000 + i, f"{line} {line} {i} {i + 1}") for i in range(30)]


def test_groups_against_all_pairs(odd, docs, sample):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    rows += cases() + [(5000 + i, t) for i, t in ODD if i is not None] + [(None, "x y z"), (None, "x  y z")]
    want = brute_groups(rows)
    for sampled in (20_000, 1):
        assert sorted((tuple(r) for r in jaccard.similar_groups(docs(rows), sampled=sampled).collect()), key=str) == want
    assert sum(i != c for i, c in want) > 40
    kept = jaccard.drop_similar(docs(rows))
    assert kept.columns == docs(rows).columns and {r.doc_id for r in kept.collect()} == {c for _, c in want}
    assert jaccard.similar_groups(docs([])).collect() == [] == jaccard.drop_similar(docs([])).collect()


def test_the_pipeline_drops_what_shares_four_fifths_of_its_shingles(spark, docs):  # noqa: F811
    rows = cases()
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs(rows), None).collect()}
    assert kept == {c for _, c in brute_groups(rows)}


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40)))
def test_similar_sets_share_a_hash_of_their_prefixes(a, b, common):
    x, y, last = (np.array(sorted(s), dtype=np.uint64) for s in (a, b, common))
    if 5 * len(a & b) >= 4 * len(a | b):
        assert set(jaccard.prefix(x, last).tolist()) & set(jaccard.prefix(y, last).tolist())


def test_simhash_links_come_first(spark):
    base = " ".join(f"w{k * k % 977}" for k in range(900))
    texts = [base, base + " more", "first " + base, " ".join(f"v{k}" for k in range(300)), "v1 v2 v3 v4 v5 v6"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard._described(docs, np.zeros(0, np.uint64), jaccard.WORDS)
    found = {tuple(r) for r in jaccard._by_fingerprint(rows, rows.select("node")).collect()}
    sets = [jaccard.hashes(t.encode()) for t in texts]
    nodes, prints = [jaccard.node_of(s) for s in sets], [jaccard.simhash(s) for s in sets]
    near = {(i, j) for i, j in itertools.combinations(range(5), 2) if (prints[i] ^ prints[j]).bit_count() <= 3}
    assert len(near) > 0 and found <= {(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in near}
    label, expected = brute_components([(nodes.index(a), nodes.index(b)) for a, b in found]), brute_components(list(near))
    assert label == expected


def test_common_hashes_are_looked_up_not_sorted_with_every_text(monkeypatch):
    common, found = np.arange(0, 4000, 2, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)
    monkeypatch.setattr(np, "isin", None)
    assert jaccard.prefix(found, common).tolist() == [101, 103, 105]
    assert jaccard.prefix(found, np.zeros(0, np.uint64)).tolist() == [100, 101, 102]
    assert jaccard.prefix(np.array([5000], np.uint64), common).tolist() == [5000]
