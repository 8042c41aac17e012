"""Closed-syncmer fingerprints against brute force, and their plan: no Python."""

import hashlib
import re

import pytest
from llm_cases import ODD, docs, odd, sample  # noqa: F401
from pyspark.sql import functions as F

from forecourt.llm import queries, syncmers
from forecourt.llm.syncmers import INNER, WINDOW, anchors, edited_likeness, fingerprint, fingerprints, likeness, matches

M = (1 << 64) - 1


def tokens(text):
    return re.findall("[⺀-퟿]|[^ \t-\r⺀-퟿]{1,16}", text or "")


def brute_places(hashes):
    """Places of the windows whose smallest pair is at an edge."""
    found = []
    for i in range(len(hashes) - (WINDOW - INNER)):
        window = hashes[i : i + WINDOW - INNER + 1]
        if min(window) in (window[0], window[-1]):
            found.append(i)
    return found


def pair_hashes(spark, text):
    t = tokens(text)
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(t, t[1:]))], "i int, a string, b string")
    return [r.h for r in rows.select("i", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).orderBy("i").collect()]


def test_anchors_are_the_closed_syncmers(spark, docs):
    texts = [t for _, t in ODD if t] + ["漢字仮名交じり文を書く人は多い" * 3, "x" * 500, "a b c d e f g", "a b c d e f g h", "🙂 " * 12]
    got = {r.text: r.found for r in docs(list(enumerate(texts))).select("text", anchors(F.col("text")).alias("found")).collect()}
    for text, found in got.items():
        n = len(tokens(text))
        places = brute_places(pair_hashes(spark, text)) if n >= WINDOW else [0] * (n > 0)
        assert [a["at"] for a in found] == places
        assert all(b - a <= WINDOW - INNER + 1 for a, b in zip(places, places[1:]))


def test_an_equal_passage_has_equal_anchors_wherever_it_stands(docs):
    passage = " ".join(f"w{k * 7919 % 1000}" for k in range(60))
    rows = docs([(1, passage), (2, "before it there is something else " + passage + " and after")])
    a, b = [{x["hash"] for x in r.anchors} for r in fingerprints(rows).orderBy("doc_id").collect()]
    assert a and a <= b
    both = rows.groupBy().agg(F.max_by("text", "doc_id").alias("b"), F.min_by("text", "doc_id").alias("a"))
    found = both.select(matches(anchors(F.col("a")), anchors(F.col("b"))).alias("m")).first().m
    assert len(found) == len(a) and {m.other - m["at"] for m in found} == {6}


def test_likeness(docs):
    text = " ".join(f"w{k}" for k in range(100))
    rows = docs([(1, text)]).select(anchors(F.col("text")).alias("a"), anchors(F.lit("q " * 30)).alias("b"), anchors(F.lit(" ")).alias("none"))
    same, other, empty, one = rows.select(likeness("a", "a"), likeness("a", "b"), likeness("none", "none"), likeness("a", "none")).first()
    assert (same, other, empty, one) == (1.0, 0.0, 1.0, 0.0)


def check_edits(rows, listed):
    """Holds the edits of ``listed`` (doc_id, text), in order, against the rows."""
    want = []
    for (i, t), (_, after) in zip(listed, listed[1:] + listed[:1]):
        n = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in rows), key=str) == sorted(want, key=str)


def test_edits_follow_the_order_of_ids(sample):
    listed = sorted((r.doc_id, r.text or "") for r in sample.collect())
    rows = edited_likeness(sample).collect()
    check_edits(rows, listed)
    long = [r for r in rows if r.n_chars > 600]
    assert sum(r.near_edited for r in long) / len(long) > 0.65 and sum(r.near_next for r in long) / len(long) < 0.1
    texts = dict(listed)
    prints = {}
    for r in rows:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint and re.fullmatch("([0-9a-f]{8})*", r.fingerprint)


def test_odd_rows_and_ties(spark, odd, docs):
    tie = dict(spark.createDataFrame([(t or "",) for _, t in ODD], "t string").select("t", F.xxhash64("t")).collect())
    order = lambda r: (r[0] is not None, r[0] or 0, tie[r[1]])
    check_edits(edited_likeness(odd).collect(), sorted([(i, t or "") for i, t in ODD], key=order))
    assert edited_likeness(docs([])).count() == 0
    check_edits(edited_likeness(docs([(3, "alone in the table")])).collect(), [(3, "alone in the table")])


def test_an_id_that_holds_most_rows(spark, docs):
    rows = [(5, f"text number {k % 40} of many") for k in range(300)] + [(5, "the same") for _ in range(400)]
    rows += [(None, "no id here at all") for _ in range(5000)] + [(k, f"other {k}") for k in range(40) if k != 5]
    tie = dict(spark.createDataFrame([(t,) for t in {t for _, t in rows}], "t string").select("t", F.xxhash64("t")).collect())
    check_edits(edited_likeness(docs(rows)).collect(), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]])))


def test_no_python_on_the_path(spark):
    df = queries.QUERIES["op12_syncmers"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan) and syncmers.WINDOW == 8


@pytest.mark.parametrize("text", ["word " * 50_000, "x" * 400_000])
def test_very_long_texts(docs, text):
    row = docs([(1, text)]).select(fingerprint(anchors(F.col("text"))).alias("f"), F.lit(1)).first()
    assert len(row.f) > 8
