"""The registered queries of the operators for training data: their SQL, their pipeline, and the guard around them."""

import glob
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest
from llm_cases import docs, odd, sample  # noqa: F401
from test_dedup import brute_exact
from test_jaccard import brute_groups
from test_tokens import WORDS, crc, expected_tokens

import __spark_entry__ as entry_point
import corpus_pipeline
from forecourt.llm import queries

SMALL = "/root/testdata/sf0.001"


def cells(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df, result = queries.QUERIES[name](spark, SMALL), con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert cells(df.columns, df.collect()) == cells(columns, result.fetchall())


def test_every_operator_has_a_query_over_its_whole_table(spark):
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    sizes = {t: spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("documents", "pages")}
    conversations = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
    assert queries.QUERIES["op11_turn_repair"](spark, SMALL).count() == conversations
    assert queries.QUERIES["op13_prefix_trie"](spark, SMALL).where("depth = 0").first().n_convs == conversations
    for name, run in queries.QUERIES.items():
        rows = run(spark, SMALL).count()
        if name.split("_")[0] not in ("op6", "op11", "op13"):
            assert rows == sizes["pages" if name[:4] in ("op4_", "op8_") else "documents"], name


def uncovered(rows):
    """id -> text without the characters that lie whole in repeated 50-byte strings, by brute force."""
    first = {}
    for i, t in rows:
        for k in range(len(t.encode()) - 49):
            gram = t.encode()[k : k + 50]
            first[gram] = min(first.get(gram, i), i)
    out = {}
    for i, t in rows:
        data = t.encode()
        cover = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < i:
                cover[k : k + 50] = b"\1" * 50
        kept, at = [], 0
        for c in t:
            n = len(c.encode())
            kept.append("" if all(cover[at : at + n]) else c)
            at += n
        out[i] = "".join(kept)
    return out


def test_pipeline_stages_against_brute_force(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "simhash_dedup", "suffix_dedup", "packing"]
    docs_ = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, tables = docs_.columns, [docs_]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SMALL).persist())
    texts = [{r.doc_id: r.text for r in t.collect()} for t in tables[:5]]
    assert all(t.columns == columns and t.count() == len(x) for t, x in zip(tables[:5], texts))

    rules = queries.QUERIES["op5_quality_rules"](spark, SMALL)
    assert texts[1] == {r.doc_id: texts[0][r.doc_id] for r in rules.where("kept").collect()}
    assert {r.doc_id for r in rules.where("base_failed").collect()} and len(texts[1]) < len(texts[0])

    exact = {keep for _, keep, _, _, _ in brute_exact(list(texts[1].items()))}
    assert texts[2] == {i: texts[1][i] for i in exact} and len(texts[2]) < len(texts[1])

    groups = brute_groups(list(texts[2].items()))
    assert set(texts[3]) == {keep for _, keep in groups} and len(texts[3]) < len(texts[2])

    assert texts[4] == uncovered(list(texts[3].items()))
    assert sum(map(len, texts[4].values())) < sum(map(len, texts[3].values()))
    assert {r.doc_id: r.n_chars for r in tables[4].collect()} == {i: len(t) for i, t in texts[4].items()}

    whole = dict(expected_tokens(list(texts[4].items()), WORDS))
    pieces = tables[5].collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(list(whole))
    for r in pieces:
        assert r.ids_crc32 == crc(whole[r.doc_id][r.start : r.start + r.length])
    assert sum(r.length for r in pieces) == sum(map(len, whole.values()))
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, SMALL).collect()) == Counter(tuple(r)[:5] for r in pieces)


def test_the_rest_works_without_this_package(tmp_path):
    root = os.path.dirname(os.path.abspath(entry_point.__file__))
    code = (
        "import sys; sys.modules['forecourt.llm'] = None; import __spark_entry__ as e; "
        "assert 'pit_join' in e.queries() and not any(n.startswith('op') for n in e.queries()) and 'pipeline' not in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=os.environ | {"PYTHONPATH": root})
