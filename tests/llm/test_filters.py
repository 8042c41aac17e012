"""Quality rules, URL filters, licence scans and WARC archives against brute force."""

import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, docs, odd, sample  # noqa: F401
from pyspark.sql import functions as F

from forecourt.llm import decision_list, license_scan, url_filter, warc
from forecourt.llm.queries import URL_RULES
from forecourt.llm.shared import file_system

# --- quality rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab#*é漢 \t\n\x0b\x1c\xa0"), max_size=60))
def test_counts_against_patterns(text):
    assert decision_list.text_counts(text.encode())[:5] == brute_counts(text)


def test_rules_are_learned_and_applied_in_order():
    rng = np.random.default_rng(5)
    x = rng.random((3000, len(decision_list.FEATURES)))
    bad = (x[:, 1] > 0.8) | ((x[:, 5] > 0.6) & (x[:, 0] <= 0.3))
    rules = decision_list.learn_list(x, bad)
    said = np.zeros(len(x), bool)
    for rule in rules:
        said |= decision_list._covered(x, rule)
    assert (said == bad).mean() > 0.97 and (bad & said).sum() > 0.95 * said.sum() and len(rules) >= 2
    assert decision_list.learn_list(x, np.zeros(len(x), bool)) == []


def test_quality_of_odd_rows(spark, odd, docs):  # noqa: F811
    labels = spark.createDataFrame([(3, 1), (1, None), (None, 0)], "doc_id long, quality int")
    got = decision_list.judge_quality(odd, labels).collect()
    want = Counter()
    for i, t in ODD:
        n, *rest = brute_counts(t)
        failed = n < 10 or 100 * rest[3] > 20 * n
        want[(i, n, *rest, failed, not failed)] += 1
    assert Counter(tuple(r) for r in got) == want
    kept = decision_list.drop_low_quality(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(n for r, n in want.items() if r[-1])
    assert decision_list.judge_quality(docs([]), labels).collect() == [] == decision_list.drop_low_quality(docs([]), labels).collect()


def test_held_out_quality(spark, sample):  # noqa: F811
    docs_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    limits = decision_list.FitLimits(least_rejected=4)
    verdicts = decision_list.judge_quality(docs_, train, limits=limits)
    rows = verdicts.join(held, "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.35


def test_the_list_is_one_conditional_expression(spark):
    rules = [[(0, True, 9.0), (1, False, 0.5)], [(5, True, 0.4)]]
    assert decision_list.as_text(rules).splitlines() == [
        "reject if word_length > 9 and symbol_share <= 0.5", "reject if capital_share > 0.4", "keep",
    ]
    counts = [(10, 100, 0), (10, 100, 90), (10, 50, 0)]
    rows = spark.createDataFrame([(*c, 0, 0, 1, 1, 0, 0, 0) for c in counts], " long, ".join([*decision_list.COUNTS, *decision_list.MORE]) + " long")
    assert [r.k for r in rows.select(decision_list.as_expression(rules).alias("k")).collect()] == [False, True, True]


# --- URL filters


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


PAGES = [
    (1, "http://a.example.org/es/1", "<link rel='canonical' href=\"https://b.example.net/x\"/>"),
    (2, "https://b.example.net/x?q=1", '<meta http-equiv="refresh" content="0; url=/x">'),
    (3, "https://b.example.net/x#part", None),
    (4, "http://EXAMPLE.org/en/1x", "<LINK HREF=c.html REL=canonical>"),
    (5, "http://example.org/en/c.html", None),
    (6, None, "x"),
    (7, "nohost/path", "<link rel=canonical href=http://com/de/>"),
    (8, "ftp://x.com", ""),
    (9, "http://x.com/de/?a", "<link rel=canonical href=//y.com/q>"),
    (10, "http://y.com/q", None),
    (11, "http://example.org.evil.com/de", None),
    (12, "http://u.net/1", "<link rel=canonical href=http://y.com/q>"),
    (13, "http://v.net/1", "<link rel=canonical href=http://com/fr/>"),
    (14, "http://w.net/1", "<link rel=canonical href=http://v.net/1><link rel=canonical href=http://com/de/>"),
    (14, "http://w.net/1", "<link rel=canonical href=http://v.net/1><link rel=canonical href=http://com/de/>"),
    (15, "http://x.com?a://b/c", "<link rel=stylesheet href=http://com/de/>"),
    (None, "HTTP://Y.com/q", None),
]


def test_urls_and_aliases(spark):
    pages = spark.createDataFrame([(*p, "r") for p in PAGES], "page_id long, url string, html string, root string")
    got = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(got) == len(PAGES)
    fate = {2: "block", 3: "block", 10: "block", 12: "block", 13: "allow", 14: "allow", None: "block"}
    urls = {i: u for i, u, _ in PAGES}
    for r in got:
        host, path = brute_url(urls[r.page_id])
        rule = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == (rule.verdict if rule else fate.get(r.page_id, "allow")), r
    more = spark.createDataFrame([("http://example.org.evil.com/de", "http://com/de/z")], "a string, b string")
    again = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, URL_RULES, redirects=more).collect()}
    assert again[11] == "block"
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).collect() == []


def test_names_of_one_resource(spark):
    alike = [
        ("http://a.org", "http://a.org/"),
        ("HTTP://A.org:80/x", "http://a.org/x"),
        ("https://a.org:443", "https://a.org/#part"),
        ("http://a.org/b/../c/./d?e=../f", "http://a.org/c/d?e=../f"),
        ("http://a.org/b/..", "http://a.org/"),
        ("http://a.org/../../b/.", "http://a.org/b/"),
        ("http://a.org:/?q", "http://a.org/?q"),
    ]
    apart = [("http://a.org:443/", "http://a.org/"), ("http://a.org/b", "http://a.org/b/"), ("http://a.org/.b/..c", "http://a.org/c"), ("http://a.org/?A", "http://a.org/?a")]
    rows = spark.createDataFrame([(*p, True) for p in alike] + [(*p, False) for p in apart], "a string, b string, same boolean")
    for r in rows.withColumns({"na": url_filter.url_node(F.col("a")), "nb": url_filter.url_node(F.col("b"))}).collect():
        assert (r.na == r.nb) == r.same, r
    # A block follows a canonical link although the page's own name is written in another way.
    blocked = [(1, "http://example.org/es/x", None), (2, "http://b.net", '<link rel="canonical" href="http://example.org/es/./x">'), (3, "http://b.net:80/", None)]
    pages = spark.createDataFrame(blocked, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(pages, URL_RULES).collect()} == {1: "block", 2: "block", 3: "block"}


def test_urls_of_the_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    for r in url_filter.judge_urls(pages, URL_RULES).collect():
        rule = brute_rule(*brute_url(urls[r.page_id]))
        assert (r.host, r.path, r.rule) == (*brute_url(urls[r.page_id]), rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "allow")


# --- licence scans


def brute_licenses(text):
    text = text or ""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    at, base = [], set()
    for phrase, label in license_scan.PHRASES:
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        at += found
        base |= {label} if found else set()
    hits = [
        (m.start(), m.end(), label, priority, confidence)
        for keyword, regex, label, priority, confidence in license_scan.signatures()
        if keyword in text.lower()
        for m in re.finditer(regex.removeprefix("(?i)"), text, re.I | re.A)
    ]
    left = [x for x in hits if not any(y[0] <= x[0] and y[1] >= x[1] and (y[3] < x[3] or y[3] == x[3] and y[1] - y[0] > x[1] - x[0]) for y in hits)]
    score = max([0.5 * bool(base), *[x[4] for x in left]])
    labels = ",".join(sorted(base | {x[2] for x in left}))
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), labels, score


LICENSED = [
    "Licensed under the Apache License, Version 2.0. Licensed under the MIT License; all-rights RESERVED, cc.by",
    "SPDX-License-Identifier: GPL-2.0-or-later and spdx-license-identifier: (MIT",
    "GNU Lesser General Public License, version 2.1 and the GNU General Public License version 3",
    "Released under CC BY-NC 4.0. CC-BY-SA 4.0. cc by cc by. ccby accby cc bys",
    "all rights all rights reserved reservedall rights reserved",
    "Mit license? A permit license. Dedicated to the public domain; license: BSD 3-Clause License",
    "No such thing; generally publicly licensed. éMIT Licenseé general  public\nlicense",
    "Kelvin sign \u212a and \u0130 here: Apache License 2.0 " + "x " * 500 + "cc by",
]


def test_license_scans_against_python(docs, sample):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    rows += [(1000 + n, t) for n, t in enumerate(LICENSED)] + [(2000 + n, t) for n, (_, t) in enumerate(ODD)]
    table = docs(rows)
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.scan_licenses(table).collect()}
    for i, t in rows:
        assert got[i] == brute_licenses(t), (i, (t or "")[:80])
    assert license_scan.scan_licenses(docs([])).collect() == []
    plan = license_scan.scan_licenses(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_detections_inside_others_are_told_apart_in_any_mixture(docs):  # noqa: F811
    pieces = ["MIT License", "Licensed under the MIT License", "License: MIT", "SPDX-License-Identifier: GPL-2.0-or-later", "CC BY-NC 4.0",
              "GNU Lesser General Public License, version 2.1", "license: BSD 3-Clause License", "é\n", "x", "zero clause BSD licence = the 0BSD"]
    rows = [(n, " ".join(random.Random(n).choices(pieces, k=n % 23))) for n in range(120)]
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.scan_licenses(docs(rows)).collect()}
    assert got == {i: brute_licenses(t) for i, t in rows}


def test_many_mentions_in_one_text_do_not_stall_a_task(docs):  # noqa: F811
    n = 20_000
    began = time.monotonic()
    row = license_scan.scan_licenses(docs([(1, "Licensed under the MIT License, " * n)])).first()
    assert (row.n_words, row.labels, row.score) == (5 * n, "mit", 0.95)
    assert time.monotonic() - began < 60


def test_there_are_hundreds_of_signatures_and_each_finds_its_form():
    rules = license_scan.signatures()
    assert len(rules) > 280 and len(set(rules)) == len(rules)
    for keyword, regex, *_ in rules:
        assert keyword == keyword.lower()
        assert re.compile(regex.removeprefix("(?i)"), re.I)
    stems = license_scan.STEMS
    assert all(any(s in k or s in r for s in stems) or "licen[sc]e" in r for k, r, *_ in rules)


def varied(parsed):
    """Texts of a parsed pattern: each of its alternatives, options and characters is in one of them."""
    parts = []
    for kind, arg in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            parts.append([chr(arg)])
        elif kind == "IN":
            parts.append([" " if str(k) == "CATEGORY" else chr(c) for k, c in arg])
        elif kind == "BRANCH":
            parts.append([t for p in arg[1] for t in varied(p)])
        elif kind == "SUBPATTERN":
            parts.append(varied(arg[3]))
        elif kind == "MAX_REPEAT":
            least, most, inner = arg
            some = varied(inner)
            parts.append([t for n in sorted({least, 1, min(most, 2)}) for t in ([""] if n == 0 else [t * n for t in some])])
        else:
            assert kind.startswith("ASSERT"), kind
            parts.append([""])
    out = ["".join(p[0] for p in parts)]
    for k, p in enumerate(parts):
        out += ["".join(q[-1] if k != m else t for m, q in enumerate(parts)) for t in p]
    return list(dict.fromkeys(out))


def test_keywords_and_stems_lose_no_match_of_any_alternative():
    seen = 0
    for keyword, regex, label, *_ in license_scan.signatures():
        texts = [t for t in varied(re._parser.parse(regex.removeprefix("(?i)"))) if re.search(regex, t, re.A)]
        assert texts, regex
        for t in texts:
            assert keyword in t.lower() and any(s in t.lower() for s in license_scan.STEMS), (label, keyword, t)
        seen += len(texts)
    assert seen > 4000


NAMED = [
    ("This work is under the Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
    ("Creative Commons Attribution 3.0", "cc-by-3.0"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0"),
    ("Creative Commons Attribution-Share Alike 3.0", "cc-by-sa-3.0"),
    ("Creative Commons Attribution-Non-Commercial 4.0", "cc-by-nc-4.0"),
    ("Creative Commons Attribution-NoDerivatives 4.0", "cc-by-nd-4.0"),
    ("the CreativeML Open RAIL-M", "openrail-m"),
    ("the GNU General\nPublic  License,\tversion 3", "gpl,gpl-3.0"),
    ("Apache\r\nLicense,\n Version 2.0", "apache-2.0"),
    ("License: GPL-3.0-or-later", "gpl-3.0"),
    ("license = MIT.", "mit"),
    ("License: Apache-2.0-style words", ""),
]


def test_names_by_any_wording(docs):  # noqa: F811
    rows = [(n, t) for n, (t, _) in enumerate(NAMED)]
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs(rows)).collect()}
    assert got == {n: label for n, (_, label) in enumerate(NAMED)}


# --- WARC


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.integers(-5, 10**12)), st.one_of(st.none(), st.text(max_size=20)), st.binary(max_size=80))
def test_records_come_back(page_id, url, payload):
    headers, block = warc.parse(warc.record(page_id, url, payload))
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert warc.content(headers, block) == (page_id, len(payload), digest, "response", None, payload)
    headers, block = warc.parse(warc.record(page_id, url, payload, 7, True))
    assert warc.content(headers, block) == (page_id, len(payload), digest, "revisit", 7, None)


def test_damaged_records_and_archives_are_found():
    good = warc.record(1, "http://a", b"payload")
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"payload", b"PAYLOAD"),
                good.replace(b"WARC-Date", b"WARC-Daft"), good + b"x"):
        with pytest.raises(warc.DamagedArchive):
            warc.content(*warc.parse(bad))
    writer = warc.ArchiveWriter(b"")
    writer.add(good)
    data = writer.data()
    assert list(warc.frames(data)) == [good]
    for bad in (data[8:], data[:-3], b""):
        with pytest.raises(warc.DamagedArchive):
            list(warc.frames(bad))


def test_archives_of_pages(spark, sample):  # noqa: F811
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html, "d") for r in pages.collect()]
    rows += [(5000 + k, "http://copy", rows[k % 3][2], "d") for k in range(40)]
    rows += [(6000, None, None, "d"), (6001, "http://e\r\nX: y", "", "d"), (None, "http://n", "no id", "d"), (6002, "u", "é" * 200_000, "d")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, same string")
    manifest = warc.write_archives(table, archive_bytes=200_000)
    files = manifest.collect()
    assert len(files) > 5 and sum(f.records for f in files) == len(rows)
    store, name = file_system(files[0].path)
    with store.open_input_stream(name, compression=None) as f:
        head = f.read(8)
    assert int.from_bytes(head[:4], "little") == warc.MAGIC and int.from_bytes(head[4:], "little") > 1000
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = Counter()
    for i, _, html, _ in rows:
        payload = (html or "").encode()
        keep = first.get(html or "", i)
        same = keep == i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[(i, len(payload), digest, "response" if same else "revisit", None if same else keep)] += 1
    assert Counter(tuple(r) for r in warc.read_archives(manifest, payloads=False).collect()) == want
    texts = {r.page_id: bytes(r.payload) for r in warc.read_archives(manifest).where("record_type = 'response'").collect()}
    assert all(texts[i] == (h or "").encode() for i, _, h, _ in rows if i in texts) and len(texts) == len({r[2] or "" for r in rows})
    assert warc.read_archives(warc.write_archives(table.limit(0))).collect() == []
    short = manifest.withColumn("records", F.col("records") + 1)
    with pytest.raises(Exception, match="instead of"):
        warc.read_archives(short).collect()
