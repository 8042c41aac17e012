"""Conversation repair and the prefix trie against brute force, also where conversations are cut by ranges."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import importable

from forecourt.llm import queries
from forecourt.llm.prefix_trie import NodeTable, prefix_trie
from forecourt.llm.turn_repair import NOTHING, cheapest, join, parse, repair_conversations, repaired_turns, turn_cells

SCHEMA = "conv_id long, turn long, role string, text string, digest string, copies int, part long, TIE string"
ROLES = ["user", "assistant", "system", "tool", "", None]


@pytest.fixture
def turns(spark):
    importable(spark)
    return lambda rows: spark.createDataFrame([(*r, "d", 9, 3, "x") for r in rows], SCHEMA)


@pytest.fixture
def ranges(spark):
    """Many small ranges, as on a cluster."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def some_conversations(seed=3):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "so be it", "", " \n", "and then", "naïve — ok.", None]
    rows = []
    for conv in range(60):
        for turn in range(draw.choice([1, 2, 3, 5, 8])):
            rows.append((conv, turn + draw.choice([0, 0, 0, 1, 4]), draw.choice(ROLES[:3] * 4 + ROLES), draw.choice(texts[:4] * 3 + texts)))
    rows += [(7, t, ["user", "assistant", "user"][t % 3], f"turn {t % 211}" + ".;"[t % 5 == 0]) for t in range(500)]  # long, repeats
    rows += [(8, None, "user", "same words.")] * 150 + [(8, None, "assistant", None)] * 3 + [(8, 5, "user", "same words.")] * 20
    rows += [(None, t, "user", f"no id {t}!") for t in (2, None, 1)] + [(90, 1, "user", "one."), (90, 1, "user", "one."), (91, 1, "assistant", "x")]
    draw.shuffle(rows)
    return rows


def in_order(rows):
    """conv_id -> [(turn, role, text)] as the operator orders them."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(v, key=key) for c, v in convs.items()}


def brute_repair(rows):
    """Cheapest edits by relaxing states turn by turn: (cost, audit, lines), with counts."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    names = {"u": "user", "a": "assistant"}
    seen, faults, best = set(), Counter(), {0: (0, "", ())}

    def inserted(best):
        for _ in range(4):
            for p, (cost, audit, lines) in list(best.items()):
                for letter, name in names.items():
                    if (p, letter) in step:
                        new, q = (cost + 3, audit + "I", lines + (name + ":",)), step[p, letter]
                        best[q] = min(best.get(q, new), new)
        return best

    best = inserted(best)
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        after = {}
        for p, (cost, audit, lines) in best.items():
            ways = [(p, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                if (p, role[:1]) in step:
                    ways.append((step[p, role[:1]], (cost + late, audit + "K", lines + (f"{role}:{text}",))))
                for letter, name in names.items():
                    if (p, letter) in step:
                        ways.append((step[p, letter], (cost + late + 3, audit + "R", lines + (f"{name}:{text}",))))
            for q, new in ways:
                after[q] = min(after.get(q, new), new)
        best = inserted(after)
    cost, audit, lines = min(best[q] for q in (0, 3) if q in best)
    known = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "turns": len(rows), "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": faults["blank"], "duplicate": faults["duplicate"], "truncated": faults["truncated"],
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }, lines


def test_one_split_per_span_is_enough():
    draw = random.Random(5)
    for n in (1, 2, 3, 5, 8, 11):
        cells = [turn_cells(draw.choice("sua?") + draw.choice("+~-")) for _ in range(n)]
        chart = {(i, i + 1): c for i, c in enumerate(cells)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                for k in range(i + 1, i + length):
                    for pair, cell in join(chart[i, k], chart[k, i + length]).items():
                        here = chart.setdefault((i, i + length), {})
                        here[pair] = min(here.get(pair, cell), cell)
        assert chart[0, n] == parse(list(cells))
    assert cheapest(NOTHING) == (0, "")


def test_repair_against_brute_force(turns, ranges):
    rows = some_conversations()
    got = {r.conv_id: r.asDict() for r in repair_conversations(turns(rows)).collect()}
    convs = in_order(rows)
    assert set(got) == set(convs)
    for conv, listed in convs.items():
        assert got[conv] == {"conv_id": conv, **brute_repair(listed)[0]}, conv


def test_repaired_turns(turns, ranges):
    rows = some_conversations(4)
    found = {}
    for r in repaired_turns(turns(rows)).collect():
        found.setdefault(r.conv_id, []).append(r)
    for conv, listed in in_order(rows).items():
        steps = sorted(found[conv], key=lambda r: r.step)
        want, lines = brute_repair(listed)
        assert "".join(r.edit for r in steps) == want["audit"] and [r.step for r in steps] == list(range(len(steps)))
        left = [r for r in steps if r.edit != "D"]
        assert tuple(f"{r.role}:{r.text}" for r in left) == lines and [r.position for r in left] == list(range(len(left)))
        assert [(r.turn, r.text) for r in steps if r.edit != "I"] == [(t, text) for t, _, text in listed]


def test_repair_of_nothing(turns, spark):
    assert repair_conversations(turns([])).count() == 0 and repaired_turns(turns([])).count() == 0
    only = spark.createDataFrame([(1, 0, "user", "a.", 0), (2, 0, "user", "a.", 1)], "conv_id long, turn long, role string, text string, copies int")
    got = {r.conv_id: r for r in repair_conversations(only, copies="copies").collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got[2].audit == "KI" and got[2].cost == 3


def test_damage_is_dealt_by_crc(turns):
    rows = [(c, t, "assistant", "a. b! c?") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    for r in queries.damaged_turns(turns(rows)).collect():
        name = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        k = zlib.crc32(name.encode()) % 20
        assert r.copies == {0: 0, 3: 2}.get(k, 1)
        if r.conv_id is not None:
            assert r.text == {1: "", 2: "a b c"}.get(k, "a. b! c?") and r.role == ("user" if k == 4 else "assistant")


def brute_trie(rows, family=None, borrow=0):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    name = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    convs = {c: [r[1:] for r in sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, name(r)))] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % (borrow + 1)
        rebuilt[c] = convs.get(c - c % family, [])[:h] + own[h:] if family else own
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(seed):
    """Conversations with shared beginnings, copies, one common first turn, one long conversation and copies of its start."""
    draw = random.Random(seed)
    rows = []
    for conv in range(45):
        n, depth = draw.choice([1, 2, 3, 6, 12]), 0
        for t in range(n):
            depth = depth or (draw.random() < 0.3)
            rows.append((conv, t, "ua"[t % 2], f"turn {t}" if not depth else f"turn {t} {draw.choice('ab')}é"))
    rows += [(12, 100 + t, "u", f"long {t}") for t in range(400)]
    rows += [(50, t, "ua"[t % 2] if t < 3 else None, f"turn {t}" if t < 6 else None) for t in range(8)] + [(50, None, None, None)] * 30
    rows += [(13, 100 + t, "u", f"long {t}") for t in range(150)] + [(None, 1, "u", "lost")] + [(60, 1, "u", "twice")] * 2
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("family,borrow", [(None, 0), (5, 8), (3, 2)])
def test_trie_against_brute_force(turns, ranges, family, borrow):
    for seed in (1, 2):
        rows = trie_rows(seed)
        if not family:  # a long conversation and one that shares 150 turns with it from the root on
            rows = [r for r in rows if r[0] not in (12, 13)] + [(c, t, "u", f"long {t}") for c, n in ((12, 400), (13, 150)) for t in range(n)]
        got = sorted((tuple(r) for r in prefix_trie(turns(rows), family, borrow).collect()), key=str)
        assert got == brute_trie(rows, family, borrow)


def test_trie_of_nothing(turns):
    assert prefix_trie(turns([])).count() == 0
    assert prefix_trie(turns([(None, 1, "u", "x")])).count() == 0
    got = prefix_trie(turns([(4, 0, None, None)])).collect()
    assert sorted((r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got) == [(0, 1, 1, 1, 0), (1, 1, 0, 1, 0)]


def test_node_table_is_minimal_perfect_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, (5000, 3)), axis=0)
    table = NodeTable(keys)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    other = keys.copy()
    other[:, 2] += 1
    known = {tuple(k) for k in keys}
    assert all((s >= 0) == (tuple(k) in known) for s, k in zip(table.slots(other), other))
    assert list(NodeTable(keys[:0]).slots(keys[:2])) == [-1, -1]
