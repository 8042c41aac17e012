"""Token files, packing and piece segmentation against the libraries and brute force."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, docs, odd, sample  # noqa: F401
from tokenizers import Tokenizer

from forecourt.llm import packing, segments, token_files, tokens
from forecourt.llm.queries import tokenizer
from forecourt.llm.shared import folder

BYTES, WORDS, PIECES = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json"), tokenizer("piece_bpe_32k.model")
TEXT = st.text(st.sampled_from("ab '|.1é漢Σİ \t\n\r\x0b\x1c\x85\xa0\u2003\u3000\u0301▁"), max_size=40)


def library(path):
    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


@pytest.mark.parametrize(("path", "drops"), [(BYTES, False), (WORDS, True)])
def test_pieces_give_the_ids_of_whole_texts(path, drops):
    own, whole = tokens.PieceEncoder(path, drops), library(path)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(TEXT, min_size=1, max_size=6))
    def check(texts):
        ids, counts = own.encode([t.encode() for t in texts])
        cuts = np.append(0, np.cumsum(counts))
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(cuts)] == [
            whole.encode(t, add_special_tokens=False).ids for t in texts
        ]

    check()


def test_encoder_that_forgets_gives_the_same_ids(monkeypatch, sample):  # noqa: F811
    texts = [r.text.encode() for r in sample.select("text").limit(40).collect()]
    want = tokens.PieceEncoder(WORDS, True).encode(texts)
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    small = tokens.PieceEncoder(WORDS, True)
    got = [small.encode([t]) for t in texts]
    assert np.concatenate([g[0] for g in got]).tolist() == want[0].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_codes_come_back(values):
    control, data = token_files.pack(values)
    assert token_files.unpack(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_damaged_token_files_are_found():
    blob = token_files.file_bytes([1, 2], [True, False], [3, 1], [0, 300, 70_000, 5])
    ids, has_id, counts, ranks = token_files.read_bytes(blob)
    assert (ids.tolist(), has_id.tolist(), counts.tolist(), ranks.tolist()) == ([1, 2], [True, False], [3, 1], [0, 300, 70_000, 5])
    for bad in (blob[:-1], b"X" + blob[1:], blob + b"0"):
        with pytest.raises(ValueError):
            token_files.read_bytes(bad)


def expected_tokens(rows, path):
    """Documents in order (null ids first, then by id): (id, tokens)."""
    whole = library(path)
    return [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_hold_every_document_in_order(spark, odd, docs, sample):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()] + [(1000 + (i or 0), t) for i, t in ODD if i != 9]
    rows += [(None, "no id")]
    want = sorted(expected_tokens(rows, BYTES), key=lambda d: (d[0] is not None, d[0] or 0, len(d[1])))
    at = folder(spark, "tokens")
    manifest = token_files.write_token_files(docs(rows), BYTES, at, file_bytes_=50_000)
    files = sorted(tuple(r) for r in manifest.select("number", "docs", "tokens").collect())
    assert len(files) > 5 and sum(f[1] for f in files) == len(rows)
    read = token_files.read_token_files(manifest, at)
    got = sorted(read.collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.ids) for r in got if r.doc_id != 1000] == [w for w in want if w[0] != 1000]
    assert [r.start for r in got] == list(itertools.accumulate([r.n_tokens for r in got[:-1]], initial=0))
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.token_checksums(manifest, at).collect()}
    assert sums == {(r.doc_id, r.start): crc(r.ids) for r in got}
    ranks = np.fromfile(f"{at.removeprefix('file://')}/ranks", "<u4")
    often = np.bincount(np.concatenate([d[1] for d in want]))
    assert (np.diff(often[ranks]) <= 0).all()


def test_token_files_of_no_documents(spark, docs):  # noqa: F811
    at = folder(spark, "tokens")
    assert token_files.read_token_files(token_files.write_token_files(docs([]), BYTES, at), at).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_first_fit_decreasing_as_by_hand(sizes):
    bins, offsets = packing.first_fit_decreasing(sizes, 20)
    space, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, used in enumerate(space) if used + sizes[i] <= 20), len(space))
        space += [0] * (b == len(space))
        want[i] = (b, space[b])
        space[b] += sizes[i]
    assert {i: (int(bins[i]), int(offsets[i])) for i in range(len(sizes))} == want


def test_packing_keeps_every_id_once(odd, docs, sample):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    rows += [(1000 + n, t) for n, (_, t) in enumerate(ODD)]
    whole = dict(expected_tokens(rows, WORDS))
    got = packing.pack_documents(docs(rows), WORDS, sequence=512, group=64).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == crc(whole[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(whole[r.doc_id])
    assert set(pieces) == set(whole)
    for parts, size in [(pieces[i], len(t)) for i, t in whole.items()] + [(s, None) for s in sequences.values()]:
        ends = list(itertools.accumulate((n for _, n in sorted(parts)), initial=0))
        assert [a for a, _ in sorted(parts)] == ends[:-1] and (size is None or ends[-1] == size) and (size or ends[-1] <= 512)
    assert sum(len(t) for t in whole.values()) > 0.97 * 512 * len(sequences)


def test_packing_odd_rows_and_none(odd, docs):  # noqa: F811
    got = packing.pack_documents(odd, WORDS).collect()
    assert sorted(str(r.doc_id) for r in got if r.start == 0) == sorted(str(i) for i, _ in ODD)
    assert packing.pack_documents(docs([]), WORDS).collect() == []


def all_segmentations(lattice, text):
    """Every segmentation of a unit as (score, ids), best first."""
    out = [(0.0, [], 0)]
    done = []
    while out:
        score, ids, at = out.pop()
        if at == len(text):
            done.append((score, ids))
            continue
        ends = [e for e in range(at + 1, len(text) + 1) if text[at:e] in lattice.pieces]
        for e in ends:
            piece, gain = lattice.pieces[text[at:e]]
            out.append((score + gain, [*ids, piece], e))
        if at + 1 not in ends:
            out.append((score + lattice.worst, [*ids, *(lattice.byte_id[b] for b in text[at].encode())], at + 1))
    return sorted(done, key=lambda d: -d[0])


def test_best_segmentations_against_all():
    lattice = segments.lattice(PIECES)

    @settings(max_examples=100, deadline=None)
    @given(st.text(st.sampled_from("▁theinorx漢\n\u0301"), min_size=1, max_size=9))
    def check(unit):
        every, best = all_segmentations(lattice, unit), lattice.best(unit, 5)
        assert [round(s, 3) for s, _ in best] == [round(s, 3) for s, _ in every[:5]]
        assert all(any(ids == other and abs(s - t) < 1e-3 for t, other in every) for s, ids in best)

    check()


def test_runs_of_one_character_take_few_steps(monkeypatch):
    lattice, pushed = segments.lattice(PIECES), []

    def push(heap, entry, inner=segments.heapq.heappush):
        pushed.append(1)
        assert len(pushed) < 200_000, "the paths of equal scores are all laid out"
        inner(heap, entry)

    monkeypatch.setattr(segments.heapq, "heappush", push)
    for size in (207, 2009):
        pushed.clear()
        (score, ids), (second, others) = lattice.best("-" * size, 2)
        assert score == lattice.forward("-" * size)[0][-1] >= second and ids != others
        for total, found in ((score, ids), (second, others)):
            assert b"".join(lattice.bytes_of[i] for i in found) == b"-" * size
            assert total == sum(lattice.pieces[lattice.bytes_of[i].decode()][1] for i in found)


def test_segments_decode_as_the_library_does(odd, docs, sample):  # noqa: F811
    texts = [r.text for r in sample.select("text").limit(60).collect()] + [t or "" for _, t in ODD] + ["  a  b ", "x\ty\r\n", " "]
    table, model = segments.UnitTable(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, counts, score, gap = table.encode([t.encode() for t in texts])
    cuts = np.append(0, np.cumsum(counts))
    parts = [ids[a:b].tolist() for a, b in itertools.pairwise(cuts)]
    assert [b.decode() for b in table.decode(ids, counts)] == texts
    assert [model.decode(p) for p in parts] == texts
    for text, part, s, g in list(zip(texts, parts, score, gap))[-14:]:
        if len(text) < 200:
            best = segments.n_best(text, PIECES, 2)
            assert abs(best[0][0] - s) < 1e-3 * max(1, abs(s)) and (best[0][1] == part or len(best) > 1 and g == 0)
            assert (len(best) == 1) == np.isinf(g)
            assert len(best) == 1 or abs(best[0][0] - best[1][0] - g) < 1e-3 * max(1, abs(s))


def test_segmentation_of_tables(odd, docs):  # noqa: F811
    encoded = segments.encode(odd, PIECES)
    back = segments.decode(encoded, PIECES)
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(str((i, t or "")) for i, t in ODD)
    shown = segments.described(odd, PIECES).collect()
    assert all(r.restored for r in shown) and len(shown) == len(ODD)
    want = sorted((str(r.doc_id), len(r.ids), crc(r.ids)) for r in encoded.collect())
    assert sorted((str(r.doc_id), r.n_pieces, r.ids_crc32) for r in shown) == want
    assert segments.encode(docs([]), PIECES).collect() == [] == segments.described(docs([]), PIECES).collect()
