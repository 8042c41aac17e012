"""SentencePiece encoding and decoding: the n best segmentations of a text by the sum of its pieces' scores.

A forward Viterbi pass over the lattice of pieces gives every position the best score of the text before it. These scores
are exact heuristics for an A-star search backwards from the end: the first path to reach the start is the best one, the
next the second best, and so on. Of equal paths the one closest to the start goes first, and no position is left more
than n times, so that a run of one character, with its countless equal segmentations, takes no more than any other text.

Pieces hold blanks only at their front, so a text parts into units before each blank that follows another character: its
best segmentation is that of its units, and its n best ones differ in few units. A worker segments each distinct unit
once. A character that no piece covers is written in byte pieces.
"""

import heapq
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

from .shared import FORGET, binary_column

BLANK = "▁"
#: Segmentations looked at; batches of text; distinct units a worker remembers; what a character in bytes costs beyond
#: the worst piece; scores from which a piece is never to be used.
BEST, BATCH, REMEMBERED, PENALTY = 2, 4 << 20, 1_000_000, 10.0
NEVER = -1e8


class Lattice:
    """The pieces of a SentencePiece model whose normalisation only marks blanks."""

    def __init__(self, path):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if model.normalize(" Éﬁ  x") != f"{BLANK}{BLANK}Éﬁ{BLANK}{BLANK}x":
            raise ValueError("the model normalises texts")
        names = [model.id_to_piece(i) for i in range(size)]
        self.pieces, self.bytes_of, self.byte_id = {}, [b""] * size, {}
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(name[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if BLANK in name.lstrip(BLANK):
                    raise ValueError("a piece holds a blank behind its front")
                self.pieces[name] = (i, model.get_score(i))
                self.bytes_of[i] = name.replace(BLANK, " ").encode()
        # Character by character: (id and score of the piece that ends here or None, what may follow).
        self.trie = {}
        for name in sorted(self.pieces):
            below = self.trie
            for c in name[:-1]:
                below = below.setdefault(c, (None, {}))[1]
            below[name[-1]] = (self.pieces[name], below.get(name[-1], (None, {}))[1])
        # Pieces that are never to be used have a score beyond all others'.
        self.worst = min(s for _, s in self.pieces.values() if s > NEVER) - PENALTY

    def forward(self, unit):
        """(best score before each position, edges (start, ids, score) that end at each position)."""
        size = len(unit)
        score, edges = [NEVER * 1e3] * (size + 1), [[] for _ in range(size + 1)]
        score[0] = 0.0
        for start in range(size):
            before, end, below = score[start], start, self.trie
            for c in unit[start:]:
                node = below.get(c)
                if node is None:
                    break
                piece, below = node
                end += 1
                if piece is not None:
                    number, gain = piece
                    edges[end].append((start, number, gain))
                    if before + gain > score[end]:
                        score[end] = before + gain
                elif end == start + 1:
                    self._spell(unit, start, score, edges)
            if end == start:
                self._spell(unit, start, score, edges)
        return score, edges

    def _spell(self, unit, start, score, edges):
        """An edge of byte pieces over one character."""
        edges[start + 1].append((start, tuple(self.byte_id[b] for b in unit[start].encode()), self.worst))
        score[start + 1] = max(score[start + 1], score[start] + self.worst)

    def best(self, unit, n=BEST):
        """The ``n`` best segmentations of a unit as (score, ids).

        With exact heuristics a position's paths come out best first, so the ``n`` best whole ones need none but its first ``n``.
        """
        score, edges = self.forward(unit)
        push, pop = heapq.heappush, heapq.heappop
        heap, made, out, left = [(-score[-1], len(unit), 0, 0.0, None)], 0, [], [n] * (len(unit) + 1)
        while heap:
            _, end, _, behind, path = pop(heap)
            if not left[end]:
                continue
            left[end] -= 1
            if end == 0:
                ids = []
                while path is not None:
                    piece, path = path
                    if isinstance(piece, tuple):
                        ids.extend(piece)
                    else:
                        ids.append(piece)
                out.append((behind, ids))
                if len(out) == n:
                    break
                continue
            for start, piece, gain in edges[end]:
                made += 1
                gain += behind
                push(heap, (-score[start] - gain, start, made, gain, (piece, path)))
        return out


@lru_cache(maxsize=2)
def lattice(path):
    return Lattice(path)


class UnitTable:
    """The segmentations of the distinct units a worker has met: ids, score, and how much worse the second best is."""

    def __init__(self, path):
        self.lattice = lattice(path)
        lengths = np.array([len(b) for b in self.lattice.bytes_of])
        self.piece_start, self.piece_length = np.cumsum(lengths) - lengths, lengths
        self.piece_pool = np.frombuffer(b"".join(self.lattice.bytes_of), np.uint8)
        self._forget()

    def _forget(self):
        self.known, self.pool = {}, np.zeros(0, np.int32)
        self.start, self.length, self.score, self.gap = (np.zeros(0, t) for t in (np.int64, np.int64, float, float))

    def _learn(self, units):
        ids, lengths, scores, gaps = [], [], [], []
        for unit in units:
            found = self.lattice.best(unit.decode().replace(" ", BLANK))
            ids.extend(found[0][1])
            lengths.append(len(found[0][1]))
            scores.append(found[0][0])
            gaps.append(found[0][0] - found[1][0] if len(found) > 1 else np.inf)
        first, used = len(self.known), len(self.pool)
        self.known.update(zip(units, range(first, first + len(units))))
        self.start = np.append(self.start, used + np.cumsum(lengths) - lengths)
        self.length, self.score, self.gap = np.append(self.length, lengths), np.append(self.score, scores), np.append(self.gap, gaps)
        self.pool = np.append(self.pool, np.array(ids, dtype=np.int32))

    def encode(self, texts):
        """(ids end to end, their number, score and gap to the second best segmentation per text); none for empty texts."""
        texts = [b" " + t if t else t for t in texts]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), *(np.zeros(len(texts), t) for t in (np.int64, float)), np.full(len(texts), np.inf)
        first = np.cumsum(sizes) - sizes
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        cut[first] = cut[len(data)] = True
        offsets = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        units = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        distinct = units.dictionary.to_pylist()
        new = [u for u in distinct if u not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[units.indices.to_numpy()]
        length = self.length[number]
        ends = np.cumsum(length)
        ids = self.pool[np.repeat(self.start[number] - (ends - length), length) + np.arange(ends[-1])]
        at = np.searchsorted(offsets, np.append(first, len(data)))
        score, gap = np.zeros(len(texts)), np.full(len(texts), np.inf)
        full = np.flatnonzero(at[1:] > at[:-1])
        score[full] = np.add.reduceat(self.score[number], at[:-1][full])
        gap[full] = np.minimum.reduceat(self.gap[number], at[:-1][full])
        return ids, np.diff(np.append(0, ends)[at]), score, gap

    def decode(self, ids, counts):
        """The texts of ids laid end to end: blanks from blank marks, bytes from byte pieces, without the first blank."""
        length = self.piece_length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        spelled = self.piece_pool[np.repeat(self.piece_start[ids] - (ends - length), length) + np.arange(total)].tobytes()
        cuts = np.append(0, ends)[np.append(0, np.cumsum(counts))].tolist()
        return [spelled[a:b].removeprefix(b" ") for a, b in zip(cuts[:-1], cuts[1:])]


@lru_cache(maxsize=2)
def units(path):
    """The worker's table for a model; it outlives the task where Spark reuses its Python workers."""
    return UnitTable(path)


FORGET.append(units.cache_clear)


ENCODED = "doc_id long, ids array<int>, score double, gap double"


def _slices(batches, name):
    for batch in batches:
        values, start, size = binary_column(batch, name), 0, 0
        for i, value in enumerate(values):
            size += len(value)
            if size >= BATCH or i == len(values) - 1:
                yield batch.slice(start, i + 1 - start), values[start : i + 1]
                start, size = i + 1, 0


def encode(docs, path, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, ids, score of the best segmentation, gap to the second best one.

    A null or empty text has no ids, score 0 and no gap; a text with a single segmentation has a null gap. Repeated rows
    each give a row. An empty table gives no rows; other columns are not looked at.
    """

    def task(batches):
        for batch, texts in _slices(batches, "text"):
            ids, counts, score, gap = units(path).encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int32()))
            columns = [batch.column(0), lists, pa.array(score), pa.array(gap, mask=np.isinf(gap))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "score", "gap"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(task, ENCODED)


def decode(rows, path):
    """doc_id and text of the rows of :func:`encode`; a literal blank mark in a text comes back as a blank."""

    def task(batches):
        for batch in batches:
            lists = batch.column(1)
            texts = units(path).decode(lists.flatten().to_numpy(), lists.value_lengths().to_numpy())
            texts = pa.array([t.decode() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(task, "doc_id long, text string")


def described(docs, path, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_pieces, ids_crc32, score, gap, and whether decoding its ids gives the text back."""
    names = ["doc_id", "n_pieces", "ids_crc32", "score", "gap", "restored"]

    def task(batches):
        for batch, texts in _slices(batches, "text"):
            table = units(path)
            ids, counts, score, gap = table.encode(texts)
            cuts = np.append(0, np.cumsum(counts)).tolist()
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            same = [a == b.replace(BLANK.encode(), b" ") for a, b in zip(table.decode(ids, counts), texts)]
            columns = [batch.column(0), pa.array(counts), pa.array(crc, pa.int64()), pa.array(score), pa.array(gap, mask=np.isinf(gap))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(same)], names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(task, "doc_id long, n_pieces long, ids_crc32 long, score double, gap double, restored boolean")


def n_best(text, path, n):
    """The ``n`` best segmentations of a whole text as (score, ids), from the n best ones of its units."""
    marked = (" " + text if text else "").replace(" ", BLANK)
    parts = []
    for c in marked:
        if parts and not (c == BLANK and parts[-1][-1] != BLANK):
            parts[-1] += c
        else:
            parts.append(c)
    best = [(0.0, ())]
    for part in parts:
        choices = lattice(path).best(part, n)
        best = heapq.nlargest(n, ((a + s, (*ids, *more)) for a, ids in best for s, more in choices), key=lambda b: b[0])
    return [(score, list(ids)) for score, ids in best]
