"""Packs documents into sequences of a fixed length: first fit decreasing in randomised groups of documents.

Whole documents are encoded; those longer than a sequence are cut into full sequences and a rest. Groups are drawn by a
hash of the row's number, so each has about as many pieces of every size, and each is packed by itself: the largest piece
first, into the first sequence with room for it, found in a tournament tree of the sequences' free space.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import fixed
from .tokens import encoded

SEQUENCE, END, GROUP = 4096, 2, 4096


class FirstFit:
    """A tournament tree over the bins' free space: each node holds the larger of its children."""

    def __init__(self, bins, capacity):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size):
        """Puts ``size`` into the first bin with room: (bin, space used there before is capacity - free)."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        left = free[node]
        free[node] = left - size
        bin_ = node - self.leaves
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return bin_, left


def first_fit_decreasing(sizes, capacity):
    """(bin, offset in it) of each size; equal sizes keep their order. No size is larger than ``capacity``."""
    order = np.argsort(-np.asarray(sizes, dtype=np.int64), kind="stable")
    tree = FirstFit(max(1, len(order)), capacity)
    bins, offsets = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    for i in order.tolist():
        bins[i], left = tree.place(int(sizes[i]))
        offsets[i] = capacity - left
    return bins, offsets


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(batches, path, drops_space, sequence):
    for batch, ids, counts in encoded(batches, "text", path, drops_space):
        rows, at = [], 0
        for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
            own = np.append(ids[at : at + n], np.uint32(END)).astype("<u4")
            at += n
            for start in range(0, n + 1, sequence):
                piece = own[start : start + sequence]
                rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), n + 1))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], PIECES.replace(" long", "").split(", "))


def _packed(table, sequence):
    group = table.column("group")[0].as_py()
    bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), sequence)
    table = table.drop_columns(["group", "row"])
    return table.append_column("sequence_id", pa.array((group << 32) + bins)).append_column("offset", pa.array(offsets))


def pack_documents(docs, path, id_col="doc_id", text_col="text", drops_space=True, sequence=SEQUENCE, group=GROUP):
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and the id 2; every id lies in exactly one piece, and the pieces of a sequence lie
    without gaps from 0. Only a document of more than ``sequence`` ids is cut. What is left of a sequence is padding,
    which a sequence of a power of two of ids does without. Null and empty texts are one id. A null id stays null;
    repeated rows are documents of their own. An empty table gives no rows; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = texts.mapInArrow(lambda batches: _pieces(batches, path, drops_space, sequence), PIECES)
    pieces = fixed(pieces.withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    dealt = dealt.select("row", "group", *pieces.columns[:-1])
    return dealt.groupBy("group").applyInArrow(
        lambda table: _packed(table.sort_by("row"), sequence), f"{PIECES}, sequence_id long, offset long"
    )
