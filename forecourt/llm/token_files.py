"""Token-id files: ids ranked by frequency, in a byte-aligned code of variable length with its control bytes apart.

A file holds documents in ascending order of id. An id is written as its rank among all ids of the corpus, the most
frequent one being 0, in one to four bytes; the lengths of four ranks share a control byte. Control bytes and data bytes
are two separate blocks, so that numpy reads a file by table lookup: lengths from the control bytes, positions from their
running sum, ranks from the data, ids from the ranks.

Texts are encoded once. The encoded documents are dealt to ranges of ids, and that one shuffle serves two jobs: the first
counts ids, the second writes the files. An RDD is used there because its shuffle is kept between jobs, which spares a
further copy of the data.

Files are written to the shared folder by tasks through pyarrow's file systems; the manifest names those of the attempts
that succeeded.
"""

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import file_system, fixed, folder, put_file
from .tokens import encoded

MAGIC, END = b"TOKRANK1", 2
#: Bytes of text per file.
FILE_BYTES = 8 << 20

#: Length of each of four values by control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def pack(values):
    """(control bytes, data bytes) of unsigned 32-bit values: one to four bytes each, little-endian."""
    values = np.ascontiguousarray(values, dtype="<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control, data, n):
    """The ``n`` values of :func:`pack`; wrong lengths raise ValueError."""
    control, data = np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8)
    size = LENGTHS[control].ravel()[:n].astype(np.int64)
    ends = np.cumsum(size)
    if len(control) != -(-n // 4) or (ends[-1] if n else 0) != len(data):
        raise ValueError("control bytes and data bytes disagree")
    at, values = ends - size, np.zeros(n, np.uint32)
    for k in range(4):
        longer = np.flatnonzero(size > k)
        values[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def file_bytes(ids, has_id, counts, ranks):
    """A file of documents: header, ids of the documents, their numbers of tokens, control bytes, data bytes."""
    control, data = pack(ranks)
    head = struct.pack("<8sQQQQ", MAGIC, len(ids), len(ranks), len(control), len(data))
    index = np.asarray(ids, "<i8").tobytes() + np.asarray(has_id, np.uint8).tobytes() + np.asarray(counts, "<u8").tobytes()
    return head + index + control + data


def read_bytes(blob):
    """(ids, has_id, counts, ranks) of a file; a damaged one raises ValueError."""
    magic, docs, tokens, controls, size = struct.unpack_from("<8sQQQQ", blob)
    at = struct.calcsize("<8sQQQQ")
    if magic != MAGIC or len(blob) != at + 17 * docs + controls + size:
        raise ValueError("not a token file, or cut off")
    ids = np.frombuffer(blob, "<i8", docs, at)
    has_id = np.frombuffer(blob, np.uint8, docs, at + 8 * docs).astype(bool)
    counts = np.frombuffer(blob, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    ranks = unpack(blob[at : at + controls], blob[at + controls :], tokens)
    if counts.sum() != tokens:
        raise ValueError("the documents' numbers of tokens don't add up")
    return ids, has_id, counts, ranks


def ranked(counts):
    """ids by rank: the most frequent first, equal ones by id."""
    return np.lexsort((np.arange(len(counts)), -counts)).astype(np.uint32)


def _bounds(docs, id_col, files):
    """Ids that part the documents into ``files`` ranges of about as many rows."""
    if files < 2:
        return []
    shares = [i / files for i in range(1, files)]
    found = docs.select(F.percentile_approx(id_col, shares, max(10_000, 20 * files))).first()[0]
    return sorted(set(found or []))


def _with_end(ids, counts):
    """Ids of documents laid end to end, each with the end id behind it."""
    ends = np.cumsum(counts + 1) - 1
    own = np.ones(len(ids) + len(counts), bool)
    own[ends] = False
    out = np.full(len(own), END, np.uint32)
    out[own] = ids
    return out


def _reordered(values, counts, order):
    """Runs of ``counts`` values laid end to end, in another order."""
    if (order[1:] > order[:-1]).all():
        return values
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


DEALT = [("part", pa.int64()), ("ids", pa.binary()), ("has_id", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())]
DEALT_SQL = "part long, ids binary, has_id binary, counts binary, tokens binary"


def _dealt(batches, path, drops_space, bounds, width):
    """Texts to packed rows of documents, one for each range of ids that a slice of texts has."""
    for batch, ids, counts in encoded(batches, "text", path, drops_space):
        has = np.array(batch.column(0).is_valid())
        docs = np.array(batch.column(0).fill_null(0), dtype=np.int64)
        part = np.where(has, np.searchsorted(bounds, docs), 0)
        order = np.argsort(part, kind="stable")
        tokens, counts = _reordered(_with_end(ids, counts), counts + 1, order), counts[order] + 1
        part, docs, has = part[order], docs[order], has[order]
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        at, rows = np.append(0, np.cumsum(counts)), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                own = tokens[at[a] : at[b]].astype(width).tobytes()
                rows.append((int(part[a]), docs[a:b].tobytes(), has[a:b].tobytes(), counts[a:b].tobytes(), own))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), DEALT)], [n for n, _ in DEALT])


def _parts(row, width):
    """(ids, has_id, counts, tokens) of a packed row."""
    return tuple(np.frombuffer(c, t) for c, t in zip(row, (np.int64, bool, np.int64, width)))


def _count_ids(rows, width):
    total = np.zeros(0, np.int64)
    for _, row in rows:
        total = _added(total, np.bincount(_parts(row, width)[3]))
    yield total


def _added(a, b):
    return a + np.pad(b, (0, len(a) - len(b))) if len(a) >= len(b) else _added(b, a)


def write_token_files(docs, path, at=None, id_col="doc_id", text_col="text", drops_space=False, file_bytes_=FILE_BYTES):
    """Encodes every text with the tokenizer file ``path``, ends it with the id 2, and writes files to the folder ``at``.

    Returns the manifest (path, number, docs, tokens), in the order of the documents. Null ids come first; rows with one
    id are ordered by their numbers of tokens. A null text is an empty one. The ids by rank are in ``at/ranks``; their
    number is bounded by the vocabulary.
    """
    spark, at = docs.sparkSession, at or folder(docs.sparkSession, "tokens")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bounds = np.array(_bounds(docs, id_col, -(-size // file_bytes_)), dtype=np.int64)
    # On the way to their files ids have as many bytes as the vocabulary needs.
    width = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.mapInArrow(lambda batches: _dealt(batches, path, drops_space, bounds, width), DEALT_SQL).rdd
    dealt = rows.map(lambda r: (r[0], tuple(bytes(c) for c in r[1:]))).partitionBy(len(bounds) + 1, int)
    by_rank = ranked(dealt.mapPartitions(lambda part: _count_ids(part, width)).treeReduce(_added))
    put_file(f"{at}/ranks", by_rank.astype("<u4").tobytes())
    rank_of = np.zeros(max(1, len(by_rank)), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def write(part):
        rows = [_parts(row, width) for _, row in part]
        if not rows:
            return
        ids, has, counts, tokens = (np.concatenate(c) for c in zip(*rows))
        del rows
        order = np.lexsort((counts, ids, has))
        ranks = shared.value[_reordered(tokens, counts, order)]
        del tokens
        ids, has, counts = ids[order], has[order], counts[order]
        number = int(np.searchsorted(bounds, ids[-1])) if has[-1] else 0
        name = f"{at}/{number:08d}-{uuid.uuid4().hex}.tok"
        put_file(name, file_bytes(ids, has, counts, ranks))
        yield name, number, len(ids), len(ranks)

    return fixed(spark.createDataFrame(dealt.mapPartitions(write), "path string, number long, docs long, tokens long"))


def _placed(manifest):
    """(path, tokens of all documents before it) of each file; the running sum sees one row per file."""
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    # The number is stated: by its size adaptive execution would leave the manifest to one task, which read every file.
    return placed.select("path", "start").repartition(max(1, manifest.count()), "path")


def _documents(batches, at):
    """Some documents at a time of the files: (ids, their starts and numbers of tokens, tokens end to end)."""
    store, name = file_system(f"{at}/ranks")
    with store.open_input_stream(name, compression=None) as source:
        by_rank = np.frombuffer(source.read(), "<u4")
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, name = file_system(path)
            with store.open_input_stream(name, compression=None) as source:
                ids, has_id, counts, ranks = read_bytes(source.read())
            ends = np.cumsum(counts)
            for a in range(0, len(ids), 512):
                b = min(a + 512, len(ids))
                first = int(ends[a] - counts[a])
                tokens = by_rank[ranks[first : ends[b - 1]]]
                yield pa.array(ids[a:b], mask=~has_id[a:b]), start + ends[a:b] - counts[a:b], counts[a:b], tokens


def read_token_files(manifest, at):
    """One row per document: doc_id, start (tokens of all documents before it), n_tokens, ids (array of int)."""

    def read(batches):
        for ids, starts, counts, tokens in _documents(batches, at):
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(tokens.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(counts), lists], ["doc_id", "start", "n_tokens", "ids"])

    return _placed(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids array<int>")


def token_checksums(manifest, at):
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches):
        for ids, starts, counts, tokens in _documents(batches, at):
            cuts = np.append(0, np.cumsum(counts)).tolist()
            crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            columns = [ids, pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(manifest).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
