"""Near duplicates by SimHash, found with a covering family of bit masks.

Every bit position gets a vector of GF(2)^(r+1), and every non-zero vector v makes a mask of the positions whose vector
has an odd product with v. The positions in which two fingerprints differ, r at most, span no more than r dimensions,
so some v is orthogonal to all of them: that mask covers none of them, and the two meet in its table. With r = 3 that
takes 15 tables, each keyed by about 34 of 64 bits, and misses no pair.

Equal fingerprints are one node. A bucket of few nodes is searched in a task; one of many is dealt out again by masks
over its remaining bits, which leaves 16 free bits at most, so that no task ever holds more than 65,536 nodes. A search
emits a spanning forest and not the pairs.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .components import connected_components
from .shared import binary_column, by_place, fixed, forget

BITS, RADIUS, WORDS, SEED = 64, 3, 3, 42
#: Nodes of a bucket from which it is dealt out by further masks.
BUCKET = 4096


def covering_masks(positions, radius=RADIUS):
    """2^(radius+1) - 1 masks over ``positions``: two words differing in ``radius`` of them or fewer agree on some mask."""
    vectors = 2 ** (radius + 1) - 1
    given = {p: 1 + i % vectors for i, p in enumerate(positions)}
    return [sum(1 << p for p, m in given.items() if (m & v).bit_count() % 2) for v in range(1, vectors + 1)]


def signed(word):
    """An unsigned 64-bit number as Spark's long."""
    return word - (1 << 64) if word >> 63 else word


def shingles(text, words=WORDS):
    """The ``words``-word shingles of a text in UTF-8, A-Z lowered; a shorter text is one shingle, an empty one none."""
    found = text.lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    ends = np.cumsum([len(w) + 1 for w in found])
    joined = b" ".join(found)
    starts = [0, *ends[:-words].tolist()]
    return [joined[s:e] for s, e in zip(starts, (ends[words - 1 :] - 1).tolist())]


def simhash(hashes):
    """The SimHash of 64-bit hashes: a bit is set if it is set in over half of them."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text, words=WORDS):
    """The SimHash of a text's shingles, repeats included."""
    digest = xxhash.xxh64_intdigest
    return simhash(np.array([digest(s, SEED) for s in shingles(text, words)], dtype=np.uint64))


def forest(nodes, radius=RADIUS):
    """Edges (smallest node, other node) that connect what links of ``radius`` differing bits connect.

    A node that is reached is taken out, so each is compared with what is left only.
    """
    left = np.unique(np.asarray(nodes, dtype=np.uint64))
    edges = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        ahead = [root]
        while ahead and len(left):
            near = np.bitwise_count(left ^ ahead.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                ahead += list(found)
                edges += [(root, f) for f in found]
    return edges


def _fingerprints(batches, words=WORDS):
    forget()
    for batch in batches:
        marks = [signed(fingerprint(t, words)) for t in binary_column(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], ["doc_id", "mark"])


def _forests(batches, radius=RADIUS):
    for batch in batches:
        for nodes in batch.column(0):
            edges = forest(nodes.values.to_numpy().view(np.uint64), radius)
            if edges:
                ends = np.array(edges, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])


def _keys(masks):
    return F.array(*[F.struct(F.lit(i).alias("t"), F.col("mark").bitwiseAND(F.lit(signed(m))).alias("k")) for i, m in enumerate(masks)])


def link_forest(marks, radius=RADIUS, bucket=BUCKET):
    """Edges (a, b) of a spanning forest of all links between the distinct longs in ``marks.mark``."""
    masks = covering_masks(range(BITS), radius)
    inner = [covering_masks([p for p in range(BITS) if not m >> p & 1], radius) for m in masks]
    keyed = marks.select("mark", F.inline(_keys(masks)))
    shared = fixed(keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = keyed.join(shared, ["t", "k"])
    whole = met.where(F.col("n") <= bucket).withColumns({"t2": F.lit(-1), "k2": F.lit(0).cast("long")})
    again = F.element_at(F.array(*[_keys(m) for m in inner]), F.col("t") + 1)
    split = met.where(F.col("n") > bucket).select("mark", "t", "k", "n", F.inline(again).alias("t2", "k2"))
    nodes = whole.unionByName(split).groupBy("t", "k", "t2", "k2").agg(F.collect_list("mark").alias("nodes"))
    nodes = nodes.where(F.size("nodes") > 1).select("nodes")
    return nodes.mapInArrow(lambda batches: _forests(batches, radius), "a long, b long")


def simhash_groups(docs, id_col="doc_id", text_col="text", words=WORDS, radius=RADIUS, bucket=BUCKET):
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable by links).

    Null and empty texts have the fingerprint 0 and link like any other. A component without any id has a null
    component_id. Repeated rows each give a row. An empty table gives no rows; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = fixed(texts.mapInArrow(lambda batches: _fingerprints(batches, words), "doc_id long, mark long"))
    marks = fixed(rows.groupBy("mark").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(link_forest(marks.select("mark"), radius, bucket))
    rooted = marks.join(roots, marks.mark == roots.node, "left").select(
        "mark", "first_id", F.coalesce("root", "mark").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = fixed(rooted.join(ids, "root").select("mark", "component_id"))
    return rows.join(known, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


@by_place
def drop_near_copies(docs, id_col="doc_id", text_col="text", **options):
    """``docs`` with one document of each component: the one whose id is the component's.

    Rows without an id stay only where their component has no id at all; rows that repeat the kept id all stay.
    """
    groups = simhash_groups(docs, id_col, text_col, **options)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")
