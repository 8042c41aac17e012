"""Near duplicates by word shingles: SimHash, then every other pair of a Jaccard similarity of 0.8 by prefix filtering.

A text is the set of the 64-bit hashes of its five-word shingles. With all sets in one order, two sets that are similar
enough have a hash in common among the first fifth of each, so only those prefixes are shuffled. The pairs that meet are
checked on the whole sets; no such pair is missed, whatever the order. The order puts hashes that a sample of the texts
has more than once last, so that common lines are no meeting point.

SimHash comes first: sets whose fingerprints differ in three bits or fewer are linked, if their Jaccard similarity agrees.
That finds the almost equal ones; most pairs of 0.8 are further apart and are left to the prefixes.

Large groups are not sent on pair by pair: first every bucket's nodes are checked against one of them, and of what that
leaves in different components only pairs go on whose marks are close. A set's marks are 2048 bits, each toggled by the
hashes that fall on it; the marks of two sets differ in no more bits than the sets do in elements, so that no similar pair
is lost, and sets that merely share a line are told apart where they meet. Equal sets are one node.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F

from .components import connected_components
from .shared import binary_column, by_place, fixed, forget
from .simhash import SEED, link_forest, shingles, simhash, signed

#: Words of a shingle; the similarity from which texts are linked is OF / BY.
WORDS, OF, BY = 5, 4, 5
#: Texts looked at for common shingles, and the most of these that are put last. Both touch the speed alone.
SAMPLED, COMMON = 20_000, 65_536
#: Different nodes of a bucket that its nodes are checked against first; pairs held before they are sent on.
HUBS, PAIRS = 4, 1 << 20
#: Bits of a set's marks.
MARKS = 2048


def hashes(text, words=WORDS):
    """The distinct hashes of a text's shingles, sorted."""
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in shingles(text, words)], dtype=np.uint64))


def node_of(found):
    """What names a set of hashes, as Spark's long."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def prefix(found, common):
    """The first hashes of a set, those of the sorted ``common`` last: enough that similar sets share one."""
    if not len(found):
        return found
    # A look-up per hash: isin would sort all common ones with every text's.
    last = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found if len(common) else np.zeros(len(found), bool)
    return np.concatenate([found[~last], found[last]])[: len(found) - -(-len(found) * OF // BY) + 1]


def similar(shared, a, b):
    """Whether sets of ``a`` and ``b`` elements that have ``shared`` (at most) in common are similar enough."""
    return (OF + BY) * shared >= OF * (a + b)


def marks(found):
    """A set's marks as bytes."""
    odd = np.bincount((found % np.uint64(MARKS)).astype(np.int64), minlength=MARKS) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def close(a, b, total):
    """Whether the marks (rows of words) of sets of ``total`` elements together allow that these are similar."""
    return (OF + BY) * np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= (BY - OF) * total


def _common(docs, words, sampled=SAMPLED):
    """Hashes that several of the sampled texts have, the most frequent ones, sorted."""

    def task(batches):
        forget()
        for batch in batches:
            for text in binary_column(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(hashes(text, words).view(np.int64))], ["h"])

    step = max(1, docs.count() // sampled)
    texts = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
    counts = fixed(texts.mapInArrow(task, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # No more rows leave the tasks than are kept: the least count with room for all that have it comes first.
    sizes = sorted(((r.n, r.rows) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()), reverse=True)
    total, least = 0, None
    for n, rows in sizes:
        total += rows
        if total > COMMON:
            break
        least = n
    found = counts.where(F.col("n") >= least).collect() if least is not None else []
    return np.sort(np.array([r.h for r in found], dtype=np.int64).view(np.uint64))


def _described(docs, common, words):
    def task(batches):
        forget()
        for batch in batches:
            found = [hashes(t, words) for t in binary_column(batch, "text")]
            heads = [prefix(x, common).view(np.int64) for x in found]
            ends = pa.array(np.append(0, np.cumsum([len(x) for x in heads])), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*heads, np.zeros(0, np.int64)])))
            nodes, sizes = pa.array([node_of(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64())
            prints = pa.array([signed(simhash(x)) for x in found], pa.int64())
            columns = [batch.column(0), nodes, sizes, lists, pa.array([marks(x) for x in found], pa.binary()), prints]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "size", "head", "marks", "print"])

    return docs.mapInArrow(task, "doc_id long, node long, size long, head array<long>, marks binary, print long")


def _by_fingerprint(rows, met):
    """Pairs (a, b) of nodes that SimHash links: a spanning forest of the fingerprints, and each one's nodes with its first."""
    nodes = rows.select("node", "print").join(met, "node", "left_semi").distinct()
    firsts = fixed(nodes.groupBy("print").agg(F.min("node").alias("first")))
    same = nodes.join(firsts, "print").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = [firsts.select(F.col("print").alias(e), F.col("first").alias(f"first_{e}")) for e in "ab"]
    links = link_forest(firsts.select(F.col("print").alias("mark"))).join(ends[0], "a").join(ends[1], "b")
    return same.union(links.select(F.least("first_a", "first_b"), F.greatest("first_a", "first_b")))


def _blocks(batches):
    """The columns of rows sorted by the first one, in blocks that hold all rows of each of its values."""
    held, key = [], None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        first = columns[0]
        if not len(first):
            continue
        if held and first[0] == key == first[-1]:
            held.append(columns)
            continue
        columns = [np.concatenate(c) for c in zip(*held, columns)]
        key = first[-1]
        cut = int(np.searchsorted(columns[0], key))
        if cut:
            yield [c[:cut] for c in columns]
        held = [[c[cut:] for c in columns]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _first_of(h):
    """Of sorted values: whether each is the first of its kind."""
    return np.append(True, h[1:] != h[:-1])


def _shared(batches):
    """Rows (h, node, size, rest) of hashes that several nodes have."""
    for h, node, size, rest in _blocks(batches):
        order = np.lexsort((node, h))
        order = order[_first_of(h[order]) | _first_of(node[order])]
        run = np.cumsum(_first_of(h[order])) - 1
        order = order[np.bincount(run)[run] > 1]
        if len(order):
            yield pa.RecordBatch.from_arrays([pa.array(c[order]) for c in (h, node, size, rest)], ["h", "node", "size", "rest"])


def _pairs(a, b):
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _with_hubs(batches):
    """Pairs of each bucket's nodes with one of them, drawn by hash."""
    for h, node, size, rest in _blocks(batches):
        drawn = (node ^ (h % HUBS + 1)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((drawn, h))
        first = _first_of(h[order])
        hub = order[np.flatnonzero(first)][np.cumsum(first) - 1]
        fits = ~first & similar(np.minimum(rest[order], rest[hub]), size[order], size[hub])
        if fits.any():
            yield _pairs(node[order[fits]], node[hub[fits]])


def _all_apart(batches):
    """Pairs of each bucket's nodes that are in different components and can be similar by size, place and marks."""
    for h, node, size, rest, root, marked in _blocks(batches):
        run = np.cumsum(_first_of(h)) - 1
        low, high = (f.reduceat(root, np.flatnonzero(_first_of(h))) for f in (np.minimum, np.maximum))
        order = np.flatnonzero((low != high)[run])
        order = order[np.lexsort((size[order], h[order]))]
        h, node, size, rest, root = (c[order] for c in (h, node, size, rest, root))
        bits = np.frombuffer(b"".join(marked[order]), np.uint64).reshape(-1, MARKS // 64)
        at, held, step = np.arange(len(h)), [], 0
        while len(at):
            step += 1
            at = at[at < len(h) - step]
            # Of a bucket's nodes by size, one whose partner is too large has no further ones.
            at = at[(h[at] == h[at + step]) & (BY * size[at] >= OF * size[at + step])]
            fits = at[(root[at] != root[at + step]) & similar(np.minimum(rest[at], rest[at + step]), size[at], size[at + step])]
            fits = fits[close(bits[fits], bits[fits + step], size[fits] + size[fits + step])]
            held.append((node[fits], node[fits + step]))
            if sum(len(x) for x, _ in held) > PAIRS or not len(at):
                a, b = (np.concatenate(x) for x in zip(*held))
                held = []
                if len(a):
                    yield _pairs(a, b)


def _by_hash(rows):
    return rows.repartition("h").sortWithinPartitions("h")


def _texts(docs, words):
    """Rows (node, compressed text)."""

    def task(batches):
        forget()
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = binary_column(batch, "text")
            nodes = pa.array([node_of(hashes(t, words)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, pa.array([squeeze(t) for t in texts], pa.binary())], ["node", "text"])

    return docs.select("text").mapInArrow(task, "node long, text binary")


def _checked(pairs, texts, words):
    """Those of the pairs (a, b) of nodes that are similar."""

    def task(batches):
        restore, known = zstandard.ZstdDecompressor().decompress, [(None, None)] * 2
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (0, 1))
            good = []
            for i, node in enumerate(a):
                # The rows come in the order of one of the ends, depending on the join.
                for end, name in enumerate((node, b[i])):
                    if known[end][0] != name:
                        known[end] = name, hashes(restore(batch.column(2 + end)[i].as_py()), words)
                one, other = known[0][1], known[1][1]
                shared = len(np.intersect1d(one, other, assume_unique=True))
                good.append(bool(similar(shared, len(one), len(other))))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(task, "a long, b long")


def similar_groups(docs, id_col="doc_id", text_col="text", words=WORDS, sampled=SAMPLED):
    """One row per document: doc_id, component_id (smallest id reachable by pairs of similarity 0.8 or more).

    Shingles are those of :func:`forecourt.llm.simhash.shingles`; a text of fewer words is one shingle. Null, empty and
    blank texts have none and are alike. A component without any id has a null component_id. Repeated rows each give a
    row. An empty table gives no rows; other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = fixed(_described(docs, _common(docs, words, sampled), words))
    heads = rows.select("node", "size", F.posexplode("head").alias("at", "h"))
    heads = heads.select("h", "node", "size", (F.col("size") - F.col("at")).alias("rest"))
    shape = "h long, node long, size long, rest long"
    shared = fixed(_by_hash(heads).mapInArrow(_shared, shape))
    met = shared.select("node").distinct()
    texts = fixed(_texts(docs, words).join(met, "node", "left_semi").dropDuplicates(["node"]))
    hubs = _by_hash(shared).mapInArrow(_with_hubs, "a long, b long")
    near = fixed(_by_fingerprint(rows, met).union(hubs).distinct())
    links = fixed(_checked(near, texts, words))
    roots = connected_components(links)
    apart = shared.join(roots, "node", "left").select(*shared.columns, F.coalesce("root", "node").alias("root"))
    of_node = rows.select("node", "marks").join(met, "node", "left_semi").dropDuplicates(["node"])
    apart = apart.join(of_node, "node").select(*apart.columns, "marks")
    rest = fixed(_by_hash(apart).mapInArrow(_all_apart, "a long, b long").distinct().join(near, ["a", "b"], "left_anti"))
    roots = connected_components(links.unionByName(_checked(rest, texts, words)))
    marks = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = marks.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = fixed(rooted)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.select("doc_id", "node").join(rooted.join(ids, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


@by_place
def drop_similar(docs, id_col="doc_id", text_col="text", **options):
    """``docs`` with one document of each component: the one whose id is the component's.

    Rows without an id stay only where their component has no id at all; rows that repeat the kept id all stay.
    """
    groups = similar_groups(docs, id_col, text_col, **options)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")
