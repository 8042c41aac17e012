"""Repeated passages: every byte covered by a 50-byte string that also starts in a document with a smaller id.

The suffixes of all texts are dealt out by their first 50 bytes: the anchor of a 50-byte window is the 16-byte string in
it with the smallest hash, so equal windows have equal anchors, and a suffix meets all suffixes it can agree with. A run
of neighbouring windows with one anchor is a segment, about one per 20 bytes.

1. In a task, of equal segments only those of the smallest document go on; the others are repeated for certain. So a
   passage that a third of all documents share is one record per task.
2. Segments are dealt by anchor as packed hashes. Equal ones are settled by the smallest document. Where an anchor has
   segments that differ, a common window would hold the 17 bytes before or behind the anchor; those that have one of
   these in common with another document are looked at closely.
3. Their bytes are fetched and their suffixes sorted: a mergesort in which two suffixes are compared by their common
   extension, found by binary search over prefix polynomial hashes; neighbours that agree in 50 bytes are verified byte
   by byte. Each class of equal 50-byte prefixes keeps its smallest document.
4. The spans found go back to their documents, where they are united.

The texts are shuffled once, by id and compressed, for steps 3 and 4, which read the same exchange.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F

from .shared import binary_column, by_place, forget

LENGTH, GRAM = 50, 16
#: Anchors in a window; bits of an anchor's hash; bytes of context of which a common window holds those on one side of
#: its anchor at least; marks for a context that isn't there, and for one that may be any.
WIDTH, ANCHOR_BITS = LENGTH - GRAM + 1, (1 << 48) - 1
CONTEXT, NO_CONTEXT, ANY_CONTEXT = (LENGTH - GRAM) // 2, 0, 1
#: Bytes of text that a task hashes at a time, and that it works on between two sends.
SLICE, BATCH = 1 << 19, 8 << 20
#: Bytes of text per bucket of anchors, and the number of segments of an anchor from which its windows are dealt singly.
BUCKET_BYTES, CROWD = 6 << 20, 8192
#: A null id is larger than all others, and stands for this plus a hash of its text.
NO_ID = 1 << 62
#: Bytes of cut segments that a task holds before it sends them on, or compares them; windows that it sorts at a time.
CUT_BYTES, SORTED = 4 << 20, 1 << 18

_RANDOM = np.random.default_rng(20_240_917)
_TABLE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(0, 1 << 63, dtype=np.uint64)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base, n):
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BASE, SLICE), _powers(_INVERSE, SLICE)


def mixed(h):
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class PrefixHash:
    """Prefix polynomial hashes of a byte array: the hash of any substring from two lookups."""

    def __init__(self, data):
        n = len(data)
        powers, self.inverse = (_POWERS, _INVERSES) if n <= SLICE else (_powers(_BASE, n), _powers(_INVERSE, n))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * powers[:n], out=self.sums[1:])

    def of(self, start, length):
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def grams(self, length):
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


def window_anchors(grams, width):
    """The smallest of each ``width`` neighbouring hashes."""
    low, span = grams, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def _context(hashes, at, length, inside):
    """A short hash of the ``length`` bytes at each place that lies inside its text, from 2 on; NO_CONTEXT elsewhere."""
    short = mixed(hashes.of(np.where(inside, at, 0), length)) % np.uint64(65_534) + np.uint64(2)
    return np.where(inside, short, NO_CONTEXT).astype(np.uint16)


def segments(data, lengths):
    """Runs of windows with one anchor in the texts laid end to end in ``data``.

    Returns arrays: anchor, hash of the run's bytes, hashes of the contexts left and right of the anchor, text number,
    start in the text, windows of the run.
    """
    hashes = PrefixHash(data)
    grams = hashes.grams(GRAM) & np.uint64(ANCHOR_BITS)
    low = window_anchors(grams, WIDTH)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    long = np.flatnonzero(lengths >= LENGTH)
    if not len(long) or not len(low):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint16, np.uint16, np.int64, np.int64, np.int64))
    new = np.zeros(len(low) + 1, bool)
    new[1:-1] = low[1:] != low[:-1]
    new[first[long]] = True
    new[first[long] + lengths[long] - LENGTH + 1] = True  # past the last window of each text
    starts = np.flatnonzero(new)
    text = np.searchsorted(first, starts, side="right") - 1
    # Texts too short for a window share their start with the next one; the run belongs to the last of them.
    inside = starts + LENGTH <= first[text] + lengths[text]
    stops = np.append(starts[1:], len(low))[inside]
    starts, text = starts[inside], text[inside]
    windows, anchor = stops - starts, low[starts]
    # The anchor's place in the run: the first one in its first window and the last one in its last.
    early, late = np.full(len(starts), -1), np.full(len(starts), -1)
    for k in reversed(range(WIDTH)):
        early[grams[starts + k] == anchor] = k
    for k in range(WIDTH):
        late[grams[stops - 1 + k] == anchor] = k
    place = starts + early
    left = _context(hashes, place - CONTEXT, CONTEXT, place - CONTEXT >= first[text])
    right = _context(hashes, place + GRAM, CONTEXT, place + GRAM + CONTEXT <= first[text] + lengths[text])
    several = place != stops - 1 + late  # which of several places counts would depend on the neighbourhood
    left[several] = right[several] = ANY_CONTEXT
    return anchor, mixed(hashes.of(starts, windows + LENGTH - 1)), left, right, text, starts - first[text], windows


def sliced(texts):
    """Texts as (number, start, bytes) pieces of bounded length; pieces overlap so that each window is in one piece."""
    step = SLICE // 2
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), step):
            yield i, at, t[at : at + step + LENGTH - 1]


def _all_segments(texts):
    """Segments of many texts, hashed some at a time."""
    parts, group, size = [], [], 0

    def flush():
        numbers = np.array([g[0] for g in group])
        offsets = np.array([g[1] for g in group])
        data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
        *hashes, text, start, windows = segments(data, np.array([len(g[2]) for g in group]))
        parts.append((*hashes, numbers[text], start + offsets[text], windows))

    for piece in sliced(texts):
        if group and size + len(piece[2]) > SLICE:
            flush()
            group, size = [], 0
        group.append(piece)
        size += len(piece[2])
    if group:
        flush()
    return [np.concatenate(c) for c in zip(*parts)] if parts else None


#: One segment as it travels: anchor, hash of its bytes, contexts, document (id, and hash of its text in case ids repeat),
#: start, windows.
SEGMENT = np.dtype(
    [("anchor", "u8"), ("seg", "u8"), ("left", "u2"), ("right", "u2"), ("id", "i8"), ("text", "i4"), ("start", "u4"), ("windows", "u4")]
)


def _packed(records):
    """Records by column and byte: alike bytes lie together, so that the shuffle's compression finds them."""
    return b"".join(
        np.ascontiguousarray(records[name]).view(np.uint8).reshape(len(records), -1).T.tobytes() for name in records.dtype.names
    )


def _unpacked(blob, dtype=SEGMENT):
    n = len(blob) // dtype.itemsize
    out, at = np.zeros(n, dtype), 0
    for name in dtype.names:
        width = dtype[name].itemsize
        flat = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n).T
        out[name] = np.ascontiguousarray(flat).view(dtype[name]).ravel()
        at += n * width
    return out


#: Kinds of rows: packed segments; repeated spans of a document; segments of a document to be looked at closely, those
#: of crowded anchors apart.
SEGMENTS, SPANS, CLOSELY, CROWDED = 0, 1, 2, 3
ROWS = pa.schema(
    [("bucket", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("text_hash", pa.int32()), ("anchor", pa.int64())]
    + [("start", pa.int64()), ("length", pa.int64()), ("blob", pa.binary())]
)
ROWS_SQL = "bucket long, kind int, id long, text_hash int, anchor long, start long, length long, blob binary"


def _rows(n, **columns):
    """A batch of ``n`` rows; columns that are not named are null."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ROWS]
    return pa.RecordBatch.from_arrays(arrays, schema=ROWS)


def _groups(*keys):
    """Start of each group of rows that are sorted by ``keys``, and each row's group number."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _settled(records):
    """(records sorted by segment, whether each repeats an equal segment of a smaller document)."""
    records = records[np.lexsort((records["id"], records["seg"], records["anchor"]))]
    starts, group = _groups(records["anchor"], records["seg"])
    return records, records["id"] > records["id"][starts][group]


def _spans(records, buckets):
    """Rows of spans: runs of repeated windows, neighbouring runs of a document as one."""
    records = records[np.lexsort((records["start"], records["text"], records["id"]))]
    stop = records["start"].astype(np.int64) + records["windows"]
    new = np.ones(len(records), bool)
    new[1:] = (records["id"][1:] != records["id"][:-1]) | (records["text"][1:] != records["text"][:-1])
    new[1:] |= records["start"][1:] > stop[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(records)) - 1
    heads = records[first]
    start = heads["start"].astype(np.int64)
    bucket = (mixed(heads["text"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64) if len(heads) else []
    return _rows(
        len(heads), bucket=bucket, kind=np.full(len(heads), SPANS), id=heads["id"], text_hash=heads["text"],
        start=start, length=stop[last] - start + LENGTH - 1,
    )


def _anchored(batches, buckets):
    """Texts to rows of packed segments by bucket, and the spans that are settled inside this batch."""

    def send(texts, ids, hashes):
        found = _all_segments(texts)
        if found is None or not len(found[0]):
            return
        anchor, seg, left, right, text, start, windows = found
        records = np.zeros(len(anchor), SEGMENT)
        records["anchor"], records["seg"], records["start"], records["windows"] = anchor, seg, start, windows
        records["left"], records["right"] = left, right
        records["id"], records["text"] = np.array(ids)[text], np.array(hashes)[text]
        records, repeated = _settled(records)
        if repeated.any():
            yield _spans(records[repeated], buckets)
            records = records[~repeated]
        bucket = (records["anchor"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        records, bucket = records[order], bucket[order]
        starts, _ = _groups(bucket)
        blobs = [_packed(part) for part in np.split(records, starts[1:])]
        yield _rows(len(blobs), bucket=bucket[starts], kind=np.full(len(blobs), SEGMENTS), blob=blobs)

    forget()
    texts, ids, hashes, size = [], [], [], 0
    for batch in batches:
        for t, i, h in zip(binary_column(batch, "_text"), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            texts.append(t)
            ids.append(i)
            hashes.append(h)
            size += len(t)
            if size >= BATCH:
                yield from send(texts, ids, hashes)
                texts, ids, hashes, size = [], [], [], 0
    if texts:
        yield from send(texts, ids, hashes)


def _in_common(records, group):
    """Whether each record of the anchor groups may have a window in common with another document."""
    found = np.zeros(len(records), bool)
    for side in ("left", "right"):
        order = np.lexsort((records["id"], records[side], group))
        context, ids = records[side][order], records["id"][order]
        starts, number = _groups(group[order], context)
        last = np.append(starts[1:], len(order)) - 1
        found[order] |= ((ids[starts] != ids[last])[number]) & (context > ANY_CONTEXT)
    loose = np.bincount(group, records["left"] == ANY_CONTEXT) > 0
    return found | loose[group]


def _matched(batches, buckets, crowd):
    """Rows of packed segments, sorted by bucket, to repeated spans and to segments whose bytes are needed."""

    def settle(blobs):
        records, repeated = _settled(np.concatenate([_unpacked(b) for b in blobs]))
        if repeated.any():
            yield _spans(records[repeated], buckets)
            records = records[~repeated]
        starts, group = _groups(records["anchor"])
        low, high = np.minimum.reduceat(records["id"], starts), np.maximum.reduceat(records["id"], starts)
        heads, _ = _groups(records["anchor"], records["seg"])
        kinds = np.bincount(group[heads], minlength=len(starts))
        close = np.flatnonzero(((low != high) & (kinds > 1))[group])
        if len(close):
            close = close[_in_common(records[close], group[close])]
        if len(close):
            close_ = records[close]
            left = np.bincount(group[close], minlength=len(starts))
            crowded = (left > crowd)[group[close]]
            yield _rows(
                len(close_), kind=np.where(crowded, CROWDED, CLOSELY), id=close_["id"], text_hash=close_["text"],
                anchor=close_["anchor"].view(np.int64), start=close_["start"].astype(np.int64),
                length=close_["windows"].astype(np.int64) + LENGTH - 1,
            )

    bucket, blobs = None, []
    for batch in batches:
        kind = batch.column(1).to_numpy()
        if (kind == SPANS).any():
            yield batch.filter(pa.array(kind == SPANS))
        packed = batch.filter(pa.array(kind == SEGMENTS))
        for b, blob in zip(packed.column(0).to_pylist(), packed.column(7).to_pylist()):
            if b != bucket and blobs:
                yield from settle(blobs)
                blobs = []
            bucket = b
            blobs.append(blob)
    if blobs:
        yield from settle(blobs)


CUT = pa.schema(
    [("bucket", pa.int64()), ("anchor", pa.int64()), ("id", pa.int64()), ("text_hash", pa.int32()), ("start", pa.int64()), ("bytes", pa.binary())]
)
CUT_SQL = "bucket long, anchor long, id long, text_hash int, start long, bytes binary"


def _squeezed(batches, text_col):
    """Rows with their texts compressed."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        at = batch.schema.get_field_index(text_col)
        texts = pa.array([None if t is None else squeeze(t) for t in batch.column(at).to_pylist()], pa.binary())
        yield batch.set_column(at, batch.schema.field(at), texts)


def _texts(batch, text_col):
    """The texts of rows as bytes; null is empty."""
    restore = zstandard.ZstdDecompressor().decompress
    return [restore(t) if t else b"" for t in binary_column(batch, text_col)]


def _cut(batches, buckets, text_col):
    """Texts with their segments to be looked at, to a row with the bytes of each, a few MB at a time."""

    def sent(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CUT)], schema=CUT)

    for batch in batches:
        texts = _texts(batch, text_col)
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        parts = batch.column(batch.schema.get_field_index("_segments"))
        rows, size = [], 0
        for text, i, h, segs in zip(texts, ids, hashes, parts):
            fields = [segs.values.field(k).to_pylist() for k in range(4)]
            for kind, anchor, start, length in zip(*fields):
                if kind == CLOSELY:
                    rows.append((anchor % buckets, anchor, i, h, start, text[start : start + length]))
                    size += length
                    if size > CUT_BYTES:
                        yield sent(rows)
                        rows, size = [], 0
                    continue
                for at in range(start, start + length - LENGTH + 1):  # each window of a crowded anchor by its own hash
                    piece = text[at : at + LENGTH]
                    key = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
                    rows.append((key % buckets, key, i, h, at, piece))
                    size += 4 * LENGTH  # with what a short row costs in Python
                    if size > CUT_BYTES:
                        yield sent(rows)
                        rows, size = [], 0
        if rows:
            yield sent(rows)


def common_extension(hashes, a, b, limit=LENGTH):
    """Length of the common extension of the suffixes at ``a`` and ``b``, up to ``limit``, by binary search on hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), limit, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = hashes.of(a, middle) == hashes.of(b, middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def suffix_before(data, hashes, a, b, limit=LENGTH):
    """Whether the suffix at ``a`` comes before the one at ``b`` by their first ``limit`` bytes; equal ones do not."""
    same = common_extension(hashes, a, b, limit)
    last = np.minimum(same, limit - 1)
    return (same < limit) & (data[a + last] < data[b + last])


class Suffixes:
    """Comparison of the suffixes ``at``, named by their numbers, by their first ``limit`` bytes.

    Most are told apart by their first eight bytes or found equal by the hash of all; the others go by their common extension.
    """

    def __init__(self, data, hashes, at, limit):
        self.data, self.hashes, self.at, self.limit = data, hashes, at, limit
        self.whole, self.head = hashes.of(at, limit), np.zeros(len(at), np.uint64)
        for k in range(min(8, limit)):
            self.head = (self.head << np.uint64(8)) | data[at + k]

    def equal(self, a, b):
        return (self.whole[a] == self.whole[b]) & (self.head[a] == self.head[b])

    def before(self, a, b):
        one, other = self.head[a], self.head[b]
        out = one < other
        close = np.flatnonzero(one == other)
        close = close[self.whole[a[close]] != self.whole[b[close]]]
        out[close] = suffix_before(self.data, self.hashes, self.at[a[close]], self.at[b[close]], self.limit)
        return out


def sort_suffixes(data, hashes, group, at, limit=LENGTH):
    """Order of the suffixes ``at`` by (group, first ``limit`` bytes): a stable bottom-up mergesort.

    ``group`` is sorted. In a round all pairs of neighbouring runs inside groups merge at once: an element's place is its
    rank in its own run plus its rank in the other one, found by binary search. A suffix that meets an equal one in a
    merge leaves the runs and follows that one, so that the rounds work on ever fewer suffixes where many are equal.
    """
    compared = Suffixes(data, hashes, at, limit)
    leader = np.arange(len(at))
    order, heads = np.arange(len(at)), np.arange(len(at))  # the elements run by run, and where the runs begin
    while len(heads) > 1:
        families, family = _groups(group[order[heads]])
        if len(families) == len(heads):
            break
        sizes = np.diff(heads, append=len(order))
        place = np.arange(len(heads)) - families[family]
        right = place % 2 == 1
        partner = np.where(right, np.arange(len(heads)) - 1, np.arange(len(heads)) + 1)
        partner[~right & (np.append(family[1:], -1) != family)] = -1  # the last run of a group waits for the next round
        run = np.repeat(np.arange(len(heads)), sizes)
        moving = np.flatnonzero(partner[run] >= 0)
        other, from_right, mine = partner[run[moving]], right[run[moving]], order[moving]
        low = heads[other]
        base, high = low.copy(), low + sizes[other]
        while (open_ := np.flatnonzero(low < high)).size:
            probe = (low[open_] + high[open_]) // 2
            theirs, own, late = order[probe], mine[open_], from_right[open_]
            # A left element comes before equal right ones.
            ahead = compared.before(np.where(late, own, theirs), np.where(late, theirs, own)) ^ late
            low[open_] = np.where(ahead, probe + 1, low[open_])
            high[open_] = np.where(ahead, high[open_], probe)
        target = np.arange(len(order))
        target[moving] = moving + np.where(from_right, low - base - sizes[other], low - base)
        met = np.flatnonzero(from_right & (low > base))
        met = met[compared.equal(mine[met], order[low[met] - 1])]
        leader[mine[met]] = order[low[met] - 1]
        stays = np.ones(len(order), bool)
        stays[target[moving[met]]] = False
        merged = np.empty_like(order)
        merged[target] = order
        firsts = heads[~right]
        order, heads = merged[stays], (np.cumsum(stays) - stays)[firsts]
    while (leader[leader] != leader).any():
        leader = leader[leader]
    rank = np.empty(len(at), np.int64)
    rank[order] = np.arange(len(order))
    return np.argsort(rank[leader], kind="stable")


def _verified(data, a, b, limit=LENGTH):
    """Whether the first ``limit`` bytes at ``a`` and ``b`` are the same bytes."""
    same = np.ones(len(a), bool)
    for k in range(limit):
        same &= data[a + k] == data[b + k]
    return same


def repeated_windows(data, group, first, count, ids, most=SORTED):
    """For segments (group, first byte in ``data``, number of windows, document id): (segment, window) pairs that repeat,
    in this order.

    A window repeats if its bytes are also a window of the same group in a document with a smaller id. Segments lie
    whole in ``data``, ``count + LENGTH - 1`` bytes each. Windows whose hash is alone in their group cannot agree with
    any other and are not sorted. Of more than ``most`` windows, those of one share of the hashes are sorted at a time.
    """
    hashes, begin, total = PrefixHash(data), np.cumsum(count) - count, int(count.sum())

    def placed(windows):
        segment = np.searchsorted(begin, windows, side="right") - 1
        return segment, windows - begin[segment]

    prefix = np.empty(total, np.uint64)
    for low in range(0, total, most):
        segment, window = placed(np.arange(low, min(low + most, total)))
        prefix[low : low + most] = hashes.of(first[segment] + window, LENGTH)
    shares = max(1, -(-total // most))
    share = (mixed(prefix) % np.uint64(shares)).astype(np.int32)
    found = [np.zeros(0, np.int64)]
    for k in range(shares):
        of_share = np.flatnonzero(share == k)
        segment, window = placed(of_share)
        at = first[segment] + window
        order = np.lexsort((prefix[of_share], group[segment]))
        _, number = _groups(group[segment][order], prefix[of_share][order])
        met = order[(np.bincount(number) > 1)[number]] if len(order) else order
        if not len(met):
            continue
        sorted_ = met[sort_suffixes(data, hashes, group[segment[met]], at[met])]
        a, b = at[sorted_[:-1]], at[sorted_[1:]]
        agree = (group[segment[sorted_[1:]]] == group[segment[sorted_[:-1]]]) & (common_extension(hashes, a, b) >= LENGTH)
        agree[agree] = _verified(data, a[agree], b[agree])
        starts = np.flatnonzero(np.append(True, ~agree))
        number = np.cumsum(np.append(True, ~agree)) - 1
        who = ids[segment[sorted_]]
        found.append(of_share[sorted_[who > np.minimum.reduceat(who, starts)[number]]])
    return placed(np.sort(np.concatenate(found)))


def _compared(batches, buckets):
    """Segments with their bytes, sorted by bucket and anchor, to the repeated spans of their documents."""

    def compare(rows):
        rows = pa.Table.from_batches(rows).combine_chunks()
        group, ids, hashes, start = (rows.column(k).to_numpy() for k in (1, 2, 3, 4))
        texts = rows.column(5).to_pylist()
        size = np.array([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        segments_, windows = repeated_windows(data, group, np.cumsum(size) - size, size - LENGTH + 1, ids)
        for low in range(0, len(windows), SORTED):
            segment, window = segments_[low : low + SORTED], windows[low : low + SORTED]
            hits = np.zeros(len(segment), SEGMENT)
            hits["id"], hits["text"] = ids[segment], hashes[segment]
            hits["start"], hits["windows"] = start[segment] + window, 1
            yield _spans(hits, buckets)

    anchor, rows, held = None, [], 0
    for batch in batches:
        numbers = batch.column(1).to_numpy()
        if not len(numbers):
            continue
        new = np.flatnonzero(np.append(numbers[0] != anchor, numbers[1:] != numbers[:-1]))
        if held > CUT_BYTES and len(new):
            yield from compare([*rows, batch.slice(0, new[0])])
            rows, held, batch = [], 0, batch.slice(new[0])
        anchor = numbers[-1]
        rows.append(batch)
        held += batch.nbytes
    if rows:
        yield from compare(rows)


def union(start, length):
    """Sorted, disjoint, maximal (start, end) pairs; spans that touch are one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], start[order] + length[order]
    reach = np.maximum.accumulate(end)
    new = np.append(True, start[1:] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)
    return np.column_stack([start[new], reach[last]])


def without(text, spans):
    """The bytes outside ``spans``."""
    edges = [0, *np.asarray(spans).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(text, spans):
    """Spans of a UTF-8 text drawn in to whole characters, so that what is left is a text; empty ones go."""
    out = []
    for a, b in np.asarray(spans).tolist():
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _with_spans(docs, id_col, text_col, bucket_bytes, crowd):
    """Rows (_id, _hash, *docs.columns, _spans): every row of docs with the repeated spans of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    absent = F.lit(NO_ID) + F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1))
    key = [F.coalesce(F.col(id_col).cast("long"), absent).alias("_id"), F.hash(text).alias("_hash")]
    # Bytes of text decide how many buckets there are, so that a bucket fits a task at any size.
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 4)
    rows = docs.select(text.alias("_text"), *key).mapInArrow(lambda batches: _anchored(batches, buckets), ROWS_SQL)
    rows = rows.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    found = rows.mapInArrow(lambda batches: _matched(batches, buckets, crowd), ROWS_SQL)
    # The segments' exchange and this one are each read twice; other columns travel with the text, once.
    packed = docs.select(*key, *docs.columns).withColumn(text_col, F.col(text_col).cast("binary"))
    texts = packed.mapInArrow(lambda batches: _squeezed(batches, text_col), packed.schema).repartition(partitions, "_id", "_hash")
    owner = [F.col("id").alias("_owner"), F.col("text_hash").alias("_owner_hash")]
    owned = (F.col("_id") == F.col("_owner")) & (F.col("_hash") == F.col("_owner_hash"))
    close = found.where(F.col("kind").isin(CLOSELY, CROWDED)).groupBy(*owner)
    close = close.agg(F.collect_list(F.struct("kind", "anchor", "start", "length")).alias("_segments"))
    # All columns go into the function: pruning them would make another exchange.
    cut = texts.join(close, owned).mapInArrow(lambda batches: _cut(batches, buckets, text_col), CUT_SQL)
    cut = cut.repartition(partitions, "bucket").sortWithinPartitions("bucket", "anchor")
    compared = cut.mapInArrow(lambda batches: _compared(batches, buckets), ROWS_SQL)
    spans = found.where(F.col("kind") == SPANS).unionByName(compared).groupBy(*owner)
    spans = spans.agg(F.collect_list(F.struct("start", "length")).alias("_spans"))
    return texts.join(spans, owned, "left").drop("_owner", "_owner_hash")


def _spans_of(batch, text_col):
    """(text, union of its spans) of each row."""
    spans = batch.column(batch.schema.get_field_index("_spans"))
    for text, found in zip(_texts(batch, text_col), spans):
        if found.values is None or not len(found.values):
            yield text, np.zeros((0, 2), np.int64)
        else:
            yield text, union(found.values.field(0).to_numpy(), found.values.field(1).to_numpy())


def _described(batches):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for text, spans in _spans_of(batch, "_source_text"):
            kept = without(text, spans)
            rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        columns = [batch.column(batch.schema.get_field_index("_doc_id")), *[pa.array(c) for c in zip(*rows)]]
        if rows:
            yield pa.RecordBatch.from_arrays(columns, names)


def repeated_passages(docs, id_col="doc_id", text_col="text", bucket_bytes=BUCKET_BYTES, crowd=CROWD):
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts, and texts of fewer than 50 bytes, keep all their bytes. Ids are integers; a null id is larger
    than all others, rows with equal ids are not smaller than each other, and null ids stand in the order of a hash of their
    texts. An empty table gives no rows; other columns are
    not looked at.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("_doc_id"), F.col(text_col).alias("_source_text"))
    found = _with_spans(narrow, "_doc_id", "_source_text", bucket_bytes, crowd)
    return found.mapInArrow(_described, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@by_place
def drop_passages(docs, id_col="doc_id", text_col="text", bucket_bytes=BUCKET_BYTES, crowd=CROWD):
    """``docs`` with the repeated passages cut out of the text, all other columns as they are.

    Spans are drawn in to whole characters first, so the text stays valid. A null text stays null.
    """
    names = docs.columns

    def cut_out(batches):
        for batch in batches:
            kept = [without(t, whole_characters(t, s)).decode() for t, s in _spans_of(batch, text_col)]
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            nulls = columns[text_col].is_null().to_pylist()
            columns[text_col] = pa.array([None if n else k for n, k in zip(nulls, kept)], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _with_spans(docs, id_col, text_col, bucket_bytes, crowd).mapInArrow(cut_out, docs.schema)
