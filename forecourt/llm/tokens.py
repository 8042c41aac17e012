"""Token ids of whole texts with the tokenizers library, each distinct word of a worker encoded once.

A byte-pair tokenizer never merges across its pre-tokenizer's boundaries, so a text may be cut at any of them. Texts are
cut where a boundary is certain from the bytes alone, Arrow numbers the distinct pieces of a batch, and only pieces that
the worker has not seen yet go to the library; the ids are then laid together by table lookup.
"""

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .shared import FORGET, binary_column

#: Bytes of text that are encoded together, and the pieces whose ids a worker remembers at most.
BATCH, REMEMBERED = 4 << 20, 800_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Bytes that surely belong to a character which isn't white space: ASCII beside controls and blanks, and the first bytes
# of two-byte characters from U+00C0 on.
_SURE_LEAD = np.zeros(256, bool)
_SURE_LEAD[0x21:0x7F] = True
_SURE_LEAD[0xC3:0xE0] = True
# Pieces that begin, after a blank, and end with a character that is surely no white space, and have no line feed.
_SURE = rb"(?:[!-~]|[\xc3-\xdf][\x80-\xbf])"
_PLAIN = re.compile(rb" ?" + _SURE + rb"(?:[^\n]*" + _SURE + rb")?").fullmatch


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def _cuts_at_marks(data):
    """Before an ASCII mark behind an ASCII letter: words of letters end there under either pattern."""
    return np.flatnonzero(_LETTER[data[:-1]] & _MARK[data[1:]]) + 1


def _cuts_at_blanks(data):
    """Before each single blank between two characters that are surely no white space: `` ?word`` patterns part there."""
    at = np.flatnonzero(data[2:-1] == 32) + 2 if len(data) > 3 else np.zeros(0, np.int64)
    before, earlier = data[at - 1], data[at - 2]
    ended = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (earlier >= 0xC3) & (earlier < 0xE0))
    return at[ended & _SURE_LEAD[data[at + 1]]]


def _cuts_at_spaces(data):
    """Before every ASCII white space: for tokenizers that drop white space."""
    return np.flatnonzero(_SPACE[data])


class PieceEncoder:
    """Encodes batches of UTF-8 texts; gives the ids that ``Tokenizer.encode`` gives for each whole text.

    ``drops_space`` says that the tokenizer drops white space between words; otherwise it is one whose words carry one
    leading blank. Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path, drops_space):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cuts = _cuts_at_spaces if drops_space else _cuts_at_blanks
        # Between pieces that are encoded in one call; its id occurs in no piece that lacks the mark.
        mark = "|" if drops_space else "\n"
        self.between = b" | " if drops_space else b"\n"
        self.plain = (lambda p: b"|" not in p) if drops_space else _PLAIN
        (self.mark_id,) = self._ids(mark)
        self._forget()

    def _ids(self, text):
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self):
        self.known, self.start, self.length, self.pool = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, pieces):
        """Adds the ids of new pieces to the table: plain ones many to a call, the others one by one."""
        plain = [p for p in pieces if self.plain(p)]
        singly = [p for p in pieces if not self.plain(p)] if len(plain) < len(pieces) else []
        lengths, pool = [], []
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            found = np.array(self._ids(self.between.join(part).decode()), dtype=np.uint32)
            cuts = np.flatnonzero(found == self.mark_id)
            if len(cuts) != len(part) - 1:  # the file's rules aren't those expected here
                raise ValueError("the tokenizer merges across pieces")
            lengths.append(np.diff(cuts, prepend=-1, append=len(found)) - 1)
            pool.append(np.delete(found, cuts))
        for piece in singly:
            pool.append(np.array(self._ids(piece.decode()), dtype=np.uint32))
            lengths.append([len(pool[-1])])
        lengths = np.concatenate(lengths)
        first, used = len(self.known), int(self.length.sum())
        self.known.update(zip(plain + singly, range(first, first + len(pieces))))
        self.start = np.append(self.start, used + np.cumsum(lengths) - lengths)
        self.length = np.append(self.length, lengths)
        self.pool = np.concatenate([self.pool, *pool])

    def encode(self, texts):
        """(ids of all texts end to end as uint32, their number per text)."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        first = np.cumsum(sizes) - sizes
        cut = np.zeros(len(data) + 1, bool)
        cut[self.cuts(data)] = cut[_cuts_at_marks(data)] = True
        cut[first] = True  # also where the next text is empty; the end of data is dropped below
        cut[len(data)] = True
        offsets = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        new = [p for p in distinct if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        codes = pieces.indices.to_numpy()
        start, length = self.start[number][codes], self.length[number][codes]
        ends = np.cumsum(length)
        ids = self.pool[np.repeat(start - (ends - length), length) + np.arange(ends[-1])]
        total = np.append(0, ends)
        at = np.searchsorted(offsets, np.append(first, len(data)))
        return ids, np.diff(total[at])


@lru_cache(maxsize=2)
def encoder(path, drops_space):
    """The worker's encoder for a file; it outlives the task where Spark reuses its Python workers."""
    return PieceEncoder(path, drops_space)


FORGET.append(encoder.cache_clear)


def encoded(batches, text_name, path, drops_space, limit=BATCH):
    """(record batch, ids, counts) for slices of record batches of at most about ``limit`` bytes of text."""
    for batch in batches:
        texts, start, size = binary_column(batch, text_name), 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= limit or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), *encoder(path, drops_space).encode(texts[start : i + 1])
                start, size = i + 1, 0
