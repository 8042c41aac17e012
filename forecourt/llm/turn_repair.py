"""Structure repair of conversations: weighted CYK interval parsing over the turns of each conversation.

A conversation is well formed when the first letters of its roles read ``(s?(ua)+)?``. The repair grammar's nonterminals
are pairs of states of that pattern: ``[p, q]`` derives a span of turns whose repaired roles lead from p to q. In Chomsky
normal form its rules are ``[p, q] -> [p, r] [r, q]``, ``[p, q] -> edit of one turn``, and ``[p, q] -> nothing``, by
inserted turns; the last is folded into the cells of single turns (insertion closure). A cell holds the smallest (cost,
audit) of each nonterminal, and cells are combined bottom-up by span length: 1, 2, 4, ... As the nonterminals are pairs of
states, every split of a span gives the same cell, so one split in the middle serves for all of them (the tests fill the
whole chart with all splits): a conversation of n turns has about 2 n cells.

Rows are dealt by ranges of (conversation, turn), so that a conversation longer than a task's share is parsed in blocks
whose cells are combined afterwards. Only the first and the last conversation of a range can be cut; all others are done
where they lie, and those few are parsed again in a second pass.
"""

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema as _arrow
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .shared import FORGET, SPACES, fixed

START, SYSTEM, USER, ASSISTANT = range(4)
#: (state, first letter of a role) -> state; a repaired conversation ends in one of ``ENDS``.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
ENDS = (START, ASSISTANT)
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}
STOPS = ".!?"
ROLES = {"u": "user", "a": "assistant"}


def _smaller(cells, key, cost, audit):
    if key not in cells or (cost, audit) < cells[key]:
        cells[key] = (cost, audit)


def join(left, right):
    """Cells of a span from those of its two parts."""
    cells = {}
    for (p, r), (cost, audit) in left.items():
        for (r2, q), (more, rest) in right.items():
            if r == r2:
                _smaller(cells, (p, q), cost + more, audit + rest)
    return cells


def _inserted():
    """Cells of no turns at all: the fewest insertions from state to state."""
    cells = {(p, p): (0, "") for p in range(4)}
    for (p, letter), q in STEPS.items():
        if letter in ROLES:
            _smaller(cells, (p, q), INSERT, "I")
    for _ in range(2):
        cells = join(cells, cells)
    return cells


NOTHING = _inserted()


@lru_cache(maxsize=None)
def turn_cells(kind):
    """Cells of one turn. Its kind is the first letter of its role (``?``: any other) and ``-`` for a turn that must go,
    ``~`` for an unfinished one, ``+`` for the others."""
    letter, fault = kind
    cells = {(p, p): (DELETE, "D") for p in range(4)}
    if fault != "-":
        more = UNFINISHED if fault == "~" else 0
        for (p, step), q in STEPS.items():
            if step == letter:
                _smaller(cells, (p, q), more, "K")
            if step in ROLES:
                _smaller(cells, (p, q), more + REROLE, "R")
    return join(join(NOTHING, cells), NOTHING)


def parse(cells):
    """Cells of a whole span from those of its turns: spans of length 1 are combined to 2, 4, 8, ..."""
    while len(cells) > 1:
        cells = [join(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else NOTHING


def cheapest(cells):
    """(cost, audit) of the whole conversation."""
    return min(cells[START, q] for q in ENDS if (START, q) in cells)


@lru_cache(maxsize=1 << 16)
def _short(kinds):
    return cheapest(parse([turn_cells(k) for k in kinds]))


FORGET.append(_short.cache_clear)


def repair(kinds):
    """(cost, audit) for the kinds of a conversation's turns; short sequences, which recur, are remembered."""
    return _short(tuple(kinds)) if len(kinds) <= 16 else cheapest(parse([turn_cells(k) for k in kinds]))


def fault_of(text):
    """``blank``, ``truncated`` or None."""
    end = text.rstrip(SPACES)
    return "blank" if not end else None if end[-1] in STOPS else "truncated"


def _letter(role):
    return role[:1] if role[:1] in ("s", "u", "a") else "?"


def _kind(role, fault):
    return _letter(role) + {"blank": "-", "duplicate": "-", "truncated": "~"}.get(fault, "+")


def applied(audit, rows):
    """(edit, role, text, row) for each letter of the audit; rows are (role, text, ...) in order, role is None where deleted.

    The number of turns left tells their roles: an odd number starts with the system's, the others alternate.
    """
    left = len(audit) - audit.count("D")
    at, rows = -(left % 2), iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(rows)
        if edit == "D":
            yield edit, None, row[1], row
            continue
        role = row[0] if edit == "K" else ROLES["ua"[at % 2]]
        yield edit, role, "" if row is None else row[1], row
        at += 1


class Counts:
    """Counts over a run of turns in order; runs can be added from left to right."""

    FIELDS = ("turns", "blank", "duplicate", "truncated", "illegal", "distinct", "low", "high", "first", "last")

    def __init__(self):
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role, fault, times=1):
        initial = role[:1]
        if self.turns:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.illegal += (times - 1) * (initial + initial not in LEGAL)
        self.last = initial
        self.turns += times
        if fault == "blank":
            self.blank += times
        else:
            self.duplicate += times - 1 if fault != "duplicate" else times
            self.truncated += fault == "truncated"
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def extend(self, other):
        """Counts of this run and of the one after it."""
        if not other.turns:
            return
        self.illegal += other.illegal + (bool(self.turns) and self.last + other.first not in LEGAL)
        self.first = self.first if self.turns else other.first
        self.last = other.last
        self.turns += other.turns
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        if other.low is not None:
            self.distinct += other.distinct - (other.low == self.high)
            self.low, self.high = other.low if self.low is None else self.low, other.high

    def report(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return self.turns, gaps, self.blank, self.duplicate, self.truncated, self.illegal


_REPORT = ["turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_EDITS = ["step", "edit", "position", "turn", "role", "text"]
_LONG = {"turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "step", "position", "turn"}


def _schema(conv_type, names, cut=False):
    fields = [StructField("conv_id", conv_type)] + [StructField(n, LongType() if n in _LONG else StringType()) for n in names]
    return StructType(fields + [StructField("_cut", BooleanType())] * cut)


def _rows(batches):
    """The rows of record batches as tuples, one batch at a time."""
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _sent(rows, schema, size=1000):
    """Record batches of tuples; a batch closes by number or by length of its texts."""
    held, length = [], 0
    for row in rows:
        held.append(row)
        length += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or length > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, length = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _results(conv, counts, cost, audit, rows, edits):
    """The report's row of a conversation, or with ``edits`` a row for every letter of its audit."""
    if edits:
        at = 0
        for step, (edit, role, text, row) in enumerate(applied(audit, rows)):
            yield (conv, step, edit, None if role is None else at, row and row[2], role or row[0], text)
            at += role is not None
        return
    digest, between = hashlib.sha256(), b""
    for _, role, text, _ in applied(audit, rows):
        if role is not None:
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
    yield (conv, *counts.report(), cost, audit, digest.hexdigest())


def _whole(conv, rows, edits):
    """Parses one conversation that lies whole in memory; rows are (role, text, turn, digest, copies)."""
    counts, kinds, listed, seen = Counts(), [], [], set()
    for role, text, turn, digest, copies in rows:
        for _ in range(copies):
            fault = fault_of(text)
            if fault != "blank" and (role, digest) in seen:
                fault = "duplicate"
            seen.add((role, digest))
            counts.add(turn, role, fault)
            kinds.append(_kind(role, fault))
            listed.append((role, text, turn))
    cost, audit = repair(kinds)
    return _results(conv, counts, cost, audit, listed, edits)


def _first_pass(schema, edits):
    """Repairs the conversations within a range; of its first and last one only the id is given, marked as cut."""

    def run(batches):
        def results():
            cut = (None,) * (len(schema.names) - 2) + (True,)
            number, last = 0, None
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                number += 1
                if number == 1:  # may have begun in the range before: none of its rows is kept
                    yield (conv, *cut)
                    for _ in rows:
                        pass
                    continue
                if last is not None:
                    yield from (r + (False,) for r in _whole(*last, edits))
                last = (conv, [r[1:] for r in rows])
            if last is not None:  # may go on in the next range
                yield (last[0], *cut)

        yield from _sent(results(), schema)

    return run


_CELL = StructType().add("p", LongType()).add("q", LongType()).add("cost", LongType()).add("audit", StringType())


def _block_pass(schema):
    """Cells and counts of each conversation's turns within a range."""

    def run(batches):
        part = TaskContext.get().partitionId()

        def blocks():
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                counts, cells = Counts(), []
                for _, turn, role, _, copies, blank, unfinished, first in rows:
                    if not copies:
                        continue
                    fault = "blank" if blank else "duplicate" if not first else "truncated" if unfinished else None
                    counts.add(turn, role, fault, copies)
                    cells.append(turn_cells(_kind(role, fault)))
                    cells.extend([turn_cells(_kind(role, "duplicate"))] * (copies - 1))
                chart = parse(cells) if cells else NOTHING
                held = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in chart.items()]
                yield (conv, part, *[getattr(counts, f) for f in Counts.FIELDS], held)

        yield from _sent(blocks(), schema, size=64)

    return run


def _joined_pass(schema):
    """(conversation, cost, audit, counts) from its blocks in order."""

    def run(batches):
        def wholes():
            for conv, blocks in groupby(_rows(batches), key=lambda r: r[0]):
                counts, charts = Counts(), []
                for _, _, *fields, held in blocks:
                    block = Counts()
                    for name, value in zip(Counts.FIELDS, fields):
                        setattr(block, name, value)
                    counts.extend(block)
                    charts.append({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in held})
                cost, audit = cheapest(parse(charts))
                yield (conv, *[getattr(counts, f) for f in Counts.FIELDS], cost, audit)

        yield from _sent(wholes(), schema, size=64)

    return run


def _last_pass(schema, edits):
    """Applies the audit, which comes first, to a conversation's rows as they stream by."""

    def run(batches):
        def results():
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                _, _, _, _, _, _, _, cost, audit, *fields = next(rows)
                counts = Counts()
                for name, value in zip(Counts.FIELDS, fields):
                    setattr(counts, name, value)
                turns = ((r[3], r[5], r[2]) for r in rows for _ in range(r[6]))
                yield from _results(conv, counts, cost, audit, turns, edits)

        yield from _sent(results(), schema)

    return run


def _cut_ones(rows, cut, schema, edits):
    """The conversations of ``cut``, parsed in blocks."""
    conv_type = rows.schema["conv_id"].dataType
    rows = rows.join(F.broadcast(cut), rows["conv_id"].eqNullSafe(cut["_id"]), "left_semi")
    trimmed = F.rtrim("text", F.lit(SPACES))
    key = ["conv_id", "turn", "role", "digest"]
    alike = rows.groupBy(*key).agg(
        F.sum("copies").alias("copies"),
        F.bool_or(trimmed == "").alias("blank"),
        F.bool_or(~F.right(trimmed, F.lit(1)).isin(*STOPS)).alias("unfinished"),
    )
    # A text's first place is marked on the row there; both meet in one aggregate, without a join.
    place = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("at")
    first = alike.where("copies > 0").groupBy("conv_id", "role", "digest").agg(place)
    nothing = [F.lit(0).cast("long").alias("copies"), F.lit(False).alias("blank"), F.lit(False).alias("unfinished")]
    marks = first.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", *nothing, F.lit(True).alias("first"))
    marked = alike.withColumn("first", F.lit(False)).unionByName(marks).groupBy(*key)
    marked = marked.agg(F.sum("copies").alias("copies"), *[F.bool_or(c).alias(c) for c in ("blank", "unfinished", "first")])
    counts = [StructField(f, StringType() if f in ("first", "last") else LongType()) for f in Counts.FIELDS]
    numbered = StructType([StructField("conv_id", conv_type), StructField("part", LongType())])
    blocks = StructType(numbered.fields + counts + [StructField("cells", ArrayType(_CELL))])
    parsed = marked.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_block_pass(_arrow(blocks)), blocks)
    wholes = StructType([numbered.fields[0]] + counts + [StructField("cost", LongType()), StructField("audit", StringType())])
    parsed = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_joined_pass(_arrow(wholes)), wholes)
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    heads = parsed.select(
        "conv_id", F.lit(0).alias("_row"), none("turn", "long"), none("role", "string"), none("digest", "binary"), none("text", "string"),
        none("copies", "long"), "cost", "audit", *Counts.FIELDS,
    )
    bodies = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("_row"), "turn", "role", "digest", "text", "copies", none("cost", "long"), none("audit", "string"),
        *[none(f.name, f.dataType) for f in counts],
    )
    stream = heads.union(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "_row", "turn", "role", "digest")
    return stream.mapInArrow(_last_pass(_arrow(schema), edits), schema)


def _repaired(turns, copies, edits):
    blank = lambda name: F.coalesce(F.col(name), F.lit(" "))
    copies = F.lit(1) if copies is None else F.col(copies)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), copies.cast("long").alias("copies"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    key = ["conv_id", "turn", "role", "digest"]
    conv_type, names = rows.schema["conv_id"].dataType, _EDITS if edits else _REPORT
    marked = _schema(conv_type, names, cut=True)
    # The row's number makes equal keys different, so that many equal rows can lie in several ranges.
    ordered = rows.withColumn("_number", F.monotonically_increasing_id()).repartitionByRange(*key, "_number").sortWithinPartitions(*key)
    ordered = ordered.select("conv_id", "role", "text", "turn", "digest", "copies")
    done = fixed(ordered.mapInArrow(_first_pass(_arrow(marked), edits), marked))
    cut = done.where("_cut").select(F.col("conv_id").alias("_id")).distinct()
    return done.where("NOT _cut").drop("_cut").union(_cut_ones(rows, cut, _schema(conv_type, names), edits))


def repair_conversations(turns, copies=None):
    """One row per conv_id: turns, gaps, blank, duplicate, truncated, illegal, cost (longs), audit, repaired_sha256.

    ``turns`` has conv_id, turn, role, text; other columns are not looked at. Turns of a conversation are taken by turn,
    nulls first, equal ones by role and the SHA-256 of their text. A null role or text is one space. The column named by
    ``copies`` tells how often a row stands there (default: once); rows of 0 only name their conversation, and one of
    nothing else has zeros, an empty audit and the empty string's hash. Null conv_ids are one conversation. Repeated rows
    are duplicates; an empty table gives no rows.

    Each turn's first fault counts: blank, duplicate (role and text seen earlier), truncated (no ``.!?`` at its end).
    Edits are K (keep, 0), R (other role, 3), D (delete, 4; a must for blank and duplicate turns) and I (insert an empty
    turn, 3); an unfinished turn that stays adds 3. Of the cheapest edits the least audit is taken.

    A conversation cut by ranges is parsed in blocks. Its SHA-256, which nothing can compute in parts, is taken from a
    stream of its turns through one task, without holding them.
    """
    return _repaired(turns, copies, edits=False)


def repaired_turns(turns, copies=None):
    """The edits themselves, in order: conv_id, step, edit, position (among the turns left; null: deleted), turn (null:
    inserted), role and text (repaired; those of a deleted turn as they were). See :func:`repair_conversations`."""
    return _repaired(turns, copies, edits=True)
