"""Quality rules: base rules, then a decision list learned from labelled documents.

Sequential covering grows one conjunction of thresholds after the other against the rejected class, on two thirds of the
labelled rows, and prunes each on the rest. The list becomes one ordered Spark conditional expression over the
statistics of a text, so applying it is a projection.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import binary_column, by_place, drawn, fixed, forget

#: A text fails with fewer words, or with a larger percentage of its words in repeated windows of five.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = [c.encode() for c in "#*$%&|<>"]
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_POINTS = b"!\"'(),-./:;?@[\\]^_`{}~"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_distinct", "n_capitals", "n_digits", "n_points"]
#: What the rules may look at: shares, so that a text's length alone decides nothing.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "point_share": ("n_points", "word_chars"),
}


def repeated_words(words, window=WINDOW):
    """Number of words that lie in some ``window``-word string which occurs twice or more."""
    grams = list(zip(*[words[i:] for i in range(window)]))
    if len(set(grams)) == len(grams):
        return 0
    first, repeated = {}, np.zeros(len(words) + 1, np.int64)
    for i, gram in enumerate(grams):
        j = first.setdefault(gram, i)
        if j != i:
            for k in (i, j):
                repeated[k : k + window] = 1
    return int(repeated.sum())


def text_counts(text):
    """The counts COUNTS + MORE of a UTF-8 text; words are what ASCII white space parts."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()] if words else []
    kept = b"".join(words)
    chars = len(kept.decode())

    def of(chosen):
        return len(kept) - len(kept.translate(None, chosen))

    return (
        len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), len(set(words)), of(_CAPITALS), of(_DIGITS), of(_POINTS),
    )


def _counted(batches):
    forget()
    for batch in batches:
        counts = [text_counts(t) for t in binary_column(batch, "text")]
        columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * len(COUNTS + MORE)
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *COUNTS, *MORE])


def quality_counts(docs, id_col="doc_id", text_col="text"):
    """doc_id and the counts of each text; a null text has no words."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_counted, "doc_id long, " + ", ".join(f"{c} long" for c in [*COUNTS, *MORE]))


def base_failed():
    """The base rules on the counts."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _features():
    return {name: F.col(a) / F.greatest(F.col(b), F.lit(1)) for name, (a, b) in FEATURES.items()}


@dataclass(frozen=True)
class FitLimits:
    """How the list is learned. ``rows`` bounds the labelled rows that are fetched for it, chosen by a hash of their id."""

    rows: int = 20_000
    thresholds: int = 48
    conditions: int = 4
    rules: int = 12
    least_rejected: int = 8
    least_precision: float = 0.95


def _covered(x, rule):
    hit = np.ones(len(x), bool)
    for feature, above, threshold in rule:
        hit &= x[:, feature] > threshold if above else x[:, feature] <= threshold
    return hit


def _grown(x, bad, limits):
    """Conditions added one by one for the largest information gain, until no kept row is covered."""
    rule, hit = [], np.ones(len(x), bool)
    while len(rule) < limits.conditions and (~bad & hit).any():
        p, n = (bad & hit).sum(), (~bad & hit).sum()
        best = (1e-9, None)
        for feature in range(x.shape[1]):
            values = x[hit, feature]
            for threshold in np.unique(np.quantile(values, np.linspace(0, 1, limits.thresholds), method="lower")):
                for above in (True, False):
                    side = values > threshold if above else values <= threshold
                    p1 = (side & bad[hit]).sum()
                    n1 = side.sum() - p1
                    if p1 and side.sum() < len(values):
                        gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        best = max(best, (gain, (feature, above, float(threshold))), key=lambda b: b[0])
        if best[1] is None:
            break
        rule.append(best[1])
        hit = _covered(x, rule)
    return rule


def _worth(x, bad, rule):
    hit = _covered(x, rule)
    p, n = (bad & hit).sum(), (~bad & hit).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn_list(x, bad, limits=FitLimits()):
    """Rules (lists of (feature, above, threshold)) that reject; the first that holds decides, none keeps."""
    prune = np.arange(len(x)) % 3 == 2
    left, rules = np.ones(len(x), bool), []
    while len(rules) < limits.rules and (bad & left).sum() >= limits.least_rejected:
        grow = _grown(x[left & ~prune], bad[left & ~prune], limits)
        choices = [grow[:k] for k in range(len(grow), 0, -1)]
        if not choices:
            break
        rule = max(choices, key=lambda r: _worth(x[left & prune], bad[left & prune], r))
        hit = left & _covered(x, rule)
        if (bad & hit).sum() < limits.least_rejected or (bad & hit).sum() < limits.least_precision * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def as_expression(rules):
    """The list as an ordered Spark conditional: true keeps."""
    names, features = list(FEATURES), _features()
    verdict = None
    for rule in rules:
        holds = F.lit(True)
        for feature, above, threshold in rule:
            value = features[names[feature]]
            holds = holds & (value > threshold if above else value <= threshold)
        verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def as_text(rules):
    """The list in words, one line per rule."""
    names = list(FEATURES)
    lines = [" and ".join(f"{names[f]} {'>' if above else '<='} {t:.6g}" for f, above, t in rule) for rule in rules]
    return "\n".join([f"reject if {line}" for line in lines] + ["keep"])


def fit_list(counts, labels, id_col="doc_id", label_col="quality", limits=FitLimits()):
    """Learns the list from labelled documents (label 0 rejects, 1 keeps) of which at most ``limits.rows`` are fetched.

    Rows that fail the base rules, null ids and null labels are left out; without labels of both kinds nothing is
    rejected.
    """
    labelled = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("label in (0, 1)")
    rows = counts.where(~base_failed()).join(labelled, "doc_id")
    rows = rows.select(F.xxhash64("doc_id").alias("draw"), "doc_id", "label", *[c.alias(n) for n, c in _features().items()])
    sample = np.array(drawn(rows, "draw", limits.rows).drop("draw", "doc_id").collect(), dtype=float)
    if len(sample) == 0:
        return []
    return learn_list(sample[:, 1:], sample[:, 0] == 0, limits)


def judge_quality(docs, labels, id_col="doc_id", text_col="text", label_col="quality", limits=FitLimits()):
    """One row per document: doc_id, the base counts, base_failed and kept.

    A null or empty text has no words and fails. Repeated rows each give a row; a null id is judged like any other. An
    empty table gives no rows; other columns are not looked at.
    """
    counts = fixed(quality_counts(docs, id_col, text_col))
    verdict = as_expression(fit_list(counts, labels, id_col, label_col, limits))
    return counts.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & verdict).alias("kept")
    )


@by_place
def drop_low_quality(docs, labels, id_col="doc_id", text_col="text", label_col="quality", limits=FitLimits(), label_id_col="doc_id"):
    """``docs`` without the documents that :func:`judge_quality` rejects.

    The list is learned from counts without texts; for the verdict they are taken once more beside each row, so no text
    is shuffled.
    """
    rules = fit_list(fixed(quality_counts(docs, id_col, text_col)), labels, label_id_col, label_col, limits)
    names = docs.columns

    def counted(batches):
        forget()
        for batch in batches:
            counts = [text_counts(t) for t in binary_column(batch, text_col)]
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] or [pa.array([], pa.int64())] * len(COUNTS + MORE)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(columns, COUNTS + MORE)], [*names, "_counts"])

    fields = ", ".join(f"{c}: long" for c in [*COUNTS, *MORE])
    schema = docs.withColumn("_counts", F.lit(None).cast(f"struct<{fields}>")).schema
    measured = docs.mapInArrow(counted, schema)
    hidden = measured.select(F.struct(*[F.col(c) for c in names]).alias("_row"), "_counts.*")
    return hidden.where(~base_failed() & as_expression(rules)).select("_row.*")
