"""Document fingerprints of closed syncmers, with DataFrame functions only.

A text's tokens are its runs of characters without white space, cut at 16, and single characters of the scripts that write
without blanks. Of its windows of 8 tokens (k-mers) those are chosen whose smallest inner pair of tokens (s-mer), by hash,
is the first or the last of the window's 7 pairs. Whether a window is chosen depends on its own tokens alone, so equal
passages choose equal windows wherever they stand, and among any 7 windows in a row at least one is chosen. The
fingerprint is the chosen windows in the order of the text, each an anchor of hash and position.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

#: Tokens of a k-mer and of an s-mer.
WINDOW, INNER = 8, 2
#: White space is ASCII; U+2E80 to U+D7FF are the scripts without blanks (and some beside them).
TOKEN = r"[\x{2E80}-\x{D7FF}]|[^\x20\x09-\x0D\x{2E80}-\x{D7FF}]{1,16}"
#: Parts of an id that holds so many rows that it lies over several buckets.
PARTS = 64


def _bound(value, use):
    """``use`` of a value that is computed once, however often ``use`` reads it for the elements of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pairs(tokens):
    return F.zip_with(F.slice(tokens, 1, F.size(tokens) - 1), F.slice(tokens, 2, F.size(tokens) - 1), lambda a, b: F.xxhash64(a, b))


def _chosen(pairs):
    inner = WINDOW - INNER + 1
    windows = F.transform(
        F.sequence(F.lit(1), F.size(pairs) - inner + 1), lambda i: F.struct((i - 1).alias("at"), F.slice(pairs, i, inner).alias("pairs"))
    )
    edge = lambda w: F.array_min(w["pairs"]).isin(F.element_at(w["pairs"], 1), F.element_at(w["pairs"], -1))
    return F.transform(F.filter(windows, edge), lambda w: F.struct(F.hash(w["pairs"]).alias("hash"), w["at"].alias("at")))


def anchors(text):
    """Column: the closed syncmers of a text, array of (hash int, at int: the first token's place, from 0), in order.

    A text of fewer than 8 tokens is one anchor as a whole, one without tokens none; null is an empty text.
    """
    names = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0)
    none = F.array().cast("array<struct<hash:int,at:int>>")
    whole = lambda t: F.array(F.struct(F.hash(t).alias("hash"), F.lit(0).alias("at")))
    return _bound(
        F.transform(names, lambda w: F.xxhash64(w)),
        lambda t: F.when(F.size(t) >= WINDOW, _bound(_pairs(t), _chosen)).when(F.size(t) > 0, whole(t)).otherwise(none),
    )


def fingerprint(found):
    """Column: anchors as a string, 8 hex digits each."""
    digits = lambda a: F.substring(F.lower(F.hex(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(1 << 32))), 2, 8)
    return F.array_join(F.transform(found, digits), "")


def likeness(a, b):
    """Column: Dice similarity of two fingerprints' distinct hashes, 0 to 1; two empty ones are alike."""
    a, b = F.transform(a, lambda x: x["hash"]), F.transform(b, lambda x: x["hash"])
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a, b)) / total)


def matches(a, b):
    """Column: pairs of places (at, other) of the anchors that two fingerprints share and that stand once in each.

    Where texts share a passage, other - at is the same all along it.
    """
    once = lambda found: F.filter(found, lambda x: F.size(F.filter(found, lambda y: y["hash"] == x["hash"])) == 1)
    paired = lambda left, right: F.flatten(
        F.transform(
            left,
            lambda x: F.transform(
                F.filter(right, lambda y: y["hash"] == x["hash"]), lambda y: F.struct(x["at"].alias("at"), y["at"].alias("other"))
            ),
        )
    )
    return _bound(once(a), lambda left: _bound(once(b), lambda right: paired(left, right)))


def fingerprints(docs, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, anchors, fingerprint. Null texts are empty; other columns are not looked at."""
    rows = docs.select(F.col(id_col).alias("doc_id"), anchors(F.col(text_col)).alias("anchors"))
    return rows.select("*", fingerprint(F.col("anchors")).alias("fingerprint"))


def _buckets(rows, n):
    """``rows`` (doc_id, text, tie) with b1, b2, in the order of (doc_id, tie): ranges of about equal numbers of rows.

    An id that fills a range is dealt by tie, and rows that are equal beyond that are one row with its number of copies.
    """
    shares = [k / n for k in range(1, n)]
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("doc_id", shares, 10_000).alias("bounds")).first()
    bounds = got.bounds or []
    hot = sorted({a for a, b in zip(bounds, bounds[1:]) if a == b})
    heavy = F.col("doc_id").isNull()
    if hot:
        heavy = heavy | F.col("doc_id").isin(*hot)
    key = ["doc_id", "tie"]
    many = rows.where(heavy).groupBy(*key).count().where(F.col("count") > got.n / n)
    many = many.select(*[F.col(c).alias(f"_{c}") for c in key], F.lit(True).alias("_many"))
    # At most n keys hold more than the n-th part of the rows.
    here = rows["doc_id"].eqNullSafe(many["_doc_id"]) & (rows["tie"] == many["_tie"])
    found = rows.join(F.broadcast(many), here, "left").select("doc_id", "text", "tie", "_many")
    one = found.where("_many").groupBy(*key, F.sha2("text", 256)).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    found = found.where("_many IS NULL").select("doc_id", "text", "tie", F.lit(1).cast("long").alias("copies"))
    found = found.union(one.select("doc_id", "text", "tie", "copies"))
    below = F.size(F.filter(F.lit(sorted(set(bounds))).cast("array<long>"), lambda b: b < F.col("doc_id"))) if bounds else F.lit(0)
    inside = F.when(F.col("doc_id").isin(*hot), 1).otherwise(0) if hot else F.lit(0)
    b1 = F.when(F.col("doc_id").isNull(), -1).otherwise(2 * below + inside)
    return found.select("*", b1.alias("b1"), F.when(heavy, F.shiftright("tie", 58)).otherwise(0).cast("long").alias("b2"))


def _followed(rows, buckets):
    """``rows`` (doc_id, text, copies, tie, b1, b2, anchors) with the next row's text and anchors; the last one's next is the first.

    A bucket's first row is lent to the bucket before, where it comes last.
    """
    session = rows.sparkSession
    firsts = buckets.groupBy("b1", "b2").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tie")).alias("first"))
    firsts = sorted(firsts.collect(), key=lambda r: (r.b1, r.b2))  # one row per bucket
    lent = [(r.b1, r.b2, r.first.doc_id, r.first.tie, p.b1, p.b2) for p, r in zip(firsts[-1:] + firsts, firsts)]
    lent = session.createDataFrame(lent, "_b1 int, _b2 long, _doc_id long, _tie long, to1 int, to2 long")
    here = (rows["b1"] == lent["_b1"]) & (rows["b2"] == lent["_b2"]) & (rows["tie"] == lent["_tie"]) & rows["doc_id"].eqNullSafe(lent["_doc_id"])
    rows = rows.join(F.broadcast(lent), here, "left")
    place = lambda b1, b2, guest: F.struct(F.col(b1).alias("b1"), F.col(b2).alias("b2"), F.lit(guest).alias("guest"))
    places = F.filter(F.array(place("b1", "b2", False), F.when(F.col("to1").isNotNull(), place("to1", "to2", True))), lambda p: p.isNotNull())
    rows = rows.select("doc_id", "text", "copies", "tie", "anchors", F.explode(places).alias("at"))
    rows = rows.select("doc_id", "text", "copies", "tie", "anchors", "at.b1", "at.b2", "at.guest")
    w = Window.partitionBy("b1", "b2").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    rows = rows.select("*", F.lead("text").over(w).alias("next_text"), F.lead("anchors").over(w).alias("next_anchors")).where("NOT guest")
    # All copies but the last are followed by one of themselves.
    run = lambda n, text, found: F.struct(n.cast("long").alias("n"), text.alias("text"), found.alias("anchors"))
    own = F.when(F.col("copies") > 1, run(F.col("copies") - 1, F.col("text"), F.col("anchors")))
    runs = F.filter(F.array(own, run(F.lit(1), F.col("next_text"), F.col("next_anchors"))), lambda r: r.isNotNull())
    rows = rows.select("doc_id", "text", "anchors", F.explode(runs).alias("next"))
    return rows.select("doc_id", "text", "anchors", F.col("next.n").alias("n"), F.col("next.text").alias("next_text"), F.col("next.anchors").alias("next_anchors"))


def edited_likeness(docs, id_col="doc_id", text_col="text"):
    """How alike fingerprints stay when a quarter of a text is replaced, and how alike those of neighbours are.

    One row per document: doc_id, n_chars (long, code points), edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has the first floor(n_chars / 4) code points of the next document, or all if it has fewer, in
    place of as many at its end. Documents follow each other by doc_id, nulls first, equal ids by the texts' XXH64; after
    the last comes the first, so that a single document follows itself. A null text is empty. Repeated rows each give a
    row; an empty table gives none; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _buckets(rows, n)
    rows = _followed(dealt.withColumn("anchors", anchors(F.col("text"))), dealt)
    n_chars, quarter = F.length("text"), (F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("doc_id", "n", n_chars.cast("long").alias("n_chars"), edited.alias("edited"), "anchors", "next_anchors")
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited")))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
        "n",
    )
    # A run of n copies becomes n rows by way of two short arrays.
    runs = F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / 4096).cast("int"))).alias("_run")
    rows = rows.select("*", runs)
    within = F.explode(F.sequence(F.lit(1), F.least(F.lit(4096), F.col("n") - 4096 * F.col("_run")).cast("int"))).alias("_copy")
    return rows.select("*", within).drop("n", "_run", "_copy")
