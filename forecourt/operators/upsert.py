"""Keyed upserts as DataFrame compositions, for tables whose format has no row-level MERGE."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_known, fail_unless
from ..schema import LABEL, LISTING_ID
from ..staging import stage

#: Slots that key hashes are dealt to where two large frames are held against each other, in words of 64: a map of
#: 16 MB at most, whatever the frames.
_WORDS = 1 << 20
#: Bytes, by Catalyst's estimate, up to which two frames are moved whole rather than read twice.
_MOVED = 256 << 20


def unique_source(source: DataFrame, keys) -> DataFrame:
    """The source, failing at run time when a key occurs twice (the matched row would be ambiguous).

    The check is a scalar subquery that counts the key columns only, with map-side partial counts.
    """
    repeated = source.where(all_known(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    worst = repeated.agg(F.max("n")).scalar()
    return source.where(fail_unless(F.coalesce(worst, F.lit(0)) <= 1, f"upsert source repeats a key of {list(keys)}"))


def upsert(target: DataFrame, source: DataFrame, keys, update_cols=None, checked=True) -> DataFrame:
    """The new content of ``target`` after merging ``source`` on ``keys``.

    Without ``update_cols`` a matched row is replaced as a whole; with it only those columns change and every other
    column keeps its stored value. Unmatched source rows are inserted. NULL keys match nothing. ``checked=False`` skips
    the duplicate-key check for a source that is unique by construction.
    """
    keys = list(keys)
    if update_cols is not None and not _broadcast_by_estimate(source):
        large = _estimate(target) + _estimate(source) > _MOVED
        return (_large_update if large else _outer)(target, source.select(*target.columns), keys, update_cols, checked)
    if checked:
        source = unique_source(source, keys)
    source = source.select(*target.columns)
    if update_cols is None:
        return target.join(source.select(*keys), keys, "left_anti").select(*target.columns).unionByName(source)

    # Left, semi and anti joins all take the increment as their broadcast side, so the stored table stays where it is.
    rows, given = _with_changes(target, source, keys, "left")
    kept = rows.select(*[_merged(c, given, c in update_cols) for c in target.columns])
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return kept.unionByName(source.join(known, keys, "left_anti").select(*target.columns))


def _with_changes(target, source, keys, how):
    """The stored rows joined to the increment's, which are in the column ``_new``, and whether a row has one."""
    changes = source.select(*[F.col(c).alias(f"_{c}") for c in keys], F.struct(*source.columns).alias("_new"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in keys])
    return target.join(changes, same, how), F.col("_new").isNotNull()


def _merged(c, taken, changes=True):
    """Column ``c`` of a joined row: the increment's where ``taken`` holds and the column changes, else the stored one."""
    return (F.when(taken, F.col("_new")[c]).otherwise(F.col(c)) if changes else F.col(c)).alias(c)


def _large_update(target, source, keys, update_cols, checked):
    """A partial update of a large table by an increment too large to broadcast.

    Hashes of the keys are moved first, eight bytes a row: they tell which rows may meet one of the other frame, or of
    their own in the increment. Only those rows are moved, to one full outer join; all others stay where they are. The
    hashes that met are kept as a map of bits, so a few other rows move along. Where it is more than half full, most
    rows meet, and all of them are moved without another pass.
    """
    old, new = [df.where(all_known(keys)).select(F.xxhash64(*keys).alias("_hash")) for df in (target, source)]
    sides = old.withColumn("_fresh", F.lit(False)).unionByName(new.withColumn("_fresh", F.lit(True)))
    both = sides.groupBy("_hash").agg(F.count_if("_fresh").alias("_n"), F.bool_and("_fresh").alias("_alone"))
    met = both.where((F.col("_n") > 1) | ((F.col("_n") > 0) & ~F.col("_alone"))).select(*_place(F.col("_hash")))
    words = stage(met.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))).alias("_bits")))
    filled = words.agg(F.sum(F.bit_count("_bits"))).first()[0] or 0
    if filled > _WORDS * 32:
        return _outer(target, source, keys, update_cols, checked)

    def parted(df):
        """The rows of ``df`` that stay, and those that may meet another."""
        placed = df.select("*", *_place(F.xxhash64(*keys)))
        known = placed.join(F.broadcast(words), "_word", "left")
        hit = F.coalesce(F.expr("shiftrightunsigned(_bits, _bit) & 1L") == 1, F.lit(False)) & all_known(keys)
        return [known.where(rows).select(*df.columns) for rows in (~hit, hit)]

    (kept, old), (added, new) = parted(target), parted(source)
    return kept.unionByName(added).unionByName(_outer(old, new, keys, update_cols, checked))


def _place(key_hash):
    """The word of the map and the bit in it that belong to a hash."""
    return [F.pmod(key_hash, F.lit(_WORDS)).alias("_word"), F.pmod(F.shiftright(key_hash, 32), F.lit(64)).cast("int").alias("_bit")]


def _outer(target, source, keys, update_cols, checked):
    """The stored table and the increment, each read and moved once, by one full outer join."""
    if checked:
        source = unique_source(source, keys)
    rows, given = _with_changes(target.withColumn("_stored", F.lit(True)), source.select(*target.columns), keys, "full")
    inserted = F.col("_stored").isNull()
    return rows.select(*[_merged(c, given if c in update_cols else inserted) for c in target.columns])


def _broadcast_by_estimate(df):
    """Whether Catalyst's own estimate of ``df`` lets it be a join's broadcast side."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return _estimate(df) <= limit


def _estimate(df):
    """Catalyst's own estimate of the bytes of ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def newest_rows(target: DataFrame, source: DataFrame, keys, order) -> DataFrame:
    """One row per key of both frames: the newest by ``order``, that of ``source`` where they tie. Combines on the map side."""
    rest = [c for c in target.columns if c not in keys]
    sides = target.withColumn("_late", F.lit(0)).unionByName(source.select(*target.columns).withColumn("_late", F.lit(1)))
    newest = F.max_by(F.struct(*rest), F.struct(F.col(order), F.col("_late")))
    return sides.groupBy(*keys).agg(newest.alias("_row")).select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in target.columns])


def backfill_labels(predictions: DataFrame, listings: DataFrame, key=LISTING_ID, label=LABEL) -> DataFrame:
    """Fills unknown labels of predictions, of every model version, from listings that have one by now.

    A label once set is never changed and no row is added. Rows that already carry a label, and open ones without an id,
    pass through plain filters; the others are joined to one label per listing, looked up for their ids only. A listing
    with two labels that an open prediction waits for is ambiguous and fails.
    """
    waiting = predictions.where(F.col(label).isNull() & F.col(key).isNotNull())
    labels = (
        listings.where(F.col(label).isNotNull())
        .join(waiting.select(key).distinct(), key, "left_semi")
        .groupBy(key)
        .agg(F.max(label).alias("_label"), F.count("*").alias("_n"))
        .select(
            key,
            F.when(fail_unless(F.col("_n") == 1, "two labels for one listing"), F.col("_label")).alias("_label"),
        )
    )
    done = predictions.where(F.col(label).isNotNull() | F.col(key).isNull())
    filled = (
        waiting.join(labels, key, "left")
        .select(*[F.col("_label").alias(c) if c == label else c for c in predictions.columns])
    )
    return done.unionByName(filled)


def same_key(left, right, keys):
    """Equality of all keys, for a catalog MERGE condition."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])
