"""Join helpers: broadcast only behind a size check, and null-key spreading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimension rows and bytes of text we are willing to ship to every executor.
# A row of the projected dimensions used here is a key plus a handful of
# fields; the text of all of them together is counted.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_TEXT = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, rows_of: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows and little text.

    The bytes of its text columns are summed by the same job and may reach
    :data:`DEFAULT_BROADCAST_TEXT`.

    ``rows_of`` may name a cheaper frame with at least as many rows as
    ``df`` (for instance the table that ``df`` is a one-row-per-row
    projection of); its count is then the bound.

    The check is a plain distributed ``count()`` (partial counts per task,
    one row shuffled each) over the projected dimension.  A ``limit`` would
    funnel rows through a single task instead.  Beyond the bound the frame is
    returned unchanged and the planner falls back to a shuffle join (AQE may
    still convert it at run time from measured shuffle sizes).
    """
    counted = df if rows_of is None else rows_of
    texts = [f.name for f in counted.schema.fields if isinstance(f.dataType, T.StringType)]
    text = sum((F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in texts), F.lit(0))
    rows, size = counted.agg(F.count(F.lit(1)), text).first()
    return F.broadcast(df) if rows <= max_rows and size <= DEFAULT_BROADCAST_TEXT else df


#: Keys whose counts the frequent-keys sketch follows, and how many of them may be called hot.
SKETCH_KEYS = 10_000
HOT_KEYS = 1_000
#: A key with this share of the rows or more is hot: a tenth of what one of 200 tasks should get.
HOT_SHARE = 0.0005


def frequent_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that a sketch puts at ``share`` of the rows or more; at most :data:`HOT_KEYS`.

    One pass with a bounded sketch per task.  Its counts are estimates: which keys
    are called hot changes the plan, never a result.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {SKETCH_KEYS})")
    found = rows.filter(F.col(key).isNotNull()).agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    rows_of: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """``left JOIN right USING (key)`` of a fact and its dimension, also when a few keys hold most of the fact.

    A dimension within the bound is broadcast.  Above it, the rows of the hot keys
    (:func:`frequent_keys`) are broadcast and looked up where the fact is read; the fact
    is then shuffled once for all other keys, its finished rows spread evenly by
    ``spread_by``, so no task gets a hot key.
    """
    small = bounded_broadcast(right, max_rows, rows_of)
    if small is not right:
        return left.join(small, key)
    hot = frequent_keys(left, key, share)
    if not hot:
        return left.join(right, key)
    values = [c for c in right.columns if c != key]
    packed = right.select(key, F.struct(*values).alias("_found"))
    first = packed.filter(F.col(key).isin(hot)).select(key, F.col("_found").alias("_hot"))
    met = left.join(bounded_broadcast(first, max_rows), key, "left")
    done = F.col("_hot").isNotNull()
    spread = F.pmod(F.xxhash64(spread_by), F.lit(1 << 30)).cast(left.schema[key].dataType)
    met = met.withColumn("_done", done).withColumn("_key", F.when(done, spread).otherwise(F.col(key)))
    rest = packed.select(F.col(key).alias("_key"), F.lit(False).alias("_done"), F.col("_found").alias("_late"))
    both = met.join(rest, ["_key", "_done"], "left")
    both = both.withColumn("_all", F.coalesce("_hot", "_late")).filter(F.col("_all").isNotNull())
    return both.select(key, *[c for c in left.columns if c != key], *[F.col(f"_all.{c}").alias(c) for c in values])


def spread_null_key(key: Column, salt: Column, marker: str = "\u0000null-key\u0000") -> Column:
    """A join key in which NULLs are replaced by distinct non-matching values.

    A NULL key never matches in an equi-join, but all NULL rows hash to the
    same shuffle partition; on an outer join that partition can hold a large
    share of the input.  Replacing NULL with ``marker || salt`` (``salt`` is a
    unique per-row value such as the primary key) keeps them unmatched and
    spreads them evenly.  The marker starts with a NUL character, which no
    e-mail address or subscriber key contains.
    """
    return F.coalesce(key, F.concat(F.lit(marker), salt.cast("string")))


DEFAULT_HOT_KEY_ROWS = 100_000
DEFAULT_SALT_BUCKETS = 64
# Hot keys that are broadcast; a longer list is joined by a shuffle.
MAX_HOT_KEYS = 100_000


def hot_key_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Column,
    max_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    buckets: int = DEFAULT_SALT_BUCKETS,
    counts_of: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with hot keys salted over ``buckets`` tasks.

    Left rows per key are counted (map-side partial counts, so a hot key
    collapses before the shuffle).  Keys with more than ``max_key_rows``
    left rows form a small table (at most total_rows / max_key_rows entries,
    counted, then broadcast); their left rows get a salt from
    ``spread_by`` (e.g. the row's own id) and their right rows are repeated
    once per salt, so one hot key is joined by ``buckets`` tasks instead of
    one.  Without hot keys this is the plain join.

    ``counts_of`` may be a cheaper frame with the same rows per key as
    ``left`` (e.g. ``left`` before a one-to-one enrichment); keys are
    counted there.
    """
    counts = (left if counts_of is None else counts_of).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > max_key_rows).select(key, F.lit(True).alias("_hot"))
    n_hot = hot.count()
    if n_hot == 0:
        return left.join(right, key, "left")
    hot = F.broadcast(hot) if n_hot <= MAX_HOT_KEYS else hot
    salt = F.pmod(F.xxhash64(spread_by), F.lit(buckets)).cast("int")
    salted_left = left.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
    all_salts = F.sequence(F.lit(0), F.lit(buckets - 1))
    salted_right = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), all_salts).otherwise(F.array(F.lit(0))))
    )
    return (
        salted_left.drop("_hot")
        .join(salted_right.drop("_hot"), [key, "_salt"], "left")
        .drop("_salt")
    )
