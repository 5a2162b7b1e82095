"""Change feeds and history tables: type 1, type 2 from changes, type 2 from snapshots.

Everything here is batch: a frame of the stored state and a frame of news give
the next state. ``ledgerline.streaming.apply`` drives it from a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.joins import spread_join
from ledgerline.operators.ordered import GROUP_LIMIT, has_large_group, ordered_columns

# Column names of history tables and change feeds (fixed values).
START, END = "__START_AT", "__END_AT"
OP = "_change_type"
SEQUENCE, DELETED = "__SEQUENCE", "__DELETED"
#: Feed columns that never belong to a target table.
FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def _lower(names: Sequence[str]) -> set[str]:
    return {n.lower() for n in names}


def _others(df: DataFrame, names: Sequence[str]) -> list[str]:
    skip = _lower(names)
    return [c for c in df.columns if c.lower() not in skip]


def changes_between(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two states of a table with unique keys.

    Unchanged rows give nothing; a changed row gives its old and its new image. Rows with a NULL key cannot be told
    apart and are not in the feed; ``unkeyed`` gives and counts them. Both states must have the same columns.
    """
    if _lower(old.columns) != _lower(new.columns):
        raise ValueError(f"columns differ: {sorted(_lower(old.columns) ^ _lower(new.columns))}")
    old, new = split_valid(old, keys)[0], split_valid(new, keys)[0]
    payload = _others(old, keys)
    left = old.select(*keys, F.struct(*payload).alias("_old"))
    right = new.select(*keys, F.struct(*payload).alias("_new"))

    def image(kind: str, side: str, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias(OP), F.col(side).alias("image")))

    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    differs = was & now & ~F.col("_old").eqNullSafe(F.col("_new"))
    images = F.array_compact(
        F.array(
            image("insert", "_new", ~was),
            image("delete", "_old", ~now),
            image("update_preimage", "_old", differs),
            image("update_postimage", "_new", differs),
        )
    )
    return (
        left.join(right, list(keys), "full_outer")
        .select(*keys, F.explode(images).alias("c"))
        .select(*keys, "c.image.*", f"c.{OP}")
    )


def unkeyed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of two states that a change feed cannot name, each content once, with how often either state has it."""
    sides = [split_valid(df, keys)[1].withColumns({"_old": F.lit(k == 0).cast("bigint"), "_new": F.lit(k == 1).cast("bigint")})
             for k, df in enumerate((old, new))]
    both = sides[0].unionByName(sides[1])
    content = [c for c in both.columns if c not in ("_old", "_new")]
    return both.groupBy(*content).agg(F.sum("_old").alias("old_rows"), F.sum("_new").alias("new_rows"))


def split_valid(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Changes that can be applied, and those with a NULL key or NULL sequence."""
    usable = F.lit(True)
    for name in [*keys, *sequence]:
        usable = usable & F.col(name).isNotNull()
    return changes.filter(usable), changes.filter(~usable)


def _newest_first(payload: Sequence[str], sequence: Column) -> Column:
    """Total order of changes: sequence, then a hash of the content, then the content."""
    content = F.struct(*payload)
    return F.struct(sequence.alias("s"), F.xxhash64(content).alias("h"), content.alias("c"))


# ----------------------------------------------------------------- type 1

def scd1_changes(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    *,
    except_columns: Sequence[str] = (),
    delete_when: Column | None = None,
) -> DataFrame:
    """Changes in the form of the stored state, one row per key (the newest)."""
    changes, _ = split_valid(_without_preimages(changes), keys, sequence)
    payload = _others(changes, [*keys, *except_columns, *FEED_COLUMNS])
    rows = changes.select(
        *keys,
        *payload,
        F.struct(*sequence).alias(SEQUENCE),
        (F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)).alias(DELETED),
    )
    return newest(rows, keys)


def newest(state_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the row with the largest sequence. Reduced on the map side, so a
    frequent key costs no more than a rare one."""
    rest = _others(state_rows, keys)
    order = _newest_first([c for c in rest if c != SEQUENCE], F.col(SEQUENCE))
    best = F.max_by(F.struct(*rest), order).alias("_best")
    return state_rows.groupBy(*keys).agg(best).select(*keys, "_best.*")


def scd1(state: DataFrame | None, news: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Next type 1 state. Late rows lose against the stored sequence; deleted
    keys stay as tombstones so that a late row cannot bring them back."""
    return news if state is None else newest(state.unionByName(news), keys)


def scd1_rows(state: DataFrame) -> DataFrame:
    """The table that users see: live rows without bookkeeping columns."""
    return state.filter(~F.col(DELETED)).drop(SEQUENCE, DELETED)


# ----------------------------------------------------------------- type 2, changes

def _without_preimages(changes: DataFrame) -> DataFrame:
    if OP.lower() not in _lower(changes.columns):
        return changes
    return changes.filter(F.coalesce(F.col(OP) != "update_preimage", F.lit(True)))


def scd2_log(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    *,
    except_columns: Sequence[str] = (),
    delete_when: Column | None = None,
) -> DataFrame:
    """Changes in normal form: keys, start, rest of the sequence, payload, delete mark."""
    changes, _ = split_valid(_without_preimages(changes), keys, sequence)
    payload = _others(changes, [*keys, *except_columns, *FEED_COLUMNS])
    deleted = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    return changes.select(
        *keys,
        F.col(sequence[0]).alias(START),
        F.struct(*sequence).alias(SEQUENCE),
        *payload,
        deleted.alias(DELETED),
    )


def scd2_history(
    log: DataFrame,
    keys: Sequence[str],
    *,
    track_except: Sequence[str] = (),
    split: bool | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Versions from the complete log of some keys, in any order of arrival.

    Neighbouring changes with equal tracked columns are one version, which shows
    the newest value of the untracked columns. A delete ends a version. Among
    changes with the same start only the last one counts.
    """
    keys = list(keys)
    payload = _others(log, [*keys, START, SEQUENCE, DELETED])
    tracked = _others(log, [*keys, START, SEQUENCE, DELETED, *track_except])
    content = [*payload, DELETED]
    # Copies and same-instant changes disappear here, before any ordered step.
    single = log.groupBy(*keys, START).agg(
        F.max_by(F.struct(*content), _newest_first(content, F.col(SEQUENCE))).alias("_c")
    ).select(*keys, START, "_c.*")
    if split is None:
        split = has_large_group(log, keys, limit)  # counts copies too, so it errs on the safe side

    mark = F.struct(F.col(DELETED), *[F.when(~F.col(DELETED), F.col(c)).alias(c) for c in tracked])
    marked = ordered_columns(
        single.withColumn("_mark", mark), keys, [START], lag={"_before": F.col("_mark")}, split=split
    )
    begins = F.when(F.col("_mark").eqNullSafe(F.col("_before")), 0).otherwise(1)
    numbered = ordered_columns(
        marked.withColumn("_begins", begins).drop("_mark", "_before"),
        keys,
        [START],
        running={"_run": F.col("_begins")},
        split=split,
    )
    runs = numbered.groupBy(*keys, "_run").agg(
        F.min(START).alias(START), F.max_by(F.struct(*content), F.col(START)).alias("_c")
    )
    ended = ordered_columns(runs, keys, [START], lead={END: F.col(START)}, split=split)
    return ended.filter(~F.col(f"_c.{DELETED}")).select(
        *keys, *[F.col(f"_c.{c}").alias(c) for c in payload], START, END
    )


# ----------------------------------------------------------------- type 2, snapshots

def scd2_snapshot(
    target: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    at: Column,
    *,
    track_except: Sequence[str] = (),
    keep: Sequence[str] = (),
    allow_empty: bool = False,
) -> DataFrame:
    """Next type 2 state after a full snapshot taken at time ``at``.

    A new key opens a version, a missing key closes one, a changed tracked
    column does both. Columns in ``track_except`` are refreshed on the open
    version; of these, ``keep`` columns (surrogate keys) stay as first written.
    Rows with a NULL key name nothing and add no version; ``split_valid`` gives them.
    """
    keys = list(keys)
    snapshot, _ = split_valid(snapshot, keys)
    payload = _others(snapshot, keys)
    _check_snapshot(target, snapshot, keys, at, allow_empty)
    fresh = snapshot.select(
        *keys, *payload, at.cast("timestamp").alias(START), F.lit(None).cast("timestamp").alias(END)
    )
    if target is None:
        return fresh

    columns = [*payload, START, END]
    open_rows = target.filter(F.col(END).isNull())
    joined = open_rows.select(*keys, F.struct(*columns).alias("_old")).join(
        fresh.select(*keys, F.struct(*columns).alias("_new")), keys, "full_outer"
    )
    tracked = _others(snapshot, [*keys, *track_except, *keep])
    same = F.struct(*[F.col(f"_old.{c}") for c in tracked]).eqNullSafe(
        F.struct(*[F.col(f"_new.{c}") for c in tracked])
    )
    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    refreshed_names = _lower(track_except) - _lower(keep)
    refreshed = F.struct(
        *[(F.col(f"_new.{c}") if c.lower() in refreshed_names else F.col(f"_old.{c}")).alias(c) for c in columns]
    )
    closed = F.col("_old").withField(END, at.cast("timestamp"))
    rows = (
        F.when(was & now & same, F.array(refreshed))
        .when(was & now, F.array(closed, F.col("_new")))
        .when(was, F.array(closed))
        .otherwise(F.array(F.col("_new")))
    )
    renewed = joined.select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
    return target.filter(F.col(END).isNotNull()).select(*keys, *columns).unionByName(renewed)


def _check_snapshot(target, snapshot, keys, at, allow_empty):
    sizes = snapshot.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    keys_seen, largest = sizes.agg(F.count(F.lit(1)), F.max("n")).first()
    if largest is not None and largest > 1:
        raise ValueError(f"snapshot has more than one row for a key of {list(keys)}")
    if not keys_seen and not allow_empty:
        raise ValueError("empty snapshot would close every version; pass allow_empty=True if that is meant")
    if target is not None:
        late = F.greatest(F.max(START), F.max(END)) >= at.cast("timestamp")
        if target.agg(late).first()[0]:
            raise ValueError("snapshot time must be later than all stored times")


# ----------------------------------------------------------------- readers

def current(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col(END).isNull())


def changed_keys(versions: DataFrame, keys: Sequence[str], count: int = 2) -> DataFrame:
    """All versions of the keys that have exactly ``count`` of them."""
    chosen = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions")).filter(F.col("versions") == count)
    return spread_join(versions, chosen, keys)


def surrogate_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A 64-bit key from the identifying columns, the same in every rebuild."""
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in columns]))
