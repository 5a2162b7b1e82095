"""Keep type 1 and type 2 tables up to date from a stream of changes."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators.joins import fits_broadcast, lookup_join
from ledgerline.operators.ordered import has_large_group
from ledgerline.operators.views import IncrementalView
from ledgerline.sources.tables import BucketedLog, BucketedTable
from ledgerline.streaming.ingest import run_batches
from ledgerline.workspace import materialize


def batch_token(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch that no other query shares: the id that Spark gave the checkpoint, and the batch number.

    A new checkpoint is a new query whose batches are counted from 0 again; its rows are news, not repeats.
    """
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return f"{json.loads(line)['id']}-{batch_id}"


def _usable(batch: DataFrame, target: BucketedTable, sequence: Sequence[str], token: str) -> DataFrame:
    """The rows that can be applied; the others (NULL key or sequence) are stored with the target."""
    valid, invalid = ch.split_valid(batch, target.keys, sequence)
    if not invalid.isEmpty():
        target.set_aside(invalid, token)
    return valid


def apply_scd1(
    stream: DataFrame,
    target: BucketedTable,
    checkpoint: str,
    sequence: Sequence[str],
    *,
    except_columns: Sequence[str] = (),
    delete_when: Column | None = None,
) -> None:
    """Upsert the newest change per key. A repeated micro-batch changes nothing.

    Rows with a NULL key or sequence go to ``target.quarantined()``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        token = batch_token(batch.sparkSession, checkpoint, batch_id)
        merge_scd1(batch, target, token, sequence, except_columns=except_columns, delete_when=delete_when)

    run_batches(stream, merge, checkpoint)


def merge_scd1(
    changes: DataFrame,
    target: BucketedTable,
    token: str,
    sequence: Sequence[str],
    *,
    except_columns: Sequence[str] = (),
    delete_when: Column | None = None,
) -> None:
    """Upsert one batch of changes into a type 1 table, once per token."""
    if target.has(token):
        return
    news = materialize(
        ch.scd1_changes(
            _usable(changes, target, sequence, token), target.keys, sequence,
            except_columns=except_columns, delete_when=delete_when,
        ),
        "scd1-news",
    )
    buckets = target.touched(news)
    if buckets:
        target.replace(ch.scd1(target.read(buckets), news, target.keys), token, buckets)


def apply_view(
    stream: DataFrame, view: IncrementalView, checkpoint: str, source: Callable[[DataFrame], DataFrame],
    shape: Callable[[DataFrame], DataFrame] = lambda images: images,
) -> None:
    """Keep a view up to date from the stream of a change feed; ``shape`` turns images into rows of the view's source."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        view.apply(shape(batch), batch_token(batch.sparkSession, checkpoint, batch_id), source)

    run_batches(stream, merge, checkpoint)


def apply_scd2(
    stream: DataFrame,
    target: BucketedTable,
    log: BucketedLog,
    checkpoint: str,
    sequence: Sequence[str],
    *,
    except_columns: Sequence[str] = (),
    delete_when: Column | None = None,
    track_except: Sequence[str] = (),
    compact_every: int | None = None,
) -> None:
    """Keep versions per key. All changes stay in ``log``, so late changes fall into
    their place. Only the tail of a key that its earliest news can affect is rebuilt;
    versions before it are kept, however long the history of the key is. Tails are written beside
    the table (``BucketedTable.amend``), which is rewritten ever more seldom as it grows. Of the log only
    changes from the earliest of these tails on are read. Rows with a NULL key or sequence
    go to ``target.quarantined()``. With ``compact_every`` the log and the table are folded after so many
    batches, so that a reader opens a bounded number of folders however long the stream has run."""
    keys = target.keys

    def merge(batch: DataFrame, batch_id: int) -> None:
        token = batch_token(batch.sparkSession, checkpoint, batch_id)
        if target.has(token):
            return
        news = materialize(
            ch.scd2_log(
                _usable(batch, target, sequence, token), keys, sequence,
                except_columns=except_columns, delete_when=delete_when,
            ),
            "scd2-news",
        )
        first = materialize(news.groupBy(*keys).agg(F.min(ch.START).alias("_cut")), "scd2-keys")
        buckets, within = target.span(first)
        if not buckets:
            return
        log.append(news, token)
        small = fits_broadcast(first)
        fold = target.fold_due(buckets)
        wanted = F.broadcast(first) if small else first
        before = target.read(buckets) if fold else target.read(buckets, wanted, within)
        cuts = first if before is None else materialize(_tails(before, first, keys, small), "scd2-cuts")
        earliest = cuts.agg(F.min("_cut")).first()[0]
        changes = log.read(buckets, within & (F.col(ch.START) >= F.lit(earliest)), news.schema)
        tail = lookup_join(changes, cuts, keys, small=small).filter(F.col(ch.START) >= F.col("_cut"))
        # Stored, as its groups are measured first: the log is read once.
        tail = materialize(tail.drop("_cut"), "scd2-tail")
        split = has_large_group(tail, keys)
        # Where no key is large every step works within a key: rows move and are sorted once.
        rows = ch.scd2_history(tail if split else tail.repartition(*keys), keys, track_except=track_except, split=split)
        if before is None:
            target.replace(rows, token, buckets)
        elif fold:
            marked = lookup_join(before, cuts, keys, "left", small=small)
            kept = marked.filter(F.col("_cut").isNull() | (F.col(ch.START) < F.col("_cut"))).drop("_cut")
            target.replace(rows.unionByName(kept), token, buckets)
        else:
            target.amend(rows, cuts.withColumnRenamed("_cut", ch.START), token, buckets)
        if compact_every and batch_id % compact_every == compact_every - 1:
            log.compact()
            target.compact(f"{token}-compact")

    run_batches(stream, merge, checkpoint)


def _tails(versions: DataFrame, first: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Where the rebuild of each key starts: at the version that is valid at its
    earliest news or ends there, else at that news itself."""
    joined = lookup_join(versions.select(*keys, ch.START, ch.END), first, keys, small=small)
    reaches = F.col(ch.END).isNull() | (F.col(ch.END) >= F.col("_cut"))
    covering = joined.filter((F.col(ch.START) < F.col("_cut")) & reaches).select(*keys, F.col(ch.START).alias("_from"))
    # At most one version covers an instant, so both sides have unique keys.
    return first.join(covering, list(keys), "left").select(*keys, F.coalesce("_from", "_cut").alias("_cut"))
