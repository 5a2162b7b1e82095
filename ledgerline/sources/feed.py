"""Tables that store what each commit changed, and the change feed as a stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerline.operators import changes as ch
from ledgerline.sources.tables import BucketedTable

VERSION, TIME = ch.FEED_COLUMNS[1:]


class ChangeTable(BucketedTable):
    """A bucketed table whose commits also store their images before and after, with commit version and time.

    ``visible`` turns stored rows into those that users see (type 1 state holds tombstones). Images come from the buckets
    that a commit rewrites; no other bucket is read. They are written beside the version and moved into the feed after its
    marker, so a feed never shows what was not committed; a move that a crash left undone is done by the next commit or
    reader. Rows with a NULL key never reach the table (they are set aside).
    """

    amends = False

    def __init__(
        self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64,
        visible: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ):
        super().__init__(spark, root, keys, buckets)
        self.visible, self.feed = visible, f"{self.root}-changes"

    def _before_commit(self, version: int, buckets: list[int]) -> None:
        after, before = self._at(version), self.read(buckets)
        if after is None and before is None:
            return
        sides = [self.visible(x) if x is not None else None for x in (before, after)]
        old, new = (x if x is not None else next(s for s in sides if s is not None).limit(0) for x in sides)
        images = ch.changes_between(old, new, self.keys).withColumn(TIME, F.lit(str(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))).cast("timestamp"))
        images.write.mode("overwrite").parquet(f"{self.root}/v={version}/_images")

    def _after_commit(self, version: int) -> None:
        self.publish_images()

    def publish_images(self) -> None:
        """Move the images of committed versions into the feed, oldest first."""
        done = {int(p.split("/")[-2].removeprefix("v=")) for p in self._files.glob(f"{self.root}/v=*/_COMMITTED.*")}
        waiting = sorted(int(p.split("/")[-2].removeprefix("v=")) for p in self._files.glob(f"{self.root}/v=*/_images"))
        for version in waiting:
            if version in done:
                self._files.move(f"{self.root}/v={version}/_images", f"{self.feed}/{VERSION}={version}")

    def changes(self, since: int = 1, until: int | None = None) -> DataFrame:
        """Images of the commits from version ``since`` to ``until``; folders of other versions are not read."""
        self.publish_images()
        rows = self.spark.read.parquet(self.feed).where(F.col(VERSION) >= since)
        return rows if until is None else rows.where(F.col(VERSION) <= until)

    def change_stream(self, schema: StructType | str, since: int = 1, max_files: int | None = None) -> DataFrame:
        """The feed as a stream, from version ``since``; ``schema`` is that of the visible rows.

        Each image has ``_change_type``, ``_commit_version`` and ``_commit_timestamp``.
        """
        self.publish_images()
        if isinstance(schema, str):
            schema = self.spark.createDataFrame([], schema).schema
        full = StructType([*schema.fields]).add(ch.OP, "string").add(TIME, "timestamp").add(VERSION, "integer")
        reader = self.spark.readStream.schema(full)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.feed).where(F.col(VERSION) >= since)
