"""Stored tables: write modes, layout, versions, and state that is rewritten by bucket.

Plain parquet has no in-place update. A new state is written next to the old one
and becomes visible through a marker file that is created last, so readers never
see half a table and a failed write leaves the old state in place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_MARKER = "_COMMITTED"
#: Amended versions of a bucket that a reader puts together at most.
_MOST_AMENDED = 64


class _Files:
    """The few file-system calls that Spark's reader and writer do not cover."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self.path(root).getFileSystem(self._conf)

    def path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def exists(self, text: str) -> bool:
        return self._fs.exists(self.path(text))

    def touch(self, text: str) -> None:
        self._fs.create(self.path(text), True).close()

    def write(self, text: str, content: str) -> None:
        """Create a small file with this content."""
        out = self._fs.create(self.path(text), True)
        out.write(bytearray(content.encode()))
        out.close()

    def move(self, old: str, new: str) -> None:
        """Rename a folder; one that is there already, from a move that was cut short, is left as it is."""
        if not self._fs.exists(self.path(new)):
            self._fs.mkdirs(self.path(new).getParent())
            if not self._fs.rename(self.path(old), self.path(new)):
                raise OSError(f"cannot move {old} to {new}")

    def time(self, text: str) -> int:
        return self._fs.getFileStatus(self.path(text)).getModificationTime()

    def glob(self, pattern: str) -> list[str]:
        return [str(s.getPath().toString()) for s in self._fs.globStatus(self.path(pattern)) or []]


def is_versioned(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is the root of a versioned or bucketed table."""
    return bool(_Files(spark, path).glob(f"{path.rstrip('/')}/v=*"))


def modified(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, time and length of the files at a path: changes when its content does."""
    files = _Files(spark, path)
    found = files._fs.globStatus(files.path(path)) or []
    parts = [p for s in found for p in (files._fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    return sorted((p.getPath().getName(), p.getModificationTime(), p.getLen()) for p in parts)


def path_exists(spark: SparkSession, path: str) -> bool:
    return _Files(spark, path).exists(path)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Parquet write; ``files`` sets the number of output files."""
    writer = (df.repartition(files) if files else df).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> None:
    """Write in key order, so that file and row-group statistics prune later scans."""
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, compression: str = "snappy", sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=header, compression=compression)


def with_period(df: DataFrame, date_column: str, months: int = 2, name: str = "period") -> DataFrame:
    """Number of whole ``months``-long periods since the earliest date of the frame."""
    first = df.agg(F.min(date_column))
    age = F.months_between(F.col(date_column), first.scalar())
    return df.withColumn(name, F.floor(age / months).cast("int"))


def append_in_periods(df: DataFrame, path: str, date_column: str, months: int = 2, name: str = "period") -> None:
    """Append all periods in one job, one directory per period."""
    with_period(df, date_column, months, name).write.mode("append").partitionBy(name).parquet(path)


def ensure_table(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], replace: bool = False
) -> DataFrame:
    """The stored table; built on first use, or again into a new version with ``replace``."""
    table = VersionedTable(spark, path)
    if replace or not table.versions():
        table.publish(build())
    return table.read()


class VersionedTable:
    """A table whose every refresh is a complete new directory ``v=N``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    def versions(self) -> list[int]:
        found = self._files.glob(f"{self.root}/v=*/{_MARKER}")
        return sorted(int(p.split("/")[-2].removeprefix("v=")) for p in found)

    def publish(self, df: DataFrame, version: int | None = None, partition_by: Sequence[str] = ()) -> int:
        """Write a new version. A version that is complete already is not written again."""
        known = self.versions()
        if version is None:
            version = known[-1] + 1 if known else 1
        if version not in known:
            target = f"{self.root}/v={version}"
            write_table(df, target, partition_by=partition_by)
            self._files.touch(f"{target}/{_MARKER}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no complete version under {self.root}")
        return self.spark.read.parquet(f"{self.root}/v={version or known[-1]}")


class BucketedTable:
    """Keyed state in ``v=N/bucket=B``: an update rewrites only the buckets it touches.

    The newest complete version that holds a bucket is the state of that bucket. Versions count up by themselves; what a
    caller wants to do only once (a micro-batch of a stream) it names by a token, which the marker of the version keeps.
    So a repeated batch is known, whichever stream, restart or checkpoint it comes from, and a new one never looks like
    an old one. One writer at a time. Choose ``buckets`` so that one holds a few hundred MB: a changed row rewrites it.

    ``amend`` writes only the rows of some keys, beside those stored, and from where on their stored rows have gone. Readers
    put both together; the next ``replace`` or ``compact`` of a bucket folds what was amended.
    """

    #: Whether ``amend`` may be used; not where commits are compared with the rows that they replace.
    amends = True

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self._files = _Files(spark, self.root)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def span(self, changes: DataFrame) -> tuple[list[int], Column]:
        """Buckets that occur in ``changes``, and between what its keys lie: other row groups of a scan are skipped."""
        ends = [F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(f"_{i}") for i, k in enumerate(self.keys)]
        found = changes.agg(F.collect_set(self.bucket()).alias("_buckets"), *ends).first()
        within = F.lit(True)
        for i, k in enumerate(self.keys):
            within &= F.col(k).between(F.lit(found[f"_{i}"]["low"]), F.lit(found[f"_{i}"]["high"]))
        return sorted(found["_buckets"]), within

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that occur in ``changes``; at most ``buckets`` numbers."""
        return [r[0] for r in changes.select(self.bucket().alias("b")).distinct().collect()]

    def has(self, token: str) -> bool:
        """Whether a complete version was written under this token."""
        return bool(self._files.glob(f"{self.root}/v=*/{_MARKER}.{token}"))

    def _committed(self, kind: str = "_BUCKETS") -> dict[int, list[int]]:
        """Buckets of each complete version, from the names of its index files: one listing, however many buckets."""
        found: dict[int, list[int]] = {}
        for path in self._files.glob(f"{self.root}/v=*/{kind}.*"):
            version, index = path.split("/")[-2:]
            found.setdefault(int(version.removeprefix("v=")), []).extend(_numbers(index))
        done = {int(p.split("/")[-2].removeprefix("v=")) for p in self._files.glob(f"{self.root}/v=*/{_MARKER}.*")}
        return {v: held for v, held in found.items() if v in done}

    def _current(self, wanted: set[int] | None = None) -> tuple[dict[int, int], list[tuple[int, int]]]:
        """The newest version that holds each bucket whole, and (version, bucket) of what was amended after it."""
        newest: dict[int, int] = {}
        for version, held in sorted(self._committed().items()):
            newest |= {b: version for b in held if wanted is None or b in wanted}
        amended = [
            (version, b) for version, held in sorted(self._committed("_AMENDED").items()) for b in held
            if (wanted is None or b in wanted) and version > newest.get(b, 0)
        ]
        return newest, amended

    def read(
        self, buckets: Iterable[int] | None = None, only: DataFrame | None = None, within: Column | None = None
    ) -> DataFrame | None:
        """Current rows of all or some buckets; None while there are none.

        ``only`` are the keys whose rows are wanted, ``within`` what is known of them; that reaches the scan.
        """
        newest, amended = self._current(None if buckets is None else set(buckets))
        held = [(v, b) for b, v in newest.items()]
        paths = self._stored([*held, *amended], "bucket")
        if not paths:
            return None

        def chosen(part: DataFrame) -> DataFrame:
            part = part if within is None else part.filter(within)
            return part if only is None else part.join(only.select(*self.keys), self.keys, "left_semi")

        if not amended:
            return chosen(self.spark.read.parquet(*paths))
        return self._without_gone(chosen(self._numbered(paths)), amended, chosen)

    def _stored(self, places: Sequence[tuple[int, int]], folder: str) -> list[str]:
        """Folders that exist among those of (version, bucket)."""
        found = {tuple(p.split("/v=")[-1].split(f"/{folder}=")) for p in self._files.glob(f"{self.root}/v=*/{folder}=*")}
        return [f"{self.root}/v={v}/{folder}={b}" for v, b in places if (str(v), str(b)) in found]

    def _numbered(self, paths: Sequence[str]) -> DataFrame:
        """Stored rows with the version that amended them; those of a whole bucket have none."""
        schema = self.spark.read.parquet(paths[-1]).schema
        schema = schema if "__VERSION" in schema.names else StructType([*schema.fields]).add("__VERSION", "integer")
        return self.spark.read.schema(schema).parquet(*paths)

    def _without_gone(
        self, rows: DataFrame, amended: Sequence[tuple[int, int]], chosen: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """Leave out the rows that a later version has replaced: the key and the place from which on they have gone say which."""
        gone = chosen(self.spark.read.parquet(*self._stored(amended, "_gone/bucket")))
        start = next(c for c in gone.columns if c not in (*self.keys, "__VERSION"))
        gone = gone.select([F.col(c).alias(f"_gone_{c}") for c in gone.columns])
        match = (F.col("_gone___VERSION") > F.coalesce("__VERSION", F.lit(0))) & (F.col(start) >= F.col(f"_gone_{start}"))
        for k in self.keys:
            match &= F.col(k) == F.col(f"_gone_{k}")
        return rows.join(gone, match, "left_anti").drop("__VERSION")

    def amend(self, rows: DataFrame, gone: DataFrame, token: str, buckets: Iterable[int]) -> int:
        """Write new rows of some keys as the next version and leave the stored rows of their buckets where they are.

        ``gone`` has the keys and one more column of ``rows``: stored rows of the key from this value on have gone.
        """
        version = self._next_version()
        target = f"{self.root}/v={version}"
        for part, path in ((rows, target), (gone, f"{target}/_gone")):
            placed = part.withColumns({"__VERSION": F.lit(version), "bucket": self.bucket()}).hint("rebalance", "bucket")
            placed.write.mode("overwrite").partitionBy("bucket").parquet(path)
        for name in _index_names(buckets):
            self._files.touch(f"{target}/{name.replace('_BUCKETS', '_AMENDED')}")
        self._files.touch(f"{target}/{_MARKER}.{token}")
        return version

    def fold_due(self, buckets: Iterable[int]) -> bool:
        """Whether an update should rewrite these buckets rather than amend them.

        Twice as many versions pass from one fold to the next, so all folds together write a few times the table; readers
        put at most ``_MOST_AMENDED`` versions together.
        """
        wanted = set(buckets)
        newest, amended = self._current(wanted)
        counts = Counter(b for _, b in amended)
        return not self.amends or any(n >= min(max(4, newest.get(b, 0)), _MOST_AMENDED) for b, n in counts.items())

    def _next_version(self) -> int:
        known = [int(p.split("=")[-1]) for p in self._files.glob(f"{self.root}/v=*")]
        return max(known, default=0) + 1  # also beyond unfinished ones

    def replace(self, rows: DataFrame, token: str, buckets: Iterable[int]) -> int:
        """Write the complete new rows of ``buckets`` as the next version. A bucket without rows becomes empty."""
        version = self._next_version()
        target = f"{self.root}/v={version}"
        # The rebalance hint lets adaptive execution split a large bucket over tasks.
        placed = rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        buckets = list(buckets)
        placed.write.mode("overwrite").partitionBy("bucket").parquet(target)
        for name in _index_names(buckets):
            self._files.touch(f"{target}/{name}")
        self._before_commit(version, buckets)
        self._files.touch(f"{target}/{_MARKER}.{token}")
        self._after_commit(version)
        return version

    def _before_commit(self, version: int, buckets: list[int]) -> None:
        """What a kind of table writes along with a version, while readers don't see the version yet."""

    def _after_commit(self, version: int) -> None:
        """What a kind of table does once a version is visible."""

    def _at(self, version: int) -> DataFrame | None:
        """The rows that a version has written, committed or not; None if it has none."""
        paths = self._files.glob(f"{self.root}/v={version}/bucket=*")
        return self.spark.read.parquet(*paths) if paths else None

    def compact(self, token: str) -> int | None:
        """Write all current rows as one version, so that readers open one folder for each bucket.

        Older versions stay for readers that began with them. Nothing is done if one version holds everything already.
        """
        newest, amended = self._current()
        if self.has(token) or (len(set(newest.values())) <= 1 and not amended):
            return None
        rows = self.read()
        if rows is None:
            return None
        return BucketedTable.replace(self, rows, token, sorted({*newest, *(b for _, b in amended)}))

    def set_aside(self, rows: DataFrame, token: str) -> None:
        """Keep rows that cannot be applied (NULL key or sequence), once per token."""
        rows.write.mode("overwrite").parquet(f"{self.root}/_quarantine/batch={token}")

    def quarantined(self) -> DataFrame | None:
        """All rows set aside so far, with the ``batch`` that brought them; count them to know how many."""
        root = f"{self.root}/_quarantine"
        found = [p for p in self._files.glob(f"{root}/batch=*") if self._files.glob(f"{p}/*.parquet")]
        return self.spark.read.option("basePath", root).parquet(*found) if found else None


#: Buckets in one index file, whose name holds them as a hex bit mask.
_PER_INDEX = 800


def _index_names(buckets: Iterable[int]) -> list[str]:
    masks: dict[int, int] = {}
    for b in buckets:
        masks[b // _PER_INDEX] = masks.get(b // _PER_INDEX, 0) | 1 << b % _PER_INDEX
    return [f"_BUCKETS.{part}.{mask:x}" for part, mask in masks.items()]


def _numbers(index_name: str) -> list[int]:
    _, part, spelled = index_name.split(".")
    mask = int(spelled, 16)
    return [int(part) * _PER_INDEX + k for k in range(mask.bit_length()) if mask >> k & 1]


class BucketedLog:
    """Append-only changes in ``batch=TOKEN/bucket=B``; a repeated batch replaces itself.

    ``compact`` folds batches into a base, ``base=N/bucket=B``, whose marker names them: from then on a reader opens the
    newest base and only the batches after it, however many there have been. Folded batches and older bases stay for
    readers that began before; a retention rule may delete them.
    """

    def __init__(self, spark: SparkSession, root: str, table: BucketedTable):
        self.spark, self.root, self.table = spark, root.rstrip("/"), table
        self._files = _Files(spark, self.root)

    def append(self, changes: DataFrame, batch: str) -> None:
        if batch in self._folded():
            return  # it is in the base already
        placed = changes.withColumn("bucket", self.table.bucket()).hint("rebalance", "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/batch={batch}")

    def _base(self) -> int | None:
        done = [int(p.split("/")[-2].removeprefix("base=")) for p in self._files.glob(f"{self.root}/base=*/{_MARKER}")]
        return max(done, default=None)

    def _folded(self) -> set[str]:
        """Tokens of the batches that the newest base holds."""
        base = self._base()
        if base is None:
            return set()
        return {r[0] for r in self.spark.read.parquet(f"{self.root}/base={base}/_folded").collect()}

    def _batches(self) -> list[str]:
        return [p.rsplit("batch=", 1)[1] for p in self._files.glob(f"{self.root}/batch=*")]

    def _parts(self) -> list[str]:
        """The folders whose rows are the log: the newest base and the batches that it does not hold."""
        base, folded = self._base(), self._folded()
        parts = [f"{self.root}/batch={b}" for b in self._batches() if b not in folded]
        return parts if base is None else [f"{self.root}/base={base}", *parts]

    def _grouped(self) -> list[tuple[str, list[str]]]:
        """(base path, folders): the base is one scan, all batches together are another."""
        base, others = [p for p in self._parts() if "/base=" in p], [p for p in self._parts() if "/base=" not in p]
        return [(p, [p]) for p in base] + ([(self.root, others)] if others else [])

    def read(self, buckets: Iterable[int], since: Column | None = None, schema: StructType | None = None) -> DataFrame:
        """Changes of some buckets, from those that ``since`` selects; both reach the scan. With ``schema``, that of the
        changes, no file is opened to find it."""
        log = None
        for base_path, folders in self._grouped():
            reader = self.spark.read.option("basePath", base_path)
            if schema is not None:
                reader = reader.schema(StructType([*schema.fields]).add("batch", "string").add("bucket", "integer"))
            part = reader.parquet(*folders).filter(F.col("bucket").isin(*buckets)).drop("batch", "bucket")
            log = part if log is None else log.unionByName(part)
        if log is None:
            raise FileNotFoundError(f"no log under {self.root}")
        return log if since is None else log.filter(since)

    def compact(self, keep: int = 0) -> int | None:
        """Fold all batches but the ``keep`` newest into a new base; returns its number, None if there is nothing to fold.

        The base becomes visible by its marker, written last; a run that dies leaves the log as it was. One writer at a time.
        """
        folded, base = self._folded(), self._base()
        waiting = sorted((self._files.time(f"{self.root}/batch={b}"), b) for b in self._batches() if b not in folded)
        chosen = [b for _, b in waiting[: len(waiting) - keep]]
        if not chosen:
            return None
        number = max([int(p.rsplit("=", 1)[1]) for p in self._files.glob(f"{self.root}/base=*")], default=0) + 1
        target = f"{self.root}/base={number}"
        rows = self.spark.read.option("basePath", self.root).parquet(*[f"{self.root}/batch={b}" for b in chosen]).drop("batch")
        if base is not None:
            old = f"{self.root}/base={base}"
            rows = rows.unionByName(self.spark.read.option("basePath", old).parquet(old))
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        names = self.spark.createDataFrame([(b,) for b in sorted(folded | set(chosen))], "batch string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{target}/_folded")
        self._files.touch(f"{target}/{_MARKER}")
        return number


def refresh(table: VersionedTable, build: Callable[[], DataFrame]) -> DataFrame:
    """Recompute a stored view completely."""
    table.publish(build())
    return table.read()


def refresh_with_fallback(
    incremental: Callable[[], DataFrame], table: VersionedTable, build: Callable[[], DataFrame]
) -> tuple[DataFrame, str]:
    """Try the incremental run; when it fails, rebuild into a new version.

    The old version stays readable until the new one is complete. Returns the
    table and which of the two ways was taken.
    """
    try:
        return incremental(), "incremental"
    except Exception as problem:  # any failed run leads to the full refresh
        try:
            return refresh(table, build), "full"
        except Exception as again:
            raise again from problem
