"""A stored index of vectors: centres and inverted lists as tables, kept under additions without fitting again.

``centres/v=N`` holds the centres of version N, ``lists/list=L`` the members of list L as appended files. A search reads
the folders of the lists that its queries probe and no others. Lists that grow too large are split in two where they are;
their members are written to lists of new numbers and the old numbers leave the next version of the centres, so searches
that run meanwhile go on with the version they began with.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ledgerline.operators.vectors import BLOCK, _assign, _best, _blocks, _compare, train_centres
from ledgerline.sources.tables import VersionedTable, _Files
from ledgerline.workspace import materialize

_MEMBERS = "id long, v array<float>, list int"


class VectorIndex:
    """The index under ``root``; ids are whole numbers, vectors of one length. One writer at a time.

    Rows with a NULL vector are not indexed. A batch is added once per token. Of equal vectors all are indexed; a search
    gives the ``k`` with the smallest ids.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)
        self._centres = VersionedTable(spark, f"{self.root}/centres")

    # ---------------------------------------------------------------- building

    def build(self, points: DataFrame, lists: int, *, id: str, vector: str, token: str = "build") -> None:
        """Fit the centres on a bounded sample of ``points`` (see ``train_centres``), the only fit there is, and add them."""
        rows = points.select(F.col(id).alias("id"), F.col(vector).cast("array<float>").alias("v"))
        centres = train_centres(rows, "v", lists)
        if not len(centres):
            raise ValueError("no vectors to build an index from")
        self._publish(dict(enumerate(centres)))
        self.add(points, id=id, vector=vector, token=token)

    def _publish(self, centres: dict[int, np.ndarray]) -> None:
        rows = [(int(n), [float(x) for x in c]) for n, c in centres.items()]
        self._centres.publish(self.spark.createDataFrame(rows, "list int, centre array<double>").coalesce(1))

    def centres(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and centres of the lists in use: one row per list."""
        rows = sorted((r["list"], r["centre"]) for r in self._centres.read().collect())
        return np.array([n for n, _ in rows]), np.array([c for _, c in rows])

    def add(self, points: DataFrame, *, id: str, vector: str, token: str) -> None:
        """Put vectors into the lists of their nearest centres; no centre moves, no stored file is read or rewritten."""
        if self._has(token):
            return
        numbers, centres = self.centres()
        rows = points.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v")).where("v IS NOT NULL")
        self._write(_numbered(_assign(rows, centres, 1), numbers), token)

    def _write(self, members: DataFrame, token: str) -> None:
        staged = f"{self.root}/staged/{token}"
        members.select("id", "v", "list").hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(staged)
        # A batch becomes visible as one folder of its own.
        self._files.move(staged, f"{self.root}/lists/batch={token}")

    def _has(self, token: str) -> bool:
        return self._files.exists(f"{self.root}/lists/batch={token}")

    # ---------------------------------------------------------------- reading

    def members(self, lists: list[int] | None = None) -> DataFrame:
        """The members of lists in use, or of some: a filter on the folders."""
        path = f"{self.root}/lists"
        rows = self.spark.read.option("basePath", path).schema(_MEMBERS).parquet(*self._files.glob(f"{path}/batch=*"))
        wanted = [int(n) for n in (self.centres()[0] if lists is None else lists)]
        return rows.where(F.col("list").isin(wanted)).select("id", "v", "list")

    def sizes(self) -> DataFrame:
        """Rows of each list, from file metadata and folder names."""
        return self.members().groupBy("list").agg(F.count(F.lit(1)).alias("rows"))

    def rebalance(self, limit: int, rounds: int = 8) -> list[int]:
        """Split lists of more than ``limit`` rows in two, again as long as they are too large; returns the lists split.

        Only the overfull lists are read. A list whose vectors are all equal stays as it is, since nothing tells them apart.
        """
        split, stuck = [], set()
        for _ in range(rounds):
            large = [r["list"] for r in self.sizes().where(F.col("rows") > limit).collect() if r["list"] not in stuck]
            if not large:
                break
            numbers, centres = self.centres()
            kept = dict(zip(numbers.tolist(), centres, strict=True))
            fresh = max([*numbers.tolist(), *self._used()]) + 1
            parts = []
            for number in large:
                rows = self.members([number])
                halves = train_centres(rows, "v", 2)
                if len(halves) < 2 or np.allclose(halves[0], halves[1]):
                    stuck.add(number)
                    continue
                names = np.arange(fresh, fresh + len(halves))
                fresh += len(halves)
                parts.append(_numbered(_assign(rows.select("id", "v"), halves, 1), names))
                del kept[number]
                kept |= dict(zip(names.tolist(), halves, strict=True))
                split.append(number)
            if not parts:
                break
            moved = parts[0]
            for part in parts[1:]:
                moved = moved.unionByName(part)
            self._write(moved, f"split-{fresh}")
            self._publish(kept)
        return split

    def _used(self) -> list[int]:
        """Numbers that any stored list has had: they are not used again."""
        return [int(p.rsplit("=", 1)[1]) for p in self._files.glob(f"{self.root}/lists/batch=*/list=*")]

    def search(self, queries: DataFrame, k: int, *, id: str, vector: str, probes: int | None = None) -> DataFrame:
        """The ``k`` nearest members for every query by squared distance, ties by id: ``q``, ``p``, ``distance``, ``rank``.

        A query looks into its nearest ``probes`` lists, by default four times the square root of their number; with all
        of them the search is exact. Vectors are compared in blocks; a block passes on k rows for each query.
        """
        numbers, centres = self.centres()
        probes = min(len(centres), probes or max(2, 4 * int(len(centres) ** 0.5)))
        rows = queries.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v")).where("v IS NOT NULL")
        asked = materialize(_numbered(_assign(rows, centres, probes), numbers), "index-queries")
        probed = [r["list"] for r in asked.select("list").distinct().collect()]  # at most as many as there are lists
        copies = Window.partitionBy("list", F.xxhash64("v"), "v").orderBy("id")
        found = self.members(probed).withColumn("_rn", F.row_number().over(copies)).where(F.col("_rn") <= k).drop("_rn")
        blocks = _blocks(materialize(found, "index-members"), BLOCK, "points")
        return _best(_compare(asked, blocks, k), k)


def _numbered(assigned: DataFrame, numbers: np.ndarray) -> DataFrame:
    """Places of centres turned into numbers of lists."""
    names = F.expr(f"array({', '.join(str(int(n)) for n in numbers)})")
    return assigned.withColumn("list", F.element_at(names, F.col("list") + 1))
