import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions.hashing import hash_unit
from ledgerline.operators import pairing, quality, timeline, vectors
from ledgerline.operators.nearest import knn_join
from tests.conftest import rows


def test_expectations(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "n int, s string")
    rules = {"positive": F.col("n") > 0, "known": F.col("s").isin("x")}
    assert rows(quality.expectation_metrics(df, "d", rules)) == [("d", "known", 1, 2), ("d", "positive", 2, 1)]
    assert quality.expect(df, rules).count() == 3
    assert rows(quality.expect(df, rules, quality.DROP)) == [(1, "x")]
    with pytest.raises(PySparkException, match="expectation failed"):
        quality.expect(df, rules, quality.FAIL).collect()
    assert quality.expect(df.limit(1), rules, quality.FAIL).count() == 1


def test_quarantine_and_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert [r[1:] for r in rows(quality.quarantine(df, ["k"]))] == [("a", 2), ("b", 2)]
    check = quality.check_primary_key(df, ["k"]).first()
    assert tuple(check) == (5, 3, 2, False)
    assert tuple(quality.check_primary_key(df.filter("k is null and false"), ["k"]).first()) == (0, 0, 0, True)
    dim = spark.createDataFrame([(1,), (1,)], "id int")
    assert tuple(quality.check_foreign_key(df, dim, "k", "id").first()) == (1, 1, 2)


def test_faults_hit_the_stated_share_again_and_again(spark):
    df = spark.range(20_000).withColumn("c", F.lit("ok"))
    hit = quality.inject_faults(df, F.col("id"), [("c", 0.1, F.lit("BAD"))])
    share = hit.filter("c = 'BAD'").count() / 20_000
    assert abs(share - 0.1) < 0.01
    assert rows(hit.limit(50)) == rows(quality.inject_faults(df, F.col("id"), [("c", 0.1, F.lit("BAD"))]).limit(50))


def test_zip_pairs_by_position(spark):
    left = spark.createDataFrame([("c",), ("a",), ("b",)], "l string")
    right = spark.range(10, 12)
    assert rows(pairing.zip_rows(left, right, ["l"], ["id"]).select("l", "id")) == [("a", 10), ("b", 11)]


def test_pick_is_uniform_and_stays_in_the_group(spark):
    people = spark.range(9000).select("id", (F.col("id") % 3).alias("g"))
    places = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 4)], "g long, p int")
    picked = pairing.pick_one(people, places, F.col("id"), ["p"], ["g"])
    counts = {(r["g"], r["p"]): r["count"] for r in picked.groupBy("g", "p").count().collect()}
    assert counts[(1, 4)] == 3000 and sum(v for (g, _), v in counts.items() if g == 0) == 3000
    assert all(900 < counts[(0, p)] < 1100 for p in (1, 2, 3)) and not any(g == 2 for g, _ in counts)


def test_no_candidates_no_rows(spark):
    empty = spark.createDataFrame([], "p int")
    assert pairing.pick_one(spark.range(5), empty, F.col("id"), ["p"]).count() == 0


@pytest.mark.parametrize("bound", [100, 3])
def test_schedule_in_one_array_or_in_chunks(spark, bound):
    templates = spark.range(7).select(F.col("id").alias("t"))
    out = pairing.expand_schedule(spark.range(4), templates, max_templates=bound)
    assert rows(out) == sorted((i, t) for i in range(4) for t in range(7))


def test_sessions_from_arrays_equal_sessions_from_rows(spark):
    df = spark.createDataFrame([("a", [1, 2, 3], [10, 20, 30]), ("b", [], []), ("c", [4], [5]), ("d", None, None),
                                ("e", [1, None], [None, 2])], "c string, g array<int>, d array<int>")
    out = timeline.expand_sessions(df, base=F.lit(100), gaps="g", durations="d")
    assert rows(out.select("c", "session", "start_at", "end_at")) == [
        ("a", 1, 101, 111), ("a", 2, 113, 133), ("a", 3, 136, 166), ("c", 1, 104, 109), ("e", 1, 101, 101), ("e", 2, 101, 103)]
    rowwise = timeline.zip_explode(df.filter("c in ('a', 'c')"), ["g", "d"], "session")
    for split in (False, True):
        timed = timeline.session_times(rowwise, ["c"], ["session"], base=F.lit(100), gap="g", duration="d", split=split)
        assert rows(timed.select("c", "session", "start_at", "end_at")) == [
            ("a", 1, 101, 111), ("a", 2, 113, 133), ("a", 3, 136, 166), ("c", 1, 104, 109)]
    with pytest.raises(PySparkException, match="same length"):
        uneven = spark.createDataFrame([([1], [1, 2])], "g array<int>, d array<int>")
        timeline.expand_sessions(uneven, base=F.lit(0), gaps="g", durations="d").collect()


def test_knn_equals_brute_force_with_a_dense_place_and_copies(spark):
    key = F.col("id")
    spreaded = spark.range(300).select(key, (hash_unit(key, "a") * 60).alias("lat"), (hash_unit(key, "b") * 60).alias("lon"))
    dense = spark.range(300, 900).select(key, (hash_unit(key, "a") / 50 + 7).alias("lat"), (hash_unit(key, "b") / 50 + 7).alias("lon"))
    copies = spark.range(900, 1200).select(key, F.lit(7.005).alias("lat"), F.lit(7.005).alias("lon"))
    points = spreaded.unionByName(dense).unionByName(copies)
    asked = points.sample(0.15, seed=3).unionByName(spark.createDataFrame([(5000, -90.0, 170.0), (5001, 7.005, 7.0)], "id long, lat double, lon double"))
    found = {}
    for r in knn_join(asked.withColumnRenamed("id", "q"), points, 4, query_id="q", point_id="id", leaf_points=16).collect():
        found.setdefault(r["q"], {})[r["rank"]] = r["id"]
    places = [tuple(r) for r in points.collect()]
    for q, lat, lon in [tuple(r) for r in asked.collect()]:
        best = sorted(places, key=lambda p: ((p[1] - lat) ** 2 + (p[2] - lon) ** 2, p[0]))[:4]
        assert [found[q][i] for i in (1, 2, 3, 4)] == [p[0] for p in best]


def test_knn_with_few_or_no_points(spark):
    asked = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "q int, lat double, lon double")
    two = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0)], "p int, lat double, lon double")
    out = knn_join(asked, two, 3, query_id="q", point_id="p")
    assert rows(out.select("q", "p", "rank")) == [(1, 1, 1), (1, 2, 2)]
    assert knn_join(asked, two.filter("false"), 3, query_id="q", point_id="p").count() == 0


def test_vector_search_exact_and_recall(spark):
    import numpy as np

    data = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    local = data.toPandas()
    matrix, ids = np.array(local["embedding"].tolist(), dtype=float), local["vec_id"].to_numpy()
    truth = {}
    for i, q in enumerate(ids):
        far = ((matrix - matrix[i]) ** 2).sum(axis=1)
        truth[q] = list(ids[np.lexsort((ids, far))[:5]])

    def search(**how):
        found = {}
        for r in vectors.knn_vectors(data, data, 5, id="vec_id", vector="embedding", lists=8, **how).collect():
            found.setdefault(r["q"], []).append((r["rank"], r["p"]))
        return {q: [p for _, p in sorted(v)] for q, v in found.items()}

    assert search(exact=True) == truth
    near = search(exact=False)
    recall = sum(len(set(near[q]) & set(truth[q])) for q in truth) / (5 * len(truth))
    assert recall >= 0.9


def test_knn_with_one_far_outlier_compares_few_pairs(spark):
    key = F.col("id")
    points = spark.range(2000).select(key, (hash_unit(key, "a") + 5).alias("lat"), (hash_unit(key, "b") + 5).alias("lon"))
    points = points.unionByName(spark.createDataFrame([(2000, 9e7, 9e7)], "id long, lat double, lon double"))
    found = knn_join(points, points.withColumnRenamed("id", "p"), 2, query_id="id", point_id="p")
    got = {(r["id"], r["rank"]): r["distance"] for r in found.collect()}
    data = [(r["id"], r["lat"], r["lon"]) for r in points.collect()]
    for i, x, y in data[::97] + data[-1:]:
        best = sorted((x - a) ** 2 + (y - b) ** 2 for _, a, b in data)[:2]
        assert [got[i, 1], got[i, 2]] == pytest.approx(best)


def test_centres_with_a_hot_vector(spark):
    points = spark.range(3000).selectExpr("transform(sequence(1, 8), j -> float(hash(id, j) / 1e9)) as v")
    # The vector that a draw by hash takes first, many times over.
    hot = points.orderBy(F.xxhash64("v", F.lit(7))).limit(1).crossJoin(spark.range(5000)).select("v")
    centres = vectors.train_centres(points.unionByName(hot), "v", 16)
    assert 12 <= len(centres) <= 16 and len(np.unique(centres.round(6), axis=0)) == len(centres)
    assert len(vectors.train_centres(points.limit(1), "v", 1)) == 1
    assert len(vectors.train_centres(points.limit(0), "v", 4)) == 0


def test_traffic_budget(spark):
    from ledgerline.operators.timeline import traffic_budget

    row = spark.range(1).select(traffic_budget(F.lit(30.0), F.lit(6), F.lit(8)).alias("b"), traffic_budget(F.lit(30.0), F.lit(8), F.lit(8)).alias("none")).first()
    assert row["b"]["down"] == 0.1 * 1024**3 / (200 * 50) and abs(row["b"]["up"] - row["b"]["down"] / 10) < 1e-9
    assert row["none"]["down"] is None


@pytest.mark.parametrize("exact", [True, False])
def test_vector_search_hands_on_small_batches(spark, monkeypatch, exact):
    """What a task passes to and from Python at once does not grow with the number of lists."""
    from pyspark import AccumulatorParam

    frame = type(spark.range(1))

    class Largest(AccumulatorParam):
        def zero(self, value):
            return 0

        def addInPlace(self, one, other):
            return max(one, other)

    rows_out = spark.sparkContext.accumulator(0, Largest())

    def watched(kind, rows_of):
        plain = getattr(frame, kind)

        def run_watched(self, run, schema, *more, **named):
            def run_and_see(batches):
                for out in run(batches):
                    rows_out.add(rows_of(out))
                    yield out

            return plain(self, run_and_see, schema, *more, **named)

        monkeypatch.setattr(frame, kind, run_watched)

    watched("mapInPandas", len)
    watched("mapInArrow", lambda batch: batch.num_rows)
    # Far more lists than 3,000 vectors need stand for the lists of many vectors.
    data = spark.range(0, 3000, 1, 1).selectExpr("id as vec_id", "transform(sequence(1, 8), j -> float(hash(id, j) / 1e9)) as embedding")
    found = vectors.knn_vectors(data, data, 3, id="vec_id", vector="embedding", lists=200, probes=100, exact=exact)
    assert found.count() == 9000
    assert 0 < rows_out.value <= 16_384


def test_knn_partitions_follow_the_number_of_queries(spark, monkeypatch):
    """Pairs of queries and cells are dealt to as many tasks as they need, however few bytes the queries have."""
    from ledgerline.operators import nearest

    monkeypatch.setattr(nearest, "TASK_ROWS", 64 * 50, raising=False)
    key = F.col("id")
    places = spark.range(400).select(key, hash_unit(key, "a").alias("lat"), hash_unit(key, "b").alias("lon"))
    found = knn_join(places, places.withColumnRenamed("id", "p"), 1, query_id="id", point_id="p")
    held = found.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(held) >= 6 and sum(r["count"] for r in held) == 400
    assert found.where("id = p and distance = 0").count() == 400
