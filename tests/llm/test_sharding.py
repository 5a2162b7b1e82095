import zlib

import numpy as np
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import sharding


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    expected = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == expected
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    most = max(r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    for k in range(shards):
        assert abs(sum(r["size"] for r in by.get(k, [])) - total / shards) <= most


def test_near_equal_bytes(spark):
    docs = documents(spark)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for range_rows in (100_000, 10):  # one range, and many that are cut again
        check(sharding.shard(docs, 5, range_rows=range_rows).collect(), texts, 5)


def test_awkward_rows(spark):
    df = awkward(spark)
    check(sharding.shard(df, 3).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 3)
    assert sharding.shard(empty(spark), 3).count() == 0


def test_hot_text_is_cut(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same words', concat('text ', id)) as text")
    check(sharding.shard(df, 4, range_rows=100).collect(), [(r["doc_id"], r["text"]) for r in df.collect()], 4)


def test_reruns_agree(spark):
    runs = [sorted(map(tuple, sharding.shard(documents(spark), 6, range_rows=20).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_locate():
    splitters = np.array([[1, 5], [1, 9], [4, 0]])
    found = sharding.locate(np.array([0, 1, 1, 1, 1, 2, 4, 4, 9]), np.array([7, 4, 5, 8, 9, 0, -1, 0, 0]), splitters)
    assert found.tolist() == [0, 0, 1, 1, 2, 2, 2, 3, 3]
