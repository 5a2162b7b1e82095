import hashlib

import numpy as np
import pytest
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import suffixes


def brute(rows, length):
    """Digest columns per row, rows in order of (id, hash of nothing): ids are unique or rows equal."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = True
            seen.add(window)
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out.append((str(i), len(data), int(gone.sum()), len(suffixes.spread(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def ours(df, **options):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((str(r["doc_id"]), *(r[c] for c in columns)) for r in suffixes.remove_repeats(df, **options).collect())


@pytest.mark.parametrize("shard_bytes", [suffixes.SHARD_BYTES, 3000])
def test_same_as_brute_force(spark, shard_bytes):
    df = documents(spark).where("doc_id < 120").select("doc_id", "text")
    assert ours(df, shard_bytes=shard_bytes) == brute([tuple(r) for r in df.collect()], 100)


@pytest.mark.parametrize("shard_bytes", [suffixes.SHARD_BYTES, 2000])
def test_traps(spark, shard_bytes):
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, f"{'ab' * (k % 7)}start {k} {passage} end {k * 31}") for k in range(60)]
    rows += [(100, "x" * 450), (101, "xy" * 300), (102, "é" * 200), (103, "ab" * 49 + "c"), (104, passage[:99]), (105, passage[:100]), (106, None)]
    rows += [(107, rows[5][1]), (108, rows[5][1]), (109, passage + passage), (None, passage[20:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(df, shard_bytes=shard_bytes) == brute(rows, 100)


def test_awkward_rows(spark):
    df = awkward(spark).where("doc_id is null or doc_id <> 4")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert ours(df) == brute(rows, 100)
    assert ours(empty(spark)) == []
    twice = spark.createDataFrame([(1, "repeat " * 30)] * 2, "doc_id long, text string")
    assert sorted(r["n_removed"] for r in suffixes.remove_repeats(twice).collect())[1] == 210


def test_suffix_array_and_prefixes():
    draw = np.random.default_rng(4)
    for data in (b"banana", b"aaaaaaaaaaaaaaaaaaaaa", b"a", bytes(draw.integers(0, 3, 900).astype(np.uint8)), b"abcabc" * 40, b"\0\0\0\0\0\0\0\0\0\0ab\0"):
        order = suffixes.suffix_array(np.frombuffer(data, dtype=np.uint8))
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared = suffixes.common_prefixes(np.frombuffer(data, dtype=np.uint8), order, 50, lane=7)
        for k in range(1, len(data)):
            a, b = data[order[k - 1] :], data[order[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(n, 50)
