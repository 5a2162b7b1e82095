import numpy as np
import pytest
import xxhash
from tests.llm.helpers import awkward, documents, empty

from ledgerline.llm import graph, simhash


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, radius):
    """Smallest id reachable, by comparing all with all."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(prints))]


@pytest.mark.parametrize("frame", [documents, awkward])
def test_same_as_brute_force(spark, frame):
    df = frame(spark)
    rows = df.select("doc_id", "text").collect()
    prints = [brute_print(r["text"]) for r in rows]
    expected = sorted(zip([str(r["doc_id"]) for r in rows], prints, map(str, brute_components(prints, [r["doc_id"] for r in rows], 2)), strict=True))
    found = simhash.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), int(bytes(r["fp"]).hex(), 16), str(r["component_id"])) for r in found) == expected
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("shard_rows", [20_000, 7])
def test_links_miss_nothing(spark, shard_rows):
    draw = np.random.default_rng(2)
    base = [int(x) for x in draw.integers(0, 2**63, 30)]
    prints = set(base)
    for b in base:  # chains of near prints, and one large group
        for _ in range(60 if b == base[0] else 3):
            b ^= 1 << int(draw.integers(64))
            prints.add(b)
    prints = sorted(prints)
    df = spark.createDataFrame([(bytearray(p.to_bytes(8, "big")),) for p in prints], "fp binary")
    edges = simhash.links(df, simhash.Settings(), len(prints), shard_rows)
    roots = {bytes(r["node"]): bytes(r["root"]) for r in graph.components(edges).collect()}
    found = [int.from_bytes(roots.get(p.to_bytes(8, "big"), p.to_bytes(8, "big")), "big") for p in prints]
    assert found == brute_components(prints, prints, 2)
    assert edges.count() < 6 * len(prints) * (1 if shard_rows > 1000 else 30)


def test_tree_follows_only_edges_within_the_radius():
    draw = np.random.default_rng(1)
    prints = np.unique(draw.integers(0, 2**16, 400).astype(np.uint64))[:, None]
    trees = simhash.Trees(prints, np.zeros(len(prints)))
    some = trees.parent >= 0
    assert (simhash.hamming(prints[some], prints[trees.parent[some]]) == trees.edge[some]).all()
    a, b = trees.search(np.arange(len(prints)), 2, np.arange(len(prints)), np.full(len(prints), -1))
    expected = {(i, j) for i in range(len(prints)) for j in range(len(prints)) if i != j and (int(prints[i, 0]) ^ int(prints[j, 0])).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == expected


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("(id * 5) % 301 as a", "((id + 1) * 5) % 301 as b")
    found = graph.components(edges).collect()
    assert len(found) == 300 and {r["root"] for r in found} == {0}


def test_stage_keeps_one_of_each_group(spark):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for d in range(12):
        text = [f"{w}x{d}" for w in words]
        rows.append((10 * d, " ".join(text)))
        rows.append((10 * d + 1, " ".join([*text[:200], "changed", *text[201:]])))
    rows += [(500, rows[0][1]), (500, rows[0][1]), (None, rows[0][1]), (None, "alone without an id"), (None, "alone without an id"), (600, None), (601, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    found = sorted(str(r["doc_id"]) for r in kept.collect())
    assert found == sorted([*[str(10 * d) for d in range(12)], "None", "600"])
    assert simhash.keep_one(empty(spark)).count() == 0


def test_stage_finds_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    component = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, settings=simhash.SIMILAR).collect()}
    sets, places = {}, {}
    for i, text in rows.items():
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
        for s in sets[i]:
            places.setdefault(s, []).append(i)
    pairs = {(a, b) for ids in places.values() if len(ids) < 30 for a in ids for b in ids if a < b}
    similar = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert len(similar) > 20 and sum(component[a] == component[b] for a, b in similar) >= 0.9 * len(similar)


def test_stage_decides_by_exact_similarity(spark):
    draw = np.random.default_rng(3)
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, linked, apart = [], [], []
    for d in range(400):
        words = [f"w{x}" for x in draw.integers(0, 10**9, 1000 if d % 2 else 300)]
        other, wanted = list(words), 0.80 + 0.05 * draw.random() if d < 200 else 0.70 + 0.09 * draw.random()
        for place in draw.permutation(len(words)):
            before, other[place] = other[place], "changed%d" % place
            s, t = shingles(words), shingles(other)
            if len(s & t) < wanted * len(s | t):
                other[place] = before
                break
        s, t = shingles(words), shingles(other)
        similar = len(s & t) >= 0.8 * len(s | t)
        (linked if similar else apart).append(d)
        rows += [(2 * d, " ".join(words)), (2 * d + 1, " ".join(other))]
    # Dominated by a repeated passage: equal as multisets, different as sets.
    repeat = "over and over again here now " * 3000
    for d in (400, 401):
        rows.append((2 * d, repeat + " ".join(f"own{d}x{k}" for k in range(100))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.keep_one(df).collect()}
    assert len(linked) > 150 and len(apart) > 150
    assert all(2 * d in kept for d in [*linked, *apart, 400, 401])
    assert all(2 * d + 1 in kept for d in apart)
    assert sum(2 * d + 1 not in kept for d in linked) >= 0.99 * len(linked)


def family(seed, size, changed, words=300):
    """Copies of one text, each with some words of its own."""
    draw = np.random.default_rng(seed)
    base = [f"w{x}" for x in draw.integers(0, 10**9, words)]
    out = []
    for d in range(size):
        text = list(base)
        for place in draw.permutation(words)[:changed]:
            text[place] = f"own{seed}x{d}x{place}"
        out.append(text)
    return out


def exact_components(texts):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("shard_bytes", [16 << 20, 20_000])
def test_near_misses_and_links_of_families(spark, monkeypatch, shard_bytes):
    """Families just below 0.8, just above it, and around it: links as by brute force, and no pairs leave a shard."""
    monkeypatch.setattr(simhash, "SHARD_BYTES", shard_bytes)
    passed_on = []
    stored = simhash.store
    monkeypatch.setattr(simhash, "store", lambda df, label: (passed_on.append((label, (r := stored(df, label)).count())), r)[1])
    texts = family(1, 120, 8) + family(2, 120, 3) + family(3, 60, 5) + family(4, 60, 6) + [w + ["tail"] * 9 for w in family(5, 30, 7)]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, settings=simhash.SIMILAR).collect()}
    expected = exact_components(texts)
    assert len({expected[k] for k in range(120)}) == 120 and len({expected[k] for k in range(120, 240)}) == 1
    wrong = [k for k in range(len(texts)) if found[k] != expected[k]]
    assert len(wrong) <= 0.01 * len(texts), wrong
    counts = dict(passed_on)
    assert counts["stars"] <= 20 * len(texts) and counts["rest"] <= (1 if shard_bytes > 100_000 else 40) * len(texts)


def test_sets_as_bits():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 40_000, n).astype(np.uint64)) for n in (0, 1, 30_000, 30_000, 500, 20_000)]
    rows = np.array([0, 1, 2, 3, 5])
    a, b = np.array([0, 1, 2, 3, 2]), np.array([1, 2, 3, 5, 5])
    common = simhash._Bits(rows, sets).common(a, b)
    assert common.tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)]
