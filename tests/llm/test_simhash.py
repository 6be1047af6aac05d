import random

import numpy as np
import pandas as pd
import xxhash

from bookflow.llm import components, simhash

from .helpers import as_dir, documents


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(rows, fps):
    """rows: (id, fp); brute force over distinct fingerprints."""
    distinct = sorted(set(fps))
    arr = np.array(distinct, np.uint64)
    parent = list(range(len(arr)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 4):
            parent[find(i)] = find(j)
    least = {}
    at = {f: i for i, f in enumerate(distinct)}
    for (i, _), f in zip(rows, fps):
        least[find(at[f])] = min(least.get(find(at[f]), 1 << 62), i)
    return [least[find(at[f])] for f in fps]


def test_fingerprint():
    for t in ["", " \n", "a", "A b c", "a b c d", "Ä ö ü\tß x\x0by", "w " * 300, "\x1c a\x85b c d e f", "THE CAT the cat the CAT"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t), t


def test_planted_chains_and_dense_groups(spark):
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(800)]
    fps = [*base, 0]
    for b in base[:60]:  # chains of links of 1 to 4 bits, and pairs of 5 bits
        for _ in range(6):
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                b ^= 1 << bit
            fps.append(b)
    dense = rnd.getrandbits(64)
    fps += [dense ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(600)]
    fps += fps[:50]
    rnd.shuffle(fps)
    rows = [(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.cluster(df).collect()}
    assert [got[i] for i, _ in rows] == plain_components(rows, fps)


def around(rnd, center, n, flips):
    out = set()
    while len(out) < n:
        x = center
        for bit in rnd.sample(range(64), flips):
            x ^= 1 << bit
        out.add(x)
    return np.array(sorted(out), np.uint64)


def test_small_blocks_lose_no_link(monkeypatch):
    rnd = random.Random(5)
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 3000)
    fps = np.unique(np.concatenate([around(rnd, rnd.getrandbits(64), 20, 3) for _ in range(4)]))
    forest = simhash.Forest(len(fps))
    simhash.meet(fps, np.arange(len(fps)), forest, 0, 0)
    want = plain_components([(i, 0) for i in range(len(fps))], [int(f) for f in fps])
    assert forest.label.tolist() == want


def test_a_large_group_of_near_copies(spark):
    """30,000 distinct fingerprints three bits from one centre, all linked, among others that aren't."""
    rnd = random.Random(11)
    fps = [*around(rnd, rnd.getrandbits(64), 30_000, 3).tolist(), *(rnd.getrandbits(64) for _ in range(2000))]
    df = spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.cluster(df).collect()}
    assert [got[i] for i in range(len(fps))] == plain_components([*enumerate(fps)], fps)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (99, 99)], "u long, v long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 99}


def test_query(spark, sf, tmp_path):
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    fps = [plain_fingerprint(t) for t in docs.text]
    want = set(zip(docs.doc_id, (f"{f:016x}" for f in fps), plain_components([*zip(docs.doc_id, fps)], fps)))
    assert {tuple(r) for r in simhash.op2(spark, sf).collect()} == want
    odd = as_dir(documents(spark, [None, "", " \n ", "one two three four five", "one two three four five", "x " * 50_000], extra=True), tmp_path / "odd")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2(spark, odd).collect()}
    assert [got[i] for i in range(3)] == [("0" * 16, 0)] * 3 and got[3][1] == got[4][1] == 3 and got[5][1] == 5
    assert simhash.op2(spark, as_dir(documents(spark, []), tmp_path / "none")).count() == 0


def test_clashing_columns_stay(spark):
    df = documents(spark, ["a b c d e f", "a b c d e f", "other words here"]).selectExpr("*", "'own' near_text", "'x' NEAR_ID", "'y' fp", "'z' group")
    kept = simhash.deduplicate(df).orderBy("doc_id").collect()
    assert [r.doc_id for r in kept] == [0, 2] and {(r.near_text, r.NEAR_ID, r.fp, r.group) for r in kept} == {("own", "x", "y", "z")}
