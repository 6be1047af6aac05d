import hashlib
import random

import numpy as np
import pandas as pd
import xxhash

from bookflow.llm import chunks

from .helpers import as_dir, documents


def plain_boundaries(data):
    """The rule, byte by byte."""
    out, start, h = [], 0, 0
    hashes = []
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFF
        hashes.append(h)
    for i in range(len(data)):
        n = i + 1 - start
        bits = chunks.STRICT if n < chunks.NORMAL else chunks.LAX
        if n >= chunks.SMALLEST and i + 1 < len(data) and hashes[i] >> (16 - bits) == 0 or n == chunks.LARGEST:
            out.append(i + 1)
            start = i + 1
    return out + [len(data)] * (start < len(data))


def test_boundaries(monkeypatch):
    rnd = random.Random(2)
    cases = [b"", b"a", b"x" * 5000, *(bytes(rnd.choices(b"abcdefg hij\n", k=rnd.randint(1, 6000))) for _ in range(60))]
    for data in cases:
        assert chunks.boundaries(data) == plain_boundaries(data)
    monkeypatch.setattr(chunks, "SLICE", 100)
    for data in cases:
        assert chunks.boundaries(data) == plain_boundaries(data)


def test_shift_resistance():
    rnd = random.Random(4)
    data = bytes(rnd.choices(b"abcdefghij klmnop", k=20_000))
    moved = data[:7000] + b"inserted words" + data[7000:]
    assert chunks.containment(chunks.fingerprint(data), chunks.fingerprint(moved)) > 0.95
    assert chunks.containment(chunks.fingerprint(data), chunks.fingerprint(data[::-1])) < 0.05


def expect(rows):
    def half_hash(t):
        return xxhash.xxh64_intdigest(t.encode(), 42) >> 1

    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), half_hash(r[1]), r[1]))
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        edited = (t[: len(t) - half] + after[:half]).encode()
        own, new, other = (chunks.fingerprint(x) for x in (t.encode(), edited, after.encode()))
        yield i, len(t), hashlib.sha256(edited).hexdigest(), chunks.digest(own), chunks.digest(new), chunks.containment(own, new), chunks.containment(own, other)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    found = got(chunks.op10(spark, sf))
    assert found == sorted(expect([*zip(docs.doc_id.tolist(), docs.text)]), key=repr)
    assert np.median([r[5] for r in found]) > 0.4 and np.median([r[6] for r in found]) < 0.2


def test_odd_rows(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", "ab", "é" * 999, "long text " * 3000, "long text " * 3000, "z"])] + [(None, "no id"), (3, "again"), (-5, "minus"), (3, "again")]
    assert got(chunks.op10(spark, as_dir(documents(spark, rows, extra=True), tmp_path))) == sorted(expect(rows), key=repr)
    assert got(chunks.op10(spark, as_dir(documents(spark, ["only one"]), tmp_path))) == [*expect([(0, "only one")])]
    assert got(chunks.op10(spark, as_dir(documents(spark, []), tmp_path))) == []
    sets = {r.doc_id: [d << 8 | n for d, n in zip(r.digests, r.sizes)] for r in chunks.chunk_sets(documents(spark, ["long text " * 300, None])).collect()}
    assert sets == {0: chunks.fingerprint(b"long text " * 300).tolist(), 1: []}


def test_the_string_holds_the_fingerprint():
    for data in (b"", b"ab", b"some longer text, with words " * 40):
        found = chunks.fingerprint(data)
        assert chunks.parse(chunks.digest(found)).tolist() == found.tolist() and chunks.weight(found) <= len(data)


def test_half_copies_of_short_texts():
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(2000)]
    for n, least in ((12, 0.2), (25, 0.3), (60, 0.38), (400, 0.45)):
        near = []
        for _ in range(200):
            a, b = (" ".join(rnd.choices(words, k=n)) for _ in range(2))
            edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
            near.append(chunks.containment(chunks.fingerprint(a.encode()), chunks.fingerprint(edited.encode())))
        assert np.mean(near) > least and np.mean(np.array(near) == 0) < 0.1, (n, np.mean(near))


def test_ids_and_nulls_that_hold_a_third_of_the_rows(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(None, f"null {rnd.random()}") for _ in range(300)] + [(7, f"seven {rnd.random()}") for _ in range(300)] + [(i, f"text {i}") for i in range(300)]
    df = documents(spark, rows)
    _, ways = chunks.bounds(df.select("doc_id").withColumnRenamed("doc_id", "id"), 8)
    assert ways[0] > 2 and sorted(ways)[-2] > 2
    assert got(chunks.op10(spark, as_dir(df, tmp_path))) == sorted(expect(rows), key=repr)
