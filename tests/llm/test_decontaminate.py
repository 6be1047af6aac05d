import itertools
import random
import re

import pandas as pd
import pytest

from bookflow.llm import decontaminate

from .helpers import as_dir, documents

ITEMS = "item_id long, text string"


def plain_words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def plain(docs, items):
    """All pairs, all diagonals; no masks. The best (score, matched, first, last) of each pair."""
    found = {}
    for d, t in docs:
        ws = plain_words(t)
        for k, it in items:
            iw = plain_words(it)
            for g in range(-len(iw), len(ws)):
                eq = [0 <= g + j < len(ws) and ws[g + j] == iw[j] for j in range(len(iw))]
                inside = [j for j in range(len(iw)) if 0 <= g + j < len(ws)]
                if sum(eq) < min(decontaminate.LEAST, len(iw)) or not iw:
                    continue
                best = max(sum(1 if eq[j] else -1 for j in inside[a:b]) for a in range(len(inside)) for b in range(a + 1, len(inside) + 1))
                if best >= min(decontaminate.LEAST, len(iw)) and (len(iw) >= decontaminate.SHORT or len(iw) == len(ws)):
                    found[(d, k)] = max(found.get((d, k), 0), best)
    return found


def fixture():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(words, k=n))) for i, n in enumerate([30, 16, 20, 12, 9, 40, 5])]
    items += [(7, "one two"), (8, "single"), (9, "again " * 15)] + [(50, None), (51, "")]
    items.append((60, items[0][1]))
    docs = []
    for i in range(60):
        ws = rnd.choices(words, k=rnd.randint(0, 80))
        if i % 2:
            own = items[rnd.randrange(6)][1].split()
            for _ in range(rnd.randint(0, len(own) // 4)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            cut = rnd.randint(0, 8) if i % 3 == 0 else 0
            own = own[cut:]
            at = rnd.randint(0, len(ws))
            ws[at:at] = own
        docs.append((i, ", ".join(ws).upper() if i % 5 == 0 else " ".join(ws)))
    return docs + [(100, None), (101, ""), (None, items[5][1]), (3, docs[3][1]), (3, "another text"), (102, items[1][1]), (103, items[4][1]), (104, "One, two!"), (105, "one two three"), (106, "single"), (107, "again " * 40), (108, "x y " + items[4][1] + " z"), (109, items[6][1] + " tail")], items


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_against_all_pairs(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", bound)
    docs, items = fixture()
    sf = as_dir(documents(spark, docs, extra=True), tmp_path)
    as_dir(spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' words", "1 doc_id", "2 seed"), tmp_path, "benchmark")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.op4(spark, sf).collect()}
    assert got == plain(docs, items) and len(got) > 20
    kept = [(r.doc_id, r.text) for r in decontaminate.clean(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).collect()]
    dirty = {(d, t) for d, t in docs for k, _ in items if (d, k) in plain([(d, t)], items)}
    assert sorted(kept, key=repr) == sorted(((d, t) for d, t in docs if (d, t) not in dirty), key=repr)


def test_clean_keeps_other_texts_of_an_id(spark):
    item = " ".join(f"x{i}" for i in range(20))
    docs = [(1, f"a {item} b"), (1, "clean words"), (None, item), (None, "no id"), (2, None)]
    kept = decontaminate.clean(documents(spark, docs), spark.createDataFrame([(1, item)], ITEMS)).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept))) == sorted(map(repr, [docs[1], docs[3], docs[4]]))


def best_score(eq):
    best = run = 0
    for same in eq:
        run = max(run + (1 if same else -1), 0)
        best = max(best, run)
    return best


def hit(eq):
    return any(all(eq[p + o] for o in m) for m in decontaminate.MASKS for p in range(len(eq) - m[-1]))


def test_recall_of_the_masks():
    """Against all stretches that reach LEAST: all of them for few substitutions, 0.99 and more at any length and rate."""
    for n, k in ((10, 0), (12, 1), (14, 2), (15, 2), (16, 3), (18, 4), (20, 5)):
        cases = [[j not in gone for j in range(n)] for gone in map(set, itertools.combinations(range(n), k))]
        cases = [eq for eq in cases if best_score(eq) >= decontaminate.LEAST]
        assert sum(map(hit, cases)) >= 0.99 * len(cases), (n, k, sum(map(hit, cases)), len(cases))
    rnd, total, found = random.Random(3), 0, 0
    for n in (12, 20, 30, 45, 60):
        for rate in (0.05, 0.1, 0.2, 0.3, 0.35):
            cases = [eq for eq in ([rnd.random() >= rate for _ in range(n)] for _ in range(500)) if best_score(eq) >= decontaminate.LEAST]
            total, found = total + len(cases), found + sum(map(hit, cases))
            assert len(cases) < 50 or sum(map(hit, cases)) >= 0.98 * len(cases), (n, rate)
    assert found >= 0.999 * total
    for k in (3, 4, 5):
        assert all(hit([(j + s) % k != 0 for j in range(60)]) for s in range(k))


def test_bitmap_keeps_all_seeds(spark):
    items = spark.range(2000).selectExpr("xxhash64(id) seed")
    both = items.union(spark.range(10_000, 60_000).selectExpr("xxhash64(id) seed"))
    kept = {r.seed for r in decontaminate.likely(both, items).collect()}
    assert {r.seed for r in items.collect()} <= kept and len(kept) < 2100


def test_spans_and_matches(spark, tmp_path):
    sf = as_dir(documents(spark, ["a b c d " + " ".join(f"x{i}" for i in range(20)) + " e f"]), tmp_path)
    as_dir(spark.createDataFrame([(1, " ".join(f"x{i}" if i != 7 else "other" for i in range(20)))], ITEMS), tmp_path, "benchmark")
    assert [tuple(r) for r in decontaminate.op4(spark, sf).collect()] == [(0, 1, 18, 19, 4, 23)]


def test_planted_in_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = pd.read_parquet(f"{sf}/documents.parquet"), pd.read_parquet(f"{sf}/benchmark.parquet")
    flat = [(i, f" {' '.join(plain_words(t))} ") for i, t in zip(docs.doc_id, docs.text)]
    whole = {(d, k) for k, it in zip(items.item_id, items.text) for d, t in flat if f" {' '.join(plain_words(it))} " in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op4(spark, sf).collect()}
    assert whole and got == whole


def test_empty_tables(spark, tmp_path):
    sf = as_dir(documents(spark, []), tmp_path)
    as_dir(spark.createDataFrame([], ITEMS), tmp_path, "benchmark")
    assert decontaminate.op4(spark, sf).count() == 0
    as_dir(documents(spark, ["some words"]), tmp_path)
    assert decontaminate.op4(spark, sf).count() == 0


def test_plan_is_native(spark, sf):
    assert not re.search("Python|Pandas|Arrow", decontaminate.op4(spark, sf)._jdf.queryExecution().toString())
