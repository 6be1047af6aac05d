import random

import corpus_pipeline
import pandas as pd
from bookflow.llm import shingles, simhash
from bookflow.llm.common import table

from .helpers import documents

SF = "/root/testdata/sf0.01"


def plain_set(t):
    ws = (t or "").encode().translate(simhash.LOWER).split()
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))) if ws else frozenset()


def plain_kept(docs):
    """Smallest id of each component over all pairs of likeness 0.8 or more."""
    sets, root = [plain_set(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    out = {}
    for i, (d, _) in enumerate(docs):
        out[find(i)] = min(out.get(find(i), d), d)
    return sorted(out.values())


def test_near_copies_of_ordinary_length(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for n in (40, 60, 120, 300, 800):
        base = rnd.choices(words, k=n)
        docs.append(" ".join(base))
        for changes in (1, n // 60, n // 45, n // 20):
            near = list(base)
            for at in range(changes):
                near[(at * n) // max(changes, 1) + 3] = f"new{at}"
            docs.append(" ".join(near))
    docs += [" ".join(rnd.choices(words, k=50)) for _ in range(20)] + ["", None, "a b", "A  b", "a b c"]
    docs = [*enumerate(docs)]
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, docs), "").collect())
    assert kept == plain_kept(docs) and len(kept) < len(docs) - 8
    assert len(simhash.deduplicate(documents(spark, docs)).collect()) > len(kept)


def test_whole_table_against_all_pairs(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    kept = sorted(r.doc_id for r in shingles.deduplicate(table(spark, SF, "documents")).collect())
    assert kept == plain_kept([*zip(docs.doc_id, docs.text)])
