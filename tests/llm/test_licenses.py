import math
import re

import pandas as pd

from bookflow.llm import licenses

from .helpers import as_dir, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(rows):
    words = [(i, plain_words(t)) for i, t in rows]
    n = len(rows)
    df = {w: sum(w in set(ws) for _, ws in words) for w in licenses.key_vocabulary(licenses.TEMPLATES)}
    weight = lambda w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1
    for i, ws in words:
        base, labels, score = [], set(), 0.0
        for t in licenses.TEMPLATES:
            k = t.key_words
            for s in range(len(ws) - len(k) + 1):
                if ws[s : s + len(k)] == k:
                    labels.add(t.label)
                    base += [(s, t.label)] * t.base
                    met = sum(weight(w) for j, w in enumerate(t.words) if 0 <= s - t.key_at + j < len(ws) and ws[s - t.key_at + j] == w)
                    score = max(score, met / sum(map(weight, t.words)))
        starts = [s for s, _ in base]
        yield i, len(ws), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(score, 6)


def got(df):
    return sorted(((*tuple(r)[:-1], round(r.score, 6)) for r in df.collect()), key=repr)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    assert got(licenses.op6(spark, sf)) == sorted(plain([*zip(docs.doc_id.tolist(), docs.text)]), key=repr)


def test_odd_rows(spark, tmp_path):
    texts = [
        None, "", " ... ", "MIT License", "mit license mit license", "x-mit-license", "mit licenses", "submit license", "KCC BY-NC 4.0 K", "GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
        "cc\x00by", "cc by", "ccby", "mit İ license", "gnu gnu general public license public license", "MIT LICENSE " * 3000, "license mit", "Permission is hereby granted, free of charge, to any person",
        "apache apache license license version 2 0", "word " * 40_000 + "mit license",
    ]
    rows = [*enumerate(texts), (None, "mit license"), (3, "MIT License")]
    assert got(licenses.op6(spark, as_dir(documents(spark, rows, extra=True), tmp_path))) == sorted(plain(rows), key=repr)
    assert licenses.op6(spark, as_dir(documents(spark, []), tmp_path)).count() == 0


def test_plan_is_native(spark, sf):
    plan = licenses.op6(spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan.split("== Physical Plan ==")[1]
