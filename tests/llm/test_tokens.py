import hashlib
import random
import time

import pandas as pd
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

from bookflow.llm import bpe, common, pretoken, token_count

from .helpers import as_dir, documents

PARTS = ["'", "s", "t", "re", "ve", "ll", "'s", "''", " ", "  ", "\n", " \n", "\t", "\r\n", "a", "é", "中", "1", "²", "!", "-", "　", "​", "\x1c", "\x85", "<|endoftext|>", "😀", "aaaaaaaa", "I'm"]
JSON = public_tokenizers.path("byte_bpe_50k.json")


def texts(n=3000):
    rnd = random.Random(7)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + ["a" * 30_000, "", " " * 500, "x  " * 900, "'s's'll"]


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(bpe.vocabulary_path()), special_tokens={})


def test_pretokens_equal_the_pattern():
    sample = texts()
    found, counts = pretoken.tokens(sample)
    at = 0
    for t, n in zip(sample, counts):
        assert found[at : at + n] == regex.findall(public_tokenizers.PATTERN, t)
        at += n


def test_encode_equals_library_and_round_trips():
    sample, enc, path = texts(), reference(), bpe.vocabulary_path()
    ids, offsets, counts = bpe.encode_texts(sample, path)
    at = 0
    for t, n, back in zip(sample, counts, bpe.decode_ids(ids, offsets, counts, path)):
        assert ids[at : at + n].tolist() == enc.encode_ordinary(t)
        assert back == t.encode()
        at += n


def test_counts_equal_library():
    sample, tok = texts(), Tokenizer.from_file(JSON)
    assert token_count.count_texts(sample, JSON).tolist() == [len(tok.encode(t, add_special_tokens=False).ids) for t in sample]


def test_queries_on_odd_rows(spark, tmp_path):
    odd = [None, "", "plain text", "plain text", " " * 40_000, "a b\n\nc's", "<|endoftext|>x"]
    df = documents(spark, odd, extra=True).union(documents(spark, [(2, "plain text")], extra=True)).union(documents(spark, [(None, "no id")], extra=True))
    sf = as_dir(df, tmp_path)
    enc, tok = reference(), Tokenizer.from_file(JSON)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op1(spark, sf).collect()}
    want = set()
    for i, t in [*enumerate(odd), (None, "no id")]:
        ids = enc.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want and bpe.op1(spark, sf).count() == 9
    counts = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.op8(spark, sf).collect()}
    assert counts == {(i, len((t or "").encode()), n := len(tok.encode(t or "").ids), n > 1024) for i, t in [*enumerate(odd), (None, "no id")]}


def test_empty_table(spark, tmp_path):
    sf = as_dir(documents(spark, []), tmp_path)
    assert bpe.op1(spark, sf).count() == token_count.op8(spark, sf).count() == 0


def test_whole_table(spark, sf):
    docs, enc, tok = pd.read_parquet(f"{sf}/documents.parquet"), reference(), Tokenizer.from_file(JSON)
    texts = [t or "" for t in docs.text]
    want = {(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t, ids in zip(docs.doc_id, texts, enc.encode_ordinary_batch(texts))}
    assert {tuple(r) for r in bpe.op1(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
    counts = {(i, len(t.encode()), len(e.ids), len(e.ids) > 1024) for i, t, e in zip(docs.doc_id, texts, tok.encode_batch(texts, add_special_tokens=False))}
    assert {tuple(r) for r in token_count.op8(spark, sf).collect()} == counts


def test_encode_and_decode_tables(spark):
    rows = [None, "", "some words here", "x" * 3000, "é 中 😀"]
    found = bpe.encode(documents(spark, rows), verify=True)
    back = {r.doc_id: (bytes(r.decoded), r.decoded_sha256) for r in bpe.decode(found, ["doc_id", "decoded_sha256"]).collect()}
    assert back == {i: ((t or "").encode(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in enumerate(rows)}


def test_segments_change_nothing(monkeypatch):
    sample, enc, tok = texts(400), reference(), Tokenizer.from_file(JSON)
    for t in sample:
        parts = [*common.segments(t, 5)]
        assert "".join(parts) == t and all(not p[:1].strip(" \n") for p in parts[1:])
    monkeypatch.setattr(common.blocks, "__defaults__", (23,))
    ids, _, counts = bpe.encode_texts(sample, bpe.vocabulary_path())
    assert ids.tolist() == [i for t in sample for i in enc.encode_ordinary(t)] and counts.sum() == len(ids)
    n, of_ids, of_bytes = bpe.digests_of(sample, bpe.vocabulary_path())
    assert of_bytes == [hashlib.sha256(t.encode()).hexdigest() for t in sample] and n == counts.tolist()
    assert of_ids == [hashlib.sha256(" ".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest() for t in sample]
    assert token_count.count_texts(sample, JSON).tolist() == [len(tok.encode(t, add_special_tokens=False).ids) for t in sample]


def test_long_runs_take_linear_time():
    rnd, tok = random.Random(3), Tokenizer.from_file(JSON)
    run = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    begun = time.time()
    assert token_count.count_texts([run, "é" * 5000], JSON).tolist() == [len(tok.encode(t).ids) for t in (run, "é" * 5000)]
    assert time.time() - begun < 5


def test_the_longest_of_overlapping_special_strings_wins():
    assert token_count.split_special("a<x>b<x><y>c", ["<x>", "<x><y>"]) == (["a", "b", "c"], 2)
