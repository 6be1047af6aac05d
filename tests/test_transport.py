"""Settings, request bodies and replies of model providers, without a network; and the whole flows."""

import json

import pytest
from bookflow import flows, rules
from bookflow.functions import text as T
from bookflow.operators import model_calls as M, transport as R
from bookflow.plans import fixtures as X
from pyspark.sql import functions as F


def test_settings():
    env = {}
    R.load_env("# c\nexport SEED_MODEL='m1'\nMIMO_BASE_URL=\nX\n", env)
    assert env == {"SEED_MODEL": "m1", "MIMO_BASE_URL": ""}
    assert R.Connection.resolve("", env | {"OPENAI_API_KEY": "k"}).api_key == "k" and R.Connection.resolve(None, env).model == "m1"
    assert R.Connection.resolve(" MIMO ", env).base_url == "" and R.Connection.resolve("mimo", {}, model="x").model == "x"
    with pytest.raises(ValueError):
        R.profile("other")


def test_dialects():
    messages = [{"role": "system", "content": "s"}, {"role": "user", "content": [{"type": "text", "text": "t"}, {"type": "image_url", "image_url": {"url": "u"}}, {"type": "other"}]}]
    seed = R.Connection.resolve("seed", {})
    _, sent = R.body(seed, messages, 5, True)
    assert sent == {"model": seed.model, "input": [{"role": "user", "content": [{"type": "input_text", "text": "t"}, {"type": "input_image", "image_url": "u"}]}], "max_output_tokens": 5, "instructions": "s"}
    _, sent = R.body(R.Connection.resolve("mimo", {}), messages, 5, True)
    assert sent["max_completion_tokens"] == 5 and sent["thinking"] == {"type": "enabled"} and sent["response_format"] == {"type": "json_object"} and "reasoning_effort" not in sent
    _, sent = R.body(R.Connection.resolve("deepseek", {}), messages, 5, False)
    assert sent["max_tokens"] == 5 and sent["reasoning_effort"] == "high" and "response_format" not in sent
    assert R.reply_text(seed, '{"output":[{"content":[{"text":"a"},{"output_text":"b"}]}]}') == "a\nb"
    with pytest.raises(RuntimeError):
        R.reply_text(seed, '{"output":[]}')


def test_json_mode_falls_back(monkeypatch):
    monkeypatch.setattr(M.time, "sleep", lambda s: None)
    seen = []

    def send(url, data, headers):
        seen.append(("response_format" in json.loads(data), headers.get("api-key")))
        if seen[-1][0]:
            raise RuntimeError("HTTP 400")
        return '{"choices":[{"message":{"content":"ok"}}]}'

    c = R.Connection.resolve("mimo", {"MIMO_API_KEY": "k"})
    assert R.call(c, [{"role": "user", "content": "x"}], 5, True, send) == "ok" and len(seen) == 4 and seen[-1] == (False, "k")


def test_report_resumes_without_new_calls(spark, sf, tmp_path):
    pages = X.pages(spark, sf).drop("translation")
    none = pages.selectExpr("book_id", "page_number", "'' AS translation").limit(0)
    first = flows.translate_report(pages, none, f"{tmp_path}/one")
    done = first["pages"].select("book_id", "page_number", "translation")

    def never():
        def client(kind, text):
            assert kind != "translate", "a finished page was sent again"
            return M.fake(kind, text)

        return client

    M.register_model_client("never", never)
    second = flows.translate_report(pages, done, f"{tmp_path}/two", client="never")
    for name in ("translation", "summary"):
        a, b = (sorted(map(tuple, r[name].collect())) for r in (first, second))
        assert a == b and a
    blank = pages.filter(T.source_text(F.col("ocr_text"), F.col("embedded_text")) == "").count()
    assert second["pages"].filter("translation = ''").count() == blank


def test_typeset_and_repair(spark, sf):
    books = X.books(spark, sf)
    made = flows.typeset(books)
    assert made["latex"].count() == books.count() and made["formatted"].count() > 0 and made["report"].count() > 0
    fixed = flows.repair(books)
    assert fixed.filter("n_after > n_before").count() == 0 and fixed.agg({"n_before": "sum"}).first()[0] > 0
    assert rules.PREAMBLE not in {r.text.split("\n")[0][3:] for r in fixed.collect()}
