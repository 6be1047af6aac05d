"""Small cases with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import assembly, checkpoints as C, chunking, lines as L, model_calls as M, sections as S
from bookflow.streaming import progress as P


def value(spark, column, **inputs):
    names = [*inputs] or ["x"]
    row = tuple(inputs.values()) or (0,)
    kinds = ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for n, v in zip(names, row))
    return spark.createDataFrame([row], kinds).select(column.alias("v")).first()["v"]


def book(spark, text):
    return L.explode_lines(spark.createDataFrame([("b", text)], "book_id string, text string"))


SCALAR = [
    (lambda x: T.slugify(x), 'a<b>:"c"', "a_b_c"), (lambda x: T.slugify(x), "...", "document"), (lambda x: T.slugify(x), "x" * 100, "x" * 80),
    (lambda x: T.source_text(F.lit("  "), x), "x", ""), (lambda x: T.source_text(F.lit(""), x), " x　", "x"),
    (lambda x: chunking.split_text(x, 10), "aaaa\n\nbbbb\n\ncc", ["aaaa", "bbbb\n\ncc"]), (lambda x: chunking.split_text(x, 11), "aaaa\n\nbbbb", ["aaaa", "bbbb"]), (lambda x: chunking.split_text(x, 12), "aaaa\n\nbbbb", ["aaaa\n\nbbbb"]),
    (lambda x: chunking.split_text(x, 3), "abcdefgh\n\nxy", ["abc", "def", "gh", "xy"]), (lambda x: chunking.split_text(x, 9), " \n ", []),
    (lambda x: chunking.chunk_text(x, 6), "aa\n\nbbb\n\ncccc", ["aa\n\nbbb", "cccc"]), (lambda x: chunking.chunk_text(x, 6), "", [""]), (lambda x: chunking.chunk_text(x, 6), "a" * 9, ["a" * 9]), (lambda x: chunking.chunk_text(x, 6), "a\n\n\n\nb", ["a\n\n\n\nb"]),
    (T.is_page_number, "序文 | 001", True), (T.is_page_number, "0042", True), (T.is_page_number, "12345", False), (T.is_page_number, "| 12", False),
    (T.title_level, "序 文", 1), (T.title_level, "文学的衰灭", 2), (T.title_level, "一、x", 3), (T.title_level, "1.5 倍", 3), (T.title_level, "六、x", None), (T.title_level, "", None),
    (T.escape_latex, "①", r"\textsuperscript\{①\}"), (T.escape_latex, 'a_b "q" 「r」', r"a\_b ``q`` ``r''"),
    (T.html_escape, "<a&'\">", "&lt;a&amp;&#x27;&quot;&gt;"), (T.broken_lines, "a//\nb\nc//  \n\nd//e", 2),
    (T.splitlines, "a\r\nb\x0bc\x85d e\n", ["a", "b", "c", "d", "e"]), (T.splitlines, "", []), (T.splitlines, "\n", [""]),
    (T.source_kind, "/a.b/C.PDF", "pdf"), (T.source_kind, "x.jpeg", "image"), (T.source_kind, "x.doc", None),
    (T.truncate_reference, "y" * 8001, "y" * 8000 + "\n...[embedded text truncated as reference]..."),
    (lambda x: T.argv_flag(x, "--llm-core"), "p --llm-core a --llm-core b --llm-core", "b"), (lambda x: T.argv_flag(x, "--llm-core"), "p", "unknown"),
    (T.chat_response_text, '{"choices":[{"message":{"content":null}}]}', ""), (T.response_text, '{"output":[{"content":[{"text":"a"},{"output_text":"b"}]}]}', "a\nb"), (T.response_text, "{}", None),
    (T.strip_page_markers, "## 第 3 页\n\n12\nx | 5\ntext", "\n\n\ntext"),
    (lambda x: P.creation_date(x).cast("string"), "20240102030405.123+480", "2024-01-02 03:04:05"), (lambda x: P.creation_date(x).cast("string"), "soon", None),
]


@pytest.mark.parametrize("i", range(len(SCALAR)))
def test_scalar(spark, i):
    f, given, want = SCALAR[i]
    assert value(spark, f(F.col("x")), x=given) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('```json\n{"text":"x","notes":""}\n```', ("x", "")), ('pre {"text":"x"} post', ("x", "")), ('{"text":"a\nb","notes": "n"}', ("a\nb", "n")), ("hello", ("hello", rules.NOT_JSON)),
        ('{"text": null, "notes": 5}', ("None", "5")), ('{"text":"x"} trailing {', ("x", "")), ("", ("", rules.NOT_JSON)),
    ],
)
def test_lenient_json(spark, raw, want):
    assert tuple(value(spark, T.lenient_json(F.col("x")), x=raw)) == want


def test_env(spark):
    text = "# c\nexport A=\"1\"\nB = x=y \nA=2\nnothing\n=v\nC=''\n"
    assert value(spark, T.env_entries(F.col("x")), x=text) == {"A": "1", "B": "x=y", "C": ""}


def test_page_markdown(spark):
    rows = [("b", 2, " ", ""), ("b", 1, "A", "n"), ("b", 3, " B\n", ""), ("e", 1, "", "")]
    df = spark.createDataFrame(rows, "book_id string, page_number int, ocr_text string, notes string")
    assert {r.book_id: r.text for r in assembly.page_markdown(df, "ocr_text").collect()} == {"b": "## 第 1 页\n\nA\n\n> OCR 备注：n\n\n## 第 3 页\n\nB\n", "e": "\n"}


def test_merge_paragraphs(spark):
    got = L.merge_paragraphs(book(spark, "序 文\na\n\n序 文\nb")).orderBy("para_no").collect()
    assert [(r.content, r.level) for r in got] == [("序 文", 1), ("a", 0), ("b", 0)]


def test_text_to_paragraphs(spark):
    assert [r.paragraph for r in L.text_to_paragraphs(book(spark, "a\nb\n\n c ")).orderBy("para_no").collect()] == ["a b", "c"]


def test_section_split(spark):
    one, two = rules.REPAIR_TITLES[:2]
    assert [(r.title, r.content) for r in S.section_split_lines(book(spark, f"{one}\n {two} \nx\ny")).collect()] == [(two, "x\ny")]
    assert [(r.title, r.content) for r in S.section_split_lines(book(spark, "x")).collect()] == [(rules.PREAMBLE, "x")]


def test_sections_skip_the_contents(spark):
    title = rules.REPAIR_TITLES[2]
    text = f"front\n《亚历山大四重奏》的辩证法 / 1\n{title}\n柄谷行人：移动的文学批评 / 9\n\n\n{title}\nbody"
    books = spark.createDataFrame([("b", text)], "book_id string, text string")
    got = S.section_extents(books, L.explode_lines(books)).orderBy("section_no").collect()
    assert [(r.title, r.content) for r in got] == [(rules.PREAMBLE, text[: text.rindex(title)].strip()), (title, f"{title}\nbody")]
    none = spark.createDataFrame([("b", "no titles")], "book_id string, text string")
    assert S.section_extents(none, L.explode_lines(none)).count() == 0


def test_clean_content_follows_the_state_machine(spark):
    text = "## 第 1 页\ncover\n## 第 6 页\nkept\n12\n图书在版编目\nhidden\n序 文\nafter\n图书在版编目\nhidden\n## 第 7 页\nagain\nISBN 9\n柄谷行人"
    assert [r.line for r in L.clean_content(book(spark, text)).orderBy("line_no").collect()] == ["kept", "序 文", "after", "again"]


def test_checkpoint_merge_is_idempotent(spark):
    kind = "book_id string, page_number int, v string"
    old, new = spark.createDataFrame([("b", 1, "1"), ("b", 2, "2")], kind), spark.createDataFrame([("b", 2, "2'"), ("b", 3, "3")], kind)
    once = C.merge(new, old, ["v"])
    assert sorted(map(tuple, once.collect())) == [("b", 1, "1"), ("b", 2, "2'"), ("b", 3, "3")] == sorted(map(tuple, C.merge(new, once, ["v"]).collect()))


def test_resume(spark):
    runs = spark.createDataFrame([("s", "a", 1, 9, 5), ("s", "b", 2, 0, 1), ("t", "c", 0, 0, 1)], "slug string, run_dir string, n_checkpoints int, n_images int, mtime int")
    assert {r.slug: r.run_dir for r in C.resume_choice(runs).collect()} == {"s": "b", "t": "c"}
    done = spark.createDataFrame([("b", 1), ("b", 5)], "book_id string, page_number int")
    pages = spark.createDataFrame([("b", n) for n in range(1, 10)] + [("c", 1)], "book_id string, page_number int")
    assert sorted((r.book_id, r.page_number) for r in C.page_range(pages, 3, 2, C.resume_point(done)).collect()) == [("b", 6), ("b", 7)]
    assert sorted(r.page_number for r in C.gaps(pages.filter("book_id = 'b'"), done).collect()) == [2, 3, 4, 6, 7, 8, 9]


def test_eta_and_bar(spark):
    done, total, seconds = F.col("d"), F.col("t"), F.col("s")
    given = {"d": 50, "t": 190, "s": 3000.0}
    assert value(spark, P.minutes_left(F.lit("ocr"), done, total, seconds), **given) == 140 + 66 + 3
    assert value(spark, P.percent(done, total), **given) == 26.3
    assert value(spark, P.progress_bar(done, total), **given) == "█" * 10 + "░" * 30
    flags = [(False, False, False, "ocr"), (True, False, False, "summary"), (True, True, False, "done"), (False, False, True, "done")]
    assert [value(spark, P.phase(*map(F.lit, f[:3]))) for f in flags] == [f[3] for f in flags]


def test_retry_waits():
    for error, waits, calls in ((ValueError, [2.0, 4.0], 3), (M.AuthenticationError, [], 1)):
        slept, made = [], []

        def call(error=error, made=made):
            made.append(1)
            raise error("no")

        with pytest.raises(RuntimeError):
            M.retry(call, sleep=slept.append)
        assert slept == waits and len(made) == calls
    made = []

    def json_refused(json_mode):
        made.append(json_mode)
        if json_mode:
            raise ValueError("no JSON mode")
        return "ok"

    assert M.with_json_fallback(json_refused, sleep=lambda s: None) == "ok" and made == [True] * 3 + [False]


def test_strip_equals_that_of_unicode_texts(spark):
    from bookflow.functions import text as T

    cases = [f"{a}x {b}y{a}{b}" for a in T.WHITE for b in ("", "　", "​")] + ["", T.WHITE, "​x", "é ", "中 "]
    df = spark.createDataFrame([*enumerate(cases)], "i int, t string")
    got = {r.i: (r.s, r.r) for r in df.select("i", T.strip(df.t).alias("s"), T.rstrip(df.t).alias("r")).collect()}
    assert all(got[i] == (t.strip(), t.rstrip()) for i, t in enumerate(cases))
