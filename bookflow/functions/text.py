"""Column functions over texts, with the white space and line rules of Unicode texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow import rules

#: White space of a strip and of \s, and decimal digits, spelled out so that every regex engine agrees.
SPACE = r"[\t-\r \x1c-\x1f\x85\p{Z}]"
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
DIGIT = r"\p{Nd}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def portable(pattern: str) -> str:
    r"""A pattern with \s, \d and . spelled out."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two in (r"\s", r"\d"):
            full = SPACE if two == r"\s" else DIGIT
            out.append(full[1:-1] if inside and two == r"\s" else full)
            i += 2
            continue
        if two[0] == "\\":
            out.append(two)
            i += 2
            continue
        c = pattern[i]
        inside = (inside or c == "[") and c != "]"
        out.append("[^\n]" if c == "." and not inside else c)
        i += 1
    return "".join(out)


def any_of(patterns: list[str]) -> str:
    """One alternation of anchored patterns; it is evaluated once for each line."""
    return "|".join(f"(?:{portable(p)})" for p in patterns)


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITE))


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(WHITE))


def is_blank(x: Column) -> Column:
    return strip(x) == ""


def matches(x: Column, patterns: list[str]) -> Column:
    return x.rlike(f"(?d){any_of(patterns)}")


def source_text(ocr: Column, embedded: Column) -> Column:
    """The recognised text, else the embedded one; a blank but not empty recognised text counts as there."""
    return strip(F.when(F.coalesce(ocr, F.lit("")) != "", ocr).otherwise(F.coalesce(embedded, F.lit(""))))


def splitlines(x: Column) -> Column:
    """Lines at every line end; no empty line after the last one."""
    parts = F.split(x, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def is_page_marker(line: Column) -> Column:
    return matches(line, [rules.PAGE_MARKER])


def is_page_number(line: Column) -> Column:
    return matches(strip(line), rules.PAGE_NUMBERS)


def is_noise(line: Column, pack: list[str] = rules.NOISE) -> Column:
    return matches(strip(line), pack)


def is_footnote(line: Column) -> Column:
    return matches(strip(line), [rules.FOOTNOTE])


def title_level(line: Column, titles: dict[int, list[str]] = rules.TITLES) -> Column:
    out = F.lit(None).cast("int")
    for level in sorted(titles, reverse=True):
        out = F.when(matches(strip(line), titles[level]), level).otherwise(out)
    return out


def strip_page_markers(x: Column) -> Column:
    for p in rules.MARKER_REMOVALS:
        x = F.regexp_replace(x, f"(?md){portable(p)}", "")
    return x


def broken_lines(x: Column) -> Column:
    return F.regexp_count(x, F.lit(f"(?md){portable(rules.BROKEN_LINE)}"))


def slugify(x: Column, longest: int = 80) -> Column:
    """A file name stem: unsafe characters and runs of _ become one _, edges are trimmed."""
    safe = F.regexp_replace(F.btrim(F.regexp_replace(x, r'[<>:"/\\|?*\x00-\x1F]', "_"), F.lit(" ._")), "_+", "_")
    short = F.substring(safe, 1, longest)
    return F.btrim(F.when(short == "", "document").otherwise(short), F.lit(" ._"))


def swapped(x: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


#: Replacements in order: footnote marks, then special characters, then quotes.
LATEX = [*((c, rf"\textsuperscript{{{c}}}") for c in rules.FOOTNOTE_MARKS), *((c, f"\\{c}") for c in "&%$#_{}"), ("~", r"\textasciitilde{}"), ("^", r"\textasciicircum{}"), ('"', "``"), ("「", "``"), ("」", "''"), ("『", "``"), ("』", "''")]
HTML = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]


def escape_latex(x: Column) -> Column:
    return swapped(x, LATEX)


def html_escape(x: Column) -> Column:
    return swapped(x, HTML)


def truncate_reference(x: Column) -> Column:
    kept = strip(x)
    return F.when(F.length(kept) > rules.REFERENCE_CHARS, F.concat(F.substring(kept, 1, rules.REFERENCE_CHARS), F.lit(rules.CUT_REFERENCE))).otherwise(kept)


def data_url(content: Column, suffix: Column) -> Column:
    kinds = {".png": "image/png", ".webp": "image/webp", ".bmp": "image/bmp", ".tif": "image/tiff", ".tiff": "image/tiff", ".gif": "image/gif", ".pdf": "application/pdf"}
    mime = F.lit("image/jpeg")
    for k, v in kinds.items():
        mime = F.when(F.lower(suffix) == k, v).otherwise(mime)
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(content), "[\r\n]", ""))


def size_format(n: Column) -> Column:
    return F.when(n >= 1 << 20, F.format_string("%.1f MB", F.bround(n / float(1 << 20), 1))).otherwise(F.format_string("%.1f KB", F.bround(n / 1024.0, 1)))


def source_kind(path: Column) -> Column:
    """pdf, image or null (unsupported) by the suffix."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))
    return F.when(suffix == ".pdf", "pdf").when(suffix.isin(rules.IMAGE_SUFFIXES), "image")


def block_docx(line: Column) -> Column:
    """struct(kind, level, text) of one line of simple Markdown."""
    x = rstrip(line)
    bullet, number = portable(r"^\s*[-*]\s+"), portable(r"^\s*\d+[.、]\s+")

    def of(kind: str, level: int, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), text.alias("text"))

    out = F.when(x == "", of("empty", 0, F.lit("")))
    for level in (1, 2, 3):
        out = out.when(x.startswith("#" * level + " "), of("heading", level, strip(F.substr(x, F.lit(level + 2)))))
    return out.when(x.rlike(bullet), of("bullet", 0, F.regexp_replace(x, bullet, ""))).when(x.rlike(number), of("number", 0, x)).otherwise(of("paragraph", 0, x))


def hard_slices(x: Column, n: int) -> Column:
    """Pieces of n code points; the empty text has none."""
    return F.when(F.length(x) > 0, F.transform(F.sequence(F.lit(0), F.length(x) - 1, F.lit(n)), lambda i: F.substr(x, i + 1, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def blocks_pdf(line: Column, n: int = 1800) -> Column:
    """array<struct(kind, text)> of one line: escaped, cut after escaping."""
    x = rstrip(line)
    e = html_escape(x)

    def one(kind: str, text: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("kind"), text.alias("text")))

    out = F.when(x == "", one("space", F.lit("")))
    for level, kind in ((1, "h1"), (2, "h2"), (3, "h2")):
        out = out.when(x.startswith("#" * level + " "), one(kind, strip(F.substr(e, F.lit(level + 2)))))
    return out.otherwise(F.transform(hard_slices(e, n), lambda s: F.struct(F.lit("body").alias("kind"), s.alias("text"))))


def bound_once(x: Column, use) -> Column:
    """use(x), with x evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(x), use), 1)


def whole_json(x: Column) -> Column:
    """The value as VARIANT if the text is one JSON value and nothing else, else null."""
    one = lambda wrapped: F.when(F.try_variant_get(wrapped, "$[1]", "variant").isNull(), F.try_variant_get(wrapped, "$[0]", "variant"))
    return bound_once(F.try_parse_json(F.concat(F.lit("["), x, F.lit("]"))), one)


def lenient_json(x: Column) -> Column:
    """struct(text, notes) of a model's reply: strict JSON, else the widest braces, else the two fields, else all of it."""
    bare = F.regexp_replace(F.regexp_replace(strip(x), portable(r"^```(?:json)?\s*"), ""), portable(r"\s*```$"), "")
    braces = F.regexp_extract(bare, r"(?s)\{.*\}", 0)

    def of(v: Column) -> Column:
        def field(name: str) -> Column:
            there = F.schema_of_variant(v).rlike(rf"[<,] ?{name}:")
            return F.when(there, strip(F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit("None")))).otherwise(F.lit(""))

        return F.when(v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT"), F.struct(field("text").alias("text"), field("notes").alias("notes")))

    def quoted(pattern: str) -> Column:
        return strip(F.replace(F.regexp_extract(bare, pattern, 1), F.lit('\\"'), F.lit('"')))

    text = rf'(?s)"text"{SPACE}*:{SPACE}*"(.*?)"{SPACE}*,{SPACE}*"notes"'
    notes = rf'(?s)"notes"{SPACE}*:{SPACE}*"(.*?)"{SPACE}*(?:\}}|$)'
    loose = F.when(bare.rlike(text), F.struct(quoted(text).alias("text"), quoted(notes).alias("notes")))
    found = F.coalesce(bound_once(whole_json(bare), of), bound_once(whole_json(F.when(braces != "", braces)), of), loose)
    return F.coalesce(found, F.struct(strip(x).alias("text"), F.lit(rules.NOT_JSON).alias("notes")))


def chat_response_text(body: Column) -> Column:
    return F.coalesce(F.get_json_object(body, "$.choices[0].message.content"), F.lit(""))


def response_text(body: Column) -> Column:
    """output_text if it is there, else all texts of output[].content[], a line each; null if there is none."""
    parsed = F.from_json(body, "output_text string, output array<struct<content: array<struct<text: string, output_text: string>>>>")
    parts = F.flatten(F.transform(parsed["output"], lambda o: F.coalesce(F.transform(o["content"], lambda b: F.coalesce(b["text"], b["output_text"])), F.array().cast("array<string>"))))
    kept = F.filter(parts, lambda p: p.isNotNull())
    return F.coalesce(parsed["output_text"], F.when(F.size(kept) > 0, F.array_join(kept, "\n")))


def argv_flag(command: Column, flag: str) -> Column:
    """The word after the last use of a flag, else unknown."""
    words = F.split(strip(command), rf"{SPACE}+")
    pairs = F.filter(F.arrays_zip(words.alias("w"), F.slice(words, 2, F.size(words)).alias("next")), lambda p: (p["w"] == flag) & p["next"].isNotNull())
    return F.when(F.size(pairs) > 0, F.element_at(pairs, -1)["next"]).otherwise("unknown")


def env_entries(content: Column) -> Column:
    """map<string,string> of a text of KEY=VALUE lines; comments, blanks and lines without = are skipped, the first use of a key counts."""
    lines = F.transform(splitlines(content), lambda x: strip(x))
    lines = F.filter(lines, lambda x: (x != "") & ~x.startswith("#"))
    lines = F.transform(lines, lambda x: F.when(x.startswith("export "), strip(F.substr(x, F.lit(8)))).otherwise(x))
    lines = F.filter(lines, lambda x: x.contains("="))
    pairs = F.transform(lines, lambda x: F.struct(strip(F.substring_index(x, "=", 1)).alias("key"), F.btrim(F.btrim(strip(F.substr(x, F.instr(x, "=") + 1)), F.lit('"')), F.lit("'")).alias("value")))
    pairs = F.filter(pairs, lambda p: p["key"] != "")
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, F.lit(1), i), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(first)
