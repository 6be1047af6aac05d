"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import decontaminate as D
from . import licenses as L


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def warc() -> str:
    """Base32 of a SHA-1: every five hex digits are four characters."""
    letters = quoted("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    each = " || ".join(f"substr({letters}, ((v // {32**k}) % 32) + 1, 1)" for k in (3, 2, 1, 0))
    digest = f"array_to_string([{each} for v in [CAST('0x' || substr(h, i * 5 + 1, 5) AS INT) for i in range(8)]], '')"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages), s AS (SELECT *, sha1(t) AS h FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {digest} AS payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM s"""


def licenses() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = sorted({w for t in L.TEMPLATES for w in t.words})
    keys = set(L.key_vocabulary(L.TEMPLATES))
    counts = ", ".join(f"count(*) FILTER (list_contains(w, {quoted(x)})) AS n{i}" for i, x in enumerate(words) if x in keys)
    weight = {x: f"(ln((n + 1.0::DOUBLE) / ({f'n{i}' if x in keys else '0'} + 1)) + 1)" for i, x in enumerate(words)}
    columns, scores = [], []
    for k, t in enumerate(L.TEMPLATES):
        same = " AND ".join(f"w[s + {j + 1}] = {quoted(x)}" for j, x in enumerate(t.key_words))
        columns.append(f"[s for s in range(0, len(w) - {len(t.key_words)} + 1) if {same}] AS t{k}")
        total = " + ".join(weight[x] for x in t.words)
        met = " + ".join(f"CASE WHEN s + {j - t.key_at} >= 0 AND w[s + {j - t.key_at + 1}] = {quoted(x)} THEN {weight[x]} ELSE 0 END" for j, x in enumerate(t.words))
        scores.append(f"list_max([({met}) / ({total}) for s in t{k}])")
    base = [k for k, t in enumerate(L.TEMPLATES) if t.base]
    starts = f"flatten([{', '.join(f't{k}' for k in base)}])"

    def labels(which: list[int]) -> str:
        return f"array_to_string(list_sort(list_distinct([x for x in [{', '.join(f'CASE WHEN len(t{k}) > 0 THEN {quoted(L.TEMPLATES[k].label)} END' for k in which)}] if x IS NOT NULL])), ',')"

    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents), c AS (SELECT count(*) AS n, {counts} FROM d),
h AS (SELECT d.*, c.*, {', '.join(columns)} FROM d, c)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len({starts}) AS BIGINT) AS n_base, CAST(list_min({starts}) AS BIGINT) AS first_word, CAST(list_max({starts}) AS BIGINT) AS last_word, {labels(base)} AS base_labels, {labels([*range(len(L.TEMPLATES))])} AS labels,
 round(coalesce(greatest({', '.join(scores)}), 0), 6) AS score FROM h"""


def decontamination() -> str:
    def words(x: str) -> str:
        return f"[w for w in regexp_split_to_array(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}]+') if w <> '']"

    # no masks here: every diagonal with enough equal words is compared
    return f"""
WITH t AS (SELECT DISTINCT doc_id, {words('text')} AS w FROM documents), b AS (SELECT DISTINCT item_id, {words('text')} AS w FROM benchmark), tk AS (SELECT *, row_number() OVER () AS tid FROM t), bk AS (SELECT *, row_number() OVER () AS bid FROM b WHERE len(w) > 0),
tw AS (SELECT tid, unnest(w) AS x, unnest(range(len(w))) AS i FROM tk), bw AS (SELECT bid, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS k FROM bk),
met AS (SELECT tid, bid, i - k AS g FROM tw JOIN bw USING (x) GROUP BY tid, bid, g HAVING count(*) >= least({D.LEAST}, any_value(n))),
cells AS (SELECT tid, bid, g, doc_id, item_id, unnest(range(greatest(g, 0), least(len(tk.w), g + len(bk.w)))) AS j, tk.w AS tw, bk.w AS bw, len(tk.w) AS text_n, len(bk.w) AS item_n FROM met JOIN tk USING (tid) JOIN bk USING (bid)),
steps AS (SELECT * EXCLUDE (tw, bw), tw[j + 1] = bw[j - g + 1] AS same, sum(CASE WHEN tw[j + 1] = bw[j - g + 1] THEN 1 ELSE -1 END) OVER w AS p FROM cells WINDOW w AS (PARTITION BY tid, bid, g ORDER BY j)),
runs AS (SELECT *, p - least(min(p) OVER w, 0) AS run, sum(CAST(same AS INT)) OVER w AS hits FROM steps WINDOW w AS (PARTITION BY tid, bid, g ORDER BY j)),
begun AS (SELECT *, coalesce(max(CASE WHEN run = 0 THEN j END) OVER w, min(j) OVER w - 1) + 1 AS first_word, hits - coalesce(max(CASE WHEN run = 0 THEN hits END) OVER w, 0) AS matched FROM runs WINDOW w AS (PARTITION BY tid, bid, g ORDER BY j)),
best AS (SELECT *, row_number() OVER (PARTITION BY tid, bid, g ORDER BY run DESC, j) AS nth FROM begun),
found AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY run DESC, first_word, j DESC, matched DESC) AS n FROM best WHERE nth = 1 AND run >= least({D.LEAST}, item_n) AND (item_n >= {D.SHORT} OR item_n = text_n))
SELECT doc_id, item_id, CAST(run AS INT) AS score, CAST(matched AS INT) AS matched, CAST(first_word AS INT) AS first_word, CAST(j AS INT) AS last_word FROM found WHERE n = 1"""
