"""Queries of prompts, messages, replies and settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T
from bookflow.operators import messages as G
from bookflow.plans import fixtures as X
from bookflow.plans.fixtures import quoted, strip_sql
from bookflow.plans.registry import query


def sql_value(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else quoted(v)


NAMES = [c.strip().split(" ")[0] for c in rules.PROFILE_COLUMNS.split(",")]
PROFILES = f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(sql_value, row)) + ')' for row in rules.PROFILES)}) p({', '.join(NAMES)}))"
ESCAPED = "to_json(coalesce(text, ''))"


@query(
    "responses_input",
    f"""SELECT conv_id, coalesce(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn, text) FILTER (role = 'system'), '') AS instructions, count(*) FILTER (role <> 'system') AS n_messages,
 '[' || coalesce(string_agg('{{"role":"' || role || '","content":[{{"type":"input_text","text":' || {ESCAPED} || '}}]}}', ',' ORDER BY turn, text) FILTER (role <> 'system'), '') || ']' AS input FROM conversations GROUP BY conv_id""",
)
def responses_input(spark, sf_dir):
    return G.responses_input(X.table(spark, sf_dir, "conversations"))


CORES = "CASE event_id % 6 WHEN 0 THEN ' Seed ' WHEN 1 THEN 'mimo' WHEN 2 THEN 'DEEPSEEK' WHEN 3 THEN '' WHEN 4 THEN 'other' END"


@query("resolve_profile", f"SELECT event_id, e.core, default_model, token_param, default_translation_chunk_chars AS chunk_chars, p.core IS NULL AS unsupported FROM (SELECT event_id, lower({strip_sql(f'CASE WHEN coalesce({CORES}, {quoted(str())}) = {quoted(str())} THEN {quoted(chr(115) + chr(101) + chr(101) + chr(100))} ELSE {CORES} END')}) AS core FROM events) e LEFT JOIN {PROFILES} p ON e.core = p.core".replace("default_translation_chunk_chars AS chunk_chars", "coalesce(default_translation_chunk_chars, 0) AS chunk_chars"))
def resolve_profile(spark, sf_dir):
    cores = X.table(spark, sf_dir, "events").select("event_id", F.expr(CORES).alias("core_value"))
    return G.resolve_profile(cores).select("event_id", "core", "default_model", "token_param", F.coalesce("default_translation_chunk_chars", F.lit(0)).alias("chunk_chars"), F.col("default_model").isNull().alias("unsupported"))


GIVEN, ENV = "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 8 AS INT) * 100 END", "CASE WHEN event_id % 3 = 0 THEN 777 END"
GIVEN_T, ENV_T = "CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'cli-model' END", "CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'env-model' END"


@query("resolve_settings", f"SELECT event_id, coalesce(nullif({GIVEN}, 0), {ENV}, 16000) AS chunk_chars, coalesce(nullif({GIVEN_T}, ''), {ENV_T}, 'default-model') AS model FROM events")
def resolve_settings(spark, sf_dir):
    e = X.table(spark, sf_dir, "events")
    return e.select("event_id", G.setting(F.expr(GIVEN), F.expr(ENV), F.lit(16000)).alias("chunk_chars"), G.text_setting(F.expr(GIVEN_T), F.expr(ENV_T), F.lit("default-model")).alias("model"))


OCR = ("CASE WHEN event_id % 5 = 0 THEN 'mimo' WHEN event_id % 5 = 1 THEN '' END", "CASE WHEN event_id % 7 = 0 THEN 'seed' WHEN event_id % 7 = 1 THEN '' WHEN event_id % 7 = 2 THEN 'deepseek' END", "CASE WHEN event_id % 2 = 0 THEN 'deepseek' ELSE 'seed' END")


@query(
    "resolve_ocr_core",
    f"SELECT event_id, o.core AS core, NOT p.supports_image_input AS unsupported FROM (SELECT event_id, coalesce(nullif({OCR[0]}, ''), nullif({OCR[1]}, ''), CASE WHEN t.supports_image_input THEN t.core ELSE 'mimo' END) AS core FROM (SELECT *, {OCR[2]} AS tc FROM events) e JOIN {PROFILES} t ON e.tc = t.core) o JOIN {PROFILES} p ON o.core = p.core",
)
def resolve_ocr_core(spark, sf_dir):
    known = F.broadcast(G.profiles(spark).select("core", "supports_image_input"))
    e = X.table(spark, sf_dir, "events").select("event_id", F.expr(OCR[0]).alias("given"), F.expr(OCR[1]).alias("env"), F.expr(OCR[2]).alias("core")).join(known, "core")
    chosen = e.select("event_id", G.resolve_ocr_core(F.col("given"), F.col("env"), F.col("core"), F.col("supports_image_input")).alias("core"))
    return chosen.join(known, "core").select("event_id", "core", (~F.col("supports_image_input")).alias("unsupported"))


@query(
    "request_payload",
    f"""SELECT doc_id, '{{"model":"' || default_model || '","messages":[{{"role":"user","content":' || {ESCAPED} || '}}],"' || token_param || '":' || CAST(default_translate_max_tokens AS STRING) || coalesce(',"thinking":{{"type":"' || thinking || '"}}', '') || coalesce(',"reasoning_effort":"' || reasoning_effort || '"', '') || CASE WHEN doc_id % 2 = 0 THEN ',"response_format":{{"type":"json_object"}}' ELSE '' END || '}}' AS payload
 FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'seed' WHEN 1 THEN 'mimo' ELSE 'deepseek' END AS core FROM documents) d JOIN {PROFILES} p ON d.core = p.core""",
)
def request_payload(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").withColumn("core", F.expr("CASE doc_id % 3 WHEN 0 THEN 'seed' WHEN 1 THEN 'mimo' ELSE 'deepseek' END"))
    p = F.broadcast(G.profiles(spark))
    body = G.request_payload(F.col("default_model"), F.coalesce("text", F.lit("")), F.col("token_param"), F.col("default_translate_max_tokens"), F.col("thinking"), F.col("reasoning_effort"), F.col("doc_id") % 2 == 0)
    return docs.join(p, "core").select("doc_id", body.alias("payload"))


def filled(task: str, values: dict[str, str]) -> str:
    x = quoted(G.PROMPTS[task])
    for name in sorted(values, key=lambda n: n == "text"):
        x = f"replace({x}, '{{{name}}}', {values[name]})"
    return x


LABEL = "'第 ' || CAST(doc_id AS STRING) || ' 页'"


@query("prompt_build", f"SELECT doc_id, {filled('translate', {'label': LABEL, 'target': quoted(rules.TARGET), 'text': 'coalesce(text, chr(32))'})} AS translate_prompt, {filled('repair', {'section': 'source', 'text': 'coalesce(text, chr(32))'})} AS repair_prompt FROM documents")
def prompt_build(spark, sf_dir):
    text = F.coalesce("text", F.lit(" "))
    label = F.format_string("第 %d 页", F.col("doc_id"))
    return X.table(spark, sf_dir, "documents").select("doc_id", G.prompt("translate", label=label, target=F.lit(rules.TARGET), text=text).alias("translate_prompt"), G.prompt("repair", section=F.col("source"), text=text).alias("repair_prompt"))


# Replies: JSON of several shapes made of the texts.
CHAT = "'{\"id\":1,\"choices\":[{\"message\":{\"content\":' || CASE WHEN doc_id % 5 = 0 THEN 'null' ELSE @j@ END || '}}]}'"


def chat_sql(j: str) -> str:
    return CHAT.replace("@j@", j)


@query("chat_response_text", f"SELECT doc_id, coalesce(json_extract_string({chat_sql(ESCAPED)}, '$.choices[0].message.content'), '') AS content FROM documents")
def chat_response_text(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").withColumn("j", json_text())
    return docs.select("doc_id", T.chat_response_text(F.expr(chat_sql("j"))).alias("content"))


def json_text():
    """A text as a JSON string."""
    one = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    return F.substr(one, F.lit(6), F.length(one) - 6)


SHAPES = "CASE doc_id % 4 WHEN 0 THEN '{\"output_text\":' || @j@ || '}' WHEN 1 THEN '{\"output\":[{\"type\":\"reasoning\"},{\"content\":[{\"text\":' || @j@ || '},{\"output_text\":\"more\"},{\"other\":1}]}]}' WHEN 2 THEN '{\"output\":[]}' ELSE '{\"output\":[{\"content\":[{\"text\":\"a\"}]},{\"content\":[{\"text\":' || @j@ || '}]}]}' END"


@query(
    "response_text",
    f"""SELECT doc_id, coalesce(json_extract_string(r, '$.output_text'), nullif(array_to_string(list_filter([coalesce(json_extract_string(b, '$.text'), json_extract_string(b, '$.output_text')) for b in flatten([CAST(coalesce(json_extract(o, '$.content[*]'), []) AS JSON[]) for o in CAST(coalesce(json_extract(r, '$.output[*]'), []) AS JSON[])])], lambda x: x IS NOT NULL), chr(10)), '')) AS reply FROM (SELECT doc_id, {SHAPES.replace('@j@', ESCAPED)} AS r FROM documents) d""",
)
def response_text(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").withColumn("j", json_text())
    return docs.select("doc_id", T.response_text(F.expr(SHAPES.replace("@j@", "j"))).alias("reply"))


REPLIES = "CASE doc_id % 5 WHEN 0 THEN '{\"text\": ' || @j@ || ', \"notes\": \"n\"}' WHEN 1 THEN '```json' || chr(10) || '{\"text\": ' || @j@ || '}' || chr(10) || '```' WHEN 2 THEN 'Here: {\"text\": ' || @j@ || ', \"notes\": null} bye' WHEN 3 THEN '{\"text\": \"two' || chr(10) || 'lines \\\"q\\\" \", \"notes\": \"loose\"' ELSE coalesce(text, '') END"


@query(
    "lenient_json",
    f"""SELECT doc_id, CASE doc_id % 5 WHEN 3 THEN 'two' || chr(10) || 'lines "q"' ELSE {strip_sql("coalesce(text, '')")} END AS text,
 CASE doc_id % 5 WHEN 0 THEN 'n' WHEN 1 THEN '' WHEN 2 THEN 'None' WHEN 3 THEN 'loose' ELSE {quoted(rules.NOT_JSON)} END AS notes FROM documents""",
)
def lenient_json(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").withColumn("j", json_text())
    raw = F.expr(REPLIES.replace("@j@", "j").replace('\\"q\\"', '\\\\"q\\\\"'))
    return docs.select("doc_id", T.lenient_json(raw).alias("r")).select("doc_id", "r.text", "r.notes")


ENV_TEXT = "'# c' || chr(10) || 'export  A=\"' || CAST(event_id AS STRING) || '\"' || chr(10) || chr(10) || ' B = x=y ' || chr(13) || chr(10) || 'A=again' || chr(10) || 'nothing' || chr(10) || '=v' || chr(10) || 'C='"


@query("env_parse", "SELECT event_id, unnest(['A', 'B', 'C']) AS name, unnest([CAST(event_id AS STRING), 'x=y', '']) AS setting FROM events")
def env_parse(spark, sf_dir):
    e = X.table(spark, sf_dir, "events").select("event_id", T.env_entries(F.expr(ENV_TEXT)).alias("m"))
    return e.select("event_id", F.explode("m").alias("name", "setting"))


COMMAND = "'python run.py --llm-core ' || event_type || CASE WHEN event_id % 3 = 0 THEN ' --llm-core  last' ELSE '' END || CASE WHEN event_id % 2 = 0 THEN ' --ocr-llm-core mimo x' ELSE ' --ocr-llm-core' END"


@query("argv_flag", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'last' ELSE event_type END AS llm_core, CASE WHEN event_id % 2 = 0 THEN 'mimo' ELSE 'unknown' END AS ocr_core FROM events")
def argv_flag(spark, sf_dir):
    c = F.expr(COMMAND)
    return X.table(spark, sf_dir, "events").select("event_id", T.argv_flag(c, "--llm-core").alias("llm_core"), T.argv_flag(c, "--ocr-llm-core").alias("ocr_core"))
