"""Prompts, request payloads and provider settings as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow import rules
from bookflow.functions import text as T

#: Prompt templates by task; {label}, {text}, {target} and {section} are filled in. All are replaceable.
PROMPTS = {
    "ocr": "Transcribe every visible character of this page in reading order, without translating. Reply with JSON: {\"page\": \"{label}\", \"text\": ..., \"notes\": ...}.\n\nEmbedded text for reference only:\n{text}",
    "translate": "Translate {label} into {target}. Keep headings, notes and paragraphs; output only the translation.\n\n{text}",
    "summarize": "Summarise {label} in {target}: theme, argument, key terms.\n\n{text}",
    "reduce": "Write one summary in {target} from these partial summaries.\n\n{text}",
    "repair": "Join lines that page breaks cut within section \"{section}\"; change nothing else and output only the text.\n\n{text}",
}
#: What the model is told about its part, by task.
SYSTEM = {
    "ocr": "You transcribe scanned pages exactly, in reading order.",
    "translate": "You translate books and long documents faithfully.",
    "summarize": "You summarise parts of long texts.",
    "reduce": "You write one readable, well ordered summary from partial ones.",
    "repair": "You edit translations: you mend lines that page breaks cut and leave all else alone.",
}
#: Sampling temperatures; other tasks use the provider's own.
TEMPERATURE = {"repair": 0.3}


def profiles(spark: SparkSession) -> DataFrame:
    """The registry of model providers, three rows."""
    return spark.createDataFrame(rules.PROFILES, rules.PROFILE_COLUMNS)


def prompt(task: str, **values: Column) -> Column:
    out = F.lit(PROMPTS[task])
    for name in sorted(values, key=lambda n: n == "text"):  # the text goes in last, so that braces in it stay
        out = F.replace(out, F.lit(f"{{{name}}}"), values[name])
    return out


def responses_input(messages: DataFrame, group: str = "conv_id", order: str = "turn") -> DataFrame:
    """(group, instructions, n_messages, input): system messages joined by blank lines, all others as typed text blocks in JSON."""
    system = F.col("role") == "system"
    entry = F.struct(F.col(order).alias("o"), F.col("role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), system.alias("system"))
    grouped = messages.groupBy(group).agg(F.array_sort(F.collect_list(entry)).alias("m"))
    instructions = F.array_join(F.transform(F.filter("m", lambda x: x["system"]), lambda x: x["text"]), "\n\n")
    rest = F.filter("m", lambda x: ~x["system"])
    blocks = F.transform(rest, lambda x: F.struct(x["role"].alias("role"), F.array(F.struct(F.lit("input_text").alias("type"), x["text"].alias("text"))).alias("content")))
    return grouped.select(group, instructions.alias("instructions"), F.size(rest).cast("long").alias("n_messages"), F.to_json(blocks).alias("input"))


def resolve_profile(cores: DataFrame, core_col: str = "core_value") -> DataFrame:
    """Adds core (null if it isn't known) and the provider's columns; blank means the default."""
    name = F.lower(T.strip(F.when(F.coalesce(F.col(core_col), F.lit("")) == "", "seed").otherwise(F.col(core_col))))
    return cores.withColumn("core", name).join(F.broadcast(profiles(cores.sparkSession)), "core", "left")


def setting(given: Column, environment: Column, default: Column) -> Column:
    """Command line, else environment, else default; 0 on the command line counts as not given."""
    return F.coalesce(F.nullif(given, F.lit(0)), environment, default)


def text_setting(given: Column, environment: Column, default: Column) -> Column:
    """As setting(); the empty string falls through on the command line, but wins in the environment."""
    return F.coalesce(F.nullif(given, F.lit("")), environment, default)


def resolve_ocr_core(given: Column, environment: Column, text_core: Column, can_read_images: Column) -> Column:
    return F.coalesce(F.nullif(given, F.lit("")), F.nullif(environment, F.lit("")), F.when(can_read_images, text_core).otherwise("mimo"))


def request_payload(model: Column, text: Column, token_param: Column, most: Column, thinking: Column, effort: Column, json_mode: Column) -> Column:
    """The JSON body of a chat request; parts that are null are left out."""
    messages = F.array(F.struct(F.lit("user").alias("role"), text.alias("content")))
    kind = F.struct(thinking.alias("type"))
    return F.to_json(
        F.struct(
            model.alias("model"), messages.alias("messages"), F.when(token_param == "max_tokens", most).alias("max_tokens"), F.when(token_param == "max_completion_tokens", most).alias("max_completion_tokens"),
            F.when(thinking.isNotNull(), kind).alias("thinking"), effort.alias("reasoning_effort"), F.when(json_mode, F.struct(F.lit("json_object").alias("type"))).alias("response_format"),
        )
    )
