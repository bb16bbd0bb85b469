"""Model calls over chunks and samples, with the model as an injected function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.replies import parse_replies, rewrite_entries
from ..functions.text import clean_context
from .lines import dedup_lines

#: Takes a system and a user prompt and returns the reply.
Model = Callable[[str, str], str]

# Attempts, and pauses before the next one in seconds.
ATTEMPTS = 3
BATCH_ATTEMPTS = 4

# The extraction prompt. {schema} and {example} are filled in; the input follows as
# the user's message.
EXTRACT_TEMPLATE = """
Your goal is to extract structured information from the user's input that matches the form described below. When extracting information please make sure it matches the type information exactly. Do not add any attributes that do not appear in the schema shown below.
{schema}
Please output the extracted information in JSON format. 

Do NOT add any clarifying information. Output MUST follow the schema above. Do NOT add any additional columns that do not appear in the schema.

Input: 
{input}
Output:
{example}
"""
SCHEMA_TEMPLATE = """
```TypeScript
    script: Array<Dict( // {task}
    {attributes}
    )>
```
"""

# The rewriter's prompts; {role} speaks, {field} is the name of its part of a reply.
REWRITE_LEAD = "请处理以下样本，返回与输入数量、id 一一对应的 JSON 数组：\n"
CONTEXT_LABEL = "上下文："
LINE_LABEL = "原台词："
REWRITE_SYSTEM = (
    "你是一个 SFT 数据标注员。任务：把小说对话改造成高质量聊天训练数据。\n"
    "你会收到多条样本，每条有 id、上下文、{role}原台词。\n"
    "为每条生成一个用户问题（自然口语，不要书面，不要提'小说片段'）和{role}的回答（30~200 字，{manner}，基于原台词扩展，不加原创设定）。\n"
    "严格只输出一个 JSON 数组，不要 markdown 代码块，不要任何前后说明文字。\n"
    '格式：[{"id": 原样本id, "user": "...", "{field}": "..."}, ...]\n'
    "数组里的条目数必须和输入完全一致，id 必须原样返回。"
)
SINGLE_SYSTEM = "你是 SFT 数据标注员。生成一个用户问题（口语自然）和{role}的回答（30~200 字，{manner}）。严格只输出 JSON 对象，不要 markdown。"
SINGLE_LEAD = '严格只输出 JSON：{"user": "...", "{field}": "..."}'


def linear_pause(attempt: int, error: Exception) -> float:
    return 2.0 * (attempt + 1)


def rate_aware_pause(attempt: int, error: Exception) -> float:
    """Longer where the message speaks of a rate or concurrency limit."""
    told = str(error).lower()
    limited = any(w in told for w in ("429", "rate", "concurrency"))
    return 5.0 + 5 * attempt if limited else 1.0 + 2 * attempt


def with_retries(model: Model, attempts: int = ATTEMPTS, pause: Callable[[int, Exception], float] = linear_pause, sleep: Callable[[float], None] = time.sleep) -> Model:
    """The model, asked again after an error; the last error is raised."""
    def call(system: str, user: str) -> str:
        for k in range(attempts):
            try:
                return model(system, user)
            except Exception as error:
                if k == attempts - 1:
                    raise
                sleep(pause(k, error))
        raise ValueError("no attempts")

    return call


def call_model(rows: DataFrame, make_model: Callable[[], Model], system: str, prompt_col: str, *, parallel: int | None = None, batch_rows: int = 16) -> DataFrame:
    """All columns with ``response`` and ``error``; a failed call leaves an error, not a dead job.

    ``make_model`` runs once in each task. ``parallel`` bounds the calls at the same time. Store
    the result before using it: a plan that is run twice asks the model twice.
    """
    rows = rows.repartition(parallel) if parallel else rows
    rows = rows.drop("response", "error")
    schema = T.StructType([*rows.schema.fields, T.StructField("response", T.StringType()), T.StructField("error", T.StringType())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(start, batch_rows)
                replies, errors = [], []
                for prompt in batch.column(batch.schema.get_field_index(prompt_col)).to_pylist():
                    try:
                        replies.append(model(system, prompt or ""))
                        errors.append(None)
                    except Exception as error:
                        replies.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(replies, pa.string()), pa.array(errors, pa.string())], names=[*batch.schema.names, "response", "error"])

    return rows.mapInArrow(ask, schema)


def extraction_prompt(task: str, attributes: list[dict[str, str]], example: str = "", template: str = EXTRACT_TEMPLATE, schema: str = SCHEMA_TEMPLATE) -> str:
    """The system prompt that asks for a list of records with the given attributes.

    ``example`` shows what to put out; the input is the user's message and left empty here.
    """
    fields = ",\n    ".join(f"{a['name']}: {a['type']} // {a['description']}" for a in attributes)
    shape = schema.replace("{task}", task).replace("{attributes}", fields)
    return template.replace("{schema}", shape).replace("{example}", example).replace("{input}", "")


def extract_lines(replies: DataFrame, index: str = "raw", chunk_text: bool = False) -> DataFrame:
    """Dialogue lines of stored replies: parsed, then the first of each (role, dialogue) kept.

    ``chunk_text`` keeps the chunk's text where it is not empty. Failed chunks give no lines.
    """
    lines = parse_replies(replies, "chunk_id", "response")
    if chunk_text:
        texts = replies.select("chunk_id", F.nullif(F.col("chunk"), F.lit("")).alias("chunk_text"))
        lines = lines.join(texts, "chunk_id", "left")
    return dedup_lines(lines, index)


def rewrite_prompts(samples: DataFrame, speaker: str, preamble: str, size: int = 10, lead: str = REWRITE_LEAD, context_label: str = CONTEXT_LABEL, line_label: str = LINE_LABEL, place: str = "pos") -> DataFrame:
    """One prompt for each batch: rows (batch, ids, prompt) from single-turn samples with ``pos``.

    ``samples`` has ``pos`` and ``conversations`` of a context and a line; ``place`` names the
    column whose tens, or ``size``s, make the batches.
    """
    parts = samples.select("pos", F.floor(F.col(place) / size).alias("batch"), clean_context(F.element_at("conversations", 1)["value"], speaker, preamble).alias("context"), F.element_at("conversations", 2)["value"].alias("line"))
    text = F.concat_ws("\n", F.concat(F.lit("--- id="), F.col("pos").cast("string"), F.lit(" ---")), F.concat(F.lit(context_label + "\n"), F.col("context")), F.concat(F.lit(f"{speaker}{line_label}"), F.col("line"), F.lit("\n")))
    grouped = parts.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("pos", text.alias("text")))).alias("items"))
    return grouped.select("batch", F.transform("items", lambda x: x["pos"]).alias("ids"), F.array_join(F.concat(F.array(F.lit(lead)), F.transform("items", lambda x: x["text"])), "\n").alias("prompt"))


def single_prompts(samples: DataFrame, speaker: str, preamble: str, field: str, context_label: str = CONTEXT_LABEL, line_label: str = LINE_LABEL, lead: str = SINGLE_LEAD) -> DataFrame:
    """One prompt for each sample: rows (pos, prompt), for those that a batch left out."""
    context = clean_context(F.element_at("conversations", 1)["value"], speaker, preamble)
    return samples.select("pos", F.concat(F.lit(context_label + "\n"), context, F.lit(f"\n\n{speaker}{line_label}"), F.element_at("conversations", 2)["value"], F.lit("\n\n" + lead.replace("{field}", field))).alias("prompt"))


def match_rewrites(replies: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """From batch replies (ids, response): rows (pos, fields...), and the positions without one.

    Entries for ids outside the batch are ignored. The second table is what to ask for singly.
    """
    entries = replies.select("ids", F.coalesce(rewrite_entries(F.col("response"), fields), F.map_from_arrays(F.array().cast("array<bigint>"), F.array().cast(f"array<struct<{','.join(f'`{f}`:string' for f in fields)}>>"))).alias("e"))
    each = entries.select(F.explode("ids").alias("pos"), "e").select("pos", F.try_element_at("e", F.col("pos")).alias("v"))
    return each.where("v IS NOT NULL").select("pos", *[F.col(f"v.{f}").alias(f) for f in fields]), each.where("v IS NULL").select("pos")


def single_rewrite(response, fields: tuple[str, ...]):
    """The fields of a lone object in a reply as a struct column; null if any is missing or empty."""
    shape = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    value = F.from_json(F.regexp_extract(response, r"(?s)\{.+\}", 0), shape)
    filled = F.lit(True)
    for f in fields:
        filled = filled & (F.coalesce(value[f], F.lit("")) != "")
    return F.when(filled, value)


def chat_items(rows: DataFrame, prefix: str, system: str, user_field: str, role_field: str) -> DataFrame:
    """Two-message samples from rewritten fields, ordered by id."""
    from ..functions.text import strip

    message = lambda side, f: F.struct(F.lit(side).alias("from"), strip(F.col(f)).alias("value"))
    return rows.select(F.format_string(prefix.replace("%", "%%") + "-%05d", "pos").alias("id"), F.lit(system).alias("system"), F.array(message("human", user_field), message("gpt", role_field)).alias("conversations")).orderBy("id")
