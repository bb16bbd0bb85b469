"""Text scalars as column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
_END = r"(?U)[\s\x1c-\x1f]+\z"

# Where a generated reply begins to speak for somebody else.
STOP_STRINGS = ("\n用户", "\nuser", "\nUser", "\nassistant", "\nAssistant", "user:", "assistant:", "<|im_start|>", "<|im_end|>")
# The same as patterns; the role's own name comes fourth.
STOP_PATTERNS = (r"(?i)(?:^|[\s\n])user\b", r"(?i)(?:^|[\s\n])assistant\b", r"用户\s*[:：]?", r"{role}\s*[:：]?", r"<\|im_(?:start|end)\|>", r"\n{3,}")
# Sentence ends; the driver tables use the ASCII ones.
SENTENCE_ENDS = "。！？"


def strip(text: Column) -> Column:
    """White space of any kind off both ends, where SQL ``trim`` takes spaces only."""
    return F.regexp_replace(text, _EDGE, "")


def rstrip(text: Column, characters: str | None = None) -> Column:
    """White space, or any of the given characters, off the end."""
    return F.regexp_replace(text, _END if characters is None else f"[{_in_class(characters)}]+\\z", "")


def _in_class(characters: str) -> str:
    return re.sub(r"([\\\]\[^&-])", r"\\\1", characters)


def clean_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, line_no, line) of the stripped non-blank lines; ``line_no`` counts those from 0."""
    kept = F.filter(F.transform(F.split(text_col, "\n"), strip), lambda x: x != "")
    return df.select(id_col, F.posexplode(kept).alias("line_no", "line"))


def sentences(text: Column, ends: str = SENTENCE_ENDS) -> Column:
    """The sentences of a line as an array; an end mark stays with its sentence."""
    return F.filter(F.split(text, f"(?<=[{_in_class(ends)}])"), lambda x: x != "")


def stop_truncate(text: Column, stops: tuple[str, ...] = STOP_STRINGS) -> Column:
    """Up to the earliest stop string, stripped; the whole text, stripped, if there is none."""
    at = [F.nullif(F.instr(text, s), F.lit(0)) for s in stops]
    first = F.least(*at) if len(at) > 1 else at[0]
    return strip(F.when(first.isNull(), text).otherwise(F.substring(text, F.lit(1), first - 1)))


def stop_truncate_patterns(text: Column, role: str, patterns: tuple[str, ...] = STOP_PATTERNS) -> Column:
    """Up to the earliest match of a pattern. After a cut, trailing marks go and the rest is
    stripped; without one, only white space at the end goes."""
    quoted = "\\Q" + role.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    at = [F.nullif(F.regexp_instr(text, F.lit(p.replace("{role}", quoted))), F.lit(0)) for p in patterns]
    first = F.least(*at) if len(at) > 1 else at[0]
    cut = strip(rstrip(F.substring(text, F.lit(1), first - 1), " \n\t：:，,。."))
    return F.when(first.isNull(), rstrip(text)).otherwise(cut)


def clean_context(text: Column, speaker: str, preamble: str, speaker_sep: str = "：") -> Column:
    """The context before the last line of the speaker.

    Without a speaker label the text stays as it is. If the preamble sentence is left in, what
    follows the first blank line counts, stripped.
    """
    label = speaker + speaker_sep
    parts = F.split(text, "\\Q" + label + "\\E")
    body = F.when(F.instr(text, label) > 0, strip(F.array_join(F.slice(parts, 1, F.size(parts) - 1), label))).otherwise(text)
    gap = F.instr(body, "\n\n")
    after = strip(F.when(gap > 0, F.substring(body, gap + 2, F.length(body))).otherwise(body))
    return F.when(F.instr(body, preamble) > 0, after).otherwise(body)


def history_prompt(system: Column, history: Column, message: Column, role: str, user_label: str = "用户", sep: str = "：") -> Column:
    """A plain prompt from past (user, assistant) pairs; empty sides are left out."""
    def line(label: str, text: Column) -> Column:
        return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit(label + sep), text))

    past = F.flatten(F.transform(F.coalesce(history, F.array().cast("array<struct<user:string,assistant:string>>")), lambda h: F.array(line(user_label, h["user"]), line(role, h["assistant"]))))
    last = F.concat(F.lit(user_label + sep), F.coalesce(message, F.lit("")))
    return F.array_join(F.concat(F.array(system, F.lit("")), F.filter(past, lambda x: x.isNotNull()), F.array(last, F.lit(role + sep))), "\n")


def chat_messages(system: Column, history: Column, message: Column) -> Column:
    """Chat messages (role, content): system first, then each pair, then the new message."""
    def say(role: str, text: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), text.alias("content"))

    past = F.flatten(F.transform(F.coalesce(history, F.array().cast("array<struct<user:string,assistant:string>>")), lambda h: F.array(say("user", h["user"]), say("assistant", h["assistant"]))))
    return F.concat(F.array(say("system", system)), past, F.array(say("user", message)))


# The system sentence of samples; the title phrase stands before the role.
TITLE_PHRASE = "《{title}》中的"
SYSTEM_SENTENCE = "你正在扮演{where}{role}。严格保持{role}的语气、性格、说话习惯和价值观，根据对话上下文自然回应，不要跳出角色，不要续写其他角色的发言。"


def role_system_prompt(role: str, title: str = "", sentence: str = SYSTEM_SENTENCE, always_title: bool = True) -> str:
    """The system sentence of samples; ``always_title`` keeps the title phrase even if empty."""
    where = TITLE_PHRASE.replace("{title}", title) if title or always_title else ""
    return sentence.replace("{where}", where).replace("{role}", role)


def checkpoint_number(path: Column) -> Column:
    """The number at the end of ``checkpoint-N``, else -1."""
    tail = F.substring_index(path, "checkpoint-", -1)
    digits = path.contains("checkpoint-") & (tail != "") & (F.translate(tail, "0123456789", "") == "")
    return F.coalesce(F.when(digits, tail.try_cast("long")), F.lit(-1).cast("long"))


def model_folder(model: Column) -> Column:
    """Dots in a model name as its cache folder writes them."""
    return F.replace(model, F.lit("."), F.lit("___"))


# Chat templates by what a model's name holds, the first that fits, and the rest.
TEMPLATES = (("qwen3.5", "qwen3_5"), ("qwen3___5", "qwen3_5"), ("qwen3.6", "qwen3_6"), ("qwen3___6", "qwen3_6"), ("qwen3", "qwen3"))
OTHER_TEMPLATE = "qwen"


def template_for_model(model: Column, templates: tuple[tuple[str, str], ...] = TEMPLATES, other: str = OTHER_TEMPLATE) -> Column:
    """The chat template of a model family; the first fitting entry of the table decides."""
    return F.coalesce(*[F.when(F.lower(model).contains(part), name) for part, name in templates], F.lit(other))


def replace_yaml_value(text: str, key: str, value: object) -> str:
    """Sets every top-level line ``key: ...``, or appends one."""
    new = f"{key}: {value!r}" if isinstance(value, float) else f"{key}: {value}"
    lines = text.splitlines()
    hits = [line.startswith(f"{key}:") for line in lines]
    out = [new if hit else line for line, hit in zip(lines, hits, strict=True)]
    return "\n".join(out if any(hits) else [*out, new]) + "\n"


def yaml_text(values: Mapping[str, object]) -> str:
    """A flat YAML file of scalars and lists of scalars, as trainers read it, in the given order."""

    def scalar(value: object) -> str:
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, int | float):
            return repr(value)
        plain = re.fullmatch(r"[A-Za-z_/.][\w/.+-]*", str(value)) and str(value).lower() not in ("null", "true", "false", "yes", "no", "on", "off")
        return str(value) if plain else json.dumps(str(value), ensure_ascii=False)

    lines = []
    for key, value in values.items():
        lines += [f"{key}:", *(f"- {scalar(v)}" for v in value)] if isinstance(value, list | tuple) and value else [f"{key}: {'[]' if isinstance(value, list | tuple) else scalar(value)}"]
    return "\n".join(lines) + "\n"


def clean_stream(parts: Iterable[str], clean: Callable[[str], str]) -> Iterator[str]:
    """What a chat shows while a reply arrives: the cleaned text so far, after each new part."""
    said = ""
    for part in parts:
        said += part
        yield clean(said)


def stop_cut(reply: str, stops: tuple[str, ...] = STOP_STRINGS) -> str:
    """``stop_truncate`` for one text in the driver, as ``clean_stream`` needs it."""
    ends = [at for at in (reply.find(s) for s in stops) if at >= 0]
    return (reply[: min(ends)] if ends else reply).strip()
