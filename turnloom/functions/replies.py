"""Model replies to dialogue lines, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# Fixed value: how replies fence their JSON.
_FENCE = r"(?s)```(?:json|JSON)?\s*(.*?)\s*```"


def json_payload(reply: Column) -> Column:
    """The JSON part of a reply: the first fenced block; else from the first ``[`` to the last
    ``]``; else from the first ``{`` to the last ``}``; else the whole reply, stripped."""
    text = strip(reply)
    def between(left: str, right: str) -> Column:
        a = F.instr(text, left)
        b = F.length(text) - F.instr(F.reverse(text), right) + 1
        return F.when((a > 0) & (F.instr(text, right) > 0) & (b > a), F.substring(text, a, b - a + 1))

    fenced = F.when(text.rlike(_FENCE), strip(F.regexp_extract(text, _FENCE, 1)))
    return F.coalesce(fenced, between("[", "]"), between("{", "}"), text)


def reply_items(payload: Column) -> Column:
    """The elements of a payload as raw JSON texts; empty for anything that has no list.

    Accepts a list, an object with a list under ``script``, and a lone object with both keys.
    """
    kind = F.schema_of_variant(F.try_parse_json(payload))
    none = F.array().cast("array<string>")
    script = F.get_json_object(payload, "$.script")
    keys = F.json_object_keys(payload)
    lone = F.array_contains(keys, "role") & F.array_contains(keys, "dialogue")
    return (
        F.when(kind.startswith("ARRAY"), F.from_json(payload, "array<string>"))
        .when(kind.startswith("OBJECT") & F.schema_of_variant(F.try_parse_json(script)).startswith("ARRAY"), F.from_json(script, "array<string>"))
        .when(kind.startswith("OBJECT") & lone, F.array(payload))
        .otherwise(none)
    )


def parse_replies(replies: DataFrame, id_col: str = "chunk_id", reply_col: str = "response", index: str = "raw") -> DataFrame:
    """Rows (id, dialogue_index, role, dialogue) of all valid elements of all replies.

    An element needs both keys; a JSON null in either makes it invalid, other scalars count as
    their JSON text. Both are stripped and must not be empty. ``index`` 'raw' numbers the valid
    elements of a reply before any dedup. Replies that are null or bad JSON give no rows.
    """
    items = reply_items(json_payload(F.col(reply_col)))
    def element(x: Column) -> Column:
        return F.struct(strip(F.get_json_object(x, "$.role")).alias("role"), strip(F.get_json_object(x, "$.dialogue")).alias("dialogue"))

    valid = F.filter(F.transform(items, element), lambda d: (F.coalesce(d["role"], F.lit("")) != "") & (F.coalesce(d["dialogue"], F.lit("")) != ""))
    return replies.select(id_col, F.posexplode(valid).alias("dialogue_index", "d")).select(id_col, F.col("dialogue_index").cast("long").alias("dialogue_index"), "d.role", "d.dialogue")


def rewrite_entries(reply: Column, fields: tuple[str, ...]) -> Column:
    """Entries of a batch rewriter's reply as a map from id to its fields.

    The greedy outermost list counts. Entries need a whole-number id and every field non-empty;
    of equal ids the last one wins.
    """
    shape = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    array = F.regexp_extract(reply, r"(?s)\[.+\]", 0)
    raw = F.coalesce(F.from_json(array, "array<string>"), F.array().cast("array<string>"))
    def entry(x: Column) -> Column:
        return F.struct(F.get_json_object(x, "$.id").try_cast("long").alias("key"), F.from_json(x, shape).alias("value"))

    entries = F.filter(F.transform(raw, entry), lambda e: e["key"].isNotNull() & _all_filled(e["value"], fields))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def _all_filled(value: Column, fields: tuple[str, ...]) -> Column:
    found = F.lit(True)
    for f in fields:
        found = found & (F.coalesce(value[f], F.lit("")) != "")
    return found
