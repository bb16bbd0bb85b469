"""Text, JSON lines, JSON arrays, settings and the dataset registry."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def read_text(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Rows (path, text), one for each whole file. ``strict`` raises for bytes that are not UTF-8."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    text = F.validate_utf8(F.col("content").cast("string")) if strict else F.make_valid_utf8(F.col("content").cast("string"))
    return raw.select("path", text.alias("text"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = schemas.LINE, ordinal: bool = True) -> DataFrame:
    """JSON lines with a given schema; a malformed line fails the job, blank lines are skipped.

    ``ordinal`` adds ``ord`` (file, place in it), so that ties keep the order of the file.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return df.withColumn("ord", F.struct(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("r"))) if ordinal else df


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = schemas.SAMPLE) -> DataFrame:
    """Rows of files that each hold one JSON list; any other top level is refused."""
    raw = spark.read.text(path, wholetext=True)
    odd = raw.where(~F.coalesce(F.col("value").rlike(r"^\s*\["), F.lit(False))).limit(1).count()
    if odd:
        raise ValueError(f"{path}: the top level must be a list")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_array_raw(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, index, json) of the same files, each element as its JSON text, types kept."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    items = F.from_json("value", "array<string>")
    return raw.select("path", F.posexplode(F.when(items.isNull(), F.raise_error(F.lit("the top level must be a list")).cast("array<string>")).otherwise(items)).alias("index", "json"))


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines, null fields left out. A second run replaces them unless ``append`` is set."""
    df.write.mode("append" if append else "overwrite").json(path)


def write_json_array(df: DataFrame, path: str, indent: int = 2) -> int:
    """One file with a JSON list, written row by row by the driver; returns the number of rows."""
    n = 0
    temp = f"{path}.new"
    with open(temp, "w", encoding="utf-8") as f:
        f.write("[")
        for row in df.toLocalIterator():
            body = json.dumps(row.asDict(recursive=True), ensure_ascii=False, indent=indent, default=str)
            f.write(("," if n else "") + "\n" + "\n".join(" " * indent + line for line in body.split("\n")))
            n += 1
        f.write("\n]\n" if n else "]\n")
    os.replace(temp, path)
    return n


def output_name(stem: str, kind: str, ids: Iterable[int] = ()) -> str:
    """File names of results: dialogues, concurrent, sorted, legacy, chunks."""
    # The endings of each kind.
    endings = {"dialogues": "_dialogues", "concurrent": "_dialogues_concurrent", "sorted": "_sorted", "legacy": "_legacy"}
    if kind == "chunks":
        return f"{stem}_chunks_{'_'.join(map(str, sorted(ids)))}.jsonl"
    return f"{stem}{endings[kind]}.jsonl"


def with_chunk_text(lines: DataFrame, keep: bool) -> DataFrame:
    """``chunk_text`` only if wanted, and null, so left out by the writer, where it is empty."""
    if not keep:
        return lines.drop("chunk_text")
    return lines.withColumn("chunk_text", F.nullif(F.col("chunk_text"), F.lit("")))


def parse_env(lines: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, value) of KEY=VALUE lines; comments go, outer quotes are taken off.

    The first ``=`` parts a line; of equal keys all stay, in no order. ``keep`` names other columns
    of ``lines`` that stay, such as the place of a line.
    """
    from ..functions.text import strip

    line = strip(F.col(line_col))
    parts = F.split(line, "=", 2)

    def unquoted(v: Column) -> Column:
        bare = F.regexp_replace(v, r'^"+|"+\z', "")
        return F.regexp_replace(bare, r"^'+|'+\z", "")

    return lines.where(line.contains("=") & ~line.startswith("#")).select(*keep, strip(parts[0]).alias("key"), unquoted(strip(parts[1])).alias("value"))


def load_env(spark: SparkSession, path: str) -> dict[str, str]:
    """The settings of a file on the driver's machine as a dictionary; a missing file gives none.

    Of equal keys the last one counts. Spark's readers skip files whose names begin with a dot, so
    the file is opened here.
    """
    try:
        with open(path, encoding="utf-8") as file:
            lines = list(enumerate(file.read().split("\n")))
    except FileNotFoundError:
        return {}
    rows = parse_env(spark.createDataFrame(lines, "pos int, value string"), keep=("pos",)).collect()
    return {r.key: r.value for r in sorted(rows, key=lambda r: r.pos)}


def upsert(old: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """Rows of ``new``, and rows of ``old`` whose key is not in it."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def registry_entries(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Registry rows of datasets in the nested sample format, from name to file name."""
    # The column and tag names of the format.
    columns = {"messages": "conversations", "system": "system"}
    tags = {"role_tag": "from", "content_tag": "value", "user_tag": "human", "assistant_tag": "gpt"}
    return spark.createDataFrame([(n, f, "sharegpt", columns, tags) for n, f in files.items()], schemas.REGISTRY)


def write_registry(entries: DataFrame, path: str) -> None:
    """The registry as one JSON object by name; datasets that are not in ``entries`` stay."""
    known = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            known = json.load(f)
    for r in entries.collect():
        known[r.name] = {"file_name": r.file_name, "formatting": r.formatting, "columns": r["columns"], "tags": r["tags"]}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(known, f, ensure_ascii=False, indent=2)
        f.write("\n")
