"""Command line: run the steps of a settings file, report on lines, validate datasets."""

from __future__ import annotations

import argparse
import functools
import importlib
import json
import logging
import os
import sys
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PLATFORMS, Settings, load_settings, resolve_platform, setting_errors
from ..operators import lines
from ..operators.conversation import DIALECTS
from ..sources import files
from . import steps

STEPS = ("extract", "build")
log = logging.getLogger("turnloom")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="turnloom")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run the steps of a settings file in order")
    run.add_argument("-c", "--config", default="config.toml")
    run.add_argument("-o", "--only", choices=STEPS)
    run.add_argument("-r", "--rerun", nargs="*", choices=STEPS, default=[], help="steps to run again although they are done")
    run.add_argument("-m", "--model", help="package.module:function that makes the model, for extract")
    one = sub.add_parser("lines", help="sort, convert, filter or report on a file of dialogue lines")
    one.add_argument("path")
    one.add_argument("--sort", metavar="OUT")
    one.add_argument("--legacy", metavar="OUT")
    one.add_argument("--dedup", metavar="OUT")
    one.add_argument("--chunks", type=int, nargs="*", default=[])
    one.add_argument("--chunks-out", metavar="OUT")
    one.add_argument("--stats", action="store_true")
    ask = sub.add_parser("extract", help="extract the dialogue lines of a text file")
    ask.add_argument("input", nargs="?")
    ask.add_argument("-m", "--model", help="package.module:function that makes the model; called with the platform's key, address and model if one is named")
    ask.add_argument("-o", "--output", help="folder of the lines; by default beside the input, by its name")
    ask.add_argument("-p", "--platform", choices=sorted(PLATFORMS))
    ask.add_argument("-l", "--list-platforms", action="store_true")
    ask.add_argument("-t", "--threads", type=int, default=8, help="model calls at the same time")
    ask.add_argument("--concurrent", action=argparse.BooleanOptionalAction, default=True)
    ask.add_argument("--chunk-id", action=argparse.BooleanOptionalAction, default=True, help="keep the chunk and the place in it")
    ask.add_argument("--save-chunk-text", action=argparse.BooleanOptionalAction, default=True)
    ask.add_argument("--sort-output", action=argparse.BooleanOptionalAction, default=True)
    ask.add_argument("--legacy-format", action="store_true", help="write the lines without chunks as well")
    ask.add_argument("--stats", action=argparse.BooleanOptionalAction, default=True)
    ask.add_argument("--tokenizer", default="", help="file of the tokenizers library that budgets count by")
    ask.add_argument("--max-tokens", type=int, default=500)
    ask.add_argument("--overlap", type=int, default=50)
    ask.add_argument("--env", default=".env", help="file of keys and addresses")
    build = sub.add_parser("build", help="build a dataset from a file of dialogue lines, in the script's dialect")
    build.add_argument("--input", required=True)
    build.add_argument("--target-role", required=True, help="names of the role, parted by commas; the first is the canonical one")
    build.add_argument("--run-name", required=True)
    build.add_argument("--novel-title", default="")
    build.add_argument("--out-dir", required=True)
    build.add_argument("--valid-ratio", type=float, default=0.05)
    build.add_argument("--seed", type=int, default=42)
    build.add_argument("--max-conversations", type=int, default=0)
    build.add_argument("--dialect", choices=sorted(DIALECTS), default="script")
    again = sub.add_parser("rewrite", help="rewrite single-turn samples into chat samples with a model, in batches")
    again.add_argument("path", help="JSON list of samples")
    again.add_argument("out")
    again.add_argument("-m", "--model", required=True)
    again.add_argument("--state", help="folder of what is done; by default beside the result")
    for name, default in (("role", None), ("title", ""), ("prefix", "chat"), ("field", "role"), ("manner", ""), ("preamble", "")):
        again.add_argument(f"--{name}", required=default is None, default=default)
    again.add_argument("--sample-count", type=int, default=0)
    again.add_argument("--batch-size", type=int, default=10)
    again.add_argument("-t", "--threads", type=int, default=8)
    check = sub.add_parser("validate", help="check datasets and print their figures")
    check.add_argument("paths", nargs="+")
    return top


def _maker(name: str | None):
    if not name:
        raise SystemExit("extract needs --model package.module:function")
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _extract(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.list_platforms:
        for name, found in PLATFORMS.items():
            print(f"{name}: {found.default_base_url} {found.default_model}")
        return 0
    if not args.input:
        raise SystemExit("extract needs an input file")
    env = {**os.environ, **files.load_env(spark, args.env)}
    if errors := setting_errors(args.max_tokens, args.overlap, 0.6, args.platform, env):
        raise SystemExit("; ".join(errors))
    made = _maker(args.model)
    if args.platform:
        service = resolve_platform(args.platform, env)
        made = functools.partial(made, **service)
    stem = os.path.splitext(os.path.basename(args.input))[0]
    beside = os.path.dirname(os.path.abspath(args.input))
    out = args.output or os.path.join(beside, files.output_name(stem, "concurrent" if args.concurrent else "dialogues"))
    work = tempfile.mkdtemp(prefix="turnloom-lines-") if not args.output else f"{out}.work"
    settings = Settings(novel_txt=args.input, target_role="-", run_name=stem, base_dir=work, max_workers=args.threads if args.concurrent else 1, chunk_size_tokens=args.max_tokens, chunk_overlap_tokens=args.overlap, tokenizer=args.tokenizer, save_chunk_text=args.save_chunk_text)
    found = steps.run_extraction(spark, settings, made, f"{out}.replies")
    sort = args.sort_output and args.chunk_id
    files.write_jsonl(found if args.chunk_id else found.drop("chunk_id", "dialogue_index"), out)
    if sort:
        out = os.path.join(os.path.dirname(out), files.output_name(os.path.splitext(os.path.basename(out))[0], "sorted"))
        files.write_jsonl(lines.sort_lines(found), out)
    if args.legacy_format and args.chunk_id:
        files.write_jsonl(lines.legacy_lines(found), os.path.join(os.path.dirname(out), files.output_name(os.path.splitext(os.path.basename(out))[0], "legacy")))
    if args.stats:
        print(json.dumps({"output": out, "platform": args.platform, **steps.report_lines(spark, settings.raw_lines)}, ensure_ascii=False))
    return 0


def _build(spark: SparkSession, args: argparse.Namespace) -> int:
    settings = Settings(novel_txt="", target_role=args.target_role, run_name=args.run_name, novel_title=args.novel_title, base_dir=args.out_dir, valid_ratio=args.valid_ratio, seed=args.seed, max_conversations=args.max_conversations, dialect=args.dialect)
    print(json.dumps(steps.build_dataset(spark, settings, files.read_jsonl(spark, args.input)), ensure_ascii=False))
    return 0


def _rewrite(spark: SparkSession, args: argparse.Namespace) -> int:
    samples = files.read_json_array_raw(spark, args.path).select(F.col("index").cast("long").alias("pos"), F.from_json("json", schemas.SAMPLE)["conversations"].alias("conversations"))
    told = steps.rewrite_samples(samples, _maker(args.model), args.state or f"{args.out}.state", args.out, role=args.role, title=args.title, prefix=args.prefix, field=args.field, manner=args.manner, preamble=args.preamble, sample_count=args.sample_count, batch_size=args.batch_size, parallel=args.threads)
    print(json.dumps(told))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = spark or SparkSession.builder.appName("turnloom").getOrCreate()
    if args.command == "validate":
        for found in steps.validate_files(spark, args.paths):
            print(json.dumps(found, ensure_ascii=False))
        return 0
    if args.command == "lines":
        source = files.read_jsonl(spark, args.path)
        jobs = ((args.sort, lines.sort_lines), (args.legacy, lines.legacy_lines), (args.dedup, lines.dedup_lines), (args.chunks_out, lambda x: lines.filter_chunks(x, args.chunks)))
        for out, work in jobs:
            if out:
                files.write_jsonl(work(source).drop("ord"), out)
        if args.stats:
            print(json.dumps(steps.report_lines(spark, args.path), ensure_ascii=False))
        return 0
    if args.command in ("extract", "build", "rewrite"):
        return {"extract": _extract, "build": _build, "rewrite": _rewrite}[args.command](spark, args)
    settings = load_settings(args.config, make_folders=True)
    state = steps.RunState(spark, settings.path("status", "steps"))
    work = {
        "extract": lambda: steps.run_extraction(spark, settings, _maker(args.model), settings.path("cache", f"{settings.run_name}_replies")),
        "build": lambda: steps.build_dataset(spark, settings),
    }
    for step in args.rerun:
        state.clear(settings.run_name, step)
    for step in [args.only] if args.only else STEPS:
        log.info("step %s of %s", step, settings.run_name)
        result = state.run(settings.run_name, step, work[step])
        if step == "build" and result:
            print(json.dumps(result, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
