"""Registered queries over the driver's tables, and the DuckDB SQL that must give the same rows.

Dialogue lines come from ``conversations`` (conversation as chunk, turn as position, target
``assistant``) and, with long runs, several target names and many repeats, from ``events`` (user
as chunk, event as position, event type as role). Samples have no text file, so they are built
from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import replies, text
from .operators import chunker, conversation, extract, lines, split, stats, validate
from .sources import files

TARGETS = {"conversations": ["assistant"], "events": ["purchase", "click"]}
RUN = "demo"
SYSTEM = text.role_system_prompt("assistant", "demo")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, name: str = "conversations") -> DataFrame:
    df = _table(spark, sf_dir, name)
    if name == "events":
        return df.select(F.col("user_id").alias("chunk_id"), F.col("event_id").alias("dialogue_index"), F.col("event_type").alias("role"), F.col("props").alias("dialogue"))
    return df.select(F.col("conv_id").alias("chunk_id"), F.col("turn").alias("dialogue_index"), "role", F.col("text").alias("dialogue"))


def _samples(spark: SparkSession, sf_dir: str, name: str = "conversations") -> DataFrame:
    return conversation.build_samples(_lines(spark, sf_dir, name), TARGETS[name], run_name=RUN, system=SYSTEM)


def _raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations as samples, unchecked: some have other roles or wrong ends."""
    side = F.when(F.col("role") == "assistant", "gpt").when(F.col("role") == "user", "human").otherwise(F.col("role"))
    per = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", side.alias("from"), F.col("text").alias("value")))).alias("m"))
    return per.select("conv_id", F.transform("m", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))).alias("conversations"))


_SQL_LINES = {
    "conversations": "SELECT conv_id AS chunk_id, turn AS dialogue_index, role, text AS dialogue FROM conversations",
    "events": "SELECT user_id AS chunk_id, event_id AS dialogue_index, event_type AS role, props AS dialogue FROM events",
}


def _sql_target(name: str) -> str:
    return "coalesce(role IN (" + ", ".join(f"'{t}'" for t in TARGETS[name]) + "), false)"


def _sql_turns(name: str) -> str:
    return f"""
        l AS (
            SELECT chunk_id, dialogue_index AS i, {_sql_target(name)} AS t,
                   CASE WHEN {_sql_target(name)} THEN trim(coalesce(dialogue, ''))
                        ELSE coalesce(role, '') || ': ' || trim(coalesce(dialogue, '')) END AS piece
            FROM ({_SQL_LINES[name]})
        ), f AS (
            SELECT *, first_value(t) OVER (PARTITION BY chunk_id ORDER BY i) AS leads, bool_or(t) OVER (PARTITION BY chunk_id) AS has_target FROM l
        ), s AS (
            SELECT *, CASE WHEN lag(t) OVER (PARTITION BY chunk_id ORDER BY i) = t THEN 0 ELSE 1 END AS n
            FROM f WHERE has_target AND NOT leads AND length(piece) > 0
        ), r AS (
            SELECT *, sum(n) OVER (PARTITION BY chunk_id ORDER BY i) AS turn_no FROM s
        ), m AS (
            SELECT chunk_id, turn_no, bool_or(t) AS t, trim(string_agg(piece, chr(10) ORDER BY i)) AS value FROM r GROUP BY chunk_id, turn_no
        ), e AS (
            SELECT *, max(CASE WHEN t THEN turn_no END) OVER (PARTITION BY chunk_id) AS last FROM m
        ), turns AS (
            SELECT chunk_id, CAST(turn_no AS INTEGER) AS turn_no, CASE WHEN t THEN 'gpt' ELSE 'human' END AS side, value
            FROM e WHERE turn_no <= last AND last >= 2
        ), samples AS (
            SELECT chunk_id, '{RUN}_' || CASE WHEN length(CAST(chunk_id AS VARCHAR)) < 5 THEN lpad(CAST(chunk_id AS VARCHAR), 5, '0') ELSE CAST(chunk_id AS VARCHAR) END AS id,
                   count(*) AS n, string_agg(side || '=' || value, '|' ORDER BY turn_no) AS talk
            FROM turns GROUP BY chunk_id
        )"""


def _sql_rank(seed: int) -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}-' || id), id)"


QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


# --- conversation building ---------------------------------------------------------------------


@query(f"WITH {_sql_turns('conversations')} SELECT * FROM turns")
def sft_turns(spark, sf_dir):
    return conversation.build_turns(_lines(spark, sf_dir), TARGETS["conversations"])


@query(f"WITH {_sql_turns('events')} SELECT * FROM turns")
def sft_turns_events(spark, sf_dir):
    return conversation.build_turns(_lines(spark, sf_dir, "events"), TARGETS["events"])


def _flat(samples: DataFrame) -> DataFrame:
    talk = F.array_join(F.transform("conversations", lambda m: F.concat(m["from"], F.lit("="), m["value"])), "|")
    return samples.select("id", "system", F.size("conversations").cast("long").alias("n"), talk.alias("talk"))


@query(f"WITH {_sql_turns('conversations')} SELECT id, '{SYSTEM}' AS system, n, talk FROM samples")
def sft_samples_flat(spark, sf_dir):
    return _flat(_samples(spark, sf_dir))


@query(f"WITH {_sql_turns('conversations')} SELECT id, '{SYSTEM}' AS system, n, talk FROM samples WHERE n >= 4")
def multi_turn_only(spark, sf_dir):
    return _flat(conversation.multi_turn(_samples(spark, sf_dir)))


def _sql_reasons(name: str) -> str:
    return f"""
        WITH l AS (SELECT chunk_id, dialogue_index AS i, {_sql_target(name)} AS t, trim(coalesce(dialogue, '')) AS d FROM ({_SQL_LINES[name]})),
        c AS (SELECT chunk_id, bool_or(t) AS has_target, arg_min(t, i) AS leads, bool_or(t AND length(d) > 0) AS said FROM l GROUP BY chunk_id)
        SELECT CASE WHEN NOT has_target THEN 'no_target' WHEN leads THEN 'leads_with_target' WHEN NOT said THEN 'too_short' ELSE 'kept' END AS reason, count(*) AS n_chunks
        FROM c GROUP BY 1"""


@query(_sql_reasons("conversations"))
def drop_reasons(spark, sf_dir):
    return conversation.drop_reasons(_lines(spark, sf_dir), TARGETS["conversations"])


@query(_sql_reasons("events"))
def drop_reasons_events(spark, sf_dir):
    return conversation.drop_reasons(_lines(spark, sf_dir, "events"), TARGETS["events"])


_SQL_LINES["blank"] = "SELECT conv_id AS chunk_id, turn AS dialogue_index, role, CASE WHEN conv_id % 3 = 0 AND role = 'assistant' THEN '  ' ELSE text END AS dialogue FROM conversations"
TARGETS["blank"] = TARGETS["conversations"]


@query(_sql_reasons("blank"))
def drop_reasons_blank(spark, sf_dir):
    """With chunks whose target lines are all blank."""
    blank = F.when((F.col("chunk_id") % 3 == 0) & (F.col("role") == "assistant"), "  ").otherwise(F.col("dialogue"))
    return conversation.drop_reasons(_lines(spark, sf_dir).withColumn("dialogue", blank), TARGETS["blank"])


@query(f"SELECT role, count(*) AS n_lines FROM ({_SQL_LINES['events']}) WHERE {_sql_target('events')} GROUP BY role")
def alias_hits(spark, sf_dir):
    return conversation.alias_hits(_lines(spark, sf_dir, "events"), TARGETS["events"])


@query(f"WITH {_sql_turns('conversations')} SELECT count(*) AS samples, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_turns, min(n) AS min_turns, max(n) AS max_turns FROM samples")
def turn_stats(spark, sf_dir):
    return conversation.turn_stats(_samples(spark, sf_dir))


@query("SELECT count(*) AS n_lines, CASE WHEN count(*) = 0 THEN 'none' WHEN count(*) < 100 THEN 'few' ELSE 'enough' END AS label FROM conversations WHERE role = 'assistant'")
def target_label(spark, sf_dir):
    return conversation.target_volume(_lines(spark, sf_dir), TARGETS["conversations"])


@query("""
    SELECT chunk_id, dialogue_index, role, dialogue, CASE WHEN role = 'click' THEN 'purchase' ELSE role END AS canonical
    FROM (SELECT user_id AS chunk_id, event_id AS dialogue_index, event_type AS role, props AS dialogue FROM events)""")
def canonical_roles(spark, sf_dir):
    names = spark.createDataFrame([(a, TARGETS["events"][0]) for a in TARGETS["events"]], "alias string, canonical string")
    return lines.canonical_role(_lines(spark, sf_dir, "events"), names)


# --- statistics --------------------------------------------------------------------------------

_SQL_NAMED = f"SELECT chunk_id, coalesce(role, 'Unknown') AS role, length(coalesce(dialogue, '')) AS chars FROM ({_SQL_LINES['events']})"


@query(f"SELECT role, count(*) AS n_lines FROM ({_SQL_NAMED}) GROUP BY role ORDER BY n_lines DESC, role LIMIT 3")
def role_top_k(spark, sf_dir):
    return stats.top_roles(_lines(spark, sf_dir, "events"), 3)


@query(f"SELECT count(*) AS total_dialogues, count(DISTINCT role) AS unique_roles, CAST(coalesce(sum(chars), 0) AS BIGINT) AS total_chars FROM ({_SQL_NAMED})")
def corpus_stats(spark, sf_dir):
    return stats.corpus_stats(_lines(spark, sf_dir, "events"))


@query(f"""
    WITH r AS (SELECT chunk_id, role, count(*) AS n, sum(chars) AS chars FROM ({_SQL_NAMED}) WHERE chunk_id IS NOT NULL GROUP BY 1, 2)
    SELECT chunk_id, CAST(sum(n) AS BIGINT) AS dialogue_count, count(*) AS n_roles, CAST(sum(chars) AS BIGINT) AS total_length, string_agg(role || ':' || n, ',' ORDER BY role) AS roles
    FROM r GROUP BY chunk_id""")
def chunk_stats(spark, sf_dir):
    found = stats.chunk_stats(_lines(spark, sf_dir, "events"))
    flat = F.array_join(F.transform(F.map_entries("roles"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return found.withColumn("roles", flat)


@query(f"SELECT chunk_id, role, count(*) AS n_lines, CAST(sum(chars) AS BIGINT) AS chars FROM ({_SQL_NAMED}) WHERE chunk_id IS NOT NULL GROUP BY 1, 2")
def chunk_role_counts(spark, sf_dir):
    return stats.chunk_role_counts(_lines(spark, sf_dir, "events"))


@query(f"SELECT count(DISTINCT chunk_id) AS total_chunks, count(*) AS total_dialogues FROM ({_SQL_NAMED}) WHERE chunk_id IS NOT NULL")
def chunk_summary(spark, sf_dir):
    return stats.chunk_summary(_lines(spark, sf_dir, "events"))


@query(f"SELECT chunk_id, count(*) AS dialogue_count FROM ({_SQL_NAMED}) WHERE chunk_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def busiest_chunks(spark, sf_dir):
    return stats.busiest_chunks(_lines(spark, sf_dir, "events"))


@query("SELECT o_custkey AS chunk_id, o_orderpriority AS role, count(*) AS n_lines, CAST(sum(length(o_orderstatus)) AS BIGINT) AS chars FROM orders GROUP BY 1, 2")
def chunk_role_counts_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return stats.chunk_role_counts(orders.select(F.col("o_custkey").alias("chunk_id"), F.col("o_orderkey").alias("dialogue_index"), F.col("o_orderpriority").alias("role"), F.col("o_orderstatus").alias("dialogue")))


# --- lines: order, filters, dedup, resume --------------------------------------------------------


@query(f"SELECT chunk_id, dialogue_index, role, dialogue, row_number() OVER (ORDER BY chunk_id, dialogue_index) - 1 AS pos FROM ({_SQL_LINES['conversations']})")
def sorted_dialogues(spark, sf_dir):
    return lines.number_rows(_lines(spark, sf_dir), "chunk_id", "dialogue_index")


@query(f"SELECT * FROM ({_SQL_LINES['events']}) WHERE chunk_id IN (3, 14, 15, 92)")
def filter_chunks(spark, sf_dir):
    return lines.filter_chunks(_lines(spark, sf_dir, "events"), [92, 3, 14, 15])


@query("SELECT coalesce(role, '') AS role, coalesce(text, '') AS dialogue FROM conversations")
def legacy_projection(spark, sf_dir):
    return lines.legacy_lines(_lines(spark, sf_dir))


_SQL_FIRST = f"SELECT * FROM ({_SQL_LINES['events']}) QUALIFY row_number() OVER (PARTITION BY role, dialogue ORDER BY chunk_id, dialogue_index) = 1"


@query(_SQL_FIRST)
def dedup_first(spark, sf_dir):
    return lines.dedup_lines(_lines(spark, sf_dir, "events"))


@query(f"SELECT chunk_id, row_number() OVER (PARTITION BY chunk_id ORDER BY dialogue_index) - 1 AS dialogue_index, role, dialogue FROM ({_SQL_FIRST})")
def dedup_dense_index(spark, sf_dir):
    return lines.dedup_lines(_lines(spark, sf_dir, "events"), "dense")


@query("SELECT min(doc_id) AS first_doc, source, text FROM documents GROUP BY source, text")
def dedup_documents(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select(F.lit(0).alias("chunk_id"), F.col("doc_id").alias("dialogue_index"), F.col("source").alias("role"), F.col("text").alias("dialogue"))
    return lines.dedup_lines(docs).select(F.col("dialogue_index").alias("first_doc"), F.col("role").alias("source"), F.col("dialogue").alias("text"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark, sf_dir):
    return lines.pending(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def resume_merged(spark, sf_dir):
    docs, done = _table(spark, sf_dir, "documents").select("doc_id"), _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lines.merge_results(lines.reused(docs, done, "doc_id"), lines.pending(docs, done, "doc_id"))


@query("SELECT doc_id, pos, CAST(floor(pos / 10) AS BIGINT) AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)")
def batch_assign(spark, sf_dir):
    return lines.assign_batches(_table(spark, sf_dir, "documents").select("doc_id"), 10, "doc_id")


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25")
def sample_prefix(spark, sf_dir):
    return split.first_rows(_table(spark, sf_dir, "documents").select("doc_id"), 25, "doc_id")


# --- cap and split -------------------------------------------------------------------------------


def _ids(spark, sf_dir) -> DataFrame:
    return _samples(spark, sf_dir, "events").select("id")


@query(f"WITH {_sql_turns('events')} SELECT id FROM samples QUALIFY {_sql_rank(42)} <= 40")
def cap_samples(spark, sf_dir):
    return split.cap_rows(_ids(spark, sf_dir), 40)


_SQL_VALID = f"{_sql_rank(42)} <= greatest(1, CAST(floor((SELECT count(*) FROM samples) * 0.05) AS BIGINT))"


@query(f"WITH {_sql_turns('events')} SELECT id FROM samples QUALIFY NOT ({_SQL_VALID})")
def split_train(spark, sf_dir):
    return split.split_rows(_ids(spark, sf_dir))[0]


@query(f"WITH {_sql_turns('events')} SELECT id FROM samples QUALIFY {_SQL_VALID}")
def split_valid(spark, sf_dir):
    return split.split_rows(_ids(spark, sf_dir))[1]


@query(f"WITH {_sql_turns('events')}, v AS (SELECT {_SQL_VALID} AS valid FROM samples) SELECT CASE WHEN valid THEN 'valid' ELSE 'train' END AS part, count(*) AS n FROM v GROUP BY 1")
def split_counts(spark, sf_dir):
    train, valid = split.split_rows(_ids(spark, sf_dir))
    both = train.select(F.lit("train").alias("part")).unionByName(valid.select(F.lit("valid").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("n"))


@query()
def split_exact(spark, sf_dir):
    """The permutation of a Mersenne Twister, which SQL does not have."""
    train, valid = split.split_rows_exact(_ids(spark, sf_dir), 0.05, "id", most=60)
    return train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))


# --- validation ------------------------------------------------------------------------------------

_SQL_ERRORS = """
    WITH m AS (
        SELECT conv_id, turn, CASE role WHEN 'assistant' THEN 'gpt' WHEN 'user' THEN 'human' ELSE role END AS side, text FROM conversations
    ), e AS (
        SELECT *, CASE WHEN coalesce(side, '') = '' THEN 'invalid_role' WHEN trim(coalesce(text, '')) = '' THEN 'invalid_content' WHEN side NOT IN ('human', 'gpt') THEN 'unsupported_role' END AS bad FROM m
    ), c AS (
        SELECT conv_id, count(*) AS n, arg_min(bad, turn) FILTER (WHERE bad IS NOT NULL) AS bad, arg_min(side, turn) AS a, arg_max(side, turn) AS z FROM e GROUP BY conv_id
    )
    SELECT conv_id, CASE WHEN n < 2 THEN 'too_few_turns' WHEN bad IS NOT NULL THEN bad WHEN a <> 'human' OR z <> 'gpt' THEN 'must_start_human_end_gpt' END AS error FROM c"""


@query(_SQL_ERRORS)
def validate_errors(spark, sf_dir):
    return validate.sample_errors(_raw_samples(spark, sf_dir)).select("conv_id", "error")


@query(f"SELECT coalesce(error, 'ok') AS error, count(*) AS n_rows FROM ({_SQL_ERRORS}) GROUP BY 1")
def validate_error_counts(spark, sf_dir):
    return validate.error_counts(_raw_samples(spark, sf_dir))


@query(_SQL_ERRORS, name="validate_errors_json")
def validate_errors_json(spark, sf_dir):
    raw = _raw_samples(spark, sf_dir).select("conv_id", F.to_json(F.struct("conversations")).alias("json"))
    return validate.json_sample_errors(raw).select("conv_id", "error")


@query(f"SELECT conv_id, coalesce(error, CASE WHEN conv_id % 5 = 0 THEN 'system_not_string' END) AS error FROM ({_SQL_ERRORS})")
def validate_errors_system(spark, sf_dir):
    """With system values that are numbers, strings, null or absent."""
    key = F.col("conv_id")
    system = F.when(key % 5 == 0, F.lit(', "system": 7')).when(key % 5 == 1, F.lit(', "system": "s"')).when(key % 5 == 2, F.lit(', "system": null')).otherwise(F.lit(""))
    body = F.regexp_replace(F.to_json(F.struct("conversations")), r"\}\z", "")
    raw = _raw_samples(spark, sf_dir).select("conv_id", F.concat(body, system, F.lit("}")).alias("json"))
    return validate.json_sample_errors(raw).select("conv_id", "error")


@query(f"""
    WITH {_sql_turns('conversations')}, per AS (
        SELECT chunk_id, count(*) AS n FROM turns GROUP BY 1
    ), said AS (SELECT side, length(trim(value)) AS c FROM turns)
    SELECT (SELECT count(*) FROM per) AS examples, (SELECT min(n) FROM per) AS min_turns, (SELECT max(n) FROM per) AS max_turns, (SELECT CAST(sum(n) AS BIGINT) FROM per) AS total_turns,
           count(*) FILTER (WHERE side = 'human') AS user_messages, CAST(sum(c) FILTER (WHERE side = 'human') AS BIGINT) AS user_chars, CAST(max(c) FILTER (WHERE side = 'human') AS BIGINT) AS max_user_chars,
           count(*) FILTER (WHERE side = 'gpt') AS assistant_messages, CAST(sum(c) FILTER (WHERE side = 'gpt') AS BIGINT) AS assistant_chars, CAST(max(c) FILTER (WHERE side = 'gpt') AS BIGINT) AS max_assistant_chars
    FROM said""")
def validate_stats(spark, sf_dir):
    return validate.dataset_stats(_samples(spark, sf_dir))


# --- text --------------------------------------------------------------------------------------------


@query("""
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INTEGER) AS line_no, line
    FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
    WHERE line <> ''""")
def clean_lines(spark, sf_dir):
    return text.clean_lines(_table(spark, sf_dir, "documents"))


@query("""
    SELECT doc_id, count(*) AS n_sentences, string_agg(s, '|' ORDER BY n) AS sentences
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?]*[.!?]|[^.!?]+')) AS s, generate_subscripts(regexp_extract_all(text, '[^.!?]*[.!?]|[^.!?]+'), 1) AS n FROM documents)
    GROUP BY doc_id""")
def sentence_split(spark, sf_dir):
    parts = text.sentences(F.col("text"), ".!?")
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(parts).cast("long").alias("n_sentences"), F.array_join(parts, "|").alias("sentences"))


_STOPS = ("\n", " the ", "tion")


@query("""
    SELECT conv_id, turn, trim(CASE WHEN cut IS NULL THEN text ELSE substr(text, 1, cut - 1) END) AS reply
    FROM (SELECT *, least(nullif(instr(text, chr(10)), 0), nullif(instr(text, ' the '), 0), nullif(instr(text, 'tion'), 0)) AS cut FROM conversations)""")
def stop_truncate(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.stop_truncate(F.col("text"), _STOPS).alias("reply"))


@query("""
    SELECT conv_id, turn, CASE WHEN cut IS NULL THEN rtrim(text) ELSE trim(rtrim(substr(text, 1, cut - 1), ' ' || chr(10) || chr(9) || '：:，,。.')) END AS reply
    FROM (SELECT *, least(CASE WHEN regexp_matches(text, '(?i)(?:^|\\s)the\\b') THEN length(regexp_extract(text, '(?is)^(.*?)(?:^|\\s)the\\b', 1)) + 1 END,
                          CASE WHEN regexp_matches(text, 'ing\\s*[:：]?') THEN length(regexp_extract(text, '(?s)^(.*?)ing', 1)) + 1 END) AS cut FROM conversations)""")
def stop_truncate_patterns(spark, sf_dir):
    cut = text.stop_truncate_patterns(F.col("text"), "ing", (r"(?i)(?:^|\s)the\b", r"{role}\s*[:：]?"))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", cut.alias("reply"))


_SQL_CONTEXT = "SELECT conv_id, string_agg(role || '：' || text, chr(10) ORDER BY turn) AS raw FROM conversations GROUP BY conv_id"


@query(f"""
    WITH c AS ({_SQL_CONTEXT}), b AS (
        SELECT conv_id, CASE WHEN contains(raw, 'assistant：') THEN regexp_replace(array_to_string(list_slice(string_split(raw, 'assistant：'), 1, len(string_split(raw, 'assistant：')) - 1), 'assistant：'), '^\\s+|\\s+$', '', 'g') ELSE raw END AS context FROM c
    ) SELECT * FROM b""")
def context_clean(spark, sf_dir):
    told = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit("："), F.col("text")).alias("t"))))
    raw = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(told.alias("m")).select("conv_id", F.array_join(F.transform("m", lambda x: x["t"]), "\n").alias("raw"))
    return raw.select("conv_id", text.clean_context(F.col("raw"), "assistant", "no such preamble").alias("context"))


@query(f"""
    WITH c AS (SELECT conv_id, CASE WHEN conv_id % 2 = 0 THEN 'What follows is the tale.' || chr(10) || chr(10) ELSE '' END || raw AS raw FROM ({_SQL_CONTEXT})), b AS (
        SELECT conv_id, CASE WHEN contains(raw, 'assistant：') THEN regexp_replace(array_to_string(list_slice(string_split(raw, 'assistant：'), 1, len(string_split(raw, 'assistant：')) - 1), 'assistant：'), '^\\s+|\\s+$', '', 'g') ELSE raw END AS body FROM c
    ) SELECT conv_id, CASE WHEN contains(body, 'follows is') THEN regexp_replace(CASE WHEN instr(body, chr(10) || chr(10)) > 0 THEN substr(body, instr(body, chr(10) || chr(10)) + 2) ELSE body END, '^\\s+|\\s+$', '', 'g') ELSE body END AS context FROM b""")
def context_clean_preamble(spark, sf_dir):
    """With a preamble sentence before every second context."""
    told = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit("："), F.col("text")).alias("t"))))
    raw = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(told.alias("m")).select("conv_id", F.array_join(F.transform("m", lambda x: x["t"]), "\n").alias("raw"))
    raw = raw.withColumn("raw", F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("What follows is the tale.\n\n"), F.col("raw"))).otherwise(F.col("raw")))
    return raw.select("conv_id", text.clean_context(F.col("raw"), "assistant", "follows is").alias("context"))


@query(f"""
    WITH p AS (
        SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations
    )
    SELECT conv_id, '{SYSTEM}' || chr(10) || chr(10) || string_agg('用户：' || text || chr(10) || 'assistant：' || reply, chr(10) ORDER BY turn) || chr(10) || '用户：go on' || chr(10) || 'assistant：' AS prompt
    FROM p WHERE role = 'user' AND next_role = 'assistant' GROUP BY conv_id""")
def history_prompt(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    talk = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("text").over(w).alias("reply"), F.lead("role").over(w).alias("next_role"))
    pairs = talk.where("role = 'user' AND next_role = 'assistant'").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("user"), F.col("reply").alias("assistant")))).alias("h"))
    past = F.transform("h", lambda x: F.struct(x["user"].alias("user"), x["assistant"].alias("assistant")))
    return pairs.select("conv_id", text.history_prompt(F.lit(SYSTEM), past, F.lit("go on"), "assistant").alias("prompt"))


@query("""
    SELECT l_orderkey, l_linenumber, coalesce(TRY_CAST(regexp_extract(path, 'checkpoint-(\\d+)$', 1) AS BIGINT), -1) AS number
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'out/checkpoint-' || l_partkey ELSE 'out/' || l_partkey END AS path FROM lineitem)""")
def checkpoint_numbers(spark, sf_dir):
    path = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("out/checkpoint-"), F.col("l_partkey").cast("string"))).otherwise(F.concat(F.lit("out/"), F.col("l_partkey").cast("string")))
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.checkpoint_number(path).alias("number"))


# --- chunks and replies --------------------------------------------------------------------------------


_SQL_CHUNKS = f"""
    WITH RECURSIVE l AS (
        SELECT doc_id, list(line ORDER BY n) AS ls
        FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
        WHERE line <> '' GROUP BY doc_id
    ), s AS (
        SELECT doc_id, 1 AS i, CAST(NULL AS VARCHAR[]) AS parts, CAST(0 AS BIGINT) AS total, CAST([] AS VARCHAR[]) AS chunks FROM l
        UNION ALL
        SELECT doc_id, i + 1,
            CASE WHEN cost IS NULL OR cost > {chunker.MAX_TOKENS} THEN NULL
                 WHEN total + cost + 1 <= {chunker.MAX_TOKENS} THEN list_concat(coalesce(parts, []), [line])
                 WHEN kept.n + cost + 1 > {chunker.MAX_TOKENS} THEN [line]
                 ELSE list_concat(CASE WHEN len(kept.t) = 0 THEN [''] ELSE kept.t END, [line]) END,
            CASE WHEN cost IS NULL OR cost > {chunker.MAX_TOKENS} THEN 0
                 WHEN total + cost + 1 <= {chunker.MAX_TOKENS} THEN total + cost + 1
                 WHEN kept.n + cost + 1 > {chunker.MAX_TOKENS} THEN cost + 1
                 ELSE kept.n + cost + 1 END,
            CASE WHEN cost IS NULL THEN CASE WHEN parts IS NULL THEN [] ELSE [array_to_string(parts, chr(10))] END
                 WHEN cost > {chunker.MAX_TOKENS} THEN list_concat(CASE WHEN parts IS NULL THEN [] ELSE [array_to_string(parts, chr(10)) || chr(10)] END,
                     list_reduce(list_transform(regexp_extract_all(line, '[^.!?]*[.!?]|[^.!?]+'), lambda x: [x]),
                         lambda a, x: CASE WHEN length(a[-1]) + length(x[1]) > {chunker.MAX_TOKENS} THEN list_concat(a, x) ELSE list_concat(a[:-2], [a[-1] || x[1]]) END))
                 WHEN total + cost + 1 > {chunker.MAX_TOKENS} AND parts IS NOT NULL THEN [array_to_string(parts, chr(10))]
                 ELSE [] END
        FROM (
            SELECT doc_id, i, parts, total, ls[i] AS line, length(ls[i]) AS cost,
                list_reduce(list_concat([{{'t': CAST([] AS VARCHAR[]), 'n': CAST(0 AS BIGINT)}}], list_transform(ls[greatest(1, i - {chunker.LOOK_BACK}):i - 1], lambda x: {{'t': [x], 'n': length(x)}})),
                    lambda a, x: CASE WHEN a.n + x.n <= {chunker.OVERLAP_TOKENS} THEN {{'t': list_concat(a.t, x.t), 'n': a.n + x.n}} ELSE a END) AS kept
            FROM s JOIN l USING (doc_id) WHERE i <= len(ls) + 1
        )
    ), each AS (
        SELECT doc_id, i, unnest(chunks) AS chunk, generate_subscripts(chunks, 1) AS k FROM s
    )
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1 AS INTEGER) AS chunk_id, chunk, CAST(length(chunk) AS INTEGER) AS n_tokens FROM each"""


@query(_SQL_CHUNKS)
def chunk_documents(spark, sf_dir):
    return chunker.chunk_documents(_table(spark, sf_dir, "documents"), ends=".!?")


@query("""
    SELECT conv_id AS chunk_id, dialogue_index, role, trim(text) AS dialogue
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS dialogue_index FROM conversations WHERE conv_id % 4 < 2 AND trim(role) <> '' AND trim(text) <> ''
          UNION ALL SELECT *, 0 FROM conversations WHERE conv_id % 4 = 2 AND trim(role) <> '' AND trim(text) <> '' QUALIFY turn = min(turn) OVER (PARTITION BY conv_id))""")
def parse_replies_unfenced(spark, sf_dir):
    """Bare lists in prose, objects with a script, lone objects, and replies without JSON."""
    element = F.struct("turn", F.struct("role", F.col("text").alias("dialogue")).alias("d"))
    filled = F.when((F.trim("role") != "") & (F.trim("text") != ""), element)
    told = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(filled)).alias("m"))
    whole = F.to_json(F.transform("m", lambda x: x["d"]))
    kind = F.col("conv_id") % 4
    reply = (
        F.when(kind == 0, F.concat(F.lit("Well: "), whole, F.lit(" and that is all.")))
        .when(kind == 1, F.concat(F.lit('{"script": '), whole, F.lit("}")))
        .when(kind == 2, F.concat(F.lit("One line: "), F.to_json(F.get("m", 0)["d"])))
        .otherwise(F.lit("I found {none"))
    )
    return replies.parse_replies(told.select(F.col("conv_id").alias("chunk_id"), reply.alias("response")))


@query("SELECT conv_id AS chunk_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS dialogue_index, role, trim(text) AS dialogue FROM conversations WHERE trim(role) <> '' AND trim(text) <> ''")
def parse_replies(spark, sf_dir):
    element = F.struct("turn", F.struct("role", F.col("text").alias("dialogue")).alias("d"))
    told = _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(element)).alias("m"))
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.to_json(F.transform("m", lambda x: x["d"])), F.lit("\n```\nDone."))
    return replies.parse_replies(told.select(F.col("conv_id").alias("chunk_id"), reply.alias("response")))


@query("SELECT conv_id * 1000 + turn AS pos, 'Q: ' || text AS user, text AS role FROM conversations WHERE text <> ''")
def batch_rewrites(spark, sf_dir):
    key = F.col("conv_id") * 1000 + F.col("turn")
    said = _table(spark, sf_dir, "conversations").where("text <> ''").select(key.cast("long").alias("pos"), "text")
    entry = F.struct(F.col("pos").alias("id"), F.concat(F.lit("Q: "), F.col("text")).alias("user"), F.col("text").alias("role"))
    batches = said.groupBy(F.floor(F.col("pos") / 10_000).alias("batch")).agg(F.collect_list("pos").alias("ids"), F.concat(F.lit("ok "), F.to_json(F.collect_list(entry))).alias("response"))
    return extract.match_rewrites(batches, ("user", "role"))[0]


@query("SELECT n_name AS key, CAST(n_nationkey AS VARCHAR) AS value FROM nation WHERE n_nationkey % 2 = 0")
def env_settings(spark, sf_dir):
    key = F.col("n_nationkey")
    line = F.when(key % 2 == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit(' = "'), key.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit("# "), F.col("n_name"), F.lit("=x")))
    return files.parse_env(_table(spark, sf_dir, "nation").select(line.alias("value")))


@query("SELECT n_nationkey AS name, 'new' AS file_name FROM nation WHERE n_regionkey = 1 UNION ALL SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 1")
def registry_upsert(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    new = nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("name"), F.lit("new").alias("file_name"))
    return files.upsert(nation.select(F.col("n_nationkey").alias("name"), F.col("n_name").alias("file_name")), new)
