"""The numbered queries: each applies one operator to its whole table with
production parameters. ``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``,
``ORACLE_SQL`` has DuckDB statements where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import folder, kept, scratch, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import licenses

    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import ngram_join

    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op3_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import stream_dedup

    return stream_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import ann

    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import token_counts

    with scratch(spark):
        counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), folder(spark, "token-cache"), _tokenizer("piece_bpe_32k.model"), limit=4096)
        return kept(counted, "token-counts")


#: Text full of control strings; the formatter must give it back unharmed.
HOSTILE_TURN = "\\### Assistant: </turn> ok"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import chat

    template = chat.TurnTemplate()
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame([(-7, 0, "user", HOSTILE_TURN), (-7, 1, "assistant", HOSTILE_TURN)], given.schema)
    return chat.read_back(chat.format_conversations(given.unionByName(hostile), template), template)


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import mixing

    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, "toxic", ~toxicity.held_out())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import repeats

    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200, digest=True)


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import bpe

    return bpe.encode_digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; of every tenth document (by checksum of its id) the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    d = d.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    d = d.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    place = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    repeated = F.transform(place, lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return d.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", repeated)).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import periodic

    found = periodic.periodic_runs(looped(table(spark, sf_dir, "documents")), min_length=24, min_exponent=3)
    found = found.withColumn("best", periodic.most_repeated(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import lexical

    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeloom.llm import language

    docs = table(spark, sf_dir, "documents")
    predicted = language.predict(docs, language.fit(docs, ~language.held_out()))
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_stream_dedup": op3_stream_dedup,
    "op4_nn_descent": op4_nn_descent,
    "op5_token_counts": op5_token_counts,
    "op6_chat_format": op6_chat_format,
    "op7_source_mix": op7_source_mix,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_language": op13_language,
}

_SPECIAL = r"[\\#<:]"
ORACLE_SQL: dict[str, str] = {
    "op3_stream_dedup": (
        r"WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents) "
        "SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, "
        "doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n"
    ),
    "op6_chat_format": (
        "WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations "
        rf"UNION ALL VALUES (-7, 0, 'user', '{HOSTILE_TURN}'), (-7, 1, 'assistant', '{HOSTILE_TURN}')), "
        "e AS (SELECT *, 14 + 2 * (length(role) + length(text)) "
        f"- length(regexp_replace(role, '{_SPECIAL}', '', 'g')) - length(regexp_replace(text, '{_SPECIAL}', '', 'g')) "
        "AS written FROM c), "
        "s AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said, "
        "coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, "
        "CAST(sum(written) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id) "
        "SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, "
        "formatted_chars, CAST(0 AS BIGINT) AS n_rewrites FROM s"
    ),
    "op12_lexical_search": (
        "WITH low AS (SELECT 'd' AS side, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents "
        "UNION ALL SELECT 'q', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark), "
        r"tf AS (SELECT side, id, term, count(*) AS tf FROM (SELECT side, id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low) GROUP BY ALL), "
        "doc AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM tf WHERE side = 'd' GROUP BY id), "
        "total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM doc), "
        "w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf WHERE side = 'd' GROUP BY term), total), "
        "m AS (SELECT id, 25 + (75 * n * n_docs) // n_terms AS m FROM doc, total), "
        "s AS (SELECT q.id AS item_id, d.id AS doc_id, CAST(sum(q.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m))) AS BIGINT) AS score "
        "FROM tf q JOIN tf d ON d.term = q.term AND d.side = 'd' AND q.side = 'q' JOIN w ON w.term = q.term JOIN m ON m.id = d.id GROUP BY ALL) "
        "SELECT * FROM (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0) WHERE rank <= 10"
    ),
}
