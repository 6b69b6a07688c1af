"""One query per operator of this subpackage, and SQL with the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procrisk.llm import (
    alignment,
    chat,
    pieces,
    quality,
    secrets,
    setsketch,
    substring,
    suffix,
    tiling,
    tokenfiles,
    toxicity,
    urls,
    variants,
)
from procrisk.llm.common import reachable
from procrisk.session import stage

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every text, the base rule's verdict and that of the adaptive thresholds."""
    judged = quality.judge(_table(spark, folder, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


_QUALITY_FENCES = ",\n".join(
    f"""      max(CASE WHEN g.measure = '{r.measure}' THEN coalesce(
        CASE WHEN g.n >= {quality.MIN_GROUP} THEN {fence('g')} END,
        CASE WHEN l.n >= {quality.MIN_GROUP} THEN {fence('l')} END, {fence('a')}) END) AS fence_{k}"""
    for k, r in enumerate(quality.RULES)
    for fence in [
        lambda t, r=r: f"{t}.middle {'+' if r.upper else '-'} greatest({r.slack}, "
        f"greatest({t}.middle - {t}.low, {t}.high - {t}.middle) * {r.spreads})"
    ]
)
_QUALITY_BEYOND = " OR ".join(
    f"coalesce({r.measure} {'>' if r.upper else '<'} fence_{k}, false)"
    for k, r in enumerate(quality.RULES)
)


def _quartiles_sql(groups: str) -> str:
    """Quartiles of the merged sketches of one level."""
    by = f"{groups}, " if groups else ""
    return f"""(SELECT {by}measure, max(n) AS n,
        min(CASE WHEN upto * 100 >= n * {quality.LOW} THEN bucket END) AS low,
        min(CASE WHEN upto * 100 >= n * {quality.MIDDLE} THEN bucket END) AS middle,
        min(CASE WHEN upto * 100 >= n * {quality.HIGH} THEN bucket END) AS high
      FROM (SELECT {by}measure, bucket,
          sum(sum(c)) OVER (PARTITION BY {by}measure ORDER BY bucket) AS upto,
          sum(sum(c)) OVER (PARTITION BY {by}measure) AS n
        FROM sketch GROUP BY {by}measure, bucket) s
      GROUP BY {by}measure)"""


QUALITY_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
w AS (
  SELECT r, doc_id, lang, source, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
grams AS (
  SELECT r, i, words[i:i + {quality.WINDOW - 1}] AS gram
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - {quality.WINDOW - 1})) AS i FROM w)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM grams)
  WHERE c > 1),
repeated AS (
  SELECT r, sum(least({quality.WINDOW}, coalesce(nxt - i, {quality.WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
m AS (
  SELECT w.r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeated ON w.r = repeated.r),
f AS (
  SELECT *, n_words < {quality.MIN_WORDS}
      OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
    n_symbols * 1000000 // greatest(word_chars, 1) AS symbol_ratio,
    n_dup_lines * 1000000 // greatest(n_lines, 1) AS line_ratio,
    word_chars * 1000 // greatest(n_words, 1) AS word_length
  FROM m),
vals AS (
  SELECT lang, source, measure, v, greatest(length(bin(v)) - 6, 0) AS s
  FROM (SELECT lang, source, unnest(['symbol_ratio', 'line_ratio', 'word_length']) AS measure,
      unnest([symbol_ratio, line_ratio, word_length]) AS v FROM f WHERE NOT base_failed)),
sketch AS (
  SELECT lang, source, measure, (v >> s) << s AS bucket, count(*) AS c FROM vals GROUP BY ALL),
fences AS (
  SELECT g.lang, g.source,
{_QUALITY_FENCES}
  FROM {_quartiles_sql("lang, source")} g
  JOIN {_quartiles_sql("lang")} l ON g.lang = l.lang AND g.measure = l.measure
  JOIN {_quartiles_sql("")} a ON g.measure = a.measure
  GROUP BY g.lang, g.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_QUALITY_BEYOND}) AS kept
FROM f LEFT JOIN fences ON f.lang = fences.lang AND f.source = fences.source"""


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base rules' spans, a digest of these, and all spans of every text."""
    found = secrets.scan(_table(spark, folder, "documents"))
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s["order"] < sum(r.base for r in secrets.RULES))

    def count(order: int):
        return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(spans).alias("spans"),
    )


def _spans_sql(order: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT r, s.b + 1 AS b, s.e, {order} AS o, s.n FROM (
    SELECT r, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
      'b': list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) - 1,
      'e': list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + list_sum(list_transform(hits[1:i], lambda x: length(x))),
      'n': length(counted[i])}})) AS s
    FROM (SELECT r, regexp_extract_all(text, '{pattern}', 0) AS hits,
        regexp_extract_all(text, '{pattern}', {rule.group}) AS counted,
        string_split_regex(text, '{pattern}') AS gaps FROM d)) WHERE s.n >= {rule.least}"""


_KINDS_SQL = ", ".join(f"'{r.kind}'" for r in secrets.RULES)
_BASE = sum(r.base for r in secrets.RULES)
SECRETS_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({' UNION ALL '.join(_spans_sql(k, r) for k, r in enumerate(secrets.RULES))}),
named AS (
  SELECT *, [{_KINDS_SQL}][o + 1] || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT) AS t
  FROM spans),
told AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
    count(*) FILTER (o = 2) AS n_hex,
    string_agg(t, ',' ORDER BY b, o) FILTER (o < {_BASE}) AS base,
    string_agg(t, ',' ORDER BY b, o) AS spans
  FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN told ON d.r = told.r"""


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url by rule or model."""
    return urls.verdicts(_table(spark, folder, "pages"))


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every text, by a model that never saw the held-out rows."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        "predicted",
        F.size("spans").alias("n_spans"),
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Positions, counts and checksums of the ids, read back from the files."""
    written = tokenfiles.write_tokens(
        _table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json")
    )
    return tokenfiles.read_tokens(spark, written, ids=False)


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every text outside strings of 200 bytes that occur elsewhere."""
    return suffix.dedup(_table(spark, folder, "documents")).drop("kept")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every text outside windows of 20 words that occur earlier."""
    return substring.dedup(_table(spark, folder, "documents")).drop("kept")


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    model = pieces.load_pieces(vocabulary("piece_bpe_32k.model"))
    rows = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode(rows, model)
    # The text's digest goes on in its place, so that decoding carries ids only.
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    decoded = pieces.decode(encoded.select("doc_id", "piece_ids", text.alias("digest")), model)
    return decoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"),
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and the benchmark items whose words they hold."""
    found = tiling.contaminations(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )
    return found.drop("text_key")


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near copies of every text."""
    return setsketch.near_duplicates(_table(spark, folder, "documents"))


_ODD_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Turns and masked texts of every conversation, read back from its formatted text."""
    conversations = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.inline(F.array(*[
            F.struct(F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(_ODD_TEXT).alias("text"))
            for k, role in enumerate(("user", "assistant"))
        ])),
    )
    formatted = stage(chat.format_conversations(conversations.unionByName(odd)), "formatted")
    return chat.read_back(formatted)


CHAT_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_ODD_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{_ODD_TEXT}'),
said AS (
  SELECT *, length(regexp_replace(text, '(\\|</turn>|###)', '\\\1', 'g')) AS chars,
    length(regexp_replace(role, '(\\|</turn>|###|:)', '\\\1', 'g')) AS role_chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(role_chars + chars + {len("### ") + len(": ") + len("</turn>") + 1}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between two tokenisers' ids of every text."""
    found = alignment.alignments(
        _table(spark, folder, "documents"),
        vocabulary("byte_bpe_50k.json"),
        vocabulary("piece_bpe_32k.model"),
    )
    return found.drop("n_shared")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent near word and root of every word of at least seven letters."""
    return variants.spelling_variants(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_token_files": op6_token_files,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filter": op9_url_filter,
    "op10_secret_scan": op10_secret_scan,
    "op11_chat_format": op11_chat_format,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op10_secret_scan": SECRETS_SQL,
    "op11_chat_format": CHAT_SQL,
    "op8_quality_rules": QUALITY_SQL,
}
