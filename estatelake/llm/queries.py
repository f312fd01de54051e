"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import (
    chat,
    collocations,
    exact_dedup,
    line_dedup,
    manifest,
    mixing,
    neighbours,
    packing,
    secrets,
    simhash,
    token_files,
    toxicity,
    urls,
)
from estatelake.llm.common import scratch, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256
FROM turns GROUP BY conv_id
"""


def planted_conversation(spark: SparkSession) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )


def read_chats(spark: SparkSession, folder: str) -> DataFrame:
    talks = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat.chat_windows(talks.unionByName(planted_conversation(spark)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join("learnt", "")
    return chat.read_back(windows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return read_chats(spark, folder)


@query(CHAT_SQL)
def op3_chat_format_turns(spark: SparkSession, folder: str) -> DataFrame:
    """What SQL can state of op3: all but the length of the formatted text."""
    return read_chats(spark, folder).drop("formatted_chars")


@query(
    r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""
)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


@query()
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = secrets.find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "entropy")

    def many(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def written(which):
        return F.array_join(
            F.transform(which, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        )

    return spans.select(
        "doc_id", many("assign"), many("access"), many("hex"),
        F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"),
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch(spark, "op1")
    pieces = stored(
        packing.cut_pieces(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0),
        f"{place}/pieces",
    )
    slim = pieces.select("doc_id", "piece", "start", "length", packing.crc32_of("ids").alias("ids_crc32"))
    return packing.pack(slim, f"{place}/packing")


@query()
def op7_bit_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_files.write_token_files(
        table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1
    )
    return token_files.read_token_files(manifest)


@query()
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", simhash.hex_digits().alias("fingerprint"), "component_id"
    )


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, folder, "labels")))


@query()
def op8_multi_index_search(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"))


def raking_sql(mix: mixing.Mix, sweeps: int = 60) -> str:
    """The mix in SQL: topics, cells, ``sweeps`` raking sweeps and the draw."""
    dims = ("source", "lang", "topic")
    targets = ", ".join(f"t_{d} / (SELECT sum(t_{d} * p_{d}) FROM shaped) AS t_{d}" for d in dims)
    shaped = ", ".join(
        f"pow(sum(w) OVER (PARTITION BY {d}), {t}) AS t_{d}, w / sum(w) OVER (PARTITION BY {d}) AS p_{d}"
        for d, t in zip(dims, mix.tempers, strict=True)
    )
    pick = "CASE i % 4 WHEN 0 THEN {0}source{1} WHEN 1 THEN {0}lang{1} ELSE {0}topic{1} END"
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS word FROM documents),
buckets AS (
  SELECT doc_id, CAST(('0x' || substr(md5(word), 1, 2)) AS INTEGER) % {mixing.TOPICS} AS topic,
         count(DISTINCT word) AS n, count(*) AS tokens FROM words GROUP BY ALL),
topics AS (
  SELECT doc_id, arg_max(topic, n * 100 - topic) AS topic, sum(tokens) AS tokens FROM buckets GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(topic, 0) AS topic,
         CAST(coalesce(tokens, 0) AS BIGINT) AS tokens FROM documents LEFT JOIN topics USING (doc_id)),
cells AS (
  SELECT source, lang, CAST(topic AS VARCHAR) AS topic, CAST(sum(tokens) AS DOUBLE) AS tokens
  FROM d GROUP BY ALL HAVING sum(tokens) > 0),
shaped AS (
  SELECT *, {shaped} FROM (SELECT *, tokens / (SELECT sum(tokens) FROM cells) AS w FROM cells)),
aimed AS (SELECT source, lang, topic, tokens, w, {targets} FROM shaped),
ipf(i, source, lang, topic, tokens, w, t_source, t_lang, t_topic) AS (
  SELECT 0, source, lang, topic, tokens, w, t_source, t_lang, t_topic FROM aimed
  UNION ALL
  SELECT i + 1, source, lang, topic, tokens,
         CASE i % 4 WHEN 3 THEN least(w, {mix.boost} * tokens / (SELECT sum(tokens) FROM cells))
              ELSE w * {pick.format("t_", "")} / sum(w) OVER (PARTITION BY {pick.format("", "")}) END,
         t_source, t_lang, t_topic
  FROM ipf WHERE i < {4 * sweeps}),
ratios AS (
  SELECT source, lang, topic, w * (SELECT sum(tokens) FROM cells) / tokens AS ratio FROM ipf WHERE i = {4 * sweeps}),
odds AS (
  SELECT source, lang, topic, least(1.0, ratio / least((SELECT max(ratio) FROM ratios), {mix.boost})) AS p FROM ratios)
SELECT doc_id, source, lang, CAST(topic AS INTEGER) AS topic, tokens,
       round(coalesce(p, 1.0), 4) AS probability,
       CAST(('0x' || substr(md5('{mix.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)) AS BIGINT)
         / {16**12}.0 < coalesce(p, 1.0) AS kept
FROM (SELECT *, CAST(topic AS VARCHAR) AS t FROM d) d
LEFT JOIN odds ON d.source = odds.source AND d.lang = odds.lang AND d.t = odds.topic
""".replace("SELECT doc_id, source, lang, CAST(topic AS INTEGER)", "SELECT doc_id, d.source, d.lang, CAST(d.topic AS INTEGER)")


@query(raking_sql(mixing.Mix()))
def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("tokens"),
        F.round("_probability", 4).alias("probability"),
        F.col("_kept").alias("kept"),
    )


@query()
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, lines with words that stay, and which."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keep = line_dedup.kept_lines(docs)
    lines = docs.select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    # Null ids are listed as NO_ID.
    same = F.coalesce(F.col("doc_id").cast("long"), F.lit(line_dedup.NO_ID)) == F.col("doc")
    return lines.join(keep.hint("merge"), same, "left").select(
        "doc_id", "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_kept"),
        F.array_join(F.transform(F.coalesce("lines", none), lambda x: x.cast("string")), ",").alias("kept_lines"),
    )


#: Fixed values of op11: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
URL_SQL = rf"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
p AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
best AS (
  SELECT i, arg_max(rhost || rpath, length(rhost || rpath) * 100000 + length(rhost)) AS rule,
         arg_max(rverdict, length(rhost || rpath) * 100000 + length(rhost)) AS verdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (i)"""


@query(URL_SQL)
def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = urls.write_list(urls.rule_table(spark, URL_RULES))
    return urls.judge(table(spark, folder, "pages"), listed)


@query()
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verify(table(spark, folder, "documents"))


PHRASES_SQL = r"""
WITH RECURSIVE lines AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM lines),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM spoken, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:], ' ')),
least AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, array_to_string(ws[i:i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - n + 2)) AS i FROM cand, (SELECT unnest([2, 3]) AS n) WHERE n < k) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM least LEFT JOIN inner_parts USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000"""


@query(PHRASES_SQL)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
