"""Cell cleaning, key/value blocks, numbers, addresses and long text."""

from pyspark.sql import functions as F

from drives.registry import query
from estatelake.functions import text as T
from estatelake.functions.html import decode_page
from estatelake.functions.wrap import description_columns, description_rest, overflow, with_lines
from estatelake.operators.contract import contract_report
from estatelake.operators.keyvalues import attributes_m, attributes_o, kv_keys, widen
from estatelake.operators.language import keep_language, label_chunks, train


@query("SELECT doc_id, text FROM documents")
def decode_fallback(t):
    latin = F.col("lang").isin("fr", "de")
    content = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    stored = t.documents.select("doc_id", content.alias("content"))
    return stored.select("doc_id", decode_page(F.col("content")).alias("text"))


@query(
    "SELECT page_id, CASE WHEN contains(url, '.html') THEN left(url, strpos(url, '.html') - 1) "
    "ELSE url END AS link FROM pages"
)
def canonical_links(t):
    return t.pages.select("page_id", T.canonical_link(F.col("url")).alias("link"))


@query("SELECT doc_id, text FROM documents")
def strip_styling(t):
    # Debris after every line break and every sentence end.
    dirty = F.replace("text", F.lit("\n"), F.lit("\n#css-1ab{color:red}"))
    dirty = F.replace(dirty, F.lit(". "), F.lit(". @media (max-width:9px){p}"))
    debris = t.documents.select("doc_id", dirty.alias("text"))
    return debris.select("doc_id", T.strip_styling(F.col("text")).alias("text"))


@query(
    "SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ', ') AS text "
    "FROM documents"
)
def join_lists(t):
    gaps = F.flatten(
        F.transform(F.split("text", "\n"), lambda x: F.array(x, F.lit("")))
    )
    return t.documents.select("doc_id", T.join_list(gaps).alias("text"))


@query(
    "SELECT doc_id, replace(replace(text, chr(10), ', '), ', ,', ',') AS text FROM documents"
)
def newline_o(t):
    dirty = t.documents.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    escaped = F.replace("text", F.lit(" "), F.lit("\\xa0"))
    # The escape stands for a space only after the comma rules have run.
    spaced = dirty.select("doc_id", T.clean_breaks_o(F.col("text")).alias("text")).select(
        "doc_id", escaped.alias("text")
    )
    return spaced.select("doc_id", T.clean_breaks_o(F.col("text")).alias("text"))


@query(
    "SELECT doc_id, replace(replace(text, chr(10), ', '), ',,', ',') AS text FROM documents"
)
def newline_m(t):
    dirty = F.replace("text", F.lit("\n"), F.lit("\n\n\n\n"))
    broken = F.replace(dirty, F.lit(". "), F.lit(". \n"))
    return t.documents.select("doc_id", broken.alias("text")).select(
        "doc_id", T.clean_breaks_m(F.col("text")).alias("text")
    )


def details_o(t):
    text = F.concat(
        F.lit("Liczba pokoi:"), F.col("p_size"), F.lit(", Piętro:9, Rodzaj zabudowy:"),
        F.col("p_type"), F.lit(", Materiał budynku:"), F.col("p_brand"), F.lit(", Piętro:"),
        F.col("p_partkey"), F.lit(", Rok budowy:"), F.col("p_size") + 1950, F.lit(", reszta"),
    )
    return t.part.select("p_partkey", "p_brand", text.alias("details"))


@query(
    """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS rooms, CAST(NULL AS VARCHAR) AS floors_number,
       CAST(p_partkey AS VARCHAR) AS floor, lower(p_type) AS type_building,
       lower(p_brand) AS material_building, CAST(p_size + 1950 AS VARCHAR) AS year
FROM part"""
)
def kv_o(t):
    parsed = details_o(t).withColumn("kv", T.key_values_o(F.col("details")))
    return parsed.select("p_partkey", *(c.alias(n) for n, c in attributes_o("kv").items()))


def details_m(t):
    text = F.concat(
        F.lit("Liczba pięter: "), F.col("p_size"), F.lit(" ,Piętro: "), F.col("p_partkey"),
        F.lit(" / 12 , Typ budynku:\n"), F.col("p_type"), F.lit(" ,Materiał budowlany: "),
        F.col("p_brand"), F.lit(" ,Liczba pięter: "), F.col("p_size") + 1,
    )
    return t.part.select("p_partkey", text.alias("details"))


@query(
    """
SELECT p_partkey, CAST(p_size + 1 AS VARCHAR) AS floors_number, CAST(p_partkey AS VARCHAR) AS floor,
       lower(p_type) AS type_building, lower(p_brand) AS material_building,
       CAST(NULL AS VARCHAR) AS year
FROM part"""
)
def kv_m(t):
    parsed = details_m(t).withColumn("kv", T.key_values_m(F.col("details")))
    return parsed.select("p_partkey", *(c.alias(n) for n, c in attributes_m("kv").items()))


@query("SELECT DISTINCT p_brand AS key FROM part UNION SELECT DISTINCT p_type FROM part")
def kv_keys_in_use(t):
    text = F.concat_ws(", ", F.concat("p_brand", F.lit(":1")), F.concat("p_type", F.lit(":2")))
    return kv_keys(t.part.select(T.key_values_o(text).alias("kv")), "kv")


@query(
    """
SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' THEN CAST(p_size AS VARCHAR) END AS "Brand#2",
       CASE WHEN p_brand = 'Brand#3' THEN CAST(p_size AS VARCHAR) END AS "Brand#3"
FROM part"""
)
def kv_wide(t):
    text = F.concat("p_brand", F.lit(":"), "p_size")
    parsed = t.part.select("p_partkey", T.key_values_o(text).alias("kv"))
    return widen(parsed, "kv", ["Brand#2", "Brand#3"]).drop("kv")


CURRENCY = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'zł' WHEN '2' THEN 'EUR' WHEN '3' THEN 'PLN' ELSE '$' END"


@query(
    f"""
SELECT o_orderkey, CASE WHEN o_orderpriority NOT LIKE '5%' THEN o_totalprice END AS price,
       CASE WHEN o_orderpriority NOT LIKE '5%' THEN {CURRENCY} END AS currency
FROM orders"""
)
def price_text_o(t):
    amount = F.translate(F.format_number("o_totalprice", 2), ",.", "\xa0,")
    text = F.when(F.col("o_orderpriority").like("5%"), "Zapytaj o cenę").otherwise(
        F.concat_ws(" ", amount, F.expr(CURRENCY))
    )
    priced = t.orders.select("o_orderkey", text.alias("text"))
    return priced.select(
        "o_orderkey",
        T.price_o(F.col("text")).alias("price"),
        T.currency_o(F.col("text")).alias("currency"),
    )


@query(
    f"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price,
       {CURRENCY} AS currency
FROM orders"""
)
def number_cells_m(t):
    amount = F.concat(F.lit("~"), F.translate(F.format_number("o_totalprice", 2), ",.", " ,"), F.lit(" "))
    first = F.when(F.col("o_orderstatus") == "F", "zapytaj").otherwise(amount)
    cells = t.orders.select("o_orderkey", F.array(first, F.expr(CURRENCY)).alias("cell"))
    return cells.select(
        "o_orderkey",
        T.number_m(F.col("cell")).alias("price"),
        T.currency_m(F.col("cell")).alias("currency"),
    )


@query(
    """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN 'parter'
       ELSE CAST(p_size AS VARCHAR) END AS floor
FROM part"""
)
def floors_m(t):
    text = (
        F.when(F.col("p_type") == "PROMO", " \n ")
        .when(F.col("p_type") == "SMALL", "parter")
        .otherwise(F.concat("p_size", F.lit("\xa0/ 50")))
    )
    return t.part.select("p_partkey", text.alias("text")).select(
        "p_partkey", T.floor_m(F.col("text")).alias("floor")
    )


@query(
    """
SELECT c_custkey, r_name AS voivodeship, n_name AS city,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN c_mktsegment END AS district,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_name END AS street
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def address_path(t):
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    head = [F.lit("start"), F.lit("rent"), F.col("r_name"), F.col("n_name")]
    segment = F.col("c_mktsegment")
    path = (
        F.when(segment.isin("BUILDING", "MACHINERY"), F.array(*head, segment, F.lit("x"), F.col("c_name")))
        .when(segment == "AUTOMOBILE", F.array(*head, segment, segment))
        .otherwise(F.array(*head))
    )
    return places.select(
        "c_custkey", *(column.alias(name) for name, column in T.address_m(path).items())
    )


@query(
    """
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN event_type
       ELSE event_type || ', ' || replace(props, ':', ': ') END AS info
FROM events"""
)
def additional_info(t):
    info = F.when(F.col("event_type") != "click", F.col("event_type"))
    details = F.when(F.col("event_type") != "view", F.col("props"))
    return t.events.select("event_id", T.additional_info(info, details).alias("info"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders")
def blank_to_null(t):
    blanked = F.replace("o_orderstatus", F.lit("P"), F.lit(""))
    return t.orders.select("o_orderkey", T.blank_to_null(blanked).alias("status"))


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def nan_to_null(t):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", T.nan_to_null(value).alias("value"))


TOKENS_SQL = (
    "list_filter(string_split_regex(translate(text, ',-', ''), '\\s+'), lambda x: x <> '')"
)


@query(f"SELECT doc_id, w AS word, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS_SQL}) AS w FROM documents) GROUP BY ALL")
def description_words(t):
    words = t.documents.select("doc_id", F.explode(T.chunk_words(F.col("text"))).alias("word"))
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


CHUNKS_SQL = f"""
words AS (SELECT doc_id, lang, unnest({TOKENS_SQL}) AS w, generate_subscripts({TOKENS_SQL}, 1) - 1 AS i FROM documents),
chunks AS (
  SELECT doc_id, lang, i // 6 AS chunk_no, lower(string_agg(w, ' ' ORDER BY i)) AS chunk
  FROM words GROUP BY doc_id, lang, i // 6)
"""


@query(f"WITH {CHUNKS_SQL} SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, chunk FROM chunks")
def description_chunks(t):
    parts = T.chunks(T.chunk_words(F.col("text")))
    return t.documents.select("doc_id", F.posexplode(parts).alias("chunk_no", "chunk"))


LANGUAGES = ("de", "en", "es", "fr")


LANGUAGE_SQL = f"""
WITH {CHUNKS_SQL},
grams AS (
  SELECT doc_id, chunk_no, substr(padded, CAST(p AS INTEGER), 3) AS gram
  FROM (SELECT doc_id, i // 6 AS chunk_no, ' ' || lower(w) || ' ' AS padded,
               unnest(range(1, length(w) + 1)) AS p FROM words)),
spoken AS (SELECT lang, ' ' || lower(w) || ' ' AS padded, count(*) AS n FROM words GROUP BY ALL),
counts AS (
  SELECT lang, substr(padded, CAST(p AS INTEGER), 3) AS gram, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT *, unnest(range(1, length(padded) - 1)) AS p FROM spoken) GROUP BY ALL),
known AS (SELECT lang, gram, CAST(round(ln(n + 1) * 1000) AS BIGINT) AS score FROM counts),
base AS (
  SELECT lang, CAST(round(-ln(sum(n) + count(*)) * 1000) AS BIGINT) AS score FROM counts GROUP BY lang),
sizes AS (SELECT doc_id, chunk_no, count(*) AS n FROM grams GROUP BY ALL),
hits AS (
  SELECT g.doc_id, g.chunk_no, k.lang, sum(k.score) AS score
  FROM grams g JOIN known k ON k.gram = g.gram GROUP BY ALL),
touched AS (SELECT DISTINCT doc_id, chunk_no FROM hits),
totals AS (
  SELECT s.doc_id, s.chunk_no, b.lang, s.n * b.score + coalesce(h.score, 0) AS score
  FROM sizes s JOIN touched USING (doc_id, chunk_no) CROSS JOIN base b
  LEFT JOIN hits h ON h.doc_id = s.doc_id AND h.chunk_no = s.chunk_no AND h.lang = b.lang),
best AS (
  SELECT doc_id, chunk_no, lang FROM totals
  QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY score DESC, lang) = 1)"""


@query(
    LANGUAGE_SQL
    + """
SELECT c.doc_id, CAST(c.chunk_no AS INTEGER) AS chunk_no, b.lang AS language
FROM chunks c LEFT JOIN best b ON b.doc_id = c.doc_id AND b.chunk_no = c.chunk_no"""
)
def language_chunks(t):
    model = train(t.documents, "text", "lang", LANGUAGES)
    parts = t.documents.select(
        "doc_id", F.posexplode(T.chunks(T.chunk_words(F.col("text")))).alias("chunk_no", "chunk")
    )
    return label_chunks(parts, model, "doc_id", "chunk_no", with_text=False).select("doc_id", "chunk_no", "language")


@query(
    LANGUAGE_SQL
    + """
, kept AS (
  SELECT c.doc_id, string_agg(c.chunk, ' ' ORDER BY c.chunk_no) AS text
  FROM chunks c LEFT JOIN best b ON b.doc_id = c.doc_id AND b.chunk_no = c.chunk_no
  WHERE coalesce(b.lang, 'fr') = 'fr' GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN length(d.text) > 2000 THEN coalesce(k.text, '') ELSE d.text END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id"""
)
def language_filtered(t):
    """The filter with a model of all documents: the French chunks of all long texts, short ones whole."""
    model = train(t.documents, "text", "lang", LANGUAGES)
    return keep_language(t.documents.select("doc_id", "text"), "text", model, target="fr", longer_than=2000)


def wrap_sql(source, key, column, names):
    """SQL wrap of a text column at 4000 characters, for words without break points inside."""
    steps = [f"w0 AS (SELECT {key}, translate({column}, chr(10) || chr(13), '  ') AS rest FROM {source})"]
    for k in range(1, 5):
        cut = (
            "CASE WHEN rest IS NULL OR length(rest) <= 4000 THEN length(rest) "
            "ELSE 4001 - strpos(reverse(substr(rest, 1, 4001)), ' ') END"
        )
        steps.append(
            f"""w{k} AS (
  SELECT * EXCLUDE (rest, cut), nullif(rtrim(substr(rest, 1, cut), ' '), '') AS {names[k - 1]},
         nullif(ltrim(substr(rest, cut + 1), ' '), '') AS rest
  FROM (SELECT *, {cut} AS cut FROM w{k - 1}))"""
        )
    return ",\n".join(steps)


DESCRIPTIONS = [f"description_{i}" for i in range(1, 5)]


@query(f"WITH {wrap_sql('documents', 'doc_id', 'text', DESCRIPTIONS)}\nSELECT * EXCLUDE (rest) FROM w4")
def wrapped_descriptions(t):
    lines = with_lines(t.documents.select("doc_id", "text"), "text", "lines")
    return lines.select("doc_id", *description_columns(F.col("lines")))


CUT = "CASE WHEN length(rest) <= 4000 THEN length(rest) ELSE 4001 - strpos(reverse(substr(rest, 1, 4001)), ' ') END"


@query(
    f"""
WITH RECURSIVE {wrap_sql('documents', 'doc_id', 'text', DESCRIPTIONS)},
more AS (
  SELECT doc_id, 4 AS piece_no, CAST(NULL AS VARCHAR) AS text, rest FROM w4 WHERE rest IS NOT NULL
  UNION ALL
  SELECT doc_id, piece_no + 1, rtrim(substr(rest, 1, {CUT}), ' '), nullif(ltrim(substr(rest, {CUT} + 1), ' '), '')
  FROM more WHERE rest IS NOT NULL)
SELECT doc_id, piece_no, text FROM more WHERE piece_no > 4"""
)
def description_rest_pieces(t):
    """What the four columns do not hold: with them it is the whole text."""
    lines = with_lines(t.documents.select("doc_id", "text"), "text", "lines")
    return description_rest(lines, "lines", "doc_id")


@query(
    f"WITH {wrap_sql('documents', 'doc_id', 'text', DESCRIPTIONS)}\n"
    "SELECT doc_id FROM w4 WHERE rest IS NOT NULL"
)
def description_overflow(t):
    lines = with_lines(t.documents.select("doc_id", "text"), "text", "lines")
    return lines.where(overflow(F.col("lines")) > 0).select("doc_id")


@query(
    """
SELECT 'text' AS "column", count_if(length(text) > 4000) AS too_long, count_if(text IS NULL) AS nulls,
       true AS nullable FROM documents
UNION ALL
SELECT 'source', count_if(length(source) > 4), count_if(source IS NULL), false FROM documents
UNION ALL
SELECT 'lang', 0, count_if(lang IS NULL), false FROM documents"""
)
def width_report(t):
    return contract_report(t.documents, {"text": 4000, "source": 4}, ("source", "lang"))
