"""Header matching, memory, suggestions and the mapping batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import contracts as ct
from bookflow.dictionary import RESERVED_NAMES, general_headers, general_rows, header_dictionary, header_rows
from bookflow.functions.values import PII_MASKS, json_to_row, row_to_json
from bookflow.operators import mapping, matching, memory
from bookflow.options import Options
from bookflow.plans.refine import map_batch
from checks.data import (
    HEADERS, SQL_MAPPED, SQL_ORDER_TEXTS, SYSTEMS, pick, raw_rows, sql_list, sql_values,
)
from checks.functions_checks import re2
from checks.registry import check, table

ALL_SYSTEMS = [*SYSTEMS, "xero", "odoo", "sage", "moneypex", "bank_pdf_ubl", "erpnext"]
KNOWN = [r[3] for r in header_rows()]
ENDINGS = ["", "s", " (PKR)", ".", " No", " of the month"]

# --- headers derived from the tables: a dictionary spelling per order, varied by the order's other columns ----


def order_headers(spark, sf_dir):
    """source_software and column, one pair per order."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    known = pick(KNOWN, (key * 7 + cust) % len(KNOWN))
    tail = pick(ENDINGS, cust % len(ENDINGS))
    name = F.concat(known, tail)
    column = (
        F.when(key % 13 == 0, F.concat(F.upper(name), F.lit(" ")))
        .when(key % 17 == 0, F.concat("o_orderpriority", F.lit(" "), known))
        .when(key % 19 == 0, pick(RESERVED_NAMES, cust % len(RESERVED_NAMES)))
        .otherwise(name)
    )
    return table(spark, sf_dir, "orders").select(
        key, pick(ALL_SYSTEMS, cust % len(ALL_SYSTEMS)).alias("source_software"), column.alias("column")
    )


DICTIONARY = sql_values(
    [(r[0], r[1], r[2], r[3], r[6], r[7]) for r in header_rows()], "ord, kind, system, header, target, base"
)
SQL_PLAIN = (
    r"trim(regexp_replace(regexp_replace(regexp_replace(lower(nfc_normalize({0})), '\([^)]*\)', '', 'g'), "
    r"'[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"
)
SQL_GRAMS = "list_distinct(list_transform(generate_series(1, CAST(length({0}) - 1 AS BIGINT)), lambda i: substr({0}, i, 2)))"

SQL_HEADERS = f"""dict AS (SELECT *, lower(header) AS ci, {SQL_PLAIN.format('header')} AS plain FROM {DICTIONARY}),
headers AS (
  SELECT o_orderkey, {sql_list(ALL_SYSTEMS)}[o_custkey % {len(ALL_SYSTEMS)} + 1] AS source_software,
    CASE WHEN o_orderkey % 13 = 0 THEN upper(known || tail) || ' ' WHEN o_orderkey % 17 = 0 THEN o_orderpriority || ' ' || known
      WHEN o_orderkey % 19 = 0 THEN {sql_list(RESERVED_NAMES)}[o_custkey % {len(RESERVED_NAMES)} + 1] ELSE known || tail END AS "column"
  FROM (SELECT *, {sql_list(KNOWN)}[(o_orderkey * 7 + o_custkey) % {len(KNOWN)} + 1] AS known,
    {sql_list(ENDINGS)}[o_custkey % {len(ENDINGS)} + 1] AS tail FROM orders)),
pairs AS (SELECT DISTINCT source_software, "column" FROM headers),
cols AS (SELECT *, lower(trim("column")) AS ci, {SQL_PLAIN.format('"column"')} AS plain FROM (SELECT DISTINCT "column" FROM pairs))"""

SQL_LOOKUPS = f"""{SQL_HEADERS},
m_system AS (SELECT source_software, "column", target FROM pairs JOIN dict ON kind = 'system' AND system = source_software AND header = "column"),
m_ci AS (SELECT "column", arg_min(target, ord) AS target, arg_min(base, ord) AS base FROM cols JOIN dict USING (ci) GROUP BY 1),
best_plain AS (SELECT plain, target, base FROM (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY base DESC, ord) AS rn FROM dict) WHERE rn = 1),
m_plain AS (SELECT "column", target, least(base, 0.85) AS base FROM cols JOIN best_plain USING (plain))"""

SQL_SCORES = f"""{SQL_LOOKUPS},
col_grams AS (SELECT "column", {SQL_GRAMS.format('plain')} AS g FROM cols WHERE length(plain) >= 2),
dict_grams AS (SELECT ord, header, target, base, {SQL_GRAMS.format('plain')} AS h FROM dict WHERE length(plain) >= 2),
fuzzy_pairs AS (SELECT "column", ord, header, target, CAST(len(list_intersect(g, h)) AS DOUBLE) / len(list_distinct(list_concat(g, h))) * base AS score
  FROM col_grams, dict_grams),
m_fuzzy AS (SELECT "column", header, target, score FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY score DESC, ord) AS rn FROM fuzzy_pairs)
  WHERE rn = 1 AND score >= 0.6),
part_pairs AS (SELECT c."column", d.ord, d.target,
  CASE WHEN contains(c.ci, d.ci) AND length(d.ci) >= 3 THEN CAST(length(d.ci) AS DOUBLE) / length(c.ci) * d.base * CAST(0.8 AS DOUBLE)
       WHEN contains(d.ci, c.ci) AND length(c.ci) >= 3 THEN CAST(length(c.ci) AS DOUBLE) / length(d.ci) * d.base * CAST(0.75 AS DOUBLE) END AS score
  FROM cols c, dict d),
m_part AS (SELECT "column", target, score FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY score DESC, ord) AS rn FROM part_pairs WHERE score IS NOT NULL)
  WHERE rn = 1 AND score >= 0.4)"""

THREE = "CAST(printf('%.3f', score) AS DOUBLE)"

# Memory: what users confirmed or the mapper stored, one row per priority and system.
SQL_MEMORY = f"""memory AS (SELECT DISTINCT {sql_list(ALL_SYSTEMS)}[o_custkey % {len(ALL_SYSTEMS)} + 1] AS source_software,
  o_orderpriority || ' Date' AS original_column, 'transaction_date' AS standard_field,
  CASE WHEN o_orderpriority < '3' THEN CAST(0.95 AS FLOAT) WHEN o_orderpriority < '4' THEN CAST(0.85 AS FLOAT) ELSE CAST(0.7 AS FLOAT) END AS confidence,
  o_orderpriority LIKE '5%' AS confirmed_by_user FROM orders)"""


def order_memory(spark, sf_dir):
    p = F.col("o_orderpriority")
    rows = table(spark, sf_dir, "orders").select(
        pick(ALL_SYSTEMS, F.col("o_custkey") % len(ALL_SYSTEMS)).alias("source_software"),
        F.concat(p, F.lit(" Date")).alias("original_column"), F.lit("transaction_date").alias("standard_field"),
        F.when(p < "3", 0.95).when(p < "4", 0.85).otherwise(0.7).alias("confidence"),
        p.startswith("5").alias("confirmed_by_user"),
    )
    keyed = rows.distinct().withColumn("mapping_id", F.md5(F.concat("source_software", "original_column")))
    return ct.apply_defaults(keyed, ct.CONTRACTS["bronze_schema_mappings"], F.lit("2024-01-01").cast("timestamp"))


SQL_MAP = f"""{SQL_SCORES}, {SQL_MEMORY},
known AS (SELECT * FROM memory WHERE confirmed_by_user OR confidence >= CAST(0.85 AS FLOAT)),
answers AS (
  SELECT p.source_software, p."column", list_contains({sql_list(RESERVED_NAMES)}, lower(p."column")) AS is_reserved,
    k.standard_field AS t1, s.target AS t2, c.target AS t3, c.base AS b3, n.target AS t4, n.base AS b4,
    f.target AS t5, f.header AS h5, CAST(printf('%.3f', f.score) AS DOUBLE) AS b5, q.target AS t6, CAST(printf('%.3f', q.score) AS DOUBLE) AS b6
  FROM pairs p LEFT JOIN known k ON k.source_software = p.source_software AND k.original_column = p."column"
    LEFT JOIN m_system s ON s.source_software = p.source_software AND s."column" = p."column"
    LEFT JOIN m_ci c ON c."column" = p."column" LEFT JOIN m_plain n ON n."column" = p."column"
    LEFT JOIN m_fuzzy f ON f."column" = p."column" LEFT JOIN m_part q ON q."column" = p."column"),
mapping AS (
  SELECT source_software, "column", is_reserved,
    CASE WHEN NOT is_reserved THEN coalesce(t1, t2, t3, t4, t5, t6) END AS standard_field,
    CAST(CASE WHEN is_reserved THEN 0 WHEN t1 IS NOT NULL THEN 1 WHEN t2 IS NOT NULL THEN 0.95 WHEN t3 IS NOT NULL THEN b3
      WHEN t4 IS NOT NULL THEN b4 WHEN t5 IS NOT NULL THEN b5 WHEN t6 IS NOT NULL THEN b6 ELSE 0 END AS DOUBLE) AS confidence,
    CASE WHEN is_reserved THEN 'reserved_rename' WHEN t1 IS NOT NULL THEN 'user_confirmed' WHEN t2 IS NOT NULL THEN 'software_exact'
      WHEN t3 IS NOT NULL THEN 'exact_case_insensitive' WHEN t4 IS NOT NULL THEN 'normalized_match'
      WHEN t5 IS NOT NULL THEN 'fuzzy_ngram (best: ' || h5 || ')' WHEN t6 IS NOT NULL THEN 'substring_match' ELSE 'no_match' END AS match_method,
    NOT is_reserved AND t1 IS NOT NULL AS confirmed, CASE WHEN is_reserved THEN 'raw_' || "column" END AS renamed_to FROM answers)"""


@check(
    "header_dictionary",
    f"""SELECT l_suppkey % 487 AS ord, kind, header, target, base, count(*) AS n FROM lineitem
    JOIN {DICTIONARY} ON ord = l_suppkey % 487 GROUP BY ALL""",
)
def _(spark, sf_dir):
    words = header_dictionary(spark).select("ord", "kind", "header", "target", F.col("confidence").alias("base"))
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 487).alias("ord"))
    return lines.join(F.broadcast(words), "ord").groupBy("ord", "kind", "header", "target", "base").agg(
        F.count("*").alias("n")
    )


@check(
    "general_overrides",
    f"""WITH w AS (SELECT header, arg_max(target, p) AS target FROM {sql_values(general_rows(), 'header, target, p')} GROUP BY 1),
    h AS (SELECT o_orderkey, {sql_list([r[0] for r in general_rows()])}[o_orderkey % {len(general_rows())} + 1] AS header FROM orders)
    SELECT o_orderkey, target FROM h JOIN w USING (header)""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    names = table(spark, sf_dir, "orders").select(key, pick([r[0] for r in general_rows()], key % len(general_rows())).alias("header"))
    return names.join(F.broadcast(general_headers(spark)), "header").select("o_orderkey", "target")


@check(
    "match_system",
    f"""WITH {SQL_LOOKUPS} SELECT source_software, "column", target AS standard_field, CAST(0.95 AS DOUBLE) AS confidence, 'software_exact' AS match_method FROM m_system""",
)
def _(spark, sf_dir):
    return matching.match_system(order_headers(spark, sf_dir))


@check(
    "match_ci",
    f"""WITH {SQL_LOOKUPS} SELECT "column", target AS standard_field, base AS confidence, 'exact_case_insensitive' AS match_method FROM m_ci""",
)
def _(spark, sf_dir):
    return matching.match_ci(order_headers(spark, sf_dir))


@check(
    "match_normalized",
    f"""WITH {SQL_LOOKUPS} SELECT "column", target AS standard_field, CAST(base AS DOUBLE) AS confidence, 'normalized_match' AS match_method FROM m_plain""",
)
def _(spark, sf_dir):
    return matching.match_normalized(order_headers(spark, sf_dir))


@check(
    "match_fuzzy",
    f"""WITH {SQL_SCORES} SELECT "column", target AS standard_field, {THREE} AS confidence, 'fuzzy_ngram (best: ' || header || ')' AS match_method FROM m_fuzzy""",
)
def _(spark, sf_dir):
    return matching.match_fuzzy(order_headers(spark, sf_dir))


@check(
    "match_substring",
    f"""WITH {SQL_SCORES} SELECT "column", target AS standard_field, {THREE} AS confidence, 'substring_match' AS match_method FROM m_part""",
)
def _(spark, sf_dir):
    return matching.match_substring(order_headers(spark, sf_dir))


@check(
    "match_confirmed",
    f"""WITH {SQL_LOOKUPS}, {SQL_MEMORY} SELECT p.source_software, "column", standard_field, CAST(1.0 AS DOUBLE) AS confidence, 'user_confirmed' AS match_method
    FROM pairs p JOIN memory m ON m.source_software = p.source_software AND original_column = "column" """,
)
def _(spark, sf_dir):
    return matching.match_confirmed(order_headers(spark, sf_dir), order_memory(spark, sf_dir))


@check("map_columns", f"WITH {SQL_MAP} SELECT * FROM mapping")
def _(spark, sf_dir):
    known = memory.load_memory(order_memory(spark, sf_dir))
    return matching.map_columns(order_headers(spark, sf_dir), known)


@check(
    "triage",
    f"""WITH {SQL_MAP} SELECT source_software, "column", standard_field IS NOT NULL AND confidence >= 0.6 AS is_mapped,
    standard_field IS NULL OR confidence < 0.85 AS needs_review FROM mapping""",
)
def _(spark, sf_dir):
    known = memory.load_memory(order_memory(spark, sf_dir))
    mapped = matching.map_columns(order_headers(spark, sf_dir), known)
    return matching.triage(mapped).select("source_software", "column", "is_mapped", "needs_review")


@check(
    "mapping_summary",
    f"""WITH {SQL_MAP}, f AS (SELECT h.o_orderkey // 8 AS file, h.o_orderkey AS position, m.* FROM headers h JOIN mapping m USING (source_software, "column"))
    SELECT file, count(*) AS columns, avg(CAST(standard_field IS NOT NULL AS INTEGER)) AS coverage, count(*) FILTER (confidence >= 0.85) AS auto_mapped_count,
    coalesce(bool_or(standard_field = 'transaction_date'), false) AS has_date, coalesce(bool_or(standard_field IN ('net_amount', 'amount_debit', 'amount_credit')), false) AS has_amount,
    coalesce(string_agg("column", '|' ORDER BY position) FILTER (standard_field IS NULL), '') AS unmapped,
    coalesce(string_agg("column", '|' ORDER BY position) FILTER (standard_field IS NOT NULL AND confidence < 0.85 AND NOT confirmed), '') AS needs_review
    FROM f GROUP BY file""",
)
def _(spark, sf_dir):
    headers = order_headers(spark, sf_dir)
    known = memory.load_memory(order_memory(spark, sf_dir))
    columns = headers.select(
        F.floor(F.col("o_orderkey") / 8).alias("layout_id"), F.col("o_orderkey").alias("position"), "source_software", "column"
    )
    mapped = mapping.attach_mapping(columns, matching.map_columns(headers, known))
    summary = matching.mapping_summary(mapped, ["layout_id"])
    return summary.select(
        F.col("layout_id").alias("file"), "columns", "coverage", "auto_mapped_count", "has_date", "has_amount",
        F.array_join("unmapped", "|").alias("unmapped"), F.array_join("needs_review", "|").alias("needs_review"),
    )


@check(
    "load_memory",
    f"WITH {SQL_MEMORY} SELECT source_software, original_column FROM memory WHERE confirmed_by_user OR confidence >= CAST(0.85 AS FLOAT)",
)
def _(spark, sf_dir):
    return memory.load_memory(order_memory(spark, sf_dir)).select("source_software", "original_column")


@check(
    "save_memory",
    f"""WITH {SQL_MAP}, seen AS (SELECT source_software, "column" AS original_column, any_value(standard_field) AS f, any_value(confidence) AS c, count(*) AS n
      FROM headers JOIN mapping USING (source_software, "column") WHERE standard_field IS NOT NULL AND confidence >= 0.6 GROUP BY ALL)
    SELECT source_software, original_column, coalesce(m.standard_field, f) AS standard_field, round(CAST(coalesce(m.confidence, CAST(c AS FLOAT)) AS DOUBLE), 4) AS confidence,
    coalesce(confirmed_by_user, false) AS confirmed_by_user, CAST(CASE WHEN m.standard_field IS NULL THEN 0 ELSE 1 END + coalesce(n, 0) AS INTEGER) AS times_seen,
    n IS NOT NULL AS touched FROM memory m FULL JOIN seen USING (source_software, original_column)""",
)
def _(spark, sf_dir):
    headers, before = order_headers(spark, sf_dir), order_memory(spark, sf_dir)
    mapped = matching.map_columns(headers, memory.load_memory(before))
    sightings = headers.select("source_software", "column").join(mapped, ["source_software", "column"])
    after = memory.save_memory(before, sightings, F.lit("2024-06-01").cast("timestamp"))
    return after.select(
        "source_software", "original_column", "standard_field",
        F.round(F.col("confidence").cast("double"), 4).alias("confidence"), "confirmed_by_user", "times_seen",
        (F.col("updated_at") > F.lit("2024-02-01").cast("timestamp")).alias("touched"),
    )


@check(
    "memory_by_times_seen",
    f"""WITH {SQL_HEADERS} SELECT source_software, "column" AS original_column, CAST(count(*) AS INTEGER) AS times_seen FROM headers GROUP BY ALL ORDER BY 3 DESC, 1, 2""",
)
def _(spark, sf_dir):
    counted = order_headers(spark, sf_dir).groupBy("source_software", F.col("column").alias("original_column")).agg(
        F.count("*").cast("int").alias("times_seen")
    )
    return memory.by_times_seen(counted)


# --- suggestions ----------------------------------------------------------------------------------------

RESPONSES = [
    '{"mappings": {"Zzyx": "vendor", "DATE": "evil_field"}}',
    '{"mappings": {"zzyx": " Vendor ", "Foo": "vendor", "DATE": 5}}',
    'Here you are: {"mappings": {"Zzyx": "cost_center\\n"}} bye',
    '{"mappings": ["Zzyx"]}', '[1, 2]', 'no idea', '{}',
]
REASONS = [
    (0, "Zzyx", "vendor", None), (0, "DATE", None, "'DATE' → 'evil_field': not a valid standard field — rejected"),
    (1, "zzyx", "vendor", None), (1, "Foo", None, "'Foo': not in original columns — possible injection"),
    (1, "DATE", None, "'DATE': target is not a string"),
    (2, "Zzyx", None, "'Zzyx' → 'cost_center\n': contains suspicious characters"),
    (3, None, None, "LLM mappings key is not a dict — rejected entirely"),
    (4, None, None, "LLM response is not a dict — rejected entirely"), (5, None, None, "LLM output was not valid JSON"),
]


def order_suggestions(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("layout_id"), pick(RESPONSES, key % len(RESPONSES)).alias("response"),
        F.array(F.lit("DATE"), F.lit("Zzyx")).alias("columns"),
    )


SQL_SUGGESTED = f"""suggested AS (SELECT CAST(o_orderkey AS VARCHAR) AS layout_id, "column", target, reason FROM orders
  JOIN {sql_values(REASONS, 'n, "column", target, reason')} ON n = o_orderkey % {len(RESPONSES)})"""


@check("validate_suggestions", f"WITH {SQL_SUGGESTED} SELECT * FROM suggested")
def _(spark, sf_dir):
    return memory.validate_suggestions(order_suggestions(spark, sf_dir))


@check(
    "apply_suggestions",
    f"""WITH {SQL_SUGGESTED}, mapped AS (SELECT CAST(o_orderkey AS VARCHAR) AS layout_id, c AS "column", t AS standard_field, f AS confidence, k AS match_method
      FROM orders, (VALUES ('DATE', 'transaction_date', 0.95, 'exact_case_insensitive'), ('Zzyx', NULL, 0.0, 'no_match')) v(c, t, f, k))
    SELECT m.layout_id, m."column", coalesce(s.target, standard_field) AS standard_field,
    CAST(CASE WHEN s.target IS NULL THEN confidence ELSE 0.75 END AS DOUBLE) AS confidence, CASE WHEN s.target IS NULL THEN match_method ELSE 'llm_assist' END AS match_method
    FROM mapped m LEFT JOIN suggested s ON s.layout_id = m.layout_id AND s."column" = m."column" """,
)
def _(spark, sf_dir):
    suggestions = order_suggestions(spark, sf_dir)
    columns = suggestions.select("layout_id", F.lit("unknown").alias("source_software"), F.explode("columns").alias("column"))
    mapped = matching.map_columns(columns)
    each = mapping.attach_mapping(columns.withColumn("position", F.lit(0)), mapped).drop("position")
    applied = memory.apply_suggestions(each, memory.validate_suggestions(suggestions), ["layout_id"])
    return applied.select("layout_id", "column", "standard_field", "confidence", "match_method")


@check(
    "sample_for_review",
    f"""WITH d AS (SELECT doc_id, doc_id // 7 AS batch_id, doc_id % 7 + 1 AS n, text FROM documents WHERE text <> ''),
    s AS (SELECT batch_id, CAST(n AS INTEGER) AS source_row_number, left(text || ' 03001234567', 50) AS value FROM d WHERE n <= 2)
    SELECT batch_id, source_row_number, 'Memo' AS "column", {'regexp_replace(' * len(PII_MASKS)}value{''.join(f", '{re2(p)}', '{m}', 'g')" for p, m in PII_MASKS)} AS value FROM s""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").filter("text <> ''").select(
        F.floor(F.col("doc_id") / 7).alias("batch_id"), (F.col("doc_id") % 7 + 1).cast("int").alias("source_row_number"),
        F.create_map(F.lit("Memo"), F.concat("text", F.lit(" 03001234567")), F.lit("Date"), F.lit("x")).alias("raw"),
    )
    open_columns = rows.select("batch_id", F.lit("Memo").alias("column"))
    return memory.sample_for_review(rows, open_columns)


# --- the batch ------------------------------------------------------------------------------------------


@check(
    "apply_mapping",
    f"""WITH {SQL_MAPPED} SELECT bronze_id, transaction_date, amount_debit, amount_credit, net_amount, vendor, description, tx_type,
    CASE WHEN sys = 3 THEN 'FORMULA_REMOVED:=1+1' WHEN sys = 5 THEN 'DANGEROUS_CONTENT_REMOVED' WHEN sys = 4 THEN '0421' END AS spare,
    CASE WHEN o_orderkey % 89 = 0 AND o_orderkey % 97 <> 0 THEN 1 ELSE 0 END AS warned FROM mapped""",
)
def _(spark, sf_dir):
    rows = map_batch(raw_rows(spark, sf_dir)).rows
    return rows.select(
        "bronze_id", "transaction_date", "amount_debit", "amount_credit", "net_amount", "vendor", "description", "tx_type",
        F.get(F.map_values("extras"), F.lit(0)).alias("spare"), F.size("warnings").alias("warned"),
    )


RESULTS = [
    ("tally", 1.0, True, True, "", ""), ("quickbooks_desktop", 1.0, True, True, "", ""),
    ("ledgermax", 1.0, True, True, "", ""),
    ("manual_excel", 0.8, True, True, "raw_quality_score", "quality_score"),
    ("bank_pdf_hbl", 1.0, True, True, "Branch Code", ""),
    ("unknown", 0.8, True, True, "Narrations|Total-Amount|Party Nam|Zzyx", ""),
]
TARGETS = {
    "tally": ["transaction_date", "vendor", "tx_type", "amount_debit", "amount_credit"],
    "quickbooks_desktop": ["transaction_date", "vendor", "description", "net_amount", "tx_type"],
    "ledgermax": ["transaction_date", "vendor", "description", "amount_debit", "amount_credit"],
    "manual_excel": ["transaction_date", "net_amount", "vendor", "description", None],
    "bank_pdf_hbl": ["transaction_date", "description", "amount_debit", "amount_credit", None],
    "unknown": ["transaction_date", "description", "net_amount", "vendor", None],
}
MAPPINGS = [
    (s, "{" + ",".join(f'"{h}":"{t}"' for h, t in zip(HEADERS[s], TARGETS[s]) if t) + "}") for s in SYSTEMS
]


@check(
    "map_batch",
    f"""WITH {SQL_MAPPED}, f AS (SELECT file_hash, any_value(source_software) AS s, count(*) AS n, any_value(sys) AS sys FROM mapped GROUP BY 1)
    SELECT file_hash, true AS success, s AS source_software, 'b-' || file_hash AS batch_id, j AS column_mapping,
    CASE WHEN renamed = '' THEN '{{}}' ELSE '{{"quality_score":"raw_quality_score"}}' END AS rename_map, review AS needs_user_review,
    CASE WHEN sys IN (3, 5) THEN n || ' formula cells neutralized' || CASE WHEN sys = 3 THEN '|Reserved column names renamed: [''quality_score'']' ELSE '' END ELSE '' END AS security_warnings,
    CASE WHEN sys IN (3, 5) THEN n ELSE 0 END AS formula_count, coverage, has_date, has_amount, false AS llm_used
    FROM f JOIN {sql_values(RESULTS, 's, coverage, has_date, has_amount, review, renamed')} USING (s) JOIN {sql_values(MAPPINGS, 's, j')} USING (s)""",
)
def _(spark, sf_dir):
    results = map_batch(raw_rows(spark, sf_dir)).results
    return results.select(
        "file_hash", "success", "source_software", "batch_id", "column_mapping", "rename_map",
        F.array_join("needs_user_review", "|").alias("needs_user_review"),
        F.array_join("security_warnings", "|").alias("security_warnings"),
        "formula_count", "coverage", "has_date", "has_amount", "llm_used",
    )


@check(
    "map_batch_gates",
    """SELECT 's' || l_suppkey AS file_hash, false AS success, 0 AS formula_count, 'File size 60.0MB exceeds maximum 50MB. Split the file and upload in parts.' AS error
    FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY l_suppkey
    UNION ALL SELECT 's' || l_suppkey, true, 0, NULL FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY l_suppkey""",
)
def _(spark, sf_dir):
    supp = F.col("l_suppkey")
    headers = F.array(F.lit("Date"), F.lit("Amount"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), supp.cast("string")).alias("file_hash"), F.lit("b").alias("batch_id"),
        F.lit("tally").alias("source_software"), headers.alias("headers"), F.col("l_linenumber").alias("source_row_number"),
        F.map_from_arrays(headers, F.array(F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_quantity").cast("string"))).alias("raw"),
        F.when(supp % 2 == 0, 60 * 1024 * 1024).otherwise(1024).cast("bigint").alias("file_size_bytes"),
    )
    results = map_batch(rows, options=Options(enforce_gates=True)).results
    return results.select("file_hash", "success", "formula_count", "error")


@check(
    "raw_json_round_trip",
    f"""WITH {SQL_ORDER_TEXTS} SELECT md5(CAST(o_orderkey AS VARCHAR)) AS bronze_id, memo AS cell FROM order_texts WHERE sys IN (1, 2, 3, 4, 5)""",
)
def _(spark, sf_dir):
    stored = raw_rows(spark, sf_dir).select("bronze_id", "raw", row_to_json(F.col("raw")).alias("raw_content"))
    # The result has a cell a row; here all cells of all systems must have come back.
    back = json_to_row(F.col("raw_content"))
    same = F.map_entries(back).eqNullSafe(F.map_entries("raw"))
    back = F.when(same, back).otherwise(F.raise_error(F.concat(F.lit("cells changed: "), "raw_content")).cast("map<string,string>"))
    cells = stored.select("bronze_id", F.explode(back).alias("column", "cell"))
    return cells.filter(F.col("column").isin("Memo", "Narration", "Tafseelat", "Narrations") | (
        (F.col("column") == "Particulars") & F.col("cell").contains(" order "))).select("bronze_id", "cell")
