"""Value, text and file-name functions over whole tables."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from bookflow.dictionary import RESERVED_NAMES, STANDARD_FIELDS, tax_rows, tx_type_rows
from bookflow.functions import files as fx
from bookflow.functions import ledger as lx
from bookflow.functions import text as tx
from bookflow.functions import values as vx
from bookflow.operators.curate import tax_info
from checks.data import cents, grouped, pick, sql_grouped, sql_list, sql_ungrouped, sql_values, ungrouped
from checks.registry import check, table

# RE2 has no possessive or Unicode switches; these are the same rules in its syntax.
SQL_NULLS = sql_list(vx.NULL_TEXTS)
SQL_NUMBER = vx.NUMBER
SQL_BARE = "trim({0}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160))"


def bare(column: str) -> str:
    return SQL_BARE.format(column)


# --- file names -----------------------------------------------------------------------------------------

STEMS = [
    "monthly_accounts", "TallyPrime_Export_2024", "tallyprime_daybook", "QuickBooks_Transaction_Detail",
    "general_ledger_detail", "qbo_export", "cashbook-tally", "LedgerMax_Report", "moneypex", "HBL_Statement_Jan",
    "united bank statement", "Bank_Alfalah_eStatement", "Meezan_Bank_Statement", "nbp-statement", "account_statement_dec",
    "Xero_Export", "erpnext", "sage report", "tally", "~$report", ".hidden",
]
ENDINGS = [".xlsx", ".xls", ".csv", ".pdf", ".json", ".XLSX", ".docx", ".tmp", ".bak", ".csv.part", "", ".DS_Store"]


def named_files(spark, sf_dir):
    """A file name per order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key, F.concat(pick(STEMS, key % len(STEMS)), F.lit("_"), key.cast("string"),
                      pick(ENDINGS, key % len(ENDINGS))).alias("file_name"),
    )


SQL_NAMED = f"""named AS (
  SELECT o_orderkey, {sql_list(STEMS)}[o_orderkey % {len(STEMS)} + 1] || '_' || o_orderkey ||
    {sql_list(ENDINGS)}[o_orderkey % {len(ENDINGS)} + 1] AS file_name FROM orders),
suffixed AS (SELECT *, regexp_extract(lower(file_name), '^.+(\\.[^.]+)$', 1) AS ext FROM named),
typed AS (SELECT *, CASE WHEN ext IN ('.xlsx', '.xls') THEN 'xlsx' WHEN ext IN ('.csv', '.pdf', '.json')
  THEN substr(ext, 2) ELSE 'unknown' END AS source_type FROM suffixed)"""

SQL_SOFTWARE = "CASE " + " ".join(
    f"WHEN regexp_matches(file_name, '{p}') THEN '{s}'" for p, s, _ in fx.NAME_PATTERNS
) + " WHEN source_type = 'pdf' THEN 'bank_pdf_generic' WHEN source_type = 'xlsx' THEN 'manual_excel' ELSE 'unknown' END"
SQL_CONFIDENCE = "CAST(CASE " + " ".join(
    f"WHEN regexp_matches(file_name, '{p}') THEN {c}" for p, _, c in fx.NAME_PATTERNS
) + " WHEN source_type IN ('pdf', 'xlsx') THEN 0.5 WHEN source_type IN ('csv', 'json') THEN 0.4 ELSE 0.0 END AS DOUBLE)"
SQL_SUPPORTED = f"list_contains({sql_list(fx.SUPPORTED)}, ext)"
SQL_IGNORED = f"(list_contains({sql_list(fx.IGNORED)}, ext) OR file_name LIKE '.%' OR file_name LIKE '~$%')"


@check("is_supported", f"WITH {SQL_NAMED} SELECT o_orderkey, {SQL_SUPPORTED} AS supported FROM typed")
def _(spark, sf_dir):
    return named_files(spark, sf_dir).select("o_orderkey", fx.is_supported(F.col("file_name")).alias("supported"))


@check("is_ignored", f"WITH {SQL_NAMED} SELECT o_orderkey, {SQL_IGNORED} AS ignored FROM typed")
def _(spark, sf_dir):
    return named_files(spark, sf_dir).select("o_orderkey", fx.is_ignored(F.col("file_name")).alias("ignored"))


@check(
    "classify_file",
    f"""WITH {SQL_NAMED} SELECT o_orderkey, source_type, {SQL_SOFTWARE} AS source_software,
    {SQL_CONFIDENCE} AS detection_conf FROM typed""",
)
def _(spark, sf_dir):
    named = named_files(spark, sf_dir).withColumn("c", fx.classify_file(F.col("file_name")))
    return named.select("o_orderkey", "c.*")


@check("fingerprint", "SELECT doc_id, sha256(text) AS file_hash FROM documents")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fx.fingerprint(F.encode("text", "UTF-8")).alias("file_hash"))


@check(
    "check_file_size",
    """SELECT doc_id, n_chars * 16384 / 1048576.0 <= 50 AS passed,
    CASE WHEN n_chars * 16384 / 1048576.0 <= 50 THEN 'File size OK (' || printf('%.1f', n_chars * 16384 / 1048576.0) || 'MB)'
    ELSE 'File size ' || printf('%.1f', n_chars * 16384 / 1048576.0) ||
      'MB exceeds maximum 50MB. Split the file and upload in parts.' END AS message FROM documents""",
)
def _(spark, sf_dir):
    gate = fx.check_file_size(F.col("n_chars") * 16384)
    return table(spark, sf_dir, "documents").select("doc_id", gate.alias("g")).select("doc_id", "g.*")


@check(
    "check_row_count",
    """SELECT l_suppkey, n <= 100000 AS passed, CASE WHEN n <= 100000 THEN 'Row count OK (' || format('{:,}', n) || ' rows)'
    ELSE 'File contains ' || format('{:,}', n) || ' rows, exceeding the 100,000 row limit. ' ||
      'Please split into monthly files and upload separately.' END AS message
    FROM (SELECT l_suppkey, count(*) * 170 AS n FROM lineitem GROUP BY 1)""",
)
def _(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.count("*") * 170).alias("n"))
    return counts.select("l_suppkey", fx.check_row_count(F.col("n")).alias("g")).select("l_suppkey", "g.*")


# --- text -----------------------------------------------------------------------------------------------


@check(
    "normalize_name",
    r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(lower(nfc_normalize(text)), '\([^)]*\)', '', 'g'),
    '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g'))) AS plain FROM documents""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.normalize_name(F.col("text"))).alias("plain"))


@check("normalize_unicode", "SELECT doc_id, md5(nfc_normalize(text)) AS text, md5(nfc_normalize(lang || 'é')) AS lang FROM documents")
def _(spark, sf_dir):
    # The accents of the text are taken apart first, so that there is something to compose.
    apart = F.col("text")
    for whole in "éèêçüöäñíó":
        parts = unicodedata.normalize("NFD", whole)
        apart = F.replace(apart, F.lit(whole), F.lit(parts))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.create_map(F.lit("text"), apart, F.concat(F.col("lang"), F.lit("é")), F.lit("x")).alias("raw")
    )
    done = tx.normalize_unicode(rows)
    return done.select(
        "doc_id", F.md5(F.map_values("raw")[0]).alias("text"), F.md5(F.map_keys("raw")[1]).alias("lang")
    )


SQL_GRAMS = "list_distinct(list_transform(generate_series(1, CAST(length({0}) - 1 AS BIGINT)), lambda i: substr({0}, i, 2)))"


@check(
    "bigram_jaccard",
    f"""WITH g AS (SELECT p_partkey, {SQL_GRAMS.format("p_name")} AS a, {SQL_GRAMS.format("lower(p_type) || ' ' || substr(p_name, 3)")} AS b
    FROM part)
    SELECT p_partkey, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE
      CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))) END AS similarity FROM g""",
)
def _(spark, sf_dir):
    other = F.concat(F.lower("p_type"), F.lit(" "), F.substring("p_name", 3, 100))
    return table(spark, sf_dir, "part").select("p_partkey", tx.bigram_jaccard(F.col("p_name"), other).alias("similarity"))


@check(
    "looks_like_date",
    r"""SELECT doc_id, regexp_matches(text, '\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4}') OR
    regexp_matches(text, '\d{4}[/\-\.]\d{1,2}[/\-\.]\d{1,2}') OR
    regexp_matches(text, '(?i)\d{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)') AS dated FROM documents""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", vx.looks_like_date(F.col("text")).alias("dated"))


# --- cell values ----------------------------------------------------------------------------------------


def amount_texts(spark, sf_dir):
    """One spelled amount per line item."""
    c, n = cents(F.col("l_extendedprice")), F.col("l_linenumber")
    text = (
        F.when(F.col("l_partkey") % 41 == 0, F.concat(ungrouped(c * 100000), F.lit("")))
        .when(n == 1, F.concat(F.lit("PKR "), grouped(c))).when(n == 2, F.concat(F.lit("("), ungrouped(c), F.lit(")")))
        .when(n == 3, F.concat(F.lit(" Rs. "), grouped(c), F.lit(" "))).when(n == 4, "N/A")
        .when(n == 5, F.concat(ungrouped(c), F.lit("d"))).when(n == 6, F.concat(F.lit("rupees"), grouped(c)))
        .otherwise(F.concat(F.lit("-"), ungrouped(c)))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", n, "l_quantity", c.alias("cents"), text.alias("amount_text")
    )


SQL_AMOUNTS = f"""amounts AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, cents,
  CASE WHEN l_partkey % 41 = 0 THEN {sql_ungrouped('(cents * 100000)')}
    WHEN l_linenumber = 1 THEN 'PKR ' || {sql_grouped('cents')} WHEN l_linenumber = 2 THEN '(' || {sql_ungrouped('cents')} || ')'
    WHEN l_linenumber = 3 THEN ' Rs. ' || {sql_grouped('cents')} || ' ' WHEN l_linenumber = 4 THEN 'N/A'
    WHEN l_linenumber = 5 THEN {sql_ungrouped('cents')} || 'd' WHEN l_linenumber = 6 THEN 'rupees' || {sql_grouped('cents')}
    ELSE '-' || {sql_ungrouped('cents')} END AS amount_text
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)),
bare AS (SELECT *, trim(amount_text) AS b FROM amounts),
signed AS (SELECT *, replace(regexp_replace(b, '{vx.CURRENCY_LABEL}', ''), ',', '') AS s FROM bare),
numbered AS (SELECT *, CASE WHEN regexp_matches(n, '{SQL_NUMBER}') THEN TRY_CAST(n AS DOUBLE) END AS v FROM
  (SELECT *, trim(CASE WHEN s LIKE '(%)' THEN '-' || substr(s, 2, length(s) - 2) ELSE s END) AS n FROM signed))"""


@check(
    "parse_amount",
    f"""WITH {SQL_AMOUNTS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cents, CASE WHEN b <> 'N/A' THEN v END AS value,
    CASE WHEN b = 'N/A' THEN NULL WHEN v IS NULL THEN 'Could not parse amount ''' || b || ''' in ''Amount'' — value will be null'
      WHEN abs(v) > 1000000000 THEN 'Very large amount in ''Amount'': ' || format('{{:,.2f}}', v) || ' — please verify' END AS warning
    FROM numbered""",
)
def _(spark, sf_dir):
    parsed = amount_texts(spark, sf_dir).withColumn("p", vx.parse_amount(F.col("amount_text"), F.lit("Amount")))
    return parsed.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents", "p.*")


@check(
    "parse_tax_rate",
    f"""WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN 'None'
      WHEN 3 THEN CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) || '%' WHEN 4 THEN CAST(CAST(l_quantity AS INTEGER) * 3 AS VARCHAR) || ' %'
      ELSE '0.' || CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) END AS s FROM lineitem),
    n AS (SELECT *, CASE WHEN regexp_matches(trim(replace(s, '%', '')), '{SQL_NUMBER}') THEN TRY_CAST(trim(replace(s, '%', '')) AS DOUBLE) END AS v FROM t)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE WHEN v BETWEEN 0 AND 100 THEN v END AS value,
    CASE WHEN s = 'None' THEN NULL WHEN v IS NULL THEN 'Tax rate ''' || s || ''' is not numeric'
      WHEN NOT v BETWEEN 0 AND 100 THEN 'Tax rate ''' || s || ''' out of range (0–100)' END AS warning FROM n""",
)
def _(spark, sf_dir):
    n, pct = F.col("l_linenumber"), F.round(F.col("l_tax") * 100).cast("int").cast("string")
    text = (
        F.when(n == 1, "n/a").when(n == 2, "None").when(n == 3, F.concat(pct, F.lit("%")))
        .when(n == 4, F.concat((F.col("l_quantity").cast("int") * 3).cast("string"), F.lit(" %")))
        .otherwise(F.concat(F.lit("0."), pct))
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return table(spark, sf_dir, "lineitem").select(*keys, vx.parse_tax_rate(text).alias("p")).select(*keys, "p.*")


@check(
    "null_values",
    f"""SELECT o_orderkey, CASE WHEN NOT list_contains({SQL_NULLS}, trim(s)) THEN trim(s) END AS value FROM
    (SELECT o_orderkey, ['', ' nan ', 'NaN', 'None', 'N/A', 'n/a', ' ' || o_orderpriority || ' '][o_orderkey % 7 + 1] AS s FROM orders)""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    padded = F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))
    text = F.element_at(
        F.array(*[F.lit(s) for s in ["", " nan ", "NaN", "None", "N/A", "n/a"]], padded), (key % 7 + 1).cast("int")
    )
    return table(spark, sf_dir, "orders").select(key, vx.null_values(text).alias("value"))


@check(
    "truncate_text",
    f"""SELECT doc_id, md5(left({bare('text')}, 500)) AS value,
    CASE WHEN length({bare('text')}) > 500 THEN 'Value truncated to 500 chars in ''Memo''' END AS warning FROM documents""",
)
def _(spark, sf_dir):
    cut = vx.truncate_text(F.col("text"), F.lit("Memo"))
    return table(spark, sf_dir, "documents").select("doc_id", cut.alias("c")).select(
        "doc_id", F.md5("c.value").alias("value"), "c.warning"
    )


@check("date_passthrough", "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS value FROM orders")
def _(spark, sf_dir):
    text = F.concat(F.lit("  "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("\t"))
    return table(spark, sf_dir, "orders").select("o_orderkey", vx.date_passthrough(text)["value"].alias("value"))


SQL_NEUTRAL = r"""CASE WHEN regexp_matches({b}, '^[=+\-@]') THEN 'FORMULA_REMOVED:' || {b}
  WHEN regexp_matches({b}, '(?i)<script|javascript:|data:text|HYPERLINK|=CMD\(|=SHELL\(|=EXEC\(|\.\./|\x00') THEN 'DANGEROUS_CONTENT_REMOVED'
  ELSE {c} END"""
SQL_PAGES = """cells AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN html WHEN 1 THEN ' =' || html WHEN 2 THEN url ELSE '@' || url END AS cell FROM pages)"""


def page_cells(spark, sf_dir):
    n = F.col("page_id") % 4
    cell = (
        F.when(n == 0, F.col("html")).when(n == 1, F.concat(F.lit(" ="), F.col("html"))).when(n == 2, F.col("url"))
        .otherwise(F.concat(F.lit("@"), F.col("url")))
    )
    return table(spark, sf_dir, "pages").select("page_id", cell.alias("cell"))


@check(
    "neutralize_cell",
    f"WITH {SQL_PAGES} SELECT page_id, md5({SQL_NEUTRAL.format(b=bare('cell'), c='cell')}) AS cell FROM cells",
)
def _(spark, sf_dir):
    return page_cells(spark, sf_dir).select("page_id", F.md5(vx.neutralize_cell(F.col("cell"))).alias("cell"))


@check(
    "neutralized_count",
    f"""WITH {SQL_PAGES} SELECT count(*) AS rows, sum(CAST({SQL_NEUTRAL.format(b=bare('cell'), c='cell')} <> cell AS BIGINT)) AS formulas FROM cells""",
)
def _(spark, sf_dir):
    rows = page_cells(spark, sf_dir).select(F.create_map(F.lit("cell"), F.col("cell")).alias("raw"))
    return rows.agg(
        F.count("*").alias("rows"), F.sum(vx.neutralized_count(F.col("raw"))).alias("formulas")
    )


PII_TAIL = " a 03001234567 +923001234567 12345-1234567-1 1234567 end"


def re2(pattern: str) -> str:
    return pattern.replace("(?U)", "")


def sql_mask(text: str, masks) -> str:
    for pattern, mask in masks:
        text = f"regexp_replace({text}, '{re2(pattern)}', '{mask}', 'g')"
    return text


@check(
    "mask_pii",
    f"SELECT doc_id, md5({sql_mask(f'''text || '{PII_TAIL}' ''', vx.PII_MASKS)}) AS masked FROM documents",
)
def _(spark, sf_dir):
    text = F.concat(F.col("text"), F.lit(PII_TAIL))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(vx.mask_pii(text)).alias("masked"))


@check(
    "mask_pii_legacy_order",
    f"SELECT doc_id, md5({sql_mask(f'''text || '{PII_TAIL}' ''', vx.PII_MASKS_LEGACY)}) AS masked FROM documents",
)
def _(spark, sf_dir):
    text = F.concat(F.col("text"), F.lit(PII_TAIL))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(vx.mask_pii(text, True)).alias("masked"))


NAMES = [*RESERVED_NAMES, *STANDARD_FIELDS]
SQL_NAMES = f"""names AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN upper(n) ELSE n END AS name FROM
  (SELECT o_orderkey, {sql_list(NAMES)}[o_orderkey % {len(NAMES)} + 1] AS n FROM orders))"""


def some_names(spark, sf_dir):
    key = F.col("o_orderkey")
    name = pick(NAMES, key % len(NAMES))
    return table(spark, sf_dir, "orders").select(
        key, F.when(key % 2 == 0, F.upper(name)).otherwise(name).alias("name")
    )


@check(
    "is_reserved",
    f"WITH {SQL_NAMES} SELECT o_orderkey, list_contains({sql_list(RESERVED_NAMES)}, lower(name)) AS reserved FROM names",
)
def _(spark, sf_dir):
    return some_names(spark, sf_dir).select("o_orderkey", vx.is_reserved(F.col("name")).alias("reserved"))


@check(
    "rename_reserved",
    f"""WITH {SQL_NAMES} SELECT o_orderkey, CASE WHEN list_contains({sql_list(RESERVED_NAMES)}, lower(name)) THEN 'raw_' || name
    ELSE name END AS column_name FROM names""",
)
def _(spark, sf_dir):
    rows = some_names(spark, sf_dir).withColumn("raw", F.create_map(F.col("name"), F.lit("x")))
    return rows.select("o_orderkey", F.map_keys(vx.rename_reserved_keys(F.col("raw")))[0].alias("column_name"))


TX_TEXTS = [source for source, _ in tx_type_rows()]


@check(
    "normalize_tx_type",
    f"""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN upper(s) || o_custkey
      WHEN o_orderkey % 5 = 0 THEN '  ' || s || ' ' ELSE s END AS s FROM
      (SELECT *, {sql_list(TX_TEXTS)}[o_orderkey % {len(TX_TEXTS)} + 1] AS s FROM orders))
    SELECT o_orderkey, CASE WHEN s = '' THEN 'unknown' ELSE coalesce(standard, lower(trim(s))) END AS tx_type FROM t
    LEFT JOIN {sql_values(tx_type_rows(), 'source, standard')} d ON trim(s) = source""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    s = pick(TX_TEXTS, key % len(TX_TEXTS))
    text = (
        F.when(key % 11 == 0, "").when(key % 13 == 0, F.concat(F.upper(s), F.col("o_custkey").cast("string")))
        .when(key % 5 == 0, F.concat(F.lit("  "), s, F.lit(" "))).otherwise(s)
    )
    return table(spark, sf_dir, "orders").select(key, vx.normalize_tx_type(text).alias("tx_type"))


TAX_NAMES = [*[r[0] for r in tax_rows()], "unlisted"]


@check(
    "tax_info",
    f"""WITH t AS (SELECT l_partkey, l_orderkey, l_suppkey, l_linenumber, l_extendedprice,
      CASE WHEN l_orderkey % 2 = 0 THEN upper(c) ELSE c END AS tax_category FROM
      (SELECT *, {sql_list(TAX_NAMES)}[l_partkey % {len(TAX_NAMES)} + 1] AS c FROM lineitem))
    SELECT tax_category, fbr_section, wht_applicable, wht_rate_filer, tax_note, count(*) AS n FROM t
    LEFT JOIN {sql_values(tax_rows(), 'head, fbr_section, wht_applicable, wht_rate_filer, tax_note')} h ON lower(tax_category) = head
    GROUP BY ALL""",
)
def _(spark, sf_dir):
    name = pick(TAX_NAMES, F.col("l_partkey") % len(TAX_NAMES))
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 2 == 0, F.upper(name)).otherwise(name).alias("tax_category")
    )
    return tax_info(rows).groupBy(
        "tax_category", "fbr_section", "wht_applicable", "wht_rate_filer", "tax_note"
    ).agg(F.count("*").alias("n"))


@check(
    "row_to_json",
    "SELECT doc_id, md5(CAST(json_object('Tafseel', text, 'زبان', lang, 'leer', NULL) AS VARCHAR)) AS raw_content FROM documents",
)
def _(spark, sf_dir):
    raw = F.create_map(
        F.lit("Tafseel"), F.col("text"), F.lit("زبان"), F.col("lang"), F.lit("leer"), F.lit(None).cast("string")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(vx.row_to_json(raw)).alias("raw_content"))


@check(
    "headers_to_json",
    "SELECT p_partkey, CAST(json_array(p_name, 'تاریخ', p_brand, p_type) AS VARCHAR) AS raw_headers FROM part",
)
def _(spark, sf_dir):
    headers = F.array(F.col("p_name"), F.lit("تاریخ"), F.col("p_brand"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", vx.headers_to_json(headers).alias("raw_headers"))


# --- ledger functions -----------------------------------------------------------------------------------


@check(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
    ['iso', 'd/M/y', 'd-M-y', 'd.M.y', 'd MMM y', 'y/M/d', 'iso_timestamp', NULL][o_orderkey % 8 + 1] AS method FROM orders""",
)
def _(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    shapes = ["yyyy-MM-dd", "dd/MM/yyyy", "d-M-yyyy", "dd.MM.yyyy", "d MMM yyyy", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss"]
    text = F.when(key % 8 == 7, "31/31/2024")
    for n, shape in enumerate(shapes):
        text = text.when(key % 8 == n, F.date_format(day, shape))
    parsed = table(spark, sf_dir, "orders").select(key, lx.parse_date(F.concat(F.lit(" "), text)).alias("p"))
    return parsed.select("o_orderkey", F.date_format("p.date", "yyyy-MM-dd").alias("day"), "p.method")


@check(
    "year_month_and_fiscal_year",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month,
    CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1)
    ELSE (year(o_orderdate) - 1) || '-' || year(o_orderdate) END AS fiscal_year FROM orders""",
)
def _(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", lx.year_month(day).alias("year_month"), lx.fiscal_year(day).alias("fiscal_year")
    )


@check(
    "period_key",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS daily, strftime(o_orderdate, '%G-W%V') AS weekly,
    strftime(o_orderdate, '%Y-%m') AS monthly FROM orders""",
)
def _(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[lx.period_key(day, p).alias(p) for p in ("daily", "weekly", "monthly")]
    )


@check(
    "split_amount",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cents,
    CASE l_linenumber WHEN 1 THEN cents WHEN 2 THEN 0 WHEN 3 THEN cents WHEN 4 THEN 0 WHEN 5 THEN cents WHEN 6 THEN 0 END AS debit,
    CASE l_linenumber WHEN 1 THEN 500 WHEN 2 THEN cents WHEN 3 THEN 0 WHEN 4 THEN cents WHEN 5 THEN 0 WHEN 6 THEN cents END AS credit,
    CASE WHEN l_linenumber = 1 THEN 'split_drCr' WHEN l_linenumber <= 4 THEN 'single_column' WHEN l_linenumber <= 6 THEN 'net' END AS method
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
    WHERE l_linenumber <> 2 UNION ALL
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cents, 0, cents, 'split_drCr'
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) WHERE l_linenumber = 2""",
)
def _(spark, sf_dir):
    n, c = F.col("l_linenumber"), cents(F.col("l_extendedprice"))
    amount = (c.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    debit = F.when(n.isin(1, 3), amount).when(n == 2, F.lit(0).cast("decimal(18,2)"))
    credit = F.when(n == 1, F.lit(5).cast("decimal(18,2)")).when(n.isin(2, 4), amount)
    net = F.when(n == 5, -amount).when(n == 6, amount)
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    split = table(spark, sf_dir, "lineitem").select(*keys, c.alias("cents"), lx.split_amount(debit, credit, net).alias("s"))
    return split.select(
        *keys, "cents", (F.col("s.amount_debit") * 100).cast("bigint").alias("debit"),
        (F.col("s.amount_credit") * 100).cast("bigint").alias("credit"), "s.method",
    )


URDU = "تفصیل رقم جمع خرچ بقیہ حوالہ نمبر"


@check(
    "detect_language",
    rf"""WITH t AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN repeat('{URDU} ', n_chars // 4) || text
      ELSE text || '{URDU}' END AS s FROM documents),
    n AS (SELECT doc_id, length(regexp_replace(s, '[^\p{{L}}]', '', 'g')) AS letters,
      length(regexp_replace(s, '[^\p{{Arabic}}]', '', 'g')) AS arabic FROM t)
    SELECT doc_id, CASE WHEN arabic = 0 THEN 'en' WHEN arabic * 10 >= letters * 8 THEN 'ur' ELSE 'mixed' END AS language FROM n""",
)
def _(spark, sf_dir):
    n, text = F.col("doc_id") % 3, F.col("text")
    mixed = (
        F.when(n == 0, text)
        .when(n == 1, F.concat(F.repeat(F.lit(URDU + " "), F.floor(F.col("n_chars") / 4).cast("int")), text))
        .otherwise(F.concat(text, F.lit(URDU)))
    )
    return table(spark, sf_dir, "documents").select("doc_id", lx.detect_language(mixed).alias("language"))


@check(
    "detect_and_mask_pii",
    f"""WITH m AS (SELECT doc_id, text, {sql_mask('text', vx.PII_MASKS)} AS masked, CASE WHEN doc_id % 2 = 0 THEN 'ref 1234567' ELSE 'ref' END AS ref FROM documents)
    SELECT doc_id, masked <> text OR doc_id % 2 = 0 AS detected, md5(masked) AS description,
    CASE WHEN masked <> text AND doc_id % 2 = 0 THEN '["description","reference"]' WHEN masked <> text THEN '["description"]'
    WHEN doc_id % 2 = 0 THEN '["reference"]' END AS fields, replace(ref, '1234567', '[NTN]') AS reference FROM m""",
)
def _(spark, sf_dir):
    ref = F.when(F.col("doc_id") % 2 == 0, "ref 1234567").otherwise("ref")
    found = lx.detect_and_mask_pii({"description": F.col("text"), "reference": ref})
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("p")).select(
        "doc_id", "p.detected", F.md5("p.description").alias("description"), "p.fields", "p.reference"
    )


@check(
    "normalize_vendor",
    r"""SELECT c_custkey, replace(trim(regexp_replace(regexp_replace(regexp_replace(lower(c_name || ' (' || c_mktsegment || ') & Sons'),
    '\([^)]*\)', '', 'g'), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')), ' ', '_') AS vendor FROM customer""",
)
def _(spark, sf_dir):
    name = F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(") & Sons"))
    return table(spark, sf_dir, "customer").select("c_custkey", lx.normalize_vendor(name).alias("vendor"))


@check(
    "clean_description",
    r"SELECT doc_id, md5(left(trim(regexp_replace(text, '\s+', ' ', 'g')), 1000)) AS description FROM documents",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(lx.clean_description(F.col("text"))).alias("description")
    )


@check(
    "quality_score",
    """SELECT o_orderkey, CAST(CAST(0.3 + CASE WHEN o_orderkey % 2 = 0 THEN 0.3 ELSE 0 END + CASE WHEN o_orderkey % 3 = 0 THEN 0.4 ELSE 0 END AS FLOAT)
    >= CAST(0.7 AS FLOAT) AS BOOLEAN) AS passes FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    score = lx.quality_score({
        "day": (F.col("o_orderdate"), 0.3), "amount": (F.when(key % 2 == 0, 1), 0.3),
        "vendor": (F.when(key % 3 == 0, "x").otherwise(" "), 0.4),
    })
    return table(spark, sf_dir, "orders").select(key, (score >= F.lit(0.7).cast("float")).alias("passes"))
