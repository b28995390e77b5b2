"""Column functions of the clean and curated layers.

The table contracts fix only the columns of these layers; the rule behind each column is chosen here and stated in
its docstring.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.functions.text import is_blank, normalize_name, strip
from bookflow.functions.values import mask_pii, normalize_tx_type
from bookflow.options import DEFAULTS, Options

# Date spellings read, in order: (method name, shape, Spark pattern). Day before month, as in the sample ledgers.
DATE_FORMATS = [
    ("iso", r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"),
    ("iso_timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}.*$", None),
    ("d/M/y", r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/y"),
    ("d-M-y", r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-y"),
    ("d.M.y", r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.y"),
    ("d MMM y", r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM y"),
    ("y/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"),
]

# Category rules, first hit wins: (category, subcategory, tax category, words of vendor or description).
CATEGORY_RULES = [
    ("Fuel & Transport", "Petrol", "fuel", "shell|pso|petrol|diesel|fuel|caltex"),
    ("Fuel & Transport", "Freight", "freight", "freight|cargo|courier|shipping"),
    ("Utilities", "Electricity", "electricity", "electric|k-electric|lesco|iesco"),
    ("Utilities", "Gas", "gas", "sui gas|ssgc|sngpl"),
    ("Utilities", "Telephone", "telephone", "ptcl|telephone|telecom|internet"),
    ("Payroll", "Salaries", "salary", "salary|salaries|payroll|wages"),
    ("Rent", "Rent", "rent", "rent|lease"),
    ("Services", "Consulting", "consulting", "consult|advisory|legal|audit"),
    ("Services", "IT", "it_services", "software|hosting|it services"),
    ("Office", "Stationery", "stationery", "stationery|printing|paper"),
    ("Inventory", "Supplies", "supplies", "supplier|supplies|goods|raw material"),
    ("Finance", "Bank profit", "bank_profit", "profit on|bank profit|markup"),
    ("Finance", "Interest", "interest", "interest"),
]
# Category of a standard transaction type: (type, category, tax category).
TX_TYPE_CATEGORIES = [
    ("sales", "Sales", None), ("purchase", "Inventory", "purchases"), ("payroll", "Payroll", "salary"),
    ("transfer", "Transfers", None), ("receipt", "Receipts", None), ("payment", "Payments", None),
    ("journal", "Adjustments", None), ("contra", "Transfers", None),
]
# Category of an account code by its first digit: (digit, category, report group).
ACCOUNT_GROUPS = [
    ("1", "Assets", "asset"), ("2", "Liabilities", "liability"), ("3", "Equity", "equity"),
    ("4", "Revenue", "revenue"), ("5", "Expenses", "expense"), ("6", "Expenses", "expense"),
]

MONEY = "decimal(18,2)"


def parse_date(text: Column) -> Column:
    """struct(date, method) of a date text; text in none of the known spellings gives nulls."""
    bare = strip(text)
    parsed, method = F.lit(None).cast("date"), F.lit(None).cast("string")
    for name, shape, pattern in reversed(DATE_FORMATS):
        value = F.try_to_date(bare, pattern) if pattern else F.try_to_date(F.substring(bare, 1, 10), "y-M-d")
        parsed = F.when(bare.rlike(shape), value).otherwise(parsed)
        method = F.when(bare.rlike(shape), F.lit(name)).otherwise(method)
    return F.struct(parsed.alias("date"), F.when(parsed.isNotNull(), method).alias("method"))


def year_month(day: Column) -> Column:
    """Month key such as 2024-01."""
    return F.date_format(day, "yyyy-MM")


def fiscal_year(day: Column, options: Options = DEFAULTS) -> Column:
    """Fiscal year such as 2024-2025; years start in ``options.fiscal_start_month``."""
    start = F.year(day) - F.when(F.month(day) < options.fiscal_start_month, 1).otherwise(0)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string")).alias("fiscal_year")


def period_key(day: Column, period_type: str) -> Column:
    """daily 2024-01-15, weekly 2024-W03 (ISO week of the ISO year), monthly 2024-01."""
    if period_type == "daily":
        return F.date_format(day, "yyyy-MM-dd")
    if period_type == "monthly":
        return year_month(day)
    week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), week)


def split_amount(debit: Column, credit: Column, net: Column) -> Column:
    """struct(amount_debit, amount_credit, method) in money.

    Two columns: split_drCr, taken as they are (null as 0). One signed amount: net, negative to the debit side. Only
    one of the two columns present: single_column. No amount at all: nulls.
    """
    zero = F.lit(0).cast(MONEY)
    d, c, n = debit.cast(MONEY), credit.cast(MONEY), net.cast(MONEY)
    method = (
        F.when(d.isNotNull() & c.isNotNull(), "split_drCr")
        .when(d.isNotNull() | c.isNotNull(), "single_column")
        .when(n.isNotNull(), "net")
    )
    from_net = F.when(method == "net", n)
    return F.struct(
        F.when(method == "net", F.greatest(-from_net, zero)).when(method.isNotNull(), F.coalesce(d, zero))
        .cast(MONEY).alias("amount_debit"),
        F.when(method == "net", F.greatest(from_net, zero)).when(method.isNotNull(), F.coalesce(c, zero))
        .cast(MONEY).alias("amount_credit"),
        method.alias("method"),
    )


def net_amount(debit: Column, credit: Column) -> Column:
    """Credit minus debit."""
    return (credit - debit).cast(MONEY)


def detect_language(text: Column) -> Column:
    """ur when at least 80 % of the letters are Arabic script, en when none is, else mixed."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    arabic = F.length(F.regexp_replace(text, r"[^\p{IsArabic}]|[^\p{L}]", ""))
    found = F.coalesce(text.rlike(r"[\p{IsArabic}&&\p{L}]"), F.lit(False))
    return F.when(~found, "en").when(arabic * 10 >= letters * 8, "ur").otherwise("mixed")


def detect_and_mask_pii(columns: dict[str, Column]) -> Column:
    """struct(detected, masked, fields, one masked text per column); ``fields`` is the JSON list of changed ones."""
    masked = {name: mask_pii(text) for name, text in columns.items()}
    hits = F.array_compact(F.array(*[F.when(masked[n] != columns[n], F.lit(n)) for n in columns]))
    found = F.size(hits) > 0
    return F.struct(
        found.alias("detected"), found.alias("masked"), F.when(found, F.to_json(hits)).alias("fields"),
        *[text.alias(name) for name, text in masked.items()],
    )


def quality_score(columns: dict[str, tuple[Column, float]]) -> Column:
    """Weighted share of filled columns, as a 32-bit float; the weights add up to 1."""
    parts = [F.when(~is_blank(c.cast("string")), F.lit(w)).otherwise(F.lit(0.0)) for c, w in columns.values()]
    return F.round(reduce(lambda a, b: a + b, parts), 4).cast("float")


def normalize_vendor(vendor: Column, composed: bool = True) -> Column:
    """Grouping key of a vendor: "Shell Clifton" gives shell_clifton; text without letters or digits gives null."""
    name = F.replace(normalize_name(vendor, composed), F.lit(" "), F.lit("_"))
    return F.when(name != "", name)


def clean_description(text: Column) -> Column:
    """Single-spaced text of at most 1000 characters."""
    return F.substring(strip(F.regexp_replace(text, r"(?U)\s+", " ")), 1, 1000)


# Every verdict a row can get: (category, subcategory, tax category, confidence, method).
VERDICTS = [
    *[(category, subcategory, tax, 0.9, "rule_based") for category, subcategory, tax, _ in CATEGORY_RULES],
    *[(category, None, None, 0.8, "account_code_map") for _, category, _ in ACCOUNT_GROUPS],
    *[(category, None, tax, 0.7, "tx_type_map") for _, category, tax in TX_TYPE_CATEGORIES],
]


def category_rule(vendor: Column, description: Column, tx_type: Column, account_code: Column) -> Column:
    """Number of the verdict (1-based place in ``VERDICTS``) of a row, null when nothing applies.

    In turn: words of vendor or description, account code, transaction type.
    """
    words = F.lower(F.concat_ws(" ", vendor, description))
    standard = normalize_tx_type(tx_type)
    conditions = [
        *[words.rlike(rf"\b({pattern})") for *_, pattern in CATEGORY_RULES],
        *[account_code.rlike(rf"^{digit}\d") for digit, _, _ in ACCOUNT_GROUPS],
        *[standard == kind for kind, _, _ in TX_TYPE_CATEGORIES],
    ]
    chain = F.when(F.lit(False), F.lit(0))
    for place, condition in enumerate(conditions, start=1):
        chain = chain.when(condition, F.lit(place))
    return chain


def categorize(rule: Column) -> Column:
    """struct(category, subcategory, tax_category, confidence, method) of a ``category_rule`` number."""
    names = ["category", "subcategory", "tax_category", "confidence", "method"]
    types = ["string", "string", "string", "float", "string"]
    return F.struct(
        *[
            F.get(F.array(*[F.lit(v[i]).cast(kind) for v in VERDICTS]), rule - 1).alias(name)
            for i, (name, kind) in enumerate(zip(names, types))
        ]
    )


def account_group(account_code: Column) -> Column:
    """asset, liability, equity, revenue, expense or other, by the first digit of the code."""
    chain = F.when(F.lit(False), F.lit(""))
    for digit, _, group in ACCOUNT_GROUPS:
        chain = chain.when(account_code.startswith(digit), F.lit(group))
    return chain.otherwise("other")


def double_entry(category: Column, net: Column) -> Column:
    """struct(debit_account, credit_account): money out debits the category and credits cash, money in the reverse."""
    account = F.coalesce(category, F.lit("Suspense"))
    out = net < 0
    return F.struct(
        F.when(out, account).otherwise("Cash").alias("debit_account"),
        F.when(out, "Cash").otherwise(account).alias("credit_account"),
    )


def money_text(amount: Column) -> Column:
    """4,500 for whole amounts, 4,500.50 for others."""
    return F.when(amount == F.floor(amount), F.format_number(amount, 0)).otherwise(F.format_number(amount, 2))


def narrative_text(day: Column, currency: Column, net: Column, vendor: Column, category: Column) -> Column:
    """"On 15 January 2024, PKR 4,500 was paid to Shell Clifton — Fuel & Transport"."""
    verb = F.when(net < 0, " was paid to ").otherwise(" was received from ")
    return F.concat(
        F.lit("On "), F.date_format(day, "d MMMM yyyy"), F.lit(", "), currency, F.lit(" "), money_text(F.abs(net)),
        verb, F.coalesce(vendor, F.lit("an unnamed party")), F.lit(" — "), F.coalesce(category, F.lit("Uncategorised")),
    )
