"""Header matching: each strategy alone and the cascade over all of them.

Every function works on distinct headers. The dictionary has 487 rows whatever the data, so its lookup forms are
always broadcast. Similarity and substring matching look candidates up by shared bigrams and trigrams: an equi-join
that finds exactly the pairs a comparison of every header with every entry would score above zero. The n-grams are
exploded in the outer form: the inner one lets the optimizer move "has n-grams", and with it the whole normalisation,
below the step that makes headers distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.dictionary import header_rows
from bookflow.functions.text import grams, normalize_name, round_half_even, strip
from bookflow.functions.values import is_reserved
from bookflow.options import DEFAULTS, Options

MATCH = ["standard_field", "confidence", "match_method"]
_ENTRY = "ord int, header string, target string, base double"


def _best_entries(key: int) -> dict[str, tuple]:
    """Dictionary rows by one of their spellings, keeping the highest confidence and then the earliest row."""
    best: dict[str, tuple] = {}
    for row in header_rows():
        if row[key] not in best or row[7] > best[row[key]][7]:
            best[row[key]] = row
    return best


def _char_grams(text: str, n: int) -> list[str]:
    return sorted({text[i : i + n] for i in range(len(text) - n + 1)})


def system_entries(spark: SparkSession) -> DataFrame:
    """(source_software, column, target): the headers of every system."""
    rows = [(r[2], r[3], r[6]) for r in header_rows() if r[1] == "system"]
    return spark.createDataFrame(rows, "source_software string, column string, target string")


def spelled_entries(spark: SparkSession) -> DataFrame:
    """(column_ci, target, base): first entry in dictionary order of each lower-case spelling."""
    first: dict[str, tuple] = {}
    for row in header_rows():
        first.setdefault(row[4], row)
    return spark.createDataFrame(
        [(k, r[6], r[7]) for k, r in first.items()], "column_ci string, target string, base double"
    )


def plain_entries(spark: SparkSession) -> DataFrame:
    """(plain, target, base): best entry of each normalised spelling."""
    rows = [(k, r[6], r[7]) for k, r in _best_entries(5).items()]
    return spark.createDataFrame(rows, "plain string, target string, base double")


def prepare(columns: DataFrame) -> DataFrame:
    """Adds ``column_ci`` (stripped, lower case) and ``plain`` (normalised) to rows with ``column``."""
    name = F.col("column")
    return columns.withColumn("column_ci", F.lower(strip(name))).withColumn("plain", normalize_name(name))


def _by_header(headers: DataFrame) -> DataFrame:
    """Headers hashed by name. Everything up to the best entry per header then stays in place, and the few headers keep
    all cores busy, where adaptive execution would gather them in one task."""
    partitions = int(headers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return headers.repartition(partitions, "column")


def _matched(target: Column, confidence: Column, method: str) -> list[Column]:
    return [
        target.alias("standard_field"), confidence.alias("confidence"), F.lit(method).alias("match_method"),
    ]


def match_confirmed(columns: DataFrame, memory: DataFrame) -> DataFrame:
    """Headers remembered for their system (see ``memory.load_memory``): confidence 1.0."""
    known = memory.select(
        "source_software", F.col("original_column").alias("column"), F.col("standard_field").alias("target")
    )
    hits = columns.select("source_software", "column").distinct().join(known, ["source_software", "column"])
    return hits.select("source_software", "column", *_matched(F.col("target"), F.lit(1.0), "user_confirmed"))


def match_system(columns: DataFrame) -> DataFrame:
    """Headers spelled exactly as their system exports them: confidence 0.95."""
    entries = F.broadcast(system_entries(columns.sparkSession))
    hits = columns.select("source_software", "column").distinct().join(entries, ["source_software", "column"])
    return hits.select("source_software", "column", *_matched(F.col("target"), F.lit(0.95), "software_exact"))


def match_ci(columns: DataFrame) -> DataFrame:
    """Headers equal to an entry of any system but for case and outer spaces: the entry's confidence."""
    entries = F.broadcast(spelled_entries(columns.sparkSession))
    wanted = columns.select("column").distinct().withColumn("column_ci", F.lower(strip(F.col("column"))))
    hits = wanted.join(entries, "column_ci")
    return hits.select("column", *_matched(F.col("target"), F.col("base"), "exact_case_insensitive"))


def match_normalized(columns: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Headers equal to an entry after ``normalize_name``: the best entry's confidence, at most 0.85."""
    entries = F.broadcast(plain_entries(columns.sparkSession))
    hits = prepare(columns.select("column").distinct()).join(entries, "plain")
    return hits.select("column", *_matched(F.col("target"), F.least("base", F.lit(0.85)), "normalized_match"))


def _similar(prepared: DataFrame, options: Options) -> DataFrame:
    spark = prepared.sparkSession
    best = _best_entries(5)
    entries = spark.createDataFrame(
        [
            (gram, len(_char_grams(plain, 2)), r[0], r[7])
            for plain, r in best.items()
            for gram in _char_grams(plain, 2)
        ],
        "gram string, entry_grams int, ord int, base double",
    )
    names = spark.createDataFrame([(r[0], r[3], r[6]) for r in best.values()], "ord int, header string, target string")
    wanted = (
        prepared.select("column", grams(F.col("plain"), 2).alias("gs"))
        .select("column", F.size("gs").alias("column_grams"), F.explode_outer("gs").alias("gram"))
    )
    # A pair of sets can be no more alike than the smaller is to the larger.
    ceiling = F.least("column_grams", "entry_grams") / F.greatest("column_grams", "entry_grams")
    shared = (
        wanted.join(F.broadcast(entries), "gram")
        .filter(ceiling * F.col("base") >= options.suggest)
        .groupBy("column", "ord", "column_grams", "entry_grams", "base")
        .agg(F.count("*").alias("both"))
    )
    either = F.col("column_grams") + F.col("entry_grams") - F.col("both")
    scored = shared.withColumn("score", F.col("both") / either * F.col("base"))
    return _top(scored.filter(F.col("score") >= options.suggest).join(F.broadcast(names), "ord"))


def _containing(prepared: DataFrame, options: Options) -> DataFrame:
    spark = prepared.sparkSession
    known = {k: r for k, r in _best_entries(4).items() if len(k) >= 3}
    schema = f"gram string, known string, {_ENTRY}"

    def entries(grams_of) -> DataFrame:
        rows = [(g, k, r[0], r[3], r[6], r[7]) for k, r in known.items() for g in grams_of(k)]
        return F.broadcast(spark.createDataFrame(rows, schema))

    names = prepared.select("column", "column_ci").filter(F.length("column_ci") >= 3)
    inside, outside = F.length("known"), F.length("column_ci")
    # An entry inside the header: its first trigram is one of the header's trigrams.
    longer = (
        names.withColumn("gram", F.explode_outer(grams(F.col("column_ci"), 3)))
        .join(entries(lambda k: [k[:3]]), "gram")
        .filter(F.col("column_ci").contains(F.col("known")))
        .withColumn("score", inside / outside * F.col("base") * F.lit(0.80))
    )
    # The header inside a longer entry: its first trigram is one of the entry's trigrams.
    shorter = (
        names.withColumn("gram", F.substring("column_ci", 1, 3))
        .join(entries(lambda k: _char_grams(k, 3)), "gram")
        .filter(F.col("known").contains(F.col("column_ci")) & (inside > outside))
        .withColumn("score", outside / inside * F.col("base") * F.lit(0.75))
    )
    return _top(longer.unionByName(shorter).filter(F.col("score") >= options.reject))


def _top(scored: DataFrame) -> DataFrame:
    """Best score per header, the earliest dictionary row on a tie."""
    best = F.max_by(F.struct("target", "header", "score"), F.struct("score", -F.col("ord")))
    return scored.groupBy("column").agg(best.alias("best")).select("column", "best.*")


def match_fuzzy(columns: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Headers whose bigram similarity times the entry's confidence reaches ``options.suggest``."""
    best = _similar(_by_header(prepare(columns.select("column").distinct())), options)
    return best.select("column", *_fuzzy_match())


def _fuzzy_match() -> list[Column]:
    method = F.concat(F.lit("fuzzy_ngram (best: "), F.col("header"), F.lit(")"))
    return [
        F.col("target").alias("standard_field"), round_half_even(F.col("score"), 3).alias("confidence"),
        method.alias("match_method"),
    ]


def match_substring(columns: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Headers that contain an entry or stand inside one, scored by the length ratio, from ``options.reject`` on."""
    best = _containing(_by_header(prepare(columns.select("column").distinct())), options)
    return best.select(
        "column", *_matched(F.col("target"), round_half_even(F.col("score"), 3), "substring_match")
    )


def map_columns(columns: DataFrame, memory: DataFrame | None = None, options: Options = DEFAULTS) -> DataFrame:
    """One row per distinct (source_software, column) with the first strategy that answers.

    Order: reserved name, memory, system, case-insensitive, normalised, similarity, substring, no match.
    Adds standard_field, confidence, match_method, confirmed, is_reserved, renamed_to. The two scored strategies run
    only over the headers the lookups leave open.
    """
    spark = columns.sparkSession
    none = F.lit(None).cast("string")

    def answer(target: Column, confidence: Column, method: Column, confirmed: bool = False) -> Column:
        return F.when(
            target.isNotNull(),
            F.struct(
                target.alias("standard_field"), confidence.alias("confidence"), method.alias("match_method"),
                F.lit(confirmed).alias("confirmed"),
            ),
        )

    if memory is None:
        memory = spark.createDataFrame([], "source_software string, original_column string, standard_field string")
    known = memory.select(
        "source_software", F.col("original_column").alias("column"), F.col("standard_field").alias("remembered")
    )
    system = system_entries(spark).withColumnRenamed("target", "exact")
    spelled = spelled_entries(spark).withColumnsRenamed({"target": "spelled", "base": "spelled_base"})
    plain = plain_entries(spark).withColumnsRenamed({"target": "normal", "base": "normal_base"})
    looked_up = (
        prepare(columns.select("source_software", "column").distinct())
        .join(known, ["source_software", "column"], "left")
        .join(F.broadcast(system), ["source_software", "column"], "left")
        .join(F.broadcast(spelled), "column_ci", "left")
        .join(F.broadcast(plain), "plain", "left")
        .withColumn("is_reserved", F.coalesce(is_reserved(F.col("column")), F.lit(False)))
        .withColumn(
            "found",
            F.coalesce(
                answer(F.col("remembered"), F.lit(1.0), F.lit("user_confirmed"), confirmed=True),
                answer(F.col("exact"), F.lit(0.95), F.lit("software_exact")),
                answer(F.col("spelled"), F.col("spelled_base"), F.lit("exact_case_insensitive")),
                answer(F.col("normal"), F.least("normal_base", F.lit(0.85)), F.lit("normalized_match")),
            ),
        )
    )
    still_open = _by_header(
        looked_up.filter(F.col("found").isNull() & ~F.col("is_reserved")).select("column", "column_ci", "plain")
    ).distinct()

    def scored(best: DataFrame, name: str, method: Column) -> DataFrame:
        value = answer(F.col("target"), round_half_even(F.col("score"), 3), method)
        return best.select("column", value.alias(name))

    similar = scored(
        _similar(still_open, options), "similar",
        F.concat(F.lit("fuzzy_ngram (best: "), F.col("header"), F.lit(")")),
    )
    containing = scored(_containing(still_open, options), "containing", F.lit("substring_match"))
    nothing = F.struct(
        none.alias("standard_field"), F.lit(0.0).alias("confidence"), F.lit("no_match").alias("match_method"),
        F.lit(False).alias("confirmed"),
    )
    reserved = F.struct(
        none.alias("standard_field"), F.lit(0.0).alias("confidence"), F.lit("reserved_rename").alias("match_method"),
        F.lit(False).alias("confirmed"),
    )
    return (
        looked_up.join(similar, "column", "left")
        .join(containing, "column", "left")
        .withColumn(
            "m",
            F.when(F.col("is_reserved"), reserved).otherwise(F.coalesce("found", "similar", "containing", nothing)),
        )
        .select(
            "source_software", "column", "m.*", "is_reserved",
            F.when(F.col("is_reserved"), F.concat(F.lit("raw_"), F.col("column"))).alias("renamed_to"),
        )
    )


def triage(mapped: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Adds ``is_mapped`` and ``needs_review``: from 0.85 mapped, from 0.60 mapped and reviewed, else reviewed."""
    usable = F.col("standard_field").isNotNull()
    return mapped.withColumn("is_mapped", usable & (F.col("confidence") >= options.suggest)).withColumn(
        "needs_review", ~(usable & (F.col("confidence") >= options.auto_accept))
    )


def mapping_summary(mapped: DataFrame, by: list[str], options: Options = DEFAULTS) -> DataFrame:
    """Per file: coverage, auto-mapped count, has_date, has_amount, unmapped and needs_review lists.

    ``mapped`` has one row per file and header with its ``position``. A file's list is as long as its header row.
    """
    field = F.col("standard_field")
    doubtful = field.isNotNull() & (F.col("confidence") < options.auto_accept) & ~F.col("confirmed")

    def listed(condition: Column) -> Column:
        entries = F.array_sort(F.collect_list(F.when(condition, F.struct("position", "column"))))
        return F.transform(entries, lambda e: e["column"])

    return mapped.groupBy(*by).agg(
        F.count("*").alias("columns"),
        F.coalesce(F.avg(field.isNotNull().cast("int")), F.lit(0.0)).alias("coverage"),
        F.count_if(F.col("confidence") >= options.auto_accept).alias("auto_mapped_count"),
        F.coalesce(F.bool_or(field == "transaction_date"), F.lit(False)).alias("has_date"),
        F.coalesce(F.bool_or(field.isin("net_amount", "amount_debit", "amount_credit")), F.lit(False)).alias(
            "has_amount"
        ),
        listed(field.isNull()).alias("unmapped"),
        listed(doubtful).alias("needs_review"),
    )
