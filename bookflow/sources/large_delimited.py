"""Large delimited files: one file over many tasks, with the rows that ``delimited`` would give.

A file is read in Spark's own splits ("blocks"), line by line. A line end inside a quoted field does not end a record, so
whether a block starts inside quotes depends on all before it. Every block is first reduced to what it does to either
state; these transitions are associative, so a prefix scan over the few blocks of a file gives every block its state and
the number of records before it. A second pass cuts each block into records; a record that crosses blocks leaves its
pieces, which are put together by its number. No task holds more than a block, and no value is longer than a record.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookflow.functions.text import let, strip
from bookflow.options import DEFAULTS, Options
from bookflow.plans.session import materialize
from bookflow.sources import delimited as dx

#: Where a record may go on: a line from the start of a record, and a line from inside a quoted field.
_INSIDE = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
_ROWS, _BYTES = 20_000, 8 << 20


class Quotes:
    """What a line does to the quote state, for one delimiter: as in ``delimited``, a quote opens a field only at its
    start, "" is a quote, and text behind the closing quote stays."""

    def __init__(self, delimiter: str):
        d = re.escape(delimiter).encode()
        text = rb"[^" + d + rb"]*+"
        field = rb' *+(?:"[^"]*+(?:""[^"]*+)*+"' + text + rb'|(?!")' + text + rb")"
        self.delimiter = delimiter.encode()
        self.open_at_end = re.compile(rb"(?:" + field + d + rb')*+ *+"[^"]*+(?:""[^"]*+)*+\Z')

    def opens(self, line: bytes, start: int = 0) -> bool:
        """A line that begins a field at ``start`` ends inside quotes."""
        return self.open_at_end.match(line, start) is not None

    def stays_open(self, line: bytes) -> bool:
        """A line that begins inside quotes ends inside quotes."""
        end = _INSIDE.match(line).end()
        if end == len(line):
            return True
        following = line.find(self.delimiter, end + 1)
        return following >= 0 and self.opens(line, following + 1)


ALL_QUOTES = [Quotes(d) for d in dx.DELIMITERS]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_path, block, line (bytes without the line end) in the order of the file within a block."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), F.col("value")
    )


def _runs(batch: pa.RecordBatch):
    """(file_path, block, slice) of the stretches of one block in a batch."""
    if batch.num_rows:
        key = pc.binary_join_element_wise(batch.column(0), batch.column(1).cast(pa.string()), "\n")
        ends = [*(i + 1 for i in pc.indices_nonzero(pc.not_equal(key[1:], key[:-1])).to_pylist()), batch.num_rows]
        start = 0
        for end in ends:
            yield batch.column(0)[start].as_py(), batch.column(1)[start].as_py(), batch.slice(start, end - start)
            start = end


SCAN = (
    "file_path string, block bigint, lines bigint, invalid boolean, beyond_ascii boolean, undefined boolean, head binary, tops array<binary>, "
    "closed array<boolean>, ends array<boolean>, starts array<bigint>"
)


class _Block:
    """One block's effect: for each delimiter and either state at its start, the state at its end and the records begun."""

    def __init__(self, first: bool, sample: int):
        self.lines, self.flags = 0, [False, False, False]
        self.ends = [s == 1 for _ in ALL_QUOTES for s in (0, 1)]
        self.starts = [0] * len(self.ends)
        self.sample, self.head, self.size = sample if first else 0, [], 0
        self.tops = [[] for _ in ALL_QUOTES] if first else None
        self.closed = [False] * len(ALL_QUOTES)

    def take(self, part: pa.RecordBatch) -> None:
        lines, quoted = part.column(2), pc.match_substring(part.column(2), b'"')
        for k in range(3):
            self.flags[k] = self.flags[k] or bool(pc.any(part.column(3 + k)).as_py())
        if self.sample > self.size or self.tops and not all(self.closed):
            for line in lines:
                line = line.as_py()
                if self.sample > self.size:
                    self.head.append(line)
                    self.size += len(line) + 1
                for d, quotes in enumerate(ALL_QUOTES):
                    if not self.closed[d]:
                        inside = quotes.stays_open(line) if self.tops[d] else quotes.opens(line)
                        self.tops[d].append(line)
                        self.closed[d] = not inside
                if self.size >= self.sample and all(self.closed):
                    break
        before = 0
        for at in pc.indices_nonzero(quoted).to_pylist():
            line, plain = lines[at].as_py(), at - before
            for k in range(len(self.ends)):
                quotes = ALL_QUOTES[k // 2]
                if self.ends[k]:
                    self.ends[k] = quotes.stays_open(line)
                else:
                    self.starts[k] += plain + 1
                    self.ends[k] = quotes.opens(line)
            before = at + 1
        for k, inside in enumerate(self.ends):
            self.starts[k] += 0 if inside else len(lines) - before
        self.lines += len(lines)

    def row(self, file_path: str, block: int) -> dict:
        first = self.tops is not None
        return {
            "file_path": file_path, "block": block, "lines": self.lines, "invalid": self.flags[0], "beyond_ascii": self.flags[1],
            "undefined": self.flags[2], "head": b"\n".join(self.head) if first else None,
            "tops": [b"\n".join(t) for t in self.tops] if first else None, "closed": self.closed if first else None,
            "ends": self.ends, "starts": self.starts,
        }


_SCAN = pa.schema([
    ("file_path", pa.string()), ("block", pa.int64()), ("lines", pa.int64()), ("invalid", pa.bool_()), ("beyond_ascii", pa.bool_()),
    ("undefined", pa.bool_()), ("head", pa.binary()), ("tops", pa.list_(pa.binary())), ("closed", pa.list_(pa.bool_())),
    ("ends", pa.list_(pa.bool_())), ("starts", pa.list_(pa.int64())),
])


def scan_blocks(spark: SparkSession, paths: list[str], options: Options = DEFAULTS) -> DataFrame:
    """A row per block of each file, see SCAN: what encoding, delimiter, header and the prefix scan need."""
    value = F.col("value")
    latin = F.decode(value.cast("binary"), "ISO-8859-1")
    valid = F.is_valid_utf8(value)
    lines = _lines(spark, paths).select(
        "file_path", "block", value.cast("binary").alias("line"), (~valid).alias("invalid"),
        (~valid | (F.octet_length(value) != F.char_length(value))).alias("beyond_ascii"),
        (~valid & latin.rlike(dx.CP1252_UNDEFINED)).alias("undefined"),
    )
    sample = 4 * options.delimiter_sample_chars

    def scan(batches):
        name, held = None, None
        for batch in batches:
            for path, block, part in _runs(batch):
                if (path, block) != name:
                    if held is not None:
                        yield pa.RecordBatch.from_pylist([held.row(*name)], _SCAN)
                    name, held = (path, block), _Block(block == 0, sample)
                held.take(part)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row(*name)], _SCAN)

    return lines.mapInArrow(scan, SCAN)


def _files(blocks: DataFrame) -> DataFrame:
    """file_path (as the line reader gives it), path (as the file listing does), marked: the file begins with a byte-order
    mark, which the line reader takes off. Three bytes are read of each file; large files are few."""
    spark = blocks.sparkSession
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for row in blocks.select("file_path").distinct().toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file_path"]))
        stream = path.getFileSystem(conf).open(path)
        try:
            found.append((row["file_path"], path.toString(), [stream.read() for _ in range(3)] == [0xEF, 0xBB, 0xBF]))
        finally:
            stream.close()
    return spark.createDataFrame(found, "file_path string, path string, marked boolean")


def _file_facts(blocks: DataFrame, files: DataFrame, options: Options) -> DataFrame:
    """file_path, path, encoding, encoding_confidence, decoder, delimiter, d, headers, places, error."""
    first = lambda name: F.first(name, ignorenulls=True).alias(name)
    facts = blocks.groupBy("file_path").agg(
        F.bool_or("invalid").alias("invalid"), F.bool_or("beyond_ascii").alias("beyond_ascii"), F.bool_or("undefined").alias("undefined"),
        first("head"), first("tops"), first("closed"), F.count("*").alias("blocks"),
    )
    facts = facts.join(files, "file_path")
    decoder = F.when(~F.col("invalid"), "utf-8").when(~F.col("undefined"), "cp1252").otherwise("latin-1")
    kinds = [(F.col("marked"), "utf-8-sig", 1.0), (~F.col("beyond_ascii"), "utf-8", 1.0), (~F.col("invalid"), "utf-8", 0.99), (F.lit(True), "cp1252", 0.73)]
    verdict = None
    for condition, encoding, confidence in kinds:
        reported = encoding if confidence >= options.encoding_min_confidence else "utf-8-sig"
        value = F.struct(F.lit(reported).alias("encoding"), F.lit(confidence).alias("confidence"))
        verdict = F.when(condition, value) if verdict is None else verdict.when(condition, value)
    facts = facts.withColumn("decoder", decoder).withColumn("detected", verdict)
    facts = facts.withColumn("delimiter", dx.detect_delimiter(dx.decode_with_fallback(F.col("head"), F.col("decoder")), options))
    facts = facts.withColumn("d", (F.array_position(F.array(*map(F.lit, dx.DELIMITERS)), F.col("delimiter")) - 1).cast("int"))
    facts = facts.withColumn("top", dx.decode_with_fallback(F.get("tops", F.col("d")), F.col("decoder")))
    headers = F.when(F.col("top") == "", F.array().cast("array<string>")).otherwise(F.transform(dx.split_fields(F.col("top"), F.col("delimiter")), strip))
    endless = ~F.get("closed", F.col("d")) & (F.col("blocks") > 1)
    return facts.withColumn("headers", headers).select(
        "file_path", "path", F.col("detected.encoding").alias("encoding"), F.col("detected.confidence").alias("encoding_confidence"), "decoder", "delimiter",
        "d", "headers", F.map_values(dx._last_places(F.col("headers"))).alias("places"),
        F.when(endless, F.lit("the header record does not end in the first split")).alias("error"),
    )


def block_states(blocks: DataFrame, facts: DataFrame) -> DataFrame:
    """file_path, block, d, start_in (the block starts inside quotes), begun (records begun before it).

    A block leaves the state as it is, turns it around, or sets it; the state at its start is the one last set,
    turned around as often as blocks since then do.
    """
    own = blocks.join(facts.filter("error IS NULL").select("file_path", "d"), "file_path")
    pick = lambda name, s: F.get(name, F.col("d") * 2 + s)
    own = own.select("file_path", "block", "d", pick("ends", 0).alias("e0"), pick("ends", 1).alias("e1"), pick("starts", 0).alias("n0"), pick("starts", 1).alias("n1"))
    order = Window.partitionBy("file_path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("turns", F.sum((F.col("e0") & ~F.col("e1")).cast("int")).over(order))
    fixed = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("state"), F.col("turns").alias("turns")))
    own = own.withColumn("fixed", fixed).withColumn("last", F.last("fixed", ignorenulls=True).over(before))
    turned = F.coalesce(F.lag("turns").over(order), F.lit(0)) - F.coalesce(F.col("last.turns"), F.lit(0))
    own = own.withColumn("start_in", F.coalesce(F.col("last.state"), F.lit(False)) != (turned % 2 == 1))
    n = F.when(F.col("start_in"), F.col("n1")).otherwise(F.col("n0"))
    return own.withColumn("begun", F.coalesce(F.sum(n).over(before), F.lit(0))).select("file_path", "block", "d", "start_in", "begun")


WHOLE, PIECE = 0, 1


def _cut(batches):
    """file_path, block, kind, number, text: the records of each block, and the pieces of those that cross its ends."""
    rows, size = [], 0

    def out():
        columns = zip(*rows)
        kinds = [pa.string(), pa.int64(), pa.int8(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["file_path", "block", "kind", "number", "text"])

    name, number, held, crossing, quotes = None, 0, [], False, None
    for batch in batches:
        for path, block, part in _runs(batch):
            if (path, block) != name:
                if held:
                    rows.append((*name, PIECE, number, b"\n".join(held)))
                name, held = (path, block), []
                quotes, crossing = ALL_QUOTES[part.column("d")[0].as_py()], part.column("start_in")[0].as_py()
                number = part.column("begun")[0].as_py()
            lines = part.column("line")
            for line, quoted in zip(lines.to_pylist(), pc.match_substring(lines, b'"').to_pylist()):
                if held or crossing:
                    held.append(line)
                    if quoted and not quotes.stays_open(line):
                        rows.append((path, block, PIECE if crossing else WHOLE, number, b"\n".join(held)))
                        held, crossing = [], False
                else:
                    number += 1
                    if quoted and quotes.opens(line):
                        held = [line]
                    else:
                        rows.append((path, block, WHOLE, number, line))
                size += len(line)
                if len(rows) >= _ROWS or size >= _BYTES and rows:
                    yield out()
                    rows, size = [], 0
    if held:
        rows.append((*name, PIECE, number, b"\n".join(held)))
    if rows:
        yield out()


@dataclass
class LargeFiles:
    """``rows`` with the columns of ``delimited.explode_all`` (file_path, as the file listing has it, for the file's
    columns), without rows for files that have none; ``meta`` per file with the metadata columns and headers; ``failed`` files (file_path, error)."""

    rows: DataFrame
    meta: DataFrame
    failed: DataFrame


def _records(cut: DataFrame, facts: DataFrame) -> DataFrame:
    """Cut records with values and overflow, as ``delimited`` makes them; the pieces keep their text."""
    width = F.size("headers")
    line = dx.decode_with_fallback(F.col("text"), F.col("decoder"))
    fields = let(
        line,
        lambda text: let(
            dx.split_fields(text, F.col("delimiter")),
            lambda found: F.struct(
                F.transform("places", lambda place: strip(F.get(found, place))).alias("values"),
                F.when(text == "", F.array().cast("array<string>")).otherwise(F.slice(found, width + 1, F.size(found))).alias("overflow"),
            ),
        ),
    )
    sound = facts.filter("error IS NULL").select("file_path", "decoder", "delimiter", "headers", "places")
    return cut.join(F.broadcast(sound), "file_path").withColumn("record", F.when(F.col("kind") == WHOLE, fields))


def _is_kept(number: Column, record: Column) -> Column:
    return (number > 1) & ~dx.is_blank_row(record) & ~dx.is_summary_row(record)


def parse_large(spark: SparkSession, paths: list[str], folder: str | None = None, options: Options = DEFAULTS) -> LargeFiles:
    """Delimited files of any size, each over as many tasks as it has splits. ``folder`` as for ``materialize``.

    Records, numbers, header rules, encodings and delimiters are those of ``delimited``; the encoding looks at all bytes.
    A file whose header record does not end in its first split is reported as failed. Lines end with \\n, \\r\\n or \\r.

    Lines and records never leave the order in which their split is read: they meet only relations with a row per file
    or per split, which are broadcast, so nothing is sorted and no task holds the rows of a split.
    """
    blocks = materialize(scan_blocks(spark, paths, options), folder)
    facts = materialize(_file_facts(blocks, _files(blocks), options), folder)
    states = materialize(block_states(blocks, facts), folder)
    lines = _lines(spark, paths).select("file_path", "block", F.col("value").cast("binary").alias("line"))
    met = lines.join(F.broadcast(states), ["file_path", "block"])
    cut = met.select("file_path", "block", "line", "d", "start_in", "begun").mapInArrow(
        _cut, "file_path string, block bigint, kind tinyint, number bigint, text binary"
    )
    parsed = _records(cut, facts).filter((F.col("kind") == PIECE) | _is_kept(F.col("number"), F.col("record")))
    # Numbers within a task follow the order of the file, and pieces are the first and the last of a block: what is kept
    # of a block is counted through by their difference.
    parsed = parsed.withColumn("at", F.monotonically_increasing_id())
    parsed = materialize(
        parsed.select("file_path", "block", "kind", "number", "at", "record", F.when(F.col("kind") == PIECE, F.col("text")).alias("text")), folder
    )
    pieces = parsed.filter(F.col("kind") == PIECE).groupBy("file_path", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "text"))).alias("pieces")
    )
    joined = pieces.select(
        "file_path", F.col("pieces")[0]["block"].alias("block"), F.lit(WHOLE).alias("kind"), "number",
        F.expr(r"aggregate(slice(pieces, 2, size(pieces)), pieces[0].text, (a, p) -> concat(a, X'0A', p.text))").alias("text"),
    )
    crossing = _records(joined, facts).filter(_is_kept(F.col("number"), F.col("record"))).select("file_path", "block", F.lit(1).alias("last"), "number", F.lit(0).cast("bigint").alias("at"), "record")
    whole = parsed.filter(F.col("kind") == WHOLE).select("file_path", "block", F.lit(0).alias("last"), "number", "at", "record")
    rows = whole.unionByName(crossing)
    # The record that crosses a block's end is its last one.
    place = ["file_path", "block", "last"]
    counted = rows.groupBy(*place).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file_path").orderBy("block", "last").rowsBetween(Window.unboundedPreceding, -1)
    counted = materialize(counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), folder)
    total = counted.groupBy("file_path").agg(F.sum("n").cast("int").alias("total_rows"))
    known = facts.filter("error IS NULL").join(total, "file_path", "left")
    meta = known.select(
        F.col("path").alias("file_path"), "encoding", "encoding_confidence", "delimiter", F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.size("headers").alias("total_cols"), F.lit(dx.PARSE_METHOD).alias("parse_method"), "headers",
    )
    numbered = rows.join(F.broadcast(counted), place).withColumn("source_row_number", F.col("base") + F.col("at") - F.col("first") + 1)
    named = known.select("file_path", "path")
    numbered = numbered.select("file_path", "number", "record", "source_row_number").join(F.broadcast(named), "file_path").drop("file_path")
    exploded = numbered.withColumnRenamed("path", "file_path").join(F.broadcast(meta), "file_path").select(
        *meta.columns, "source_row_number", F.col("number").alias("source_record_number"),
        F.map_from_arrays(F.array_distinct("headers"), "record.values").alias("raw"), F.col("record.overflow").alias("overflow"),
    )
    return LargeFiles(exploded, meta, facts.filter("error IS NOT NULL").select(F.col("path").alias("file_path"), "error"))
