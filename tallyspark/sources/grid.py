"""Statement folder scan -> GRID ``(file, row_no, cells array<string>)`` (A1-A3).

One scan of the raw lines of every file; all the rest is SQL over them.

* **Splittable, quoted newlines included.**  Whether a line begins inside a
  quoted cell depends on all lines before it.  Every line maps the state
  before it (outside or inside quotes) to the state after it.  These maps are
  composed inside each byte split under both possible starts, then over the
  splits of a file, one row per split.  So a file of any size is read by many
  tasks, and a record may cross lines and splits.
* **No width.**  A row's cells are an array of its own length.
* **UTF-8, else cp1252**, per file, decided by the bytes of its lines.
* **Rejects.**  The folder's listing is a table; files that are of another
  format, empty, not decodable, only partly readable, or end inside quotes
  come back as ``(file, reason)`` and give no rows.
* Cells the reference CSV reader treats as missing become NULL; blank lines
  are no rows.  ``row_no`` numbers a file's records from 0.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.clean import NA_TOKENS
from tallyspark.operators.common import checkpointed, sized_broadcast, stored
from tallyspark.session import ensure_session_defaults

# A quoted cell and what follows its closing quote, up to the next comma.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_CELL = rf'(?:{_QUOTED}|[^",][^,]*+|)'
# a line that leaves no quote open, from outside and from inside quotes
_CLOSED = rf"^(?:,{_CELL})*+\z"
_CLOSING = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{_CELL})*+\z'
# the bytes that cp1252 leaves undefined, read as ISO-8859-1
_UNDEFINED = "[\u0081\u008d\u008f\u0090\u009d]"

NOT_A_FORMAT = "format not supported"
EMPTY = "empty file"
UNDECODABLE = "text is neither UTF-8 nor cp1252"
OPEN_QUOTE = "quoted cell not closed"
UNREADABLE = "file only partly readable"


def decoded(path):
    """The plain name of a file: ``_metadata`` has it URL-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_paths(paths: list[str]) -> list[str]:
    """Paths to be read as they are, without glob characters."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(file, length) of every file under ``path``; contents are not read."""
    # a drop folder is a set of files: list sub-folders, infer no partitions
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    found = r.load(path)
    # a scan leaves out empty files, the index has their names too
    name = F.regexp_replace("name", r"^(\w+):///", "$1:/")  # written as the scan writes it
    names = spark.createDataFrame([(n,) for n in found.inputFiles()], "name string").select(decoded(name).alias("file"))
    sizes = found.select(decoded(F.col("_metadata.file_path")).alias("file"), "length")
    return names.join(sizes, "file", "left").select("file", F.coalesce("length", F.lit(0)).alias("length"))


def raw_lines(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """(file, split, pos, sub, raw, sep): lines in the order of the file.
    ``raw`` are its bytes, ``sep`` the newline that ended it (LF, CR LF, CR)."""
    r = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").option("ignoreCorruptFiles", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    lines = r.text(path).select(
        decoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    crlf = F.col("value").endswith("\r")
    body = F.when(crlf, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    pieces = F.when(F.contains(body, F.lit("\r")), F.split(body, "\r")).otherwise(F.array(body))
    # bytes that are not UTF-8 survive only while no text function touches them
    whole = F.is_valid_utf8("value")
    bytes_ = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    crlf_b = bytes_.endswith("\r")
    body_b = F.when(crlf_b, F.expr("left(decode(cast(value as binary), 'ISO-8859-1'), length(decode(cast(value as binary), 'ISO-8859-1')) - 1)")).otherwise(bytes_)
    pieces_b = F.when(F.contains(body_b, F.lit("\r")), F.split(body_b, "\r")).otherwise(F.array(body_b))
    out = lines.select(
        "file", "split", "pos", whole.alias("utf8"), F.when(whole, crlf).otherwise(crlf_b).alias("crlf"),
        F.octet_length("value").alias("size"),
        F.when(whole, pieces).otherwise(pieces_b).alias("pieces"),
    )
    out = out.select("*", F.posexplode("pieces").alias("sub", "text"))
    sep = F.when(F.col("sub") < F.size("pieces") - 1, F.lit("\r")).when(F.col("crlf"), F.lit("\r\n")).otherwise(F.lit("\n"))
    return out.select("file", "split", "pos", "sub", "text", "utf8", F.when(F.col("sub") == 0, F.col("size") + 1).otherwise(0).alias("size"), sep.alias("sep"))


def _state_before(part: list[str], order: list[str], f0: str, f1: str) -> tuple[Column, Column]:
    """State before each row (0 outside, 1 inside quotes) where the part
    begins outside, and where it begins inside.  ``f0`` and ``f1`` are the
    states after a row that begins outside or inside: such a map resets the
    state, keeps it, or flips it."""
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum((F.col(f0) > F.col(f1)).cast("int")).over(before), F.lit(0))
    # the last reset, and the flips before it
    reset = F.last(F.when(F.col(f0) == F.col(f1), F.col(f0)), ignorenulls=True).over(before)
    return flips.alias("flips"), reset.alias("reset")


def _with_states(df: DataFrame, part: list[str], order: list[str], f0: str, f1: str) -> DataFrame:
    """``df`` with ``s0`` and ``s1``: the state before each row."""
    flips, reset = _state_before(part, order, f0, f1)
    df = df.select("*", flips, reset)
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at_reset = F.last(F.when(F.col(f0) == F.col(f1), F.col("flips")), ignorenulls=True).over(before)
    df = df.withColumn("_at", at_reset)
    since = F.when(F.col("reset").isNull(), F.col("flips")).otherwise(F.col("flips") - F.col("_at") + F.col("reset"))
    return df.withColumn("s0", F.pmod(since, F.lit(2))).withColumn(
        "s1", F.when(F.col("reset").isNull(), F.pmod(since + 1, F.lit(2))).otherwise(F.col("s0"))).drop("flips", "reset", "_at")


def _after(state: Column) -> Column:
    return F.when(state == 0, F.col("f0")).otherwise(F.col("f1"))


def cells_of(record: Column) -> Column:
    """Cells of a CSV record: a cell that begins with a quote is quoted, its
    inner quotes doubled; any other quote is text."""
    plain = F.split(record, ",")
    fields = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(rf",({_QUOTED}|[^,]*+)"), F.lit(1))
    inner = r'^"([^"]*+(?:""[^"]*+)*+)"'
    quoted = F.transform(fields, lambda x: F.when(
        x.startswith('"'),
        F.concat(F.replace(F.regexp_extract(x, inner, 1), F.lit('""'), F.lit('"')), F.regexp_replace(x, inner, "")),
    ).otherwise(x))
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(plain)


def scan_folder(spark: SparkSession, path: str | list[str], glob: str | None = "*.csv",
                fallback_encoding: str | None = "windows-1252") -> tuple[DataFrame, DataFrame]:
    """GRID rows of the files that ``glob`` names, and (file, reason) of every
    file under ``path`` that gives none."""
    ensure_session_defaults(spark)
    listing = checkpointed(list_files(spark, path))  # one row per file
    wanted = listing if glob is None else checkpointed(list_files(spark, path, glob))
    lines = raw_lines(spark, path, glob)
    # The states of quotes before and after a line; most lines have no quote.
    text = F.col("text")
    quotes = F.contains(text, F.lit('"'))
    lines = lines.withColumn("f0", F.when(quotes & ~F.concat(F.lit(","), text).rlike(_CLOSED), 1).otherwise(0)) \
        .withColumn("f1", F.when(quotes & text.rlike(_CLOSING), 0).otherwise(1))
    part, order = ["file", "split"], ["pos", "sub"]
    lines = _with_states(lines, part, order, "f0", "f1")
    blank = F.trim(F.replace(text, F.lit("\t"), F.lit(" "))) == ""
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for k in (0, 1):
        begins = ((F.col(f"s{k}") == 0) & ~blank).cast("int")
        lines = lines.withColumn(f"n{k}", F.sum(begins).over(upto))
    lines = stored(lines.withColumn("blank", blank), "lines")

    place = F.struct("pos", "sub")
    as_bytes = F.when(F.col("utf8"), F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")).otherwise(text)
    undefined = (~F.col("utf8") | (F.octet_length(text) > F.length(text))) & as_bytes.rlike(_UNDEFINED)
    splits = lines.groupBy(*part).agg(
        F.max_by(_after(F.col("s0")), place).alias("f0"), F.max_by(_after(F.col("s1")), place).alias("f1"),
        F.max("n0").alias("n0"), F.max("n1").alias("n1"), F.sum("size").alias("size"),
        F.min("utf8").alias("utf8"), F.max(undefined).alias("undefined"))
    splits = _with_states(splits, ["file"], ["split"], "f0", "f1")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("s0") == 0, F.col("n0")).otherwise(F.col("n1"))
    splits = checkpointed(splits.select(
        *part, F.col("s0").alias("state"), _after(F.col("s0")).alias("ends"), own.alias("n"), "size", "utf8", "undefined",
        F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias("off")))

    files = splits.groupBy("file").agg(
        F.sum("n").alias("n"), F.max_by("ends", "split").alias("ends"), F.min("utf8").alias("utf8"),
        F.max("undefined").alias("undefined"), F.sum("size").alias("size"))
    told = wanted.join(files, "file", "left")
    decodable = F.col("utf8") | (F.lit(fallback_encoding is not None) & ~F.col("undefined"))
    reason = (
        F.when(F.col("length") == 0, EMPTY)
        # the last line may lack its newline, the reader leaves out a byte order mark
        .when(F.col("size").isNull() | (F.col("size") + 3 < F.col("length")), UNREADABLE)
        .when(~decodable, UNDECODABLE)
        .when(F.col("ends") == 1, OPEN_QUOTE)
        .when(F.col("n") == 0, EMPTY)
    )
    told = checkpointed(told.select("file", "utf8", reason.alias("reason")))
    rejects = told.where("reason IS NOT NULL").select("file", "reason")
    if glob is not None:
        rejects = rejects.unionByName(
            listing.join(wanted.select("file"), "file", "left_anti").select("file", F.lit(NOT_A_FORMAT).alias("reason")))

    # one row per split, behind a size check: the lines are not shuffled again
    good = splits.drop("utf8").join(told.where("reason IS NULL").select("file", F.col("utf8").alias("file_utf8")), "file")
    good = checkpointed(good.select(*part, "state", "off", "file_utf8"))
    rows = lines.join(sized_broadcast(good), part)
    outside = F.col("state") == 0
    rows = rows.withColumn("s", F.when(outside, F.col("s0")).otherwise(F.col("s1")))
    rows = rows.where(~(F.col("blank") & (F.col("s") == 0)))
    # a line of valid UTF-8 in a cp1252 file, and the bytes of the others
    latin = F.when(F.col("utf8"), F.decode(F.encode(text, "UTF-8"), fallback_encoding or "UTF-8")).otherwise(
        F.decode(F.encode(text, "ISO-8859-1"), fallback_encoding or "ISO-8859-1"))
    rows = rows.select(
        "file", (F.col("off") + F.when(outside, F.col("n0")).otherwise(F.col("n1")) - 1).alias("row_no"),
        "split", "pos", "sub", "sep", F.when(F.col("file_utf8"), text).otherwise(latin).alias("text"),
        ((F.col("s") == 1) | (_after(F.col("s")) == 1)).alias("shared"))
    one = rows.where(~F.col("shared")).select("file", "row_no", "text")
    # records of several lines: a newline inside quotes stays what it was
    several = rows.where("shared").groupBy("file", "row_no").agg(F.sort_array(F.collect_list(F.struct("split", "pos", "sub", "text", "sep"))).alias("l"))
    several = several.select("file", "row_no", F.concat(
        F.array_join(F.transform(F.slice("l", F.lit(1), F.size("l") - 1), lambda x: F.concat(x["text"], x["sep"])), ""),
        F.element_at("l", -1)["text"]).alias("text"))
    records = one.unionByName(several)
    # a byte order mark is no text
    record = F.when((F.col("row_no") == 0) & text.startswith("﻿"), F.expr("substring(text, 2)")).otherwise(text)
    cells = F.transform(cells_of(F.col("record")), lambda x: F.when(x.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(x))
    grid = records.withColumn("record", record).select("file", "row_no", cells.alias("cells"))
    return grid, rejects


def grid_scan(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = "*.csv",
    fallback_encoding: str | None = "windows-1252",
    checkpoint: bool = True,
) -> DataFrame:
    """GRID rows of a folder (or list) of statement CSV files."""
    grid, _ = scan_folder(spark, path, glob, fallback_encoding)
    return stored(grid, "grid") if checkpoint else grid


def row_texts(grid: DataFrame) -> DataFrame:
    """(file, row_no, line): every row as text, cells joined by a blank.
    Empty cells at a row's end add nothing."""
    line = F.rtrim(F.array_join(F.transform("cells", lambda x: F.coalesce(x, F.lit(""))), " "))
    return grid.select("file", "row_no", line.alias("line"))


def file_text(grid: DataFrame, num_chars: int | None = 400) -> DataFrame:
    """The first ``num_chars`` characters of each file as text (None: all of
    it): its ``row_texts`` joined by newlines."""
    head = row_texts(grid)
    if num_chars is not None:
        # a row adds its newline at least, so row k starts at character k or later
        head = head.where(F.col("row_no") < num_chars).withColumn("line", F.substring("line", 1, num_chars))
    text = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("row_no", "line"))), lambda s: s["line"]),
        "\n",
    )
    if num_chars is not None:
        text = F.substring(text, 1, num_chars)
    return head.groupBy("file").agg(text.alias("text"))
