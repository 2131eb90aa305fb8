"""Reading of quoted CSV files in parallel, whatever their size or number.

A quoted field may hold line breaks, so a byte range of a file can't tell by
itself whether it begins inside a field; Spark's ``multiLine`` reader therefore
makes each file one task.  Here a first scan reads the files as plain lines, in
as many tasks as their bytes ask for, and returns one row per range: the header
line and whether every line is a record of its own.

* Files whose lines all are go to Spark's CSV reader without ``multiLine``,
  which splits them by itself.
* The others are read as lines once more.  A task numbers the lines of each of its ranges
  and keeps, for both possible states at the range's begin, where the last record
  began.  A quote flips the state (a doubled one twice), so the ranges' parities,
  summed up in the order of a file, settle the state of each; a line that begins
  outside quotes begins a record.  Lines that are whole records go on as they
  are; those of longer records, also across ranges, are put together by record.
  Spark's own parser then takes each record apart.  The numbered lines are
  written to the shared scratch folder first, because the ranges of a scan
  belong to that scan alone.

Headers are grouped by Spark: the driver sees the distinct ones and the names of
their files, and opens no file.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refinery.session import scratch_dir, ship_package

#: distinct headers that one reading accepts
MOST_HEADERS = 1000
LINE_SCHEMA = "path string, block bigint, no bigint, inside boolean, odd boolean, began_out bigint, began_in bigint, line string"
PARSE = {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}


class _Range:
    """State of one range while its lines pass: lines so far, parity since its begin, last record begins."""

    def __init__(self, key):
        self.key, self.no, self.parity, self.out, self.into = key, 0, 0, -1, -1

    def mark(self, text: pa.Array) -> list:
        odd = pc.count_substring(text, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
        after = (self.parity + np.cumsum(odd)) & 1
        inside = after ^ odd
        at = self.no + np.arange(len(odd))
        out = np.maximum(np.maximum.accumulate(np.where(inside == 0, at, -1)), self.out)
        into = np.maximum(np.maximum.accumulate(np.where(inside == 1, at, -1)), self.into)
        self.no, self.parity, self.out, self.into = self.no + len(odd), int(after[-1]), int(out[-1]), int(into[-1])
        return [pa.array(x) for x in (at, inside == 1, odd == 1, out, into)]


def _by_range(batch: pa.RecordBatch):
    """((path, block), lines) of each stretch of a batch that comes from one range."""
    if not batch.num_rows:
        return
    path, block, line = (batch.column(i) for i in range(3))
    names = path.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(names) != 0) | (np.diff(block.to_numpy()) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield (path[a].as_py(), block[a].as_py()), line.slice(a, b - a)


def numbered_lines(batches):
    """Arrow batches of (path, block, line) in file order -> those of :data:`LINE_SCHEMA`."""
    state = None
    names = [c.split()[0] for c in LINE_SCHEMA.split(", ")]
    for batch in batches:
        for key, line in _by_range(batch):
            if state is None or state.key != key:
                state = _Range(key)
            no, inside, odd, out, into = state.mark(line)
            path, block = pa.array([key[0]] * len(line), pa.string()), pa.array([key[1]] * len(line), pa.int64())
            yield pa.RecordBatch.from_arrays([path, block, no, inside, odd, out, into, line], names)


def surveyed_lines(batches):
    """Arrow batches of (path, block, line) in file order -> one (path, first, tricky) for each range.

    ``first`` is the file's first line (null in later ranges).  Tricky is a range with a line that is no record of
    its own: an odd number of quotes, a carriage return inside, or nothing but white space.
    """
    state, first, tricky, out = None, None, False, []
    for batch in batches:
        for key, line in _by_range(batch):
            if key != state:
                if state is not None:
                    out.append((state[0], first, tricky))
                state, tricky = key, False
                first = line[0].as_py() if key[1] == 0 else None
            if not tricky:
                text = pc.utf8_rtrim(line, "\r")
                odd = pc.bit_wise_and(pc.count_substring(text, '"'), 1)
                bare = pc.and_(pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(text)), 0), pc.not_equal(text, ""))
                found = pc.or_(pc.or_(pc.equal(odd, 1), pc.match_substring(text, "\r")), bare)
                tricky = bool(pc.any(found).as_py())
    if state is not None:
        out.append((state[0], first, tricky))
    yield pa.RecordBatch.from_pydict({"path": pa.array([r[0] for r in out], pa.string()),
                                      "first": pa.array([r[1] for r in out], pa.string()),
                                      "tricky": pa.array([r[2] for r in out], pa.bool_())})


def _source(text: DataFrame) -> DataFrame:
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").alias("line"))


def survey(spark: SparkSession, path: str, glob: str | None = None, exclude: str | None = None,
           partition: str | None = None, value: str | None = None) -> DataFrame:
    """``path``, ``first`` and ``tricky`` of every matching file that has a line.

    ``partition`` names a partition column (``value``: only that one's files are read).
    """
    ship_package(spark)
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if partition:
        reader = reader.schema(f"value string, `{partition}` string")
    text = reader.text(path)
    if value is not None:
        text = text.where(F.col(partition) == value)
    if exclude:
        text = text.where(~F.contains(F.col("_metadata.file_name"), F.lit(exclude)))
    each = _source(text).mapInArrow(surveyed_lines, "path string, first string, tricky boolean")
    return each.groupBy("path").agg(F.max("first").alias("first"), F.bool_or("tricky").alias("tricky"))


def line_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The numbered lines of the files, written to the scratch folder and read back."""
    ship_package(spark)
    out = scratch_dir(spark, "csv-lines")
    text = spark.read.option("lineSep", "\n").text(paths)
    _source(text).mapInArrow(numbered_lines, LINE_SCHEMA).write.mode("overwrite").parquet(out)
    return spark.read.schema(LINE_SCHEMA).parquet(out)


def _joined(line: Column) -> Column:
    """The text of a record from its collected (block, no, line) structs."""
    return F.array_join(F.transform(F.sort_array(line), lambda x: x["line"]), "\n")


def ranges(lines: DataFrame) -> DataFrame:
    """One row per range: ``path``, ``block``, ``entered`` (begins inside quotes), the record that its first lines
    go on with (``from_block``, ``from_no``) and the file's ``header`` text.  Its size is that of the list of ranges."""
    each = lines.groupBy("path", "block").agg(F.bit_xor(F.col("odd").cast("int")).alias("parity"),
                                              F.max("began_out").alias("out"), F.max("began_in").alias("into"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("entered", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
    own = F.when(F.col("entered"), F.col("into")).otherwise(F.col("out"))
    each = each.withColumn("own", F.when(own >= 0, F.struct("block", own.alias("no"))))
    each = each.withColumn("from", F.last("own", ignorenulls=True).over(before))
    first = lines.where((F.col("block") == 0) & (F.col("began_out") == 0))
    heads = first.groupBy("path").agg(_joined(F.collect_list(F.struct("block", "no", "line"))).alias("header"))
    return each.join(heads, "path", "left").select(
        "path", "block", "entered", F.col("from.block").alias("from_block"), F.col("from.no").alias("from_no"), "header")


def records(lines: DataFrame, known: DataFrame) -> DataFrame:
    """``path``, ``header`` and ``record`` of every record after the header, line breaks kept; empty lines are left out."""
    own = F.when(F.col("entered"), F.col("began_in")).otherwise(F.col("began_out"))
    met = lines.join(known, ["path", "block"]).select(
        "path", "header", "block", "no", "line", (F.col("inside") != F.col("entered")).alias("goes_on"), "odd",
        F.when(own >= 0, F.col("block")).otherwise(F.col("from_block")).alias("rec_block"),
        F.when(own >= 0, own).otherwise(F.col("from_no")).alias("rec_no"))
    met = met.where(~((F.col("rec_block") == 0) & (F.col("rec_no") == 0)))  # the header
    whole = ~F.col("goes_on") & ~F.col("odd")
    ones = met.where(whole).select("path", "header", F.col("line").alias("record"))
    longer = (met.where(~whole).groupBy("path", "header", "rec_block", "rec_no")
              .agg(_joined(F.collect_list(F.struct("block", "no", "line"))).alias("record")).select("path", "header", "record"))
    out = ones.unionByName(longer).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return out.where("record <> ''")


def header_names(text: str) -> list[str]:
    """The column names of a header record (a byte order mark before them is left out)."""
    return next(csv.reader([text.removeprefix(chr(0xFEFF)).removesuffix("\r")]), [])


#: columns that a reading adds to the rows of its files
FILE_PATH = "_file_path"


def _unique(names: list[str]) -> list[str]:
    """Names for the columns of a file; of columns with the same name the last one counts, the others get names to drop."""
    return [h if h not in names[i + 1:] else f"_repeated_{i}" for i, h in enumerate(names)]


def _schema(names: list[str]) -> str:
    return ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)


def file_name() -> Column:
    """The name of a row's file."""
    return F.element_at(F.split(F.col(FILE_PATH), "/"), -1)


def _plain(spark: SparkSession, names: list[str], paths: list[str] | str, glob: str | None, exclude: str | None) -> DataFrame:
    unique = _unique(names)
    reader = spark.read.schema(_schema(unique)).options(**PARSE).option("multiLine", "false").option("header", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.csv(paths)
    if exclude:
        rows = rows.where(~F.contains(F.col("_metadata.file_name"), F.lit(exclude)))
    return rows.select(*[F.col("`{}`".format(n.replace("`", "``"))) for n in unique if n in names],
                       F.col("_metadata.file_path").alias(FILE_PATH))


def _tricky(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], DataFrame]]:
    lines = line_table(spark, paths)
    out = scratch_dir(spark, "csv-ranges")
    ranges(lines).write.mode("overwrite").parquet(out)
    known = spark.read.parquet(out)
    texts = known.where("header <> ''").groupBy("header").agg(F.min("path").alias("first")).limit(MOST_HEADERS + 1).collect()
    rows, found = records(lines, known), []
    for names, of in _grouped([(r["header"], r["first"]) for r in texts]):
        unique = _unique(names)
        row = (rows.where(F.col("header").isin([text for text, _ in of]))
               .select("path", F.from_csv("record", F.lit(_schema(unique)), PARSE).alias("_row")))
        cols = [F.col("_row").getField(n).alias(n) for n in unique if n in names]
        found.append((names, row.select(*cols, F.col("path").alias(FILE_PATH))))
    return found


def _grouped(headers: list[tuple[str, object]]) -> list[tuple[list[str], list[tuple[str, object]]]]:
    """(names, those of the (header text, ...) that stand for them)."""
    if len(headers) > MOST_HEADERS:
        raise ValueError(f"over {MOST_HEADERS} different headers")
    found: dict[tuple[str, ...], list] = {}
    for one in headers:
        found.setdefault(tuple(header_names(one[0])), []).append(one)
    return [(list(names), of) for names, of in found.items()]


def read_by_header(spark: SparkSession, path: str, glob: str | None = None, exclude: str | None = None,
                   partition: str | None = None, value: str | None = None) -> list[tuple[list[str], DataFrame]]:
    """(header, rows) for each distinct header among the files: all strings, and the file's path in ``_file_path``.

    Headers come in the order of their files' paths.  Quoted line breaks, doubled quotes, backslashes and line ends
    of either kind are kept as Spark's ``multiLine`` reader does with a doubled quote as escape.  A quote within an
    unquoted field is not valid.  A record has to fit a row.  Files without any line, or with an empty first one, have
    no header and are left out; files with a header only give no rows.
    """
    groups = (survey(spark, path, glob, exclude, partition, value).groupBy("first", "tricky")
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).collect())
    groups = [g for g in groups if g["first"] is not None]
    plain = [(g["first"], g["paths"]) for g in groups if not g["tricky"] and g["first"].removesuffix("\r")]
    parts: list[tuple[str, list[str], DataFrame]] = []
    for names, of in _grouped(plain):
        paths = sorted(p for _, ps in of for p in ps)
        whole = partition is None and len(of) == len(groups)  # all files of the folder: no need to name them
        parts.append((paths[0], names, _plain(spark, names, path, glob, exclude) if whole
                      else _plain(spark, names, paths, None, None)))
    tricky = sorted(p for g in groups if g["tricky"] for p in g["paths"])
    if tricky:
        parts += [(tricky[0], names, rows) for names, rows in _tricky(spark, tricky)]
    out: dict[tuple[str, ...], DataFrame] = {}
    for _, names, rows in sorted(parts, key=lambda p: p[0]):
        key = tuple(names)
        out[key] = out[key].unionByName(rows) if key in out else rows
    return [(list(names), rows) for names, rows in out.items()]
