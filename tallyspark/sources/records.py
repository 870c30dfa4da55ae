"""CSV records of big report files: cells may hold line breaks, and a file is read by many tasks.

Spark splits a text file into byte blocks and gives physical lines.  Whether a line begins a record
depends on the number of quotes before it in the file, so:

* files in which every line has an even number of quotes have no cell with a line break; their lines
  are their records, and nothing is shuffled;
* for the others, quotes are summed within each block, block sums become a prefix over the file's
  blocks (a row per block), and both together tell each line's parity.  A record is named by the
  position of its first line, also where it goes on in the next block; only records of several
  lines are gathered.

A quote inside a cell is doubled, which leaves the parity as it is.  Line ends are ``\\n`` or ``\\r\\n``; within
cells they stay as written.  A quote byte never occurs inside a character of the charsets in use
(UTF-8, cp932), so the parity is taken on bytes.  The lines are written aside once, those of files with
such cells once more.  A file with an unclosed quote, or a record of more than ``MAX_RECORD_BYTES``, is
rejected with that reason: one lost quote would otherwise swallow the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import materialized
from tallyspark.sources import csv_reports as C

MAX_RECORD_BYTES = 16 << 20
#: a position is the number of 4 KB pages before the block, then the line's number in its task
_PAGE_BITS, _LINE_BITS = 12, 33


def physical_lines(spark: SparkSession, paths) -> DataFrame:
    """(path, mtime, size, block, pos, raw) of every physical line; ``pos`` orders the lines of a file (files under 4 TB)."""
    m = F.col("_metadata")
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        m["file_path"].alias("path"), m["file_modification_time"].alias("mtime"), m["file_size"].alias("size"),
        m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    at = F.shiftleft(F.shiftright("block", _PAGE_BITS), _LINE_BITS) + F.col("_id").bitwiseAND(F.lit((1 << _LINE_BITS) - 1))
    return lines.select("path", "mtime", "size", "block", at.alias("pos"), "raw")


def _quotes(raw: Column) -> Column:
    return F.octet_length(raw) - F.octet_length(F.replace(raw, F.lit('"'), F.lit("")))


def _file_facts(lines: DataFrame) -> DataFrame:
    """Per file: its first position, quotes, and whether a line has an odd number of them."""
    return lines.groupBy("path").agg(F.min("pos").alias("first_pos"), F.sum("q").alias("quotes"), F.max(F.col("q") % 2).alias("odd"))


def _record_starts(lines: DataFrame) -> DataFrame:
    """Lines with the position of the record they belong to (``rec``), by quote parity within and across blocks."""
    in_block = Window.partitionBy("path", "block").orderBy("pos")
    before = F.coalesce(F.sum("q").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumn("before", before)
    # what a block adds, for either parity it may begin with
    starts = lines.groupBy("path", "block").agg(
        (F.sum("q") % 2).alias("odd"), *[F.max(F.when(F.col("before") == p, F.col("pos"))).alias(f"last{p}") for p in (0, 1)])
    by_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("carry", F.coalesce(F.sum("odd").over(by_file), F.lit(0)) % 2)
    # a line starts a record if its parity within the block makes the parity in the file even
    starts = starts.withColumn("last", F.when(F.col("carry") == 0, F.col("last0")).otherwise(F.col("last1")))
    starts = starts.select("path", "block", "carry", F.max("last").over(by_file).alias("open_rec"))
    j = lines.join(starts, ["path", "block"])
    begins = F.col("before") == F.col("carry")
    rec = F.max(F.when(begins, F.col("pos"))).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    return j.withColumn("alone", begins & (F.col("q") % 2 == 0)).withColumn("rec", F.coalesce(rec, F.col("open_rec")))


def read_records(spark: SparkSession, paths, encoding: str = "UTF-8", max_bytes: int = MAX_RECORD_BYTES):
    """((path, mtime, size, pos, line) of every record, (path, state, reason) of every non-empty file).

    ``pos`` is 0 for a file's first record and rises with its records; the frame is what the line readers of
    ``csv_reports`` work on, only that a line may hold line breaks within quotes.
    """
    # written once: blocks and positions depend on how one scan splits the files, so no second scan may meet them
    raw = materialized(physical_lines(spark, paths).withColumn("q", _quotes(F.col("raw"))).withColumn("raw", F.col("raw").cast("binary")))
    facts = _file_facts(raw)
    # a row per file: broadcast, so that lines stay where they are read and a big file is not one task's
    whole = F.broadcast(facts.where("odd = 0").select("path", "first_pos"))
    broken = F.broadcast(facts.where("odd = 1 and quotes % 2 = 0").select("path", "first_pos"))

    def text(c):
        return F.decode(c, encoding)

    plain = raw.join(whole, "path").select("path", "mtime", "size", (F.col("pos") - F.col("first_pos")).alias("pos"), text(F.col("raw")).alias("line"))
    marked = materialized(_record_starts(raw.join(broken.select("path"), "path", "left_semi"))
                          .select("path", "mtime", "size", "pos", "rec", "alone", "raw"))
    alone = marked.where("alone").select("path", "mtime", "size", "pos", text(F.col("raw")).alias("line"))
    several = marked.where("not alone")
    too_long = F.broadcast(several.groupBy("path", "rec").agg(F.sum(F.octet_length("raw") + 1).alias("n")).where(F.col("n") > max_bytes + 1).select("path").distinct())
    gathered = (several.join(too_long, "path", "left_anti").groupBy("path", F.col("rec").alias("pos"))
                .agg(F.first("mtime").alias("mtime"), F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("pos", text(F.col("raw")).alias("t")))).alias("_l")))
    gathered = gathered.select("path", "mtime", "size", "pos", F.array_join(F.transform("_l", lambda x: x["t"]), "\n").alias("line"))
    mended = (alone.join(too_long, "path", "left_anti").unionByName(gathered).join(broken, "path")
              .select("path", "mtime", "size", (F.col("pos") - F.col("first_pos")).alias("pos"), "line"))
    both = plain.unionByName(mended)
    line = F.regexp_replace(F.when(F.col("pos") == 0, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line")), "\r$", "")
    reason = F.when(F.col("quotes") % 2 == 1, "unclosed quote").when(F.col("long"), f"record over {max_bytes} bytes")
    status = (facts.join(too_long.withColumn("long", F.lit(True)), "path", "left")
              .select("path", F.when(reason.isNull(), "ok").otherwise("rejected").alias("state"), reason.alias("reason")))
    return both.select("path", "mtime", "size", "pos", line.alias("line")), status


def read_report_records(spark: SparkSession, paths, encoding: str = "UTF-8", required: Sequence[str] = (), sep: str = ",",
                        max_bytes: int = MAX_RECORD_BYTES):
    """S1 with line breaks in cells: (rows of the accepted files or None, status of every non-empty file)."""
    records, status = read_records(spark, paths, encoding, max_bytes)
    rows, screened = C.parse_header_lines(records, required, sep)
    bad = status.where("state = 'rejected'").select("path", "state", "reason", F.lit(None).cast("long").alias("replaced_chars"))
    return rows, screened.join(bad, "path", "left_anti").unionByName(bad)
