"""Readers for the messy daily report CSVs.

Two paths:
* ``read_report_csv`` -- ``spark.read.csv`` for plain header CSVs that share one
  header; splittable, so a large file is read by many tasks.  Headers are
  validated against each other (``enforceSchema=false``) instead of being
  silently taken by position.
* ``read_lines`` + family parsers -- for small report files with preambles,
  a header somewhere inside, per-file headers, or cp932 text.  Each file is
  decoded by Spark (``decode(content, charset)``), split into numbered lines
  and parsed with ``from_csv``; the per-file decisions (where the header is,
  how many fields it has, which date the preamble names) are aggregates per
  file joined back to the lines, so any number of files is one job.

All cells come out as strings with NULL and the NA tokens pandas knows turned
into ``''`` (the source system read every file with pandas defaults).
Rejected files are reported in a status frame, never dropped silently.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.dates import iso_text

# A quote inside a quoted cell is doubled; a backslash is an ordinary character.
CSV_OPTIONS = {"quote": '"', "escape": '"'}
# One record as text: line breaks within its cells stay as written.
RECORD_OPTIONS = {**CSV_OPTIONS, "multiLine": "true"}

# The text tokens pandas' read_csv turns into NaN by default
# (they end up as '' in the all-string raw tables).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Positional schemas of the two preamble families.
AFFILIATE_COLUMNS = ("成果発生日時", "商品管理者商品名", "商品名", "ジャンル名", "受注番号", "受注番号(確定後)",
                     "売上金額", "料率", "成果報酬", "ステータス", "クリック端末種別", "購入端末種別", "商品種別")
AFFILIATE_SKIPROWS = 11
EXPANSION_COLUMNS = ("日付", "商品ページURL", "商品管理番号", "実績額", "インプレッション数", "クリック数",
                     "CTR（クリック率）", "CPC実績", "売上件数-合計-", "売上件数-新規-", "売上件数-既存-",
                     "CVR（転換率）-合計-", "注文獲得単価-合計-", "売上金額-合計-", "売上金額-新規-",
                     "売上金額-既存-", "ROAS-合計-", "平均購入単価-合計-")
EXPANSION_SKIPROWS = 5
# Header marker of the ad reports, the page-analysis date column,
# and the field count that identifies a daily-total report.
AD_HEADER_MARKER = '"CTR(%)"'
PAGE_DATE_COLUMN = "対象日"
DAILY_TOTAL_COLUMNS = 42


def blank_na(c: Column) -> Column:
    """NULL and pandas NA tokens -> ''."""
    return F.when(c.isNull() | c.isin(*NA_TOKENS), F.lit("")).otherwise(c)


def _with_file_meta(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path")) \
             .withColumn("source_mtime", F.col("_metadata.file_modification_time"))


def read_report_csv(spark: SparkSession, paths, encoding: str = "UTF-8", sep: str = ",",
                    multi_line: bool = False, keep_na_tokens: bool = False) -> DataFrame:
    """Header CSV, all strings, BOM stripped, NULL/NA tokens -> '' + file name and mtime."""
    r = (spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
         .option("sep", sep).option("multiLine", multi_line).option("enforceSchema", False)
         .option("mode", "PERMISSIVE").options(**CSV_OPTIONS))
    df = _with_file_meta(r.csv(paths))
    data_cols = [c for c in df.columns if c not in ("source_file", "source_mtime")]
    fix = (lambda c: F.coalesce(F.col(c), F.lit(""))) if keep_na_tokens else (lambda c: blank_na(F.col(c)))
    return df.select(*[fix(c).alias(c) for c in data_cols], "source_file", "source_mtime")


def read_lines(spark: SparkSession, paths, encoding: str = "UTF-8") -> DataFrame:
    """(path, mtime, size, pos, line) for every line of every file; any charset Java knows.

    Line breaks are ``\\r\\n``, ``\\n`` or ``\\r``; a final line break does not make
    an extra empty line; a UTF-8 BOM is removed.
    """
    bf = spark.read.format("binaryFile").load(paths)
    return lines_from_binary(bf, encoding)


def lines_from_binary(bf: DataFrame, encoding: str = "UTF-8", content: str = "content") -> DataFrame:
    """Numbered lines of a (path, modificationTime, length, content) frame.

    Other charsets than Spark's own list (MS932 reports) and replacement of malformed bytes by U+FFFD
    are session settings (``tallyspark.session.DEFAULT_CONF``); ``screen_files`` counts the replacements.
    """
    text = F.decode(F.col(content), encoding)
    text = F.regexp_replace(text, "^\ufeff", "")
    text = F.regexp_replace(text, "(\r\n|\n|\r)$", "")
    return bf.select(F.col("path"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"),
                     F.posexplode(F.split(text, "\r\n|\n|\r", -1)).alias("pos", "line"))


def field_count(line) -> Column:
    """Number of CSV fields in a line (separators inside quotes do not count)."""
    c = F.col(line) if isinstance(line, str) else line
    return F.size(F.split(F.regexp_replace(c, '"[^"]*"', ""), ",", -1))


def _positional(n: int) -> str:
    return ", ".join(f"_c{i} STRING" for i in range(n))


def parse_fields(line, names: Sequence[str], sep: str = ",") -> list[Column]:
    """Parse one CSV line into ``names`` (positional), blanks and NA tokens -> ''."""
    c = F.col(line) if isinstance(line, str) else line
    rec = F.from_csv(c, _positional(len(names)), {"sep": sep, "mode": "PERMISSIVE", **RECORD_OPTIONS})
    return [blank_na(rec.getField(f"_c{i}")).alias(n) for i, n in enumerate(names)]


def mangle_duplicates(names: Sequence[str]) -> list[str]:
    """``a, a`` -> ``a, a.1`` (how pandas names repeated headers)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def _split_header(text: str, sep: str = ",") -> list[str]:
    return next(csv.reader(io.StringIO(text), delimiter=sep))


def parse_with_headers(lines: DataFrame, headers: DataFrame, sep: str = ",",
                       keep_meta: bool = True) -> DataFrame:
    """Parse data lines by their own file's header (U2), in one pass over the lines.

    ``headers`` has (path, header, header_pos); data lines are those after the
    header.  The distinct header texts (a handful -- report layouts, not rows)
    are read on the driver only to know the output columns; each line is
    parsed once positionally and zipped with its file's header names into a
    map, so files of every layout share one scan.  A column a file does not
    have comes out as '' (``unionByName(allowMissingColumns=True)`` semantics).
    """
    variants = sorted(r[0] for r in headers.select("header").distinct().collect())
    if not variants:
        raise ValueError("no header found in any file")
    names_of = {v: mangle_duplicates(_split_header(v, sep)) for v in variants}
    width = max(len(n) for n in names_of.values())
    columns: list[str] = []
    for v in variants:
        columns += [n for n in names_of[v] if n not in columns]
    # header text -> its column names, as a literal map (layouts, not data)
    layout = F.create_map(*[x for v in variants for x in (F.lit(v), F.array(*[F.lit(n) for n in names_of[v]]))])
    files = headers.select("path", "header_pos", layout[F.col("header")].alias("_names"))
    data = lines.join(files, "path").where((F.col("pos") > F.col("header_pos")) & (F.col("line") != ""))
    rec = F.from_csv(F.col("line"), _positional(width), {"sep": sep, "mode": "PERMISSIVE", **RECORD_OPTIONS})
    fields = F.array(*[rec.getField(f"_c{i}") for i in range(width)])
    cells = F.map_from_arrays(F.col("_names"), F.slice(fields, 1, F.size("_names")))
    parsed = data.select(cells.alias("_m"), "path", "mtime", "pos")
    meta = [F.col("path").alias("source_file"), F.col("mtime").alias("source_mtime"),
            F.col("pos").alias("source_line")] if keep_meta else []
    return parsed.select(*[blank_na(F.col("_m").getItem(c)).alias(c) for c in columns], *meta)


def header_at(lines: DataFrame, pos: int = 0) -> DataFrame:
    """(path, header, header_pos) taking line ``pos`` of each file as its header."""
    return lines.where(F.col("pos") == pos).select("path", F.col("line").alias("header"),
                                                   F.lit(pos).alias("header_pos"))


def quoted_line_breaks(lines: DataFrame) -> DataFrame:
    """Files with a quoted field that spans lines (a line with an odd number of quotes).

    The line-level readers split on every line break, so such a file would be
    mis-parsed; it belongs on the ``multiLine`` path (``read_report_csv``).
    """
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    return lines.where(quotes % 2 == 1).select("path").distinct()


def read_header_csvs(spark: SparkSession, paths, encoding: str = "UTF-8", sep: str = ",",
                     on_quoted_newline: str = "raise") -> DataFrame:
    """S1 for many small files with possibly different headers (line path).

    A file with a quoted line break raises (``on_quoted_newline="raise"``) or is
    left out (``"skip"``; list them with ``quoted_line_breaks``) -- never
    mis-parsed.
    """
    lines = read_lines(spark, paths, encoding)
    bad = quoted_line_breaks(lines)
    if on_quoted_newline == "raise":
        found = [r.path for r in bad.limit(5).collect()]
        if found:
            raise ValueError(f"quoted line breaks, read these with read_report_csv(multi_line=True): {found}")
    elif on_quoted_newline == "skip":
        lines = lines.join(bad, "path", "left_anti")
    return parse_with_headers(lines, header_at(lines, 0), sep)


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def _replaced(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("\ufffd"), F.lit("")))


def screen_files(lines: DataFrame, required: Sequence[str] = (), header_pos: int = 0) -> DataFrame:
    """(path, state, reason, replaced_chars) of every file, judged by its own lines only.

    ``rejected``: no header line, a quoted line break (the line readers would cut its cell), a data line
    with more fields than the header, or a header without a ``required`` column.  Malformed bytes don't
    reject a file; ``replaced_chars`` counts what replaced them.
    """
    is_header, is_data = F.col("pos") == header_pos, (F.col("pos") > header_pos) & (F.col("line") != "")
    per = lines.groupBy("path").agg(
        F.max(F.when(is_header, F.col("line"))).alias("h"), F.max(F.when(is_data, field_count("line"))).alias("widest"),
        F.max(_odd_quotes(F.col("line")).cast("int")).alias("odd"), F.sum(_replaced(F.col("line"))).alias("replaced_chars"))
    names = F.transform(F.split(F.replace(F.col("h"), F.lit('"'), F.lit("")), ","), lambda x: F.trim(x))
    lacking = F.filter(F.array(*[F.lit(c) for c in required]).cast("array<string>"), lambda c: ~F.array_contains(names, c))
    reason = (F.when(F.coalesce(F.col("h"), F.lit("")) == "", "no header line")
              .when(F.col("odd") == 1, "quoted line break")
              .when(F.size(lacking) > 0, F.concat(F.lit("missing column "), F.array_join(lacking, ", ")))
              .when(F.col("widest") > field_count("h"), F.concat(F.lit("fields "), F.col("widest").cast("string"), F.lit(" > "), field_count("h").cast("string"))))
    return per.select("path", F.when(reason.isNull(), "ok").otherwise("rejected").alias("state"), reason.alias("reason"), "replaced_chars")


def parse_header_lines(lines: DataFrame, required: Sequence[str] = (), sep: str = ","):
    """S1 on numbered lines: (rows of the accepted files or None, file status); one bad file never hides another."""
    status = screen_files(lines, required)
    good = lines.join(status.where("state = 'ok'").select("path"), "path", "left_semi")
    headers = header_at(good, 0)
    return (None if headers.isEmpty() else parse_with_headers(good, headers, sep)), status


def _preamble_files(lines: DataFrame, skiprows: int, expected: int, header: bool):
    """(data lines, status of every file): a file is judged by its lines after ``skiprows``.

    ``rejected``: no line after the preamble, a first line of too few fields, or a quoted line break.
    """
    body = (F.col("pos") >= skiprows) & (F.col("line") != "")
    first = F.min_by(F.when(body, F.struct("pos", "line")), F.when(body, F.col("pos")))
    per = lines.groupBy("path").agg(first.alias("f"), F.max(F.when(body, _odd_quotes(F.col("line")).cast("int"))).alias("odd"))
    n = field_count("f.line")
    reason = (F.when(F.col("f").isNull(), "no data lines")
              .when(n < expected, F.concat(F.lit("columns "), n.cast("string"), F.lit(" < "), F.lit(str(expected))))
              .when(F.col("odd") == 1, "quoted line break"))
    per = per.select("path", F.col("f.pos").alias("first_pos"), reason.alias("reason"))
    start = F.col("pos") > F.col("first_pos") if header else F.col("pos") >= F.col("first_pos")
    data = lines.where(body).join(per.where(F.col("reason").isNull()).select("path", "first_pos"), "path").where(start)
    return data, per.select("path", F.when(F.col("reason").isNull(), "ok").otherwise("rejected").alias("state"), "reason")


def _preamble_rows(lines: DataFrame, skiprows: int, columns: Sequence[str], header: bool):
    data, status = _preamble_files(lines, skiprows, len(columns), header)
    return data.select(*parse_fields("line", columns), F.col("path").alias("source_file"), F.col("mtime").alias("source_mtime")), status


def affiliate_from_lines(lines: DataFrame, skiprows: int = AFFILIATE_SKIPROWS, columns: Sequence[str] = AFFILIATE_COLUMNS):
    """S2 on numbered lines: skip the preamble, no header, name by position; (rows, status of every file); extra fields are cut."""
    return _preamble_rows(lines, skiprows, columns, header=False)


def expansion_from_lines(lines: DataFrame, skiprows: int = EXPANSION_SKIPROWS, columns: Sequence[str] = EXPANSION_COLUMNS):
    """S3 on numbered lines: skip the preamble, drop the file's header line, name by position; (rows, status of every file)."""
    return _preamble_rows(lines, skiprows, columns, header=True)


def read_affiliate(spark: SparkSession, paths, encoding: str = "UTF-8",
                   skiprows: int = AFFILIATE_SKIPROWS, columns: Sequence[str] = AFFILIATE_COLUMNS):
    """S2 on files."""
    return affiliate_from_lines(read_lines(spark, paths, encoding), skiprows, columns)


def read_expansion(spark: SparkSession, paths, encoding: str = "UTF-8",
                   skiprows: int = EXPANSION_SKIPROWS, columns: Sequence[str] = EXPANSION_COLUMNS):
    """S3 on files."""
    return expansion_from_lines(read_lines(spark, paths, encoding), skiprows, columns)


def _screened(lines: DataFrame, status: DataFrame, header_pos: int = 0):
    """(lines of files that stay, status) after the data lines of the ``ok`` files were screened against their header."""
    ok = lines.join(status.where("state = 'ok'").select("path"), "path", "left_semi")
    found = screen_files(ok, header_pos=header_pos).where("state = 'rejected'").select("path", F.col("reason").alias("_why"))
    status = status.join(found, "path", "left").select(
        "path", F.when(F.col("_why").isNotNull(), "rejected").otherwise(F.col("state")).alias("state"), F.coalesce("_why", "reason").alias("reason"))
    return lines.join(status.where("state <> 'rejected'").select("path"), "path", "left_semi"), status


def clean_report_lines(lines: DataFrame, marker: str = AD_HEADER_MARKER):
    """Drop everything before the first line containing the header marker.

    Returns (kept lines, status).  A file without the marker is kept whole and
    flagged ``header_not_found`` (the source system saved it as-is with a warning).
    """
    hpos = lines.where(F.col("line").contains(marker)).groupBy("path").agg(F.min("pos").alias("hpos"))
    j = lines.join(hpos, "path", "left")
    kept = j.where(F.col("hpos").isNull() | (F.col("pos") >= F.col("hpos")))
    status = (lines.select("path").distinct().join(hpos, "path", "left")
              .select("path", F.when(F.col("hpos").isNull(), "header_not_found").otherwise("ok").alias("state")))
    return kept.select("path", "mtime", "size", (F.col("pos") - F.coalesce("hpos", F.lit(0))).alias("pos"),
                       "line"), status


def ad_report_from_lines(lines: DataFrame, sep: str = ","):
    """S4 + S1 on numbered lines: (rows, status); a file without the marker is kept whole, one with too wide a line is rejected."""
    kept, status = clean_report_lines(lines)
    kept, status = _screened(kept, status.withColumn("reason", F.lit(None).cast("string")))
    return parse_with_headers(kept, header_at(kept, 0), sep), status


def read_ad_report(spark: SparkSession, paths, encoding: str = "MS932", sep: str = ","):
    """S4 + S1 on files: cp932 ad reports as downloaded."""
    return ad_report_from_lines(read_lines(spark, paths, encoding), sep)


def page_analysis_from_lines(lines: DataFrame, sep: str = ","):
    """S5 on numbered lines: date from line 3 field 2, header line 6, data from line 7, each row prefixed with the date.

    Files with fewer than 7 lines, without a date or with a line wider than the header are rejected.
    """
    per_file = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.when(F.col("pos") == 2, F.regexp_extract(F.split_part(F.col("line"), F.lit(","), F.lit(2)),
                                                        r"(\d{4}年\d{2}月\d{2}日)", 1))).alias("jp"))
    d = F.try_to_date(F.nullif(F.col("jp"), F.lit("")), "yyyy年MM月dd日")
    per_file = per_file.withColumn("report_date", iso_text(d))
    reason = F.when(F.col("n_lines") < 7, "fewer than 7 lines").when(F.col("report_date").isNull(), "no date in line 3")
    status = per_file.select("path", F.when(reason.isNull(), "ok").otherwise("rejected").alias("state"), reason.alias("reason"))
    good = per_file.where((F.col("n_lines") >= 7) & F.col("report_date").isNotNull()).select("path", "report_date")
    j = lines.join(good, "path")
    prefixed = j.select("path", "mtime", "size", "pos",
                        F.when(F.col("pos") == 5, F.concat(F.lit(PAGE_DATE_COLUMN + sep), F.col("line")))
                         .otherwise(F.concat(F.col("report_date"), F.lit(sep), F.col("line"))).alias("line"))
    body, status = _screened(prefixed.where(F.col("pos") >= 5), status, 5)
    return parse_with_headers(body, header_at(body, 5), sep), status


def read_page_analysis(spark: SparkSession, paths, encoding: str = "UTF-8", sep: str = ","):
    """S5 on files."""
    return page_analysis_from_lines(read_lines(spark, paths, encoding), sep)


def action_list_from_lines(lines: DataFrame, report_date: str | None = None, sep: str = ","):
    """S6 on numbered lines: header line 3, data from line 4, rows prefixed with the report date.

    The date comes from ``report_date`` or else the first ``_yyyymmdd`` in the
    file name.  Files with fewer than 4 lines or a line wider than the header are rejected.
    """
    if report_date is not None:
        d = F.lit(report_date)
    else:
        d = iso_text(F.try_to_date(F.regexp_extract(F.col("path"), r"_(\d{8})", 1), "yyyyMMdd"))
    n = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n_lines"))
    reason = F.when(F.col("n_lines") < 4, "fewer than 4 lines")
    status = n.select("path", F.when(reason.isNull(), "ok").otherwise("rejected").alias("state"), reason.alias("reason"))
    j = lines.join(n.where(F.col("n_lines") >= 4), "path").where(F.col("pos") >= 2)
    prefixed = j.select("path", "mtime", "size", "pos",
                        F.when(F.col("pos") == 2, F.concat(F.lit(PAGE_DATE_COLUMN + sep), F.col("line")))
                         .otherwise(F.concat(d, F.lit(sep), F.col("line"))).alias("line"))
    body, status = _screened(prefixed, status, 2)
    return parse_with_headers(body, header_at(body, 2), sep), status


def read_action_list(spark: SparkSession, paths, report_date: str | None = None, encoding: str = "MS932",
                     sep: str = ","):
    """S6 on files."""
    return action_list_from_lines(read_lines(spark, paths, encoding), report_date, sep)


#: bytes of a file that normally hold its first two lines
HEAD_BYTES = 64 << 10


def daily_totals_scan(spark: SparkSession, paths, encoding: str = "MS932", head_bytes: int = HEAD_BYTES) -> DataFrame:
    """S7 on files: (path, n_cols, clicks_text, cost_text) per file."""
    return daily_totals_from_heads(spark.read.format("binaryFile").load(paths), encoding, head_bytes)


def daily_totals_from_heads(bf: DataFrame, encoding: str = "MS932", head_bytes: int = HEAD_BYTES) -> DataFrame:
    """Header field count and cells 3 and 4 of the first row of every (path, content) file; files without a row are left out.

    Only the first ``head_bytes`` bytes are decoded and split, one row a file; where they end before the second
    line does, the whole content is.  A file of millions of lines costs what one of two lines costs.
    """
    def first_lines(content):
        return F.split(F.regexp_replace(F.decode(content, encoding), "^\ufeff", ""), "\r\n|\n|\r", 3)

    # the head's second line is whole if a line break follows it; a lone \r at the very end may be half of one
    head = F.transform(F.array(first_lines(F.substring("content", 1, head_bytes))), lambda h: F.when(
        (F.octet_length("content") <= head_bytes) | ((F.size(h) == 3) & (F.element_at(h, 3) != "")), h))
    lines = F.coalesce(F.element_at(head, 1), first_lines(F.col("content")))
    two = bf.select("path", F.explode(F.array(lines)).alias("l"))                 # split once
    two = two.where((F.size("l") >= 2) & ~((F.size("l") == 2) & (F.element_at("l", 2) == "")))
    rec = F.from_csv(F.element_at("l", 2), _positional(5), {"mode": "PERMISSIVE", **CSV_OPTIONS})
    return two.select("path", field_count(F.element_at("l", 1)).alias("n_cols"), F.coalesce(rec.getField("_c3"), F.lit("")).alias("clicks_text"),
                      F.coalesce(rec.getField("_c4"), F.lit("")).alias("cost_text"))


_ZIP_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("member", T.StringType()),
                            T.StructField("modificationTime", T.TimestampType()),
                            T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def _first_csv_in_zip(batches):
    import zipfile

    import pandas as pd

    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            with zipfile.ZipFile(io.BytesIO(r.content)) as z:
                names = sorted(n for n in z.namelist() if n.lower().endswith(".csv"))
                if names:
                    data = z.read(names[0])
                    rows.append((r.path, names[0], r.modificationTime, len(data), data))
        yield pd.DataFrame(rows, columns=["path", "member", "modificationTime", "length", "content"])


def zipped_report_lines(spark: SparkSession, zip_glob: str, encoding: str = "MS932",
                        newest_only: bool = True) -> DataFrame:
    """First CSV inside the (newest) zip, as numbered lines ready for S4.

    Unzipping is per-file Python (``mapInPandas``); each zip is one row, so the
    work spreads over tasks and nothing passes through the driver.
    """
    bf = spark.read.format("binaryFile").load(zip_glob)
    if newest_only:
        newest = bf.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p"))
        bf = bf.join(newest, bf.path == newest.p, "left_semi")
    unz = bf.select("path", F.lit(None).cast("string").alias("member"), "modificationTime", "length", "content") \
            .mapInPandas(_first_csv_in_zip, _ZIP_SCHEMA)
    return lines_from_binary(unz, encoding)
