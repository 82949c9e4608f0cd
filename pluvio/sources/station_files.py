"""Raw station-file ingest as one Spark job.

A raw file holds 8 metadata lines (``KEY:;value``), a data header line and a
delimited body, all text, Latin-1. Stages, all as column expressions over
the file's line array:

* file discovery: ``binaryFile`` source, recursive, ``*.csv`` / ``*.CSV``;
* metadata: each of the first 8 lines split on ``;`` (or ``,`` when the line
  has no ``;``), key stripped of spaces and trailing ``:``, value = the second
  part only; last occurrence of a key wins, a missing field is ``""``;
* data start: first line holding ``Data`` and one of ``Hora`` / ``UTC`` /
  ``PRECIPITA`` (case-sensitive), else line 8;
* delimiter: ``;`` when the header line has more ``;`` than ``,``;
* body: empty lines skipped, rows with more fields than the header dropped,
  short rows padded with NULL, NA tokens -> NULL, all-NULL rows dropped;
* union by name per distinct header layout, metadata columns first.

Files are read as lines by splits, so a file of any size goes to many tasks. A line's
number is its place in its split plus the lines of the file's earlier splits; header
facts come from the few lines that each split keeps for them, and meet the body once,
in a join by split (``read_station_lines``, ``parse_lines``). Texts that are already
rows of a table are parsed in place (``parse_text_files``).
A field in double quotes may hold the separator, and ``""`` inside it is a quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.session import persist_table

# The 8 metadata fields, in output order.
HEADER_FIELDS = ["REGIAO", "UF", "ESTACAO", "CODIGO (WMO)", "LATITUDE", "LONGITUDE",
                 "ALTITUDE", "DATA DE FUNDACAO"]

# Text read as missing (the default NA tokens of pandas' CSV reader).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]


#: What Python's ``str.strip()`` removes from Latin-1 text: also the separators
#: 1C-1F, the next-line control and the no-break space.
BLANK = r"[ \t\n\x0B\f\r\x1C-\x1F\x85\xA0]"


def strip(c: Column) -> Column:
    """Python ``str.strip()``: leading / trailing whitespace removed."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def split_fields(line: Column, sep: Column) -> Column:
    """Fields of a delimited line. Lines without a quote are split at the
    separator; else each separator outside quotes ends a field, outer quotes go
    and doubled quotes become one."""
    mark = F.lit("\x01")
    # a separator is outside quotes if an even number of quotes follows it
    outside = F.regexp_replace(line, F.concat(sep, F.lit(r'(?=(?:[^"]*"[^"]*")*[^"]*$)')), mark)
    quoted = F.transform(F.split(outside, "\x01", -1), lambda v: F.when(
        v.rlike(r'^".*"$'), F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('""'), F.lit('"'))).otherwise(v))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, sep, -1))


def read_station_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, split, at, line) of every ``*.csv`` / ``*.CSV`` under ``folder``,
    recursively, decoded from Latin-1: ``split`` is the byte at which the line's split
    starts, ``at`` its place in the split, from 0. Fails when there is no file. Read
    once and written to the shared folder, so that every later step sees the same
    splits."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,CSV}")
    if reader.format("binaryFile").load(folder).select("path").limit(1).count() == 0:
        raise FileNotFoundError(f"no CSV file under {folder}")
    raw = reader.format("text").option("lineSep", "\n").load(folder)
    text = F.regexp_replace(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), "\r$", "")
    rows = persist_table(raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), text.alias("line")), "lines")
    # the lines of a split have consecutive ids
    first = rows.groupBy("path", "split").agg(F.min("id").alias("first"))
    return rows.join(first, ["path", "split"]).select("path", "split", (F.col("id") - F.col("first")).alias("at"), "line")


def list_station_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of every ``*.csv`` / ``*.CSV`` under ``folder``, also of empty ones."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.{csv,CSV}").load(folder))
    return files.select("path")


def _meta_entries(lines: Column) -> Column:
    def entry(line):
        sep = F.when(F.instr(line, ";") > 0, F.lit(";")).otherwise(F.lit(","))
        parts = F.split(strip(line), sep, -1)
        return F.struct((F.size(parts) >= 2).alias("ok"),
                        F.regexp_replace(strip(parts[0]), ":+$", "").alias("k"),
                        strip(F.get(parts, 1)).alias("v"))
    return F.transform(F.slice(lines, 1, 8), entry)


def header_value(entries: Column, field: str) -> Column:
    hits = F.filter(entries, lambda e: e["ok"] & (e["k"] == F.lit(field)))
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["v"], F.lit(""))


def data_start(lines: Column) -> Column:
    """0-based index of the data header line (8 when none is found)."""
    pred = F.transform(lines, _is_header)
    pos = F.array_position(pred, True)
    return F.when(pos > 0, pos - 1).otherwise(F.lit(8)).cast("int")


def delimiter(header_line: Column) -> Column:
    n_semi = F.length(header_line) - F.length(F.replace(header_line, F.lit(";"), F.lit("")))
    n_comma = F.length(header_line) - F.length(F.replace(header_line, F.lit(","), F.lit("")))
    return F.when(n_semi > n_comma, F.lit(";")).otherwise(F.lit(","))


def _is_header(line: Column) -> Column:
    return F.contains(line, F.lit("Data")) & (F.contains(line, F.lit("Hora")) | F.contains(line, F.lit("UTC"))
                                              | F.contains(line, F.lit("PRECIPITA")))


def _facts(meta: str, start: Column, header: Column) -> list[Column]:
    """Metadata fields (of the entries in column ``meta``), data start, delimiter and
    header fields of a file."""
    meta, sep = F.col(meta), delimiter(header)
    return [*[header_value(meta, h).alias(h) for h in HEADER_FIELDS], start.cast("int").alias("inicio_dados"),
            sep.alias("sep"), split_fields(header, sep).alias("cabecalho")]


def _kept_rows(body: DataFrame) -> DataFrame:
    """Body lines (path, facts, linha, __line) -> rows with their fields (NA -> NULL)."""
    body = body.filter((F.col("linha") > F.col("inicio_dados")) & (F.col("__line") != "")
                       & F.col("cabecalho").isNotNull())
    na = F.array(*[F.lit(t) for t in NA_TOKENS])
    fields = F.transform(split_fields(F.col("__line"), F.col("sep")),
                         lambda v: F.when(F.array_contains(na, v), F.lit(None)).otherwise(v))
    body = body.withColumn("campos", fields).drop("__line")
    body = body.filter(F.size("campos") <= F.size("cabecalho"))
    return body.filter(F.exists("campos", lambda v: v.isNotNull()))


def parse_text_files(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Long form of files that are rows of a table: one row per kept body line with the
    file's metadata, data start, delimiter, header fields and the line's fields (NA ->
    NULL)."""
    lines = F.split(F.col(text), r"\r?\n", -1)
    f = files.select(F.col(path).alias("path"), lines.alias("__lines"))
    f = f.withColumns({"__start": data_start(F.col("__lines")), "__meta": _meta_entries(F.col("__lines"))})
    f = f.withColumn("__hdr", F.get(F.col("__lines"), F.col("__start")))
    body = f.select("path", *_facts("__meta", F.col("__start"), F.col("__hdr")),
                    F.posexplode("__lines").alias("linha", "__line"))
    return _kept_rows(body)


#: Lines at the top of a file that may hold metadata, and the line that is the data
#: header when no line looks like one.
HEAD_LINES = 9


def split_facts(lines: DataFrame) -> DataFrame:
    """(path, split, before, facts of the file): ``before`` is the number of lines in the
    file's earlier splits. A split keeps its first lines and its first data header; one
    row per split goes on from there."""
    head = F.col("at") < HEAD_LINES
    looks = F.when(_is_header(F.col("line")), F.col("at"))
    splits = lines.groupBy("path", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min(looks).alias("hit"), F.min_by("line", looks).alias("hit_line"),
        F.collect_list(F.when(head, F.struct("at", "line"))).alias("top"))
    order = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    placed = F.transform("top", lambda t: F.struct((t["at"] + F.col("before")).alias("at"), t["line"].alias("line")))
    heads = splits.select("path", "before", "hit", "hit_line",
                          F.filter(placed, lambda t: t["at"] < HEAD_LINES).alias("top"))
    place = F.col("before") + F.col("hit")
    files = heads.groupBy("path").agg(
        F.min(place).alias("start"), F.min_by("hit_line", place).alias("found"),
        F.array_sort(F.flatten(F.collect_list("top"))).alias("top"))
    texts = F.transform("top", lambda t: t["line"])
    header = F.when(F.col("start").isNotNull(), F.col("found")).otherwise(F.get(texts, F.lit(HEAD_LINES - 1)))
    files = files.withColumn("meta", _meta_entries(texts)).select(
        "path", *_facts("meta", F.coalesce("start", F.lit(HEAD_LINES - 1)), header))
    return splits.select("path", "split", "before").join(files, "path")


def parse_lines(lines: DataFrame) -> DataFrame:
    """``parse_text_files`` over the lines of ``read_station_lines``."""
    return _kept_rows(lines.join(split_facts(lines), ["path", "split"]).select(
        "path", *HEADER_FIELDS, "inicio_dados", "sep", "cabecalho",
        (F.col("before") + F.col("at")).alias("linha"), F.col("line").alias("__line")))


def column_names(header: Column) -> Column:
    """Header names as the CSV reader makes them: blank -> ``Unnamed: i``,
    repeats -> ``name.1``, ``name.2``."""
    full = F.transform(header, lambda h, i: F.when(h == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(h))

    def numbered(h, i):
        before = F.size(F.filter(F.slice(full, F.lit(1), i), lambda x: x == h))
        return F.when(before > 0, F.concat(h, F.lit("."), before.cast("string"))).otherwise(h)
    return F.transform(full, numbered)


def to_wide(long: DataFrame) -> DataFrame:
    """Union by name of every header layout (absent -> NULL) in ONE pass.

    Column names are made per row from its header (``column_names``), so a row
    becomes a name -> field map without any lookup table. The driver only gets
    the distinct names, which are the columns of the result; where headers are so
    malformed that this is no table, the long form has every row. A body column named
    like a metadata field would be ambiguous and is refused."""
    named = long.withColumn("__nomes", column_names(F.col("cabecalho")))
    names = [r["n"] for r in named.select(F.posexplode("__nomes").alias("i", "n")).groupBy("n")
             .agg(F.min("i").alias("i")).orderBy("i", "n").collect()]
    if clash := sorted(set(names) & set(HEADER_FIELDS)):
        raise ValueError(f"body columns named like metadata fields: {clash}")
    m = F.map_from_arrays(F.col("__nomes"),
                          F.transform(F.col("__nomes"), lambda n, i: F.get(F.col("campos"), i)))
    j = named.withColumn("__m", m)
    return j.select(*HEADER_FIELDS, *[F.col("__m").getItem(n).alias(n) for n in names])


def ingest_summary(files: DataFrame, long: DataFrame) -> DataFrame:
    """One row per file: rows kept, and whether the file yielded none."""
    n = long.groupBy("path").agg(F.count(F.lit(1)).alias("__n"))
    return (files.select("path").join(n, "path", "left")
            .select("path", F.coalesce("__n", F.lit(0)).cast("bigint").alias("linhas"))
            .withColumn("vazio", F.col("linhas") == 0))


def ingest_station_files(spark: SparkSession, folder: str) -> DataFrame:
    """Folder of raw station files -> one all-string table."""
    return to_wide(parse_lines(read_station_lines(spark, folder)))


def type_station_rows(wide: DataFrame, date_col: str = "Data", hour_col: str = "Hora UTC",
                      numeric: dict | None = None, station: str = "CODIGO (WMO)",
                      extra: tuple[str, ...] = ()) -> DataFrame:
    """Typing step after ingest: ``dt_utc`` from the date and hour texts
    (``HH:MM`` or ``HHMM UTC``), numeric columns from decimal-comma text
    (invalid -> NULL), station code and ``extra`` columns kept as text."""
    from pluvio.functions.scalars import hour_utc_parse, to_double_comma
    out = [F.col(f"`{station}`").alias("CODIGO_WMO"),
           hour_utc_parse(F.col(f"`{date_col}`"), F.col(f"`{hour_col}`")).alias("dt_utc")]
    out += [F.col(f"`{c}`") for c in extra]
    for name, src in (numeric or {}).items():
        out.append(to_double_comma(F.col(f"`{src}`")).alias(name))
    return wide.select(*out)
