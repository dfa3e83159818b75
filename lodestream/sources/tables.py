"""Readers: company lists with resolved headers, snapshots, result logs, checkpoints, spreadsheets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..storage import settle

# ---- fixed values: names of columns that company lists use, in order ----
NAME_HEADERS = "company_name company name organization organisation employer business_name account_name".split()
WEBSITE_HEADERS = "website web url homepage domain company_website site web_address".split()
COUNTRY_HEADERS = "country country_name nation location_country hq_country".split()


def normalize_header(value: str | None) -> str:
    return re.sub("[^a-z0-9]+", "_", (value or "").lower()).strip("_")


def resolve_header(cells: list[str]) -> tuple[int, int | None, int | None, bool]:
    """Places of name, website and country, and whether the row is a header at all.

    Exact names count before names that contain one; without any the columns go by place
    and the row is data; without a name alone, the name is the first column.
    """
    given = [normalize_header(c) for c in cells]

    def find(wanted: list[str]) -> int | None:
        for w in wanted:
            if w in given:
                return given.index(w)
        for w in wanted:
            for i, g in enumerate(given):
                if w in g:
                    return i
        return None

    name, site, country = find(NAME_HEADERS), find(WEBSITE_HEADERS), find(COUNTRY_HEADERS)
    if (name, site, country) == (None, None, None):
        return 0, 1, 2, False
    return (0 if name is None else name), site, country, True


def _select(raw: DataFrame, header: list[str]) -> DataFrame:
    """The columns that a header names; raw is one file and, as its quoted cells may hold line ends, one partition: its ids are its lines."""
    name, site, country, has_header = resolve_header(header)
    cell = lambda i: F.trim(F.coalesce(F.col(raw.columns[i]), F.lit(""))) if i is not None and i < len(raw.columns) else F.lit("")
    rows = raw.select(cell(name).alias("name"), cell(site).alias("website"), cell(country).alias("country"), F.monotonically_increasing_id().alias("row_idx"))
    if has_header:
        rows = rows.where(F.col("row_idx") != F.lit(0))
    return rows.where("name != ''")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """(name, website, country, row_idx) of a CSV, TSV or XLSX list; rows without a name go; row_idx follows the file's order."""
    if re.search(r"\.(csv|tsv|tab|txt)$", path, re.I):
        sep = "\t" if re.search(r"\.(tsv|tab)$", path, re.I) else ","
        raw = spark.read.option("sep", sep).option("multiLine", True).option("escape", '"').option("nullValue", "\x00").csv(path)
        if len(raw.inputFiles()) > 1:
            raise ValueError(f"{path} is no single list: a list is one file, whose order counts")
    else:
        raw = read_xlsx(spark, path)
    head = raw.limit(1).collect()
    if not head:
        return spark.createDataFrame([], "name string, website string, country string, row_idx long")
    # the byte-order mark belongs to no name
    return _select(raw, [(c or "").lstrip("﻿") for c in head[0]])


def read_strings(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """CSV with a header, all columns strings, blanks kept as blanks."""
    for p in [paths] if isinstance(paths, str) else paths:
        settle(spark, p)
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\x00").option("emptyValue", "").csv(paths)
    return df.fillna("")


def read_snapshot(spark: SparkSession, path: str) -> tuple[DataFrame | None, str]:
    """Rows and an empty message, or none and what went wrong: absent, empty and unreadable files are no errors of the caller."""
    try:
        df = read_strings(spark, path)
    except Exception as fault:  # the reader's own message is the result
        return None, str(fault).split("\n")[0]
    return (df, "") if df.columns else (None, "the file is empty")


def completed_keys(spark: SparkSession, path: str) -> DataFrame:
    """(key) of the companies in an output file, each once."""
    rows = read_strings(spark, path)
    return rows.select(F.concat_ws("|", "company_name", "website").alias("key")).distinct()


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """(row_id, result) of a log of JSON lines: lines that are no objects go, the last of a row_id counts.

    The last is that of the latest batch (``seq``, which ``append_results`` writes); lines
    without one come before, by their files' times.  Within a batch files go by name and
    lines by place, whatever order Spark reads them in.
    """
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select("value", F.col("_metadata.file_modification_time").alias("written"), place.alias("place"))
    of = lambda key: F.get_json_object("value", f"$.{key}")
    parsed = lines.select(of("row_id").alias("row_id"), of("result").alias("result"), F.coalesce(of("seq").cast("long"), F.lit(0)).alias("seq"), "written", "place").where("row_id IS NOT NULL")
    order = F.struct("seq", F.when(F.col("seq") == 0, F.col("written")), "place")
    return parsed.groupBy("row_id").agg(F.max_by("result", order).alias("result"))


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """(row_id) of the lines of a checkpoint, each once."""
    return spark.read.text(path).select(F.trim("value").alias("row_id")).where("row_id != ''").distinct()


def rss_links(xml: Column) -> Column:
    """Links of the items of a feed."""
    return F.transform(F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"(?is)<item>.*?<link>(.*?)</link>.*?</item>"), F.lit(1)), lambda x: F.trim(x))


class _Sheet(DataSourceReader):
    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        for row in sheet_rows(self.path):
            yield tuple((row + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """The first sheet of a workbook, cells as strings; a workbook is one file and is read by one task."""

    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        width = max((len(r) for r in sheet_rows(self.options["path"])), default=1)
        return ", ".join(f"_c{i} string" for i in range(width))

    def reader(self, schema: StructType):
        return _Sheet(self.options["path"], len(schema.fields))


def sheet_rows(path: str) -> list[list[str | None]]:
    """Rows of the first sheet, values only."""
    import zipfile
    from xml.etree import ElementTree

    from pyarrow import fs

    filesystem, at = fs.FileSystem.from_uri(path if "://" in path else "file://" + path)
    local = lambda tag: tag.rsplit("}", 1)[-1]
    with filesystem.open_input_file(at) as stream, zipfile.ZipFile(stream) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter() if local(t.tag) == "t") for item in root]
        sheet = sorted(n for n in book.namelist() if n.startswith("xl/worksheets/sheet"))[0]
        rows = []
        for row in (e for e in ElementTree.fromstring(book.read(sheet)).iter() if local(e.tag) == "row"):
            cells: list[str | None] = []
            for cell in row:
                if cell.get("r"):  # its column, in letters; without one it follows the cell before
                    column = 0
                    for letter in re.match("[A-Z]+", cell.get("r"))[0]:
                        column = column * 26 + ord(letter) - 64
                    cells += [None] * (column - 1 - len(cells))
                text = "".join(t.text or "" for t in cell.iter() if local(t.tag) in ("v", "t"))
                cells.append(shared[int(text)] if cell.get("t") == "s" and text else text or None)
            rows.append(cells)
    return rows


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(XlsxSource)
    return spark.read.format("xlsx").option("path", path).load()
