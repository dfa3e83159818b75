"""Writers: append, atomic replacement, migration, purge, side outputs, workbooks."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..operators.relational import migrate, purge
from ..storage import settle, swap


def append(rows: DataFrame, path: str, columns: list[str] = V.OUTPUT_COLUMNS) -> None:
    """Rows under the fixed columns, unknown ones ignored, appended to what the folder holds."""
    settle(rows.sparkSession, path)
    migrate(rows, columns).write.mode("append").option("header", True).option("escape", '"').csv(path)


def replace(rows: DataFrame, path: str) -> None:
    """rows in place of the folder at path: written beside it, then put in its place by ``storage.swap``.

    A crash before the swap is committed leaves the old folder, one after it the new;
    the readers and writers of this package finish a swap that was left half done.
    """
    new = f"{path}.{uuid.uuid4().hex}.new"
    rows.write.option("header", True).option("escape", '"').csv(new)
    swap(rows.sparkSession, path, new)


def migrate_file(spark: SparkSession, path: str, columns: list[str] = V.OUTPUT_COLUMNS) -> bool:
    """Bring the file at path to the columns given; whether anything had to change."""
    from .tables import read_strings

    rows = read_strings(spark, path)
    if rows.columns == list(columns):
        return False
    replace(migrate(rows, columns), path)
    return True


def purge_file(spark: SparkSession, path: str) -> int:
    """Drop the rows that are to be tried again; how many. The file is replaced only if there are any."""
    from .tables import read_strings

    rows = read_strings(spark, path)
    gone = rows.where(F.col("job_status").isin(*V.RETRYABLE)).count()
    if gone:
        replace(purge(rows, "job_status", V.RETRYABLE), path)
    return gone


def append_results(results: DataFrame, log: str, checkpoint: str, errors: str) -> None:
    """Results as JSON lines, then their ids, then errors aside: a crash between the first two repeats work, but loses none.

    Each line carries the time of its batch, by which ``read_results`` tells the last.
    """
    good = results.where("error IS NULL")
    good.select("row_id", "result", F.lit(time.time_ns()).alias("seq")).write.mode("append").json(log)
    good.select("row_id").write.mode("append").text(checkpoint)
    results.where("error IS NOT NULL").select("row_id", "error").write.mode("append").option("header", True).csv(errors)


def write_outputs(sheets: dict[str, DataFrame], folder: str) -> None:
    """A folder of CSV per sheet."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")


def write_xlsx(sheets: dict[str, DataFrame], path: str) -> None:
    """A workbook with a sheet per frame, streamed row by row from the driver; a workbook holds at most 1,048,576 rows a sheet."""
    import zipfile
    from xml.sax.saxutils import escape

    from pyarrow import fs

    filesystem, at = fs.FileSystem.from_uri(path if "://" in path else "file://" + path)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cell = lambda v: "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) and not isinstance(v, bool) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
    with filesystem.open_output_stream(at) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as book:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i, _ in enumerate(sheets, 1))
        book.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        book.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)[:31]}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(sheets, 1)) + "</Relationships>")
        for i, df in enumerate(sheets.values(), 1):
            with book.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                out.write(f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetData>'.encode())
                out.write(("<row>" + "".join(map(cell, df.columns)) + "</row>").encode())
                for row in df.toLocalIterator():
                    out.write(("<row>" + "".join(map(cell, row)) + "</row>").encode())
                out.write(b"</sheetData></worksheet>")
