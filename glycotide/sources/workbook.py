"""Excel workbooks of sensor readings as rows, from any store that Spark reads.

A workbook is a zip of XML files, which the standard library reads. Spark lists the files and deals them out, several small
ones a task; a workbook is in memory as it is stored, and its sheet streams by. Dates stored as day numbers become ISO text.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import batched
from urllib.parse import unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The headings of the export, and the XML name spaces of workbooks.
TIME_COLUMN, VALUE_COLUMN = "血糖时间", "血糖值"
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATIONS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that are dates or times.
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
DAY_ZERO = datetime(1899, 12, 30)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref)[0]:
        n = 26 * n + ord(ch) - 64
    return n - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): f.get("formatCode") for f in root.iter(f"{MAIN}numFmt")}
    is_date = lambda k: k in DATE_FORMATS or bool(re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(k, "")).lower()))
    formats = root.find(f"{MAIN}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else []) if is_date(int(x.get("numFmtId", 0)))}


def read_rows(data: bytes) -> Iterator[dict[int, str]]:
    """The first sheet's rows, from its XML as it streams by: column number to text."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in root.iter(f"{MAIN}si")]
        dates = _date_styles(book)
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
        links = {x.get("Id"): x.get("Target") for x in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = links[sheets[0].get(f"{RELATIONS}id")]
        with book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{MAIN}row":
                    continue
                out: dict[int, str] = {}
                for at, cell in enumerate(row.iter(f"{MAIN}c")):
                    kind, value = cell.get("t"), cell.find(f"{MAIN}v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                    elif value is None or value.text is None:
                        continue
                    elif kind == "s":
                        text = shared[int(value.text)]
                    elif kind is None and int(cell.get("s", 0)) in dates:
                        text = (DAY_ZERO + timedelta(milliseconds=round(float(value.text) * 86_400_000))).isoformat(sep=" ")
                    else:
                        text = value.text
                    out[_column(cell.get("r")) if cell.get("r") else at] = text
                row.clear()
                yield out


#: Rows of a batch that leaves a task.
BATCH = 4096
SCHEMA = f"file string, stem string, row_no long, `{TIME_COLUMN}` string, `{VALUE_COLUMN}` string, problem string"


def _readings(file: str, data: bytes) -> Iterator[tuple]:
    """The tuples of SCHEMA of one workbook; what is wrong with it is the last one's ``problem``."""
    stem = posixpath.splitext(posixpath.basename(file))[0]
    try:
        rows = read_rows(data)
        places = {name.strip(): k for k, name in next(rows, {}).items()}
        if missing := [c for c in (TIME_COLUMN, VALUE_COLUMN) if c not in places]:
            yield file, stem, None, None, None, f"Missing required columns: {', '.join(missing)}"
            return
        for n, row in enumerate(rows, 2):
            if row:
                yield file, stem, n, row.get(places[TIME_COLUMN]), row.get(places[VALUE_COLUMN]), None
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError, TypeError, AttributeError, EOFError, NotImplementedError, zlib.error) as e:
        yield file, stem, None, None, None, f"not a workbook: {type(e).__name__} {e}"


def _parsed(batches) -> Iterator[pa.RecordBatch]:
    names = ["file", "stem", "row_no", TIME_COLUMN, VALUE_COLUMN, "problem"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1), strict=True):
            for rows in batched(_readings(unquote(file.as_py()), content.as_py()), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_workbooks(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    """Raw readings of one workbook or of all in a folder: file, stem, row_no and the two columns of the export, as text.

    A workbook that can't be read, or lacks a column, fails the job; with ``tolerant`` it has a row whose ``problem`` says why.
    """
    files = path if path.endswith(".xlsx") else f"{path.rstrip('/')}/*.xlsx"  # of a folder, not of folders in it
    try:
        listed = spark.read.format("binaryFile").load(files).select("path", "content")
    except AnalysisException as e:
        raise FileNotFoundError(f"no workbook at {path}") from e
    rows = listed.mapInArrow(_parsed, SCHEMA)
    if tolerant:
        return rows
    fine = F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat("file", F.lit(": "), "problem")).cast("boolean"))
    return rows.filter(fine).drop("problem")
