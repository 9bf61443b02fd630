"""Books on disk: an inventory of files, and their pages through a reader that is at hand."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: A page reader takes a book's bytes, the resolution and the greatest number of pages, and yields
#: (page number from 1, page text, image bytes) one by one, so pages beyond the limit are never rendered.
PageReader = Callable[[bytes, int, int], Iterator[tuple[int, str, bytes]]]

PAGE_SCHEMA = "path string, source_book string, source_page int, page_text string, image binary, dpi int, error string"


def list_books(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """``path, source_book, length`` of the files of a folder, in order of paths. A missing folder raises
    FileNotFoundError, and one without such files RuntimeError. Contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    try:
        found = files.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("source_book"), "length").orderBy("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(folder) from e
    if found.isEmpty():
        raise RuntimeError(f"no files {glob} in {folder}")
    return found


def read_text_pages(content: bytes, dpi: int, most: int) -> Iterator[tuple[int, str, bytes]]:
    """Reader for plain text with form feeds between pages; there is no image."""
    for n, page in enumerate(content.decode("utf-8", "replace").split("\f")[:most], 1):
        yield n, page, b""


def read_pdf_pages(content: bytes, dpi: int, most: int) -> Iterator[tuple[int, str, bytes]]:
    """Reader for PDF files, where the optional rendering library is installed."""
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("reading PDF files needs pymupdf") from e
    with pymupdf.open(stream=content, filetype="pdf") as doc:
        for k in range(min(doc.page_count, most)):
            page = doc[k]
            yield k + 1, page.get_text("text"), page.get_pixmap(matrix=pymupdf.Matrix(dpi / 72, dpi / 72), alpha=False).tobytes("png")


def count_pdf_pages(content: bytes) -> int:
    """Pages of a PDF file, where the optional rendering library is installed."""
    try:
        import pymupdf
    except ImportError as e:
        raise RuntimeError("reading PDF files needs pymupdf") from e
    with pymupdf.open(stream=content, filetype="pdf") as doc:
        return doc.page_count


def count_text_pages(content: bytes) -> int:
    return content.count(b"\f") + 1


def page_of(content: bytes, page: int, dpi: int, reader: PageReader) -> tuple[str, bytes]:
    """Text and image of one page by its number from 1. IndexError beyond the book's pages."""
    if page >= 1:
        for n, text, image in reader(content, dpi, page):
            if n == page:
                return text, image
    raise IndexError(f"no page {page}")


def data_url(image: bytes) -> str:
    """An image as it is handed to a model."""
    return "data:image/png;base64," + base64.b64encode(image).decode("ascii")


def renderer(reader: PageReader) -> Callable[[dict, int], str]:
    """Makes the image of a request (path, page) anew at another resolution. The path must be a file that workers see."""

    def render(request: dict, dpi: int) -> str:
        with open(request["path"].removeprefix("file:"), "rb") as f:
            return data_url(page_of(f.read(), request["page"], dpi, reader)[1])

    return render


def count_pages(spark: SparkSession, folder: str, counter: Callable[[bytes], int], glob: str = "*.pdf") -> DataFrame:
    """``source_book, n_pages`` of the books of a folder; a book that can't be read has null pages."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = []
            for content in pdf["content"]:
                try:
                    counts.append(counter(bytes(content)))
                except Exception:
                    counts.append(None)
            yield pd.DataFrame({"source_book": [p.rsplit("/", 1)[-1] for p in pdf["path"]], "n_pages": pd.array(counts, dtype="Int32")})

    return files.mapInPandas(run, "source_book string, n_pages int")


def read_pages(spark: SparkSession, folder: str | list[str], reader: PageReader, glob: str = "*.pdf", dpi: int = 150, most: int = 10) -> DataFrame:
    """Pages of all books of a folder, or of the files of a list, text and image in one pass over each file. A book that can't be
    read is one row with the error."""
    files = spark.read.format("binaryFile")
    files = (files.option("pathGlobFilter", glob) if isinstance(folder, str) else files).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in PAGE_SCHEMA.split(", ")]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                book = path.rsplit("/", 1)[-1]
                try:
                    for n, text, image in reader(bytes(content), dpi, most):
                        yield pd.DataFrame([(path, book, n, text, image, dpi, None)], columns=columns)
                except Exception as e:
                    yield pd.DataFrame([(path, book, None, None, None, dpi, str(e))], columns=columns)

    return files.mapInPandas(run, PAGE_SCHEMA)
