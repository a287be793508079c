"""Corpus ingest from a folder of files.

``binaryFile`` lists the folder (not recursive) and reads the bytes on the
executors; the suffix filter is case-insensitive on ``.pdf/.docx/.txt``. Text is
extracted per file in ``mapInPandas`` (the bytes never pass through the driver):

* ``.txt``: UTF-8, undecodable bytes dropped, outer whitespace stripped;
* ``.docx``: the body's own paragraphs in ``word/document.xml`` (not those in tables), tabs
  and breaks kept (standard-library ``zipfile`` + XML parser), blank ones dropped, joined
  with newlines, stripped;
* ``.pdf``: an extractor passed by the caller (``bytes -> str``); without one the
  file goes to the quarantine with a reason.

Files that cannot be read are returned in the quarantine frame instead of
failing the job. Empty texts are dropped, and documents are keyed by file stem,
the last path in sorted order winning when several files share a stem.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TT

from sifter.operators.common import materialize, numbered
from sifter.session import ensure_workers

SUFFIXES = (".pdf", ".docx", ".txt")
WORD_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
WORD_BREAKS = {f"{WORD_NS}tab": "\t", f"{WORD_NS}br": "\n", f"{WORD_NS}cr": "\n"}

EXTRACTED = TT.StructType([
    TT.StructField("path", TT.StringType()),
    TT.StructField("name", TT.StringType()),
    TT.StructField("suffix", TT.StringType()),
    TT.StructField("text", TT.StringType()),
    TT.StructField("error", TT.StringType()),
])


def txt_text(data: bytes) -> str:
    return data.decode("utf-8", errors="ignore").strip()


def docx_text(data: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{WORD_NS}body")
    paras = []
    for p in body.findall(f"{WORD_NS}p") if body is not None else ():
        t = "".join(node.text or "" if node.tag == f"{WORD_NS}t" else WORD_BREAKS.get(node.tag, "") for node in p.iter())
        if t.strip():
            paras.append(t)
    return "\n".join(paras).strip()


def _file_parts(path: str) -> tuple[str, str]:
    return split_name(posixpath.basename(unquote(path)))


def split_name(base: str) -> tuple[str, str]:
    """A file's stem and its suffix in lower case."""
    stem, dot, ext = base.rpartition(".")
    if not dot or not stem:
        return base, ""
    return stem, "." + ext.lower()


def extract_one(suffix: str, content: bytes, pdf_extractor: Callable[[bytes], str] | None = None) -> tuple[str | None, str | None]:
    """S2-S5 for one file: (text, None) or (None, reason)."""
    try:
        if suffix == ".txt":
            return txt_text(content), None
        if suffix == ".docx":
            return docx_text(content), None
        if suffix == ".pdf":
            if pdf_extractor is None:
                return None, "no PDF extractor configured"
            return (pdf_extractor(content) or "").strip(), None
        return None, f"unsupported format: {suffix}"
    except Exception as e:  # noqa: BLE001 - quarantined, not fatal
        return None, f"{type(e).__name__}: {e}"


def extract_files(pdf_extractor: Callable[[bytes], str] | None = None):
    """The ``mapInPandas`` function (S2-S5): (path, content) batches -> EXTRACTED rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name, suffix = _file_parts(path)
                rows.append((path, name, suffix, *extract_one(suffix, content, pdf_extractor)))
            yield pd.DataFrame(rows, columns=[f.name for f in EXTRACTED.fields])

    return run


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """S1 listing: the folder's files with a supported suffix (any case), not recursive."""
    any_case = ",".join("*." + "".join(f"[{c}{c.upper()}]" for c in suffix[1:]) for suffix in SUFFIXES)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
            .option("pathGlobFilter", "{" + any_case + "}").load(folder).select("path", "content"))


def load_corpus(spark: SparkSession, folder: str,
                pdf_extractor: Callable[[bytes], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(corpus (name, path, text), quarantine (path, name, suffix, error))``.

    The corpus has one row per file stem: the last file in path order among those
    with non-empty text."""
    ensure_workers(spark)
    files = read_files(spark, folder)
    return split_extracted(materialize(files.mapInPandas(extract_files(pdf_extractor), EXTRACTED)))  # each file is parsed once


def split_extracted(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``load_corpus``'s two frames from EXTRACTED rows."""
    quarantine = extracted.where(F.col("error").isNotNull()).select("path", "name", "suffix", "error")
    ok = extracted.where(F.col("error").isNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    last = ok.groupBy("name").agg(F.max("path").alias("path"))  # a common stem moves paths, not texts
    return ok.join(last, ["name", "path"]).select("name", "path", "text"), quarantine


def corpus_counts(corpus: DataFrame) -> DataFrame:
    """Documents per format."""
    suffix = F.lower(F.regexp_extract(F.col("path"), r"(\.[^./]+)$", 1))
    return corpus.groupBy(suffix.alias("suffix")).agg(F.count(F.lit(1)).alias("n_docs"))


def with_doc_ids(corpus: DataFrame) -> DataFrame:
    """BIGINT ids for a named corpus, for the id-keyed operators: 0, 1, ... in name order, so
    no two documents share one. The same names get the same ids."""
    return numbered(corpus, "doc_id", "name")
