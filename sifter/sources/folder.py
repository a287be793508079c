"""A folder of documents as a Spark data source (S1-S5, S7): batch, streaming and write.

``spark.read.format("corpus_folder").load(folder)`` gives one EXTRACTED row a file, as
``corpus.read_files`` with ``extract_files`` does, but:

* files are dealt to partitions by size (the next largest to the lightest partition), a file
  counting its bytes and ``OPEN_COST``, so that neither a few large nor very many small files make a slow task;
* a task holds one file and ``BATCH_BYTES`` of texts. A file that vanished since the listing goes to the
  quarantine; other read errors fail the task, which Spark runs again;
* ``spark.readStream`` reads files as they arrive. The offset is the (modification time, path) of the last
  listed file. Files younger than the option ``settleSeconds`` (default 1) wait, so that none
  is read half written or passed over by a file of the same instant. A changed file is read again;
  a file moved in with an older time than the offset is not seen (touch it).

Writing (``df.write.format("corpus_folder").mode("append").save(folder)``, columns ``name``, ``suffix``, ``text``) makes a
file a row: ``.docx`` with a paragraph a line, without the characters that XML forbids, else
UTF-8. Each appears whole under its name (a hidden file is renamed), so that a task that runs again
leaves the same files. NULL names and names with a slash are errors, a NULL text is an empty file.

The folder is listed by one process and not recursively; names that begin with a dot or an underscore
are passed over. Paths are those ``pyarrow.fs`` reads: local, ``file:``, ``hdfs:``, ``s3:``.
"""

from __future__ import annotations

import heapq
import io
import math
import re
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from sifter.operators.common import materialize
from sifter.session import ensure_workers
from sifter.sources.corpus import EXTRACTED, SUFFIXES, WORD_NS, extract_one, split_extracted, split_name

FORMAT = "corpus_folder"
PARTITION_BYTES = 128 << 20
OPEN_COST = 1 << 20
BATCH_BYTES = 8 << 20
ARROW = pa.schema([(f.name, pa.string()) for f in EXTRACTED.fields])
NOT_XML = re.compile("[^\t\n\r\u0020-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


@dataclass(frozen=True)
class Found:
    """A listed file."""

    path: str
    size: int
    mtime: int

    @property
    def mark(self) -> tuple[int, str]:
        return self.mtime, self.path


@dataclass
class Files(InputPartition):
    """The files of one task."""

    folder: str
    paths: list[str]


def filesystem(folder: str) -> tuple[pfs.FileSystem, str]:
    return pfs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def listing(folder: str) -> list[Found]:
    """The folder's files with a supported suffix (any case), by path."""
    fs, base = filesystem(folder)
    found = [Found(f.path, f.size or 0, f.mtime_ns or 0) for f in fs.get_file_info(pfs.FileSelector(base))
             if f.type == pfs.FileType.File and f.base_name[0] not in "._" and split_name(f.base_name)[1] in SUFFIXES]
    return sorted(found, key=lambda f: f.path)


def balanced(files: list[Found], partition_bytes: int = PARTITION_BYTES) -> list[list[str]]:
    """Files dealt to partitions of about ``partition_bytes``: the next largest to the lightest."""
    if not files:
        return []
    n = min(len(files), math.ceil(sum(f.size + OPEN_COST for f in files) / partition_bytes))
    parts: list[list[str]] = [[] for _ in range(n)]
    heap = [(0, i) for i in range(n)]
    for f in sorted(files, key=lambda f: (-f.size, f.path)):
        load, i = heapq.heappop(heap)
        parts[i].append(f.path)
        heapq.heappush(heap, (load + f.size + OPEN_COST, i))
    return parts


def extracted_batches(part: Files, pdf_extractor: Callable[[bytes], str] | None) -> Iterator[pa.RecordBatch]:
    fs, _ = filesystem(part.folder)
    rows, held = [], 0
    for path in part.paths:
        name, suffix = split_name(path.rsplit("/", 1)[-1])
        try:
            with fs.open_input_stream(path) as f:
                text, error = extract_one(suffix, f.read(), pdf_extractor)
        except FileNotFoundError:
            text, error = None, "vanished after it was listed"
        rows.append((path, name, suffix, text, error))
        held += len(text or "") + 200
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=ARROW)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=ARROW)


class FolderReader(DataSourceReader):
    def __init__(self, options, pdf_extractor):
        self.folder, self.pdf_extractor = options["path"], pdf_extractor
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Files]:
        return [Files(self.folder, paths) for paths in balanced(listing(self.folder), self.partition_bytes)] or [Files(self.folder, [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return extracted_batches(partition, self.pdf_extractor)


class FolderStream(DataSourceStreamReader):
    def __init__(self, options, pdf_extractor):
        self.folder, self.pdf_extractor = options["path"], pdf_extractor
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.settle_ns = int(float(options.get("settleSeconds", 1)) * 1e9)
        self.last = (-1, "")

    def initialOffset(self) -> dict:
        return {"mtime": -1, "path": ""}

    def latestOffset(self) -> dict:
        settled = time.time_ns() - self.settle_ns
        self.last = max([self.last, *(f.mark for f in listing(self.folder) if f.mtime <= settled)])
        return {"mtime": self.last[0], "path": self.last[1]}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        after, upto = (start["mtime"], start["path"]), (end["mtime"], end["path"])
        self.last = max(self.last, upto)  # a restarted query goes on from here
        new = [f for f in listing(self.folder) if after < f.mark <= upto]
        return [Files(self.folder, paths) for paths in balanced(new, self.partition_bytes)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return extracted_batches(partition, self.pdf_extractor)

    def commit(self, end: dict) -> None:
        """Nothing is kept for read files."""


def docx_bytes(text: str) -> bytes:
    """A document with a paragraph a line, readable by ``docx_text``."""
    paragraphs = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in NOT_XML.sub("", text).split("\n"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{WORD_NS[1:-1]}"><w:body>{paragraphs}</w:body></w:document>')
    return out.getvalue()


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.folder = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, base = filesystem(self.folder)
        fs.create_dir(base, recursive=True)
        for batch in iterator:
            for name, suffix, text in zip(*(batch.column(c) for c in ("name", "suffix", "text"))):
                name, suffix, text = name.as_py(), suffix.as_py() or "", text.as_py() or ""
                if not name or "/" in name + suffix:
                    raise ValueError(f"not a file name: {name!r}{suffix}")
                hidden = f"{base}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(hidden) as f:
                    f.write(docx_bytes(text) if suffix.lower() == ".docx" else text.encode())
                fs.move(hidden, f"{base}/{name}{suffix}")
        return WriterCommitMessage()


def folder_source(pdf_extractor: Callable[[bytes], str] | None = None) -> type[DataSource]:
    """The data source to register, with the PDF extractor built in."""

    class CorpusFolder(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> StructType:
            return EXTRACTED

        def reader(self, schema: StructType) -> FolderReader:
            return FolderReader(self.options, pdf_extractor)

        def streamReader(self, schema: StructType) -> FolderStream:
            return FolderStream(self.options, pdf_extractor)

        def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
            if overwrite:
                raise ValueError("a folder of documents is only appended to")
            return FolderWriter(self.options)

    return CorpusFolder


def register(spark: SparkSession, pdf_extractor: Callable[[bytes], str] | None = None) -> None:
    ensure_workers(spark)
    spark.dataSource.register(folder_source(pdf_extractor))


def load_folder(spark: SparkSession, folder: str, pdf_extractor: Callable[[bytes], str] | None = None,
                partition_bytes: int = PARTITION_BYTES) -> tuple[DataFrame, DataFrame]:
    """``corpus.load_corpus`` by this source: (corpus, quarantine), each file parsed once."""
    register(spark, pdf_extractor)
    return split_extracted(materialize(spark.read.format(FORMAT).option("partitionBytes", partition_bytes).load(folder)))
