"""The folder data source: listing, partitions, quarantine, streaming and writing."""

import os
import tempfile
import time

import pytest

from sifter.sources import corpus as S
from sifter.sources import folder as D
from test_cache_sources import _docx


@pytest.fixture
def folder():
    d = tempfile.mkdtemp(prefix="sifter-folder-")
    files = {
        "a.txt": b"  from txt  \n", "a.docx": _docx(["first para", "   ", "second para"]), "b.txt": b"   ",
        "c.TXT": b"upper case suffix", "d.txt": b"bad \xff\xfe bytes", "e.bin": b"ignored", ".g.txt": b"hidden",
        "f.pdf": b"%PDF-1.4 not parsed", "h 100%.txt": b"odd name", "i.docx": b"not a zip", "empty.txt": b"",
    }
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    os.mkdir(os.path.join(d, "sub.txt"))
    return d


def test_load_folder_equals_load_corpus(spark, folder):
    corpus, quarantine = D.load_folder(spark, "file:" + folder)
    plain, plain_quarantine = S.load_corpus(spark, folder)
    got = {r.name: r.text for r in corpus.collect()}
    assert got == {"a": "from txt", "c": "upper case suffix", "d": "bad  bytes", "h 100%": "odd name"}
    assert got == {r.name: r.text for r in plain.collect()}
    cols = ["name", "suffix", "error"]
    assert sorted(quarantine.select(cols).collect()) == sorted(plain_quarantine.select(cols).collect())
    assert {r.name for r in quarantine.collect()} == {"f", "i"}
    with_pdf, _ = D.load_folder(spark, folder, pdf_extractor=lambda b: b.decode()[9:])
    assert {r.name: r.text for r in with_pdf.collect()}["f"] == "not parsed"


def test_empty_folder(spark):
    corpus, quarantine = D.load_folder(spark, tempfile.mkdtemp(prefix="sifter-folder-"))
    assert corpus.count() == 0 and quarantine.count() == 0


def test_partitions_are_balanced_by_size():
    sizes = [900 << 20] + [50 << 20] * 10 + [1000] * 3000
    files = [D.Found(f"/x/{i}", n, i) for i, n in enumerate(sizes)]
    parts = D.balanced(files, 128 << 20)
    assert sorted(p for part in parts for p in part) == sorted(f.path for f in files)
    cost = {f.path: f.size + D.OPEN_COST for f in files}
    loads = sorted(sum(cost[p] for p in part) for part in parts)
    assert loads[-1] == cost["/x/0"]  # the huge file is alone
    assert loads[-2] - loads[0] <= 51 << 20  # the others differ by no more than one file
    assert D.balanced([]) == []


def test_vanished_file_goes_to_quarantine(folder):
    part = D.Files(folder, [f"{folder}/a.txt", f"{folder}/gone.txt"])
    rows = [r for b in D.extracted_batches(part, None) for r in b.to_pylist()]
    assert [(r["text"], r["error"]) for r in rows] == [("from txt", None), (None, "vanished after it was listed")]


def test_batches_are_bounded(folder, monkeypatch):
    monkeypatch.setattr(D, "BATCH_BYTES", 1000)
    for i in range(30):
        with open(f"{folder}/long{i}.txt", "w") as f:
            f.write("word " * 100)
    batches = list(D.extracted_batches(D.Files(folder, [f.path for f in D.listing(folder)]), None))
    assert len(batches) > 10 and all(b.num_rows <= 5 for b in batches)


def test_written_files_are_read_back(spark):
    out = tempfile.mkdtemp(prefix="sifter-folder-") + "/new"
    D.register(spark)
    long = "line of a long text\n" * 100_000
    rows = [("a", ".txt", " x \n y "), ("b", ".docx", "p <1>\n\n &\tp2\x01"), ("c", ".txt", None), ("d", ".docx", long), ("é ü", ".txt", "ñ")]
    df = spark.createDataFrame(rows, "name string, suffix string, text string")
    for _ in range(2):  # written again: the same files
        df.repartition(3).write.format(D.FORMAT).mode("append").save(out)
    corpus, quarantine = D.load_folder(spark, out)
    assert {r.name: r.text for r in corpus.collect()} == {"a": "x \n y", "b": "p <1>\n &\tp2", "d": long.strip(), "é ü": "ñ"}
    assert quarantine.count() == 0 and not [f for f in os.listdir(out) if f.startswith(".") and not f.endswith(".crc")]


def test_stream_reads_each_file_once_over_restarts(spark):
    base = tempfile.mkdtemp(prefix="sifter-folder-")
    inbox = base + "/in"
    os.mkdir(inbox)
    D.register(spark)

    def arrive(*names):
        for n in names:
            with open(f"{inbox}/{n}.txt", "w") as f:
                f.write(f"text of {n}")

    def run():
        q = (spark.readStream.format(D.FORMAT).option("settleSeconds", 0.2).load(inbox).writeStream.format("parquet")
             .option("checkpointLocation", base + "/ckpt").start(base + "/out"))
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(r.name for r in spark.read.parquet(base + "/out").collect())

    arrive("b", "c")
    time.sleep(0.4)
    assert run() == ["b", "c"]
    assert run() == ["b", "c"]
    arrive("a", "d")  # "a" sorts before what was read
    time.sleep(0.4)
    assert run() == ["a", "b", "c", "d"]


def test_young_files_wait(folder):
    stream = D.FolderStream({"path": folder, "settleSeconds": "3600"}, None)
    assert stream.latestOffset() == stream.initialOffset()
    assert stream.partitions(stream.initialOffset(), stream.latestOffset()) == []
