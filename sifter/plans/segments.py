"""A prepared corpus that grows (V1): appended segments, tombstones, compaction.

``<path>/segments/<name>/<part>`` holds the parts of ``analysis.Prepared`` for the documents of one ``add``,
``<path>/tombstones/<name>`` the ids of one ``delete`` (or those that an ``add`` replaces), and
``<path>/manifest/<version>.json`` says which of them make up a version. Only new documents are
worked out; nothing stored is rewritten before ``compact``.

* A segment and a tombstone table carry the version that made them. A tombstone takes its
  ids out of *older* segments only, so that a document may be added again. Reading is one
  scan a part with an anti join on the ids, broadcast after a size check.
* The manifest appears last and under its final name at once: a reader sees whole versions, a
  version once read stays readable until ``vacuum``, and what a failed ``add`` wrote is in no version.
  One writer at a time: a version that exists already is an error.
* ``compact`` merges the newest segments while the next older one has at most ``ratio`` times their
  rows, so that a row is rewritten about log(rows) times over all adds and there are about log(rows) segments.
  Tombstones that no older segment is left for are dropped.

Rows with a NULL id are left out. An ``add`` or ``delete`` of an empty table is a version like any
other; ids that are not there are ignored by ``delete``. Rows that repeat an id within one ``add`` are all kept, as
``write_corpus`` does. Other columns are kept in ``rows``; segments without one of them have NULL.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, fields
from functools import reduce

import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.operators.common import bounded_broadcast
from sifter.params import Params
from sifter.plans.analysis import Prepared, derive_corpus
from sifter.sources.folder import filesystem

PARTS = [part.name for part in fields(Prepared)]


@dataclass(frozen=True)
class Stored:
    """A segment or a tombstone table: its folder, the version that made it, and its rows."""

    name: str
    version: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    segments: list[Stored] = field(default_factory=list)
    tombstones: list[Stored] = field(default_factory=list)


def versions(path: str) -> list[int]:
    fs, base = filesystem(path)
    found = fs.get_file_info(pfs.FileSelector(f"{base}/manifest", allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[0] != ".")


def read_manifest(path: str, version: int | None = None) -> Manifest:
    """A version's manifest (default: the latest; an empty one where nothing is stored)."""
    known = versions(path)
    if not known and version is None:
        return Manifest()
    fs, base = filesystem(path)
    with fs.open_input_stream(f"{base}/manifest/{known[-1] if version is None else version:012d}.json") as f:
        m = json.loads(f.read())
    return Manifest(m["version"], [Stored(**s) for s in m["segments"]], [Stored(**s) for s in m["tombstones"]])


def _publish(path: str, m: Manifest) -> Manifest:
    fs, base = filesystem(path)
    fs.create_dir(f"{base}/manifest", recursive=True)
    name, hidden = f"{base}/manifest/{m.version:012d}.json", f"{base}/manifest/.{uuid.uuid4().hex}"
    if fs.get_file_info(name).type != pfs.FileType.NotFound:
        raise RuntimeError(f"version {m.version} of {path} was written by someone else")
    with fs.open_output_stream(hidden) as f:
        f.write(json.dumps(asdict(m)).encode())
    fs.move(hidden, name)
    return m


def _scan(spark: SparkSession, path: str, kind: str, stored: list[Stored], part: str = "") -> DataFrame | None:
    tables = [spark.read.parquet(f"{path}/{kind}/{s.name}{part}").withColumn("__version", F.lit(s.version)) for s in stored]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables) if tables else None


def _live(spark: SparkSession, path: str, m: Manifest, segments: list[Stored], d_id: str) -> Prepared:
    """The parts of the given segments without the documents that later tombstones take out."""
    oldest = min(s.version for s in segments)
    gone = _scan(spark, path, "tombstones", [t for t in m.tombstones if t.version > oldest and t.rows])
    if gone is not None:
        gone = gone.groupBy(F.col(d_id).alias("__gone")).agg(F.max("__version").alias("__when"))
        gone, _ = bounded_broadcast(gone, 1_000_000)
    parts = []
    for name in PARTS:
        part = _scan(spark, path, "segments", segments, f"/{name}")
        if gone is not None:
            part = part.join(gone, (F.col(d_id) == F.col("__gone")) & (F.col("__version") < F.col("__when")), "left_anti")
        parts.append(part.drop("__version"))
    return Prepared(*parts)


def read_segments(spark: SparkSession, path: str, d_id: str, version: int | None = None) -> Prepared:
    """A version of the corpus (default: the latest) for ``analysis.compare_corpus``."""
    m = read_manifest(path, version)
    if not m.segments:
        raise FileNotFoundError(f"no segments below {path}")
    return _live(spark, path, m, m.segments, d_id)


def _write_segment(parts: Prepared, path: str, version: int) -> Stored:
    name = uuid.uuid4().hex
    for part in PARTS:
        getattr(parts, part).write.parquet(f"{path}/segments/{name}/{part}")
    rows = parts.rows.sparkSession.read.parquet(f"{path}/segments/{name}/rows").count()
    return Stored(name, version, rows)


def _write_tombstones(ids: DataFrame, path: str, version: int) -> list[Stored]:
    name = uuid.uuid4().hex
    ids.write.parquet(f"{path}/tombstones/{name}")
    rows = ids.sparkSession.read.parquet(f"{path}/tombstones/{name}").count()
    return [Stored(name, version, rows)] if rows else []


def add(docs: DataFrame, d_id: str, params: Params, path: str, **how) -> Manifest:
    """Works out and appends ``docs`` (id, text, other columns). Documents whose id is stored are
    replaced. ``how`` goes to ``derive_corpus`` (encoder, cache)."""
    spark, m = docs.sparkSession, read_manifest(path)
    docs = docs.where(F.col(d_id).isNotNull())
    segment = _write_segment(derive_corpus(docs, d_id, params, **how), path, m.version + 1)
    replaced: list[Stored] = []
    if m.segments:
        new = spark.read.parquet(f"{path}/segments/{segment.name}/rows").select(d_id).distinct()
        live = _live(spark, path, m, m.segments, d_id).rows.select(d_id)
        replaced = _write_tombstones(new.join(live, d_id, "left_semi"), path, m.version + 1)
    return _publish(path, Manifest(m.version + 1, [*m.segments, segment], [*m.tombstones, *replaced]))


def delete(ids: DataFrame, d_id: str, path: str) -> Manifest:
    """Takes the documents with these ids out."""
    spark, m = ids.sparkSession, read_manifest(path)
    gone: list[Stored] = []
    if m.segments:
        live = _live(spark, path, m, m.segments, d_id).rows.select(d_id).distinct()
        gone = _write_tombstones(live.join(ids.select(d_id), d_id, "left_semi"), path, m.version + 1)
    return _publish(path, Manifest(m.version + 1, m.segments, [*m.tombstones, *gone]))


def compact(spark: SparkSession, path: str, d_id: str, ratio: float = 1.0) -> Manifest:
    """Merges the newest segments (all of them with ``ratio=float("inf")``); the corpus stays the same."""
    m = read_manifest(path)
    if not m.segments:
        return m
    order = sorted(m.segments, key=lambda s: s.version)
    keep, merge = order[:-1], order[-1:]
    while keep and keep[-1].rows <= ratio * sum(s.rows for s in merge):
        merge.insert(0, keep.pop())
    touched = any(t.version > merge[0].version for t in m.tombstones)
    if len(merge) == 1 and not touched:
        return m
    segment = _write_segment(_live(spark, path, m, merge, d_id), path, m.version + 1)
    oldest = keep[0].version if keep else segment.version
    return _publish(path, Manifest(m.version + 1, [*keep, segment], [t for t in m.tombstones if keep and t.version > oldest]))


def vacuum(path: str, keep_versions: int = 1) -> list[str]:
    """Deletes the manifests but the last ``keep_versions`` and every folder that none of those
    names, also what failed calls left behind. Not while a writer is at work."""
    fs, base = filesystem(path)
    known = versions(path)
    kept = [read_manifest(path, v) for v in known[-keep_versions:]]
    for v in known[:-keep_versions]:
        fs.delete_file(f"{base}/manifest/{v:012d}.json")
    gone = []
    for kind in ("segments", "tombstones"):
        named = {s.name for m in kept for s in getattr(m, kind)}
        for f in fs.get_file_info(pfs.FileSelector(f"{base}/{kind}", allow_not_found=True)):
            if f.type == pfs.FileType.Directory and f.base_name not in named:
                fs.delete_dir(f.path)
                gone.append(f"{kind}/{f.base_name}")
    return sorted(gone)
