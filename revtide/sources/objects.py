"""Stored objects as tables, and the create-only copy between mounted folders."""

from __future__ import annotations

import contextlib
import hashlib
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.verdicts import Refused

#: Bytes of an object that a task holds at once, and bytes of objects for one task.
CHUNK_BYTES = 8 << 20
TASK_BYTES = 1 << 30

COPY_RESULT = (
    "seq long, key string, bytes long, action string, phase string, cause string"
)


def list_objects(spark: SparkSession, root: str, store: str) -> DataFrame:
    """``store, key, digest, bytes`` of the files under ``root``; content stays in its task.

    Spark's file source passes over zero-length files; ``verify_objects`` sees them.
    """
    root = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    bare = root.split(":", 1)[1].lstrip("/") if ":" in root else root.lstrip("/")
    key = F.substring_index("path", f"{bare}/", -1)
    return files.select(
        F.lit(store).alias("store"),
        key.alias("key"),
        F.sha2("content", 256).alias("digest"),
        F.col("length").alias("bytes"),
    )


def _mounted(root: str) -> str:
    path = root.removeprefix("file://").removeprefix("file:")
    if ":" in path.split("/", 1)[0]:
        raise Refused("objects are copied between mounted folders")
    return path.rstrip("/")


class Unread(Exception):
    """An object could not be read; the argument says why."""


def _chunks(path: str, size: int) -> Iterator[bytes]:
    try:
        if os.path.getsize(path) != size:
            raise Unread("length_mismatch")
        with open(path, "rb") as file:
            while chunk := file.read(CHUNK_BYTES):
                yield chunk
    except FileNotFoundError:
        raise Unread("missing") from None
    except PermissionError:
        raise Unread("denied") from None


def _sent(path: str, size: int, to=None) -> tuple[str | None, str | None]:
    """(digest, fault) of the object at ``path``, read in chunks and written on to the file ``to``."""
    read, digest, chunks = 0, hashlib.sha256(), _chunks(path, size)
    while True:
        try:
            chunk = next(chunks, None)
        except Unread as fault:
            return None, str(fault)
        except OSError:
            return None, "backend"
        if chunk is None:
            break
        read += len(chunk)
        digest.update(chunk)
        if to is not None:
            to.write(chunk)
    return (digest.hexdigest(), None) if read == size else (None, "length_mismatch")


def _fault(path: str, digest: str, size: int) -> str | None:
    """Why the object at ``path`` is not the listed one; NULL if it is."""
    found, fault = _sent(path, size)
    return fault or (None if found == digest else "digest_mismatch")


def _cause(fault: str | None) -> str | None:
    """A mismatch of any kind is an integrity failure to the recovery."""
    return "integrity" if fault in ("length_mismatch", "digest_mismatch") else fault


def _inside(key: str | None) -> bool:
    return bool(key) and os.path.normpath(key) == key and not key.startswith(("/", "..")) and key != "."


def _number(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _valid(key: str | None, digest: str | None, size: int | None) -> bool:
    """An entry that can be looked up at all: a key inside the folder, a digest and a length."""
    return _inside(key) and digest is not None and size is not None and size >= 0


def _publish(source: str, path: str, digest: str, size: int) -> tuple[str | None, str | None]:
    """Create without overwriting: (``created`` or ``existing``, fault of the source)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    partial = f"{path}.{uuid.uuid4().hex}.partial"
    try:
        with open(partial, "xb") as file:
            found, fault = _sent(source, size, file)
            if fault or found != digest:
                return None, fault or "digest_mismatch"
            file.flush()
            os.fsync(file.fileno())
        # A hard link appears complete or not at all, and fails if the name is taken.
        os.link(partial, path)
        return "created", None
    except FileExistsError:
        return "existing", None
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(partial)


def _spread(manifest: DataFrame, tasks: int | None) -> DataFrame:
    """The entries dealt out by key, by default to as many tasks as their bytes ask for."""
    entries = manifest.select("seq", "key", "digest", "bytes")
    if tasks is None:
        total = entries.agg(F.sum(F.col("bytes").cast("decimal(38,0)")).alias("n")).first().n or 0
        parallel = entries.sparkSession.sparkContext.defaultParallelism
        tasks = max(parallel, -(-int(total) // TASK_BYTES))
    return entries.repartition(tasks, "key")


def copy_objects(
    manifest: DataFrame, source: str, destination: str, tasks: int | None = None
) -> DataFrame:
    """Copy every listed object unless the destination already has it: one result per entry.

    ``manifest``: ``seq, key, digest, bytes``. Equal content is ``existing``; other content
    under the key is an ``integrity`` failure and is neither overwritten nor deleted. An entry without key, digest
    or length, or with a key outside the folder, is ``invalid``. Each
    created object is read back, in chunks like every other. Results (not content) are what is returned; a task that
    runs twice finds its own objects and reports them as existing.
    """
    from_root, to_root = _mounted(source), _mounted(destination)

    def entry(seq, key, digest, size):
        def result(action=None, phase=None, cause=None):
            return (seq, key, size, action, phase, cause)

        if not _valid(key, digest, size):
            return result(phase="destination_read", cause="invalid")
        target = f"{to_root}/{key}"
        fault = _fault(target, digest, size)
        if fault is None:
            return result("existing")
        if fault != "missing":
            return result(phase="destination_read", cause=_cause(fault))
        try:
            action, fault = _publish(f"{from_root}/{key}", target, digest, size)
            if fault is not None:
                return result(phase="source_read", cause=_cause(fault))
        except PermissionError:
            return result(phase="create", cause="denied")
        except OSError:
            return result(phase="create", cause="unknown")
        fault = _fault(target, digest, size)
        if fault is not None:
            return result(phase="destination_verify", cause=_cause(fault))
        return result(action)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["seq", "key", "bytes", "action", "phase", "cause"]
        for batch in batches:
            rows = [
                entry(_number(s), k, d, _number(b))
                for s, k, d, b in zip(batch["seq"], batch["key"], batch["digest"], batch["bytes"])
            ]
            yield pd.DataFrame(rows, columns=columns).astype({"seq": "Int64", "bytes": "Int64"})

    return _spread(manifest, tasks).mapInPandas(run, COPY_RESULT)


def verify_objects(manifest: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Read every listed object under a mounted folder: ``seq, key, bytes, status``.

    Listed entries only, each read by the task that holds its entry; empty objects count.
    """
    mounted = _mounted(root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            statuses = [
                (_fault(f"{mounted}/{k}", d, b) or "ok") if _valid(k, d, b) else "invalid"
                for k, d, b in zip(batch["key"], batch["digest"], map(_number, batch["bytes"]))
            ]
            yield batch[["seq", "key", "bytes"]].assign(status=statuses)

    return _spread(manifest, tasks).mapInPandas(run, "seq long, key string, bytes long, status string")
