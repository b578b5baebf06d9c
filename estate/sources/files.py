"""File scans, content hashes and distributed copies.

Folders are listed and files are read by the executors through Arrow's file systems, so
roots are any URI those can open; on one machine plain local paths.  Spark's own file
sources would list everything on the driver and leave out empty files and names that
start with ``_`` or ``.``.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import itertools
import os
import stat
import sys
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions import classify, paths
from estate.functions.measures import wall
from estate.operators.ordering import number_in_place
from estate.session import durable

# the small helpers below travel with their tasks; executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 8 * 1024 * 1024
#: bytes of files for a task, and what opening a file weighs beside them
TASK_BYTES, OPENING_BYTES = 1 << 30, 1 << 20
#: files above this are copied in parts of this size
PART_BYTES = 4 << 30


def _tasks(spark: SparkSession, asked: int | None = None) -> int:
    return asked or spark.sparkContext.defaultParallelism


def scan_files(spark: SparkSession, root: str, tasks: int | None = None, unreadable: str = "fail") -> DataFrame:
    """One row per regular file below ``root``, empty and hidden ones too; contents are not read.

    One job per folder level: the folders of a level are dealt out over ``tasks`` and listed in parallel, and what a folder
    holds leaves the worker in batches.  On mounted file systems entries are taken one by one, so a flat folder of any size
    needs little memory; other file systems hand over a folder at once.  Each level is written to a table, so the result is
    a fixed snapshot.  A root that does not exist is an error; a folder that goes meanwhile holds nothing.

    A folder or an entry that cannot be read ends the scan.  With ``unreadable="rows"`` it is one row instead, which names it
    and says why in a further column ``error`` (null for files), and the rest is listed.
    """
    if unreadable not in ("fail", "rows"):
        raise ValueError("unreadable is 'fail' or 'rows'")
    schema = "relative_path string, is_folder boolean, size_bytes bigint, modified_us bigint, error string"
    folders = spark.range(1).select(F.lit("").alias("relative_path"))
    found = None
    while True:
        level = durable(folders.repartition(_tasks(spark, tasks)).mapInArrow(_list_task(root, unreadable == "rows"), schema))
        found = level if found is None else found.unionByName(level)
        folders = level.filter("is_folder").select("relative_path")
        if folders.isEmpty():
            break
    kept = found.filter("NOT is_folder").withColumn("modified_ts", wall(F.timestamp_micros("modified_us")))
    return kept.select("relative_path", "size_bytes", "modified_ts", *(["error"] if unreadable == "rows" else []))


def _list_task(root: str, report: bool):
    columns = pa.schema(
        [("relative_path", pa.string()), ("is_folder", pa.bool_()), ("size_bytes", pa.int64()), ("modified_us", pa.int64()), ("error", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import LocalFileSystem

        filesystem, base = _open_fs(root)
        entries = _local_entries if isinstance(filesystem, LocalFileSystem) else functools.partial(_entries, filesystem)

        def rows():
            for folder in _values(batches, "relative_path"):
                try:
                    for name, is_folder, size, modified, error in entries(f"{base}/{folder}".rstrip("/") or "/", folder == ""):
                        if error is not None and not report:
                            raise OSError(f"{folder}/{name}: {error}")
                        yield f"{folder}/{name}".lstrip("/"), is_folder, size, modified, error
                except OSError as problem:
                    if not report or folder == "":
                        raise
                    yield folder, False, None, None, str(problem)

        return _in_batches(rows(), columns)

    return run


def _entries(filesystem, folder: str, must_exist: bool) -> Iterator[tuple]:
    """``(name, is_folder, size, modified_us, error)`` of what a folder holds."""
    from pyarrow.fs import FileSelector, FileType

    for e in filesystem.get_file_info(FileSelector(folder, allow_not_found=not must_exist)):
        if e.type in (FileType.File, FileType.Directory):
            yield e.base_name, e.type == FileType.Directory, e.size, e.mtime_ns // 1000 if e.mtime_ns else None, None


def _local_entries(folder: str, must_exist: bool) -> Iterator[tuple]:
    """As ``_entries``, one by one: the folder is never held whole."""
    try:
        listing = os.scandir(folder)
    except FileNotFoundError:
        if must_exist:
            raise
        return
    with listing:
        for e in listing:
            name = os.fsencode(e.name).decode("utf-8", "replace")
            try:
                there = e.stat()
            except FileNotFoundError:
                continue
            except OSError as problem:
                yield name, False, None, None, str(problem)
                continue
            if not (stat.S_ISDIR(there.st_mode) or stat.S_ISREG(there.st_mode)):
                continue
            problem = None if os.fsencode(e.name) == name.encode() else "the name is no UTF-8"
            is_folder = stat.S_ISDIR(there.st_mode) and problem is None
            yield name, is_folder, None if problem or is_folder else there.st_size, there.st_mtime_ns // 1000, problem


def scan_files_filtered(spark: SparkSession, root: str, transfer_types_only: bool = True, unreadable: str = "fail") -> DataFrame:
    """``scan_files`` without dot-files and, by default, only the transferred file types; rows with an ``error`` stay."""
    name = paths.file_name("relative_path")
    found = scan_files(spark, root, unreadable=unreadable)
    wanted = ~F.startswith(name, F.lit("."))
    if transfer_types_only:
        wanted = wanted & classify.is_transfer_type(name)
    return found.filter(wanted | F.col("error").isNotNull() if unreadable == "rows" else wanted)


def deal_by_bytes(rows: DataFrame, path: str, tasks: int | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows in tasks of about equal bytes by ``size_bytes``; without that column, dealt evenly by count.

    A file weighs its bytes and a fixed part for opening it.  Running totals of the weight, in order of path, cut the rows into
    tasks of ``task_bytes``, or into ``tasks``, no fewer than there are cores and no more than there are files; so a task holds at most that weight and
    the file that crosses it.  Unknown sizes weigh the fixed part.
    """
    spark = rows.sparkSession
    if "size_bytes" not in rows.columns:
        return rows.repartition(_tasks(spark, tasks))
    rows = durable(rows)  # both passes must see the same files
    weight = F.coalesce(F.greatest("size_bytes", F.lit(0)), F.lit(0)) + F.lit(OPENING_BYTES)
    total, count = rows.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count(F.lit(1))).first()
    n = tasks or max(1, min(count, max(_tasks(spark), -(-total // task_bytes))))
    share = max(1, -(-total // n))
    placed = number_in_place(rows, [path, "size_bytes"], sums={"_until": weight}, ordinal="_place")
    # the middle of a file decides: one that is larger than a share does not drag its neighbours along
    task = F.least(F.lit(n - 1), F.floor((F.col("_until") - weight / 2) / share)).cast("int")
    return placed.repartitionById(n, task).select(*rows.columns)


def content_checksum(inventory: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """``(relative_path, checksum, error)`` for every inventory row.

    Files are dealt out by their bytes if the inventory knows ``size_bytes``, else by count, and read in chunks, so none is ever
    held whole.  An MD5 has one order, so one file is one task's work.  A file that cannot be read has a null checksum and an
    error text.
    """
    known = [c for c in ("relative_path", "size_bytes") if c in inventory.columns]
    dealt = deal_by_bytes(inventory.select(*known), "relative_path", tasks)
    return dealt.select("relative_path").mapInArrow(_hash_task(root), "relative_path string, checksum string, error string")


def _open_fs(root: str):
    from pyarrow import fs

    filesystem, base = fs.FileSystem.from_uri(root)
    return filesystem, base.rstrip("/")


def _values(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[str]:
    for batch in batches:
        yield from batch.column(column).to_pylist()


def _in_batches(rows: Iterator[tuple], columns: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, so that results leave the worker while it goes on."""
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(v), f.type) for v, f in zip(zip(*part), columns)], schema=columns
        )


def _chunks(filesystem, path: str) -> Iterator[bytes]:
    with filesystem.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK):
            yield chunk


def _md5(filesystem, path: str) -> str:
    digest = hashlib.md5()
    for chunk in _chunks(filesystem, path):
        digest.update(chunk)
    return digest.hexdigest()


def _hash_task(root: str):
    columns = pa.schema([("relative_path", pa.string()), ("checksum", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _open_fs(root)

        def rows():
            for path in _values(batches, "relative_path"):
                try:
                    yield path, _md5(filesystem, f"{base}/{path}"), None
                except OSError as problem:
                    yield path, None, str(problem)

        return _in_batches(rows(), columns)

    return run


def write_files(content: DataFrame, root: str) -> DataFrame:
    """Write one file per row of ``(relative_path, content)``; returns path and size."""
    columns = pa.schema([("relative_path", pa.string()), ("size_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _open_fs(root)
        made: set[str] = set()

        def rows():
            for batch in batches:
                for path, data in zip(batch.column("relative_path").to_pylist(), batch.column("content").to_pylist()):
                    _put(filesystem, f"{base}/{path}", [data], made)
                    yield path, len(data)

        return _in_batches(rows(), columns)

    return content.select("relative_path", "content").mapInArrow(run, "relative_path string, size_bytes bigint")


def _put(filesystem, path: str, chunks, made: set[str]) -> None:
    """Write under a temporary name and rename, so a repeated task leaves a whole file."""
    folder, _, name = path.rpartition("/")
    if folder not in made:
        filesystem.create_dir(folder, recursive=True)
        made.add(folder)
    partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with filesystem.open_output_stream(partial) as out:
            for chunk in chunks:
                out.write(chunk)
        filesystem.move(partial, path)
    except OSError:
        if filesystem.get_file_info(partial).is_file:
            filesystem.delete_file(partial)
        raise


OUTCOME_SCHEMA = (
    "path string, status string, skipped boolean, error string, size_bytes bigint, attempt int, checksum string"
)


def copy_files(
    manifest: DataFrame,
    source_root: str,
    target_root: str,
    attempts: int = 3,
    concurrency: int | None = None,
    verify_md5: bool = False,
    backoff_seconds: float = 1.0,
    overwrite: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Copy the files of a manifest ``(path)`` and return one outcome row per file.

    A target of the same size is skipped, with ``verify_md5`` only if the contents agree and with ``overwrite`` never;
    a missing source fails at once, a name that cannot be used is one failed row, other errors are
    retried with doubling waits.  Copies are renamed into place, so a task that runs twice does no harm.

    A column ``action`` of the manifest decides row by row (``sync_plan``): ``overwrite`` always copies, ``skip`` never does and
    looks at nothing, any other value or null does as above.

    With a column ``size_bytes`` the files are dealt out by bytes, otherwise by count, over ``concurrency`` tasks; by default
    tasks of about a gigabyte, at least one per core.  Files of more than ``part_bytes`` are first fetched in parts by many tasks
    and then joined at the target, so a lost executor fetches a part again, not the file.  The parts lie in a hidden folder
    beside the target, whose name holds size and time of the source, and go when the file is whole; a later run takes up what
    an earlier one left of the same source.  What has no part is read from the source.  Parts are fetched when this is called.

    The rest of the copying happens whenever the result is evaluated: store it with ``append_ledger``.
    """
    columns = pa.schema(
        [
            ("path", pa.string()),
            ("status", pa.string()),
            ("skipped", pa.bool_()),
            ("error", pa.string()),
            ("size_bytes", pa.int64()),
            ("attempt", pa.int32()),
            ("checksum", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source_fs, source = _open_fs(source_root)
        target_fs, target = _open_fs(target_root)
        made: set[str] = set()

        def rows():
            for p, action, size in zip(*(_values(c, n) for c, n in zip(itertools.tee(batches, 3), ("path", "action", "size_bytes")))):
                if action == "skip":
                    yield p, "success", True, None, size, 0, None
                    continue
                again = overwrite or action == "overwrite"
                in_parts = part_bytes if size is not None and size > part_bytes else None
                yield _copy_one(
                    source_fs, f"{source}/{p}", target_fs, f"{target}/{p}", p, attempts, verify_md5, backoff_seconds, made, again, in_parts
                )

        return _in_batches(rows(), columns)

    wanted = manifest.select("path", *[c if c in manifest.columns else F.lit(None).cast(t).alias(c) for c, t in (("action", "string"), ("size_bytes", "bigint"))])
    if "size_bytes" not in manifest.columns:
        return wanted.repartition(_tasks(manifest.sparkSession, concurrency)).mapInArrow(run, OUTCOME_SCHEMA)
    wanted = durable(wanted)
    _fetch_parts(wanted, source_root, target_root, attempts, backoff_seconds, overwrite, part_bytes, verify_md5)
    return deal_by_bytes(wanted, "path", concurrency).mapInArrow(run, OUTCOME_SCHEMA)


def _home_of_parts(target: str, info, part_bytes: int) -> str:
    """The folder of the parts of one state of a source."""
    folder, _, name = target.rpartition("/")
    return f"{folder}/.{hashlib.md5(name.encode()).hexdigest()}.{info.size}.{info.mtime_ns}.{part_bytes}.parts"


def _has(filesystem, path: str, size: int) -> bool:
    info = filesystem.get_file_info(path)
    return info.is_file and info.size == size


def _fetch_parts(wanted, source_root, target_root, attempts, backoff, overwrite, part_bytes, verify_md5) -> None:
    """Copy the parts of the large files that need copying; a part that cannot be had is missing, which the joining meets again."""
    large = wanted.filter((F.col("size_bytes") > part_bytes) & F.coalesce(F.col("action") != "skip", F.lit(True)))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("size_bytes") - 1, F.lit(part_bytes).cast("bigint"))
    parts = large.distinct().select("path", "action", F.col("size_bytes").alias("_size"), F.explode(starts).alias("_start"))
    parts = parts.select("path", "action", "_start", F.least(F.lit(part_bytes).cast("bigint"), F.col("_size") - F.col("_start")).alias("size_bytes"))
    if large.isEmpty():
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source_fs, source = _open_fs(source_root)
        target_fs, target = _open_fs(target_root)
        made: set[str] = set()

        def fetch(path, action, start, length):
            info = source_fs.get_file_info(f"{source}/{path}")
            part = f"{_home_of_parts(f'{target}/{path}', info, part_bytes)}/{start}"
            whole = not (overwrite or verify_md5 or action == "overwrite") and _has(target_fs, f"{target}/{path}", info.size)
            if not info.is_file or info.size < start + length or whole or _has(target_fs, part, length):
                return
            digest = hashlib.md5()
            _put(target_fs, part, _digested(_range_chunks(source_fs, f"{source}/{path}", start, length), digest), made)
            if verify_md5 and _md5(target_fs, part) != digest.hexdigest():
                target_fs.delete_file(part)
                raise OSError("checksum mismatch")

        for batch in batches:
            for row in batch.to_pylist():
                for attempt in range(1, attempts + 1):
                    try:
                        fetch(row["path"], row["action"], row["_start"], row["size_bytes"])
                        break
                    except OSError:
                        if attempt < attempts:
                            time.sleep(backoff * 2 ** (attempt - 1))
        yield from ()

    dealt = deal_by_bytes(parts.withColumn("_at", F.concat_ws("/", "path", F.lpad(F.col("_start").cast("string"), 20, "0"))), "_at", None, part_bytes + OPENING_BYTES)
    dealt.mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def _range_chunks(filesystem, path: str, start: int, length: int) -> Iterator[bytes]:
    with filesystem.open_input_file(path) as file:
        while length > 0:
            chunk = file.read_at(min(CHUNK, length), start)
            if not chunk:
                raise OSError("the source became shorter")
            yield chunk
            start, length = start + len(chunk), length - len(chunk)


def _joined_chunks(source_fs, source: str, target_fs, home: str, size: int, part_bytes: int) -> Iterator[bytes]:
    """The whole source from its parts, and from the source itself where a part is missing."""
    for start in range(0, size, part_bytes):
        length = min(part_bytes, size - start)
        if _has(target_fs, f"{home}/{start}", length):
            yield from _range_chunks(target_fs, f"{home}/{start}", 0, length)
        else:
            yield from _range_chunks(source_fs, source, start, length)


def _drop_parts(filesystem, home: str | None) -> None:
    if home is not None:
        with contextlib.suppress(FileNotFoundError):
            filesystem.delete_dir(home)


def _digested(chunks: Iterator[bytes], digest) -> Iterator[bytes]:
    for chunk in chunks:
        digest.update(chunk)
        yield chunk


def apply_sync_plan(plan: DataFrame, source_root: str, target_root: str, **options) -> DataFrame:
    """Carry out ``planning.sync_plan``: create, overwrite and skip in one call; outcomes as of ``copy_files``."""
    return copy_files(plan.select(F.col("relative_path").alias("path"), "size_bytes", "action"), source_root, target_root, **options)


def _copy_one(source_fs, source, target_fs, target, path, attempts, verify_md5, backoff, made, overwrite=False, part_bytes=None):
    from pyarrow.fs import FileType

    try:
        info = source_fs.get_file_info(source)
        if info.type != FileType.File:
            return (path, "failed", False, "source file not found", None, 0, None)
        home = _home_of_parts(target, info, part_bytes) if part_bytes else None
        there = target_fs.get_file_info(target)
        if not overwrite and there.type == FileType.File and there.size == info.size:
            if not verify_md5 or _md5(source_fs, source) == _md5(target_fs, target):
                _drop_parts(target_fs, home)
                return (path, "success", True, None, info.size, 0, None)
    except OSError as error:
        return (path, "failed", False, str(error), None, 0, None)
    problem = ""
    for attempt in range(1, attempts + 1):
        try:
            digest = hashlib.md5()
            if home is None:
                chunks = _chunks(source_fs, source)
            else:
                chunks = _joined_chunks(source_fs, source, target_fs, home, info.size, part_bytes)
            _put(target_fs, target, _digested(chunks, digest), made)
            written = target_fs.get_file_info(target).size
            if written != info.size:
                raise OSError(f"size mismatch: {written} of {info.size} bytes")
            if verify_md5 and _md5(target_fs, target) != digest.hexdigest():
                raise OSError("checksum mismatch")
            _drop_parts(target_fs, home)
            return (path, "success", False, None, info.size, attempt, digest.hexdigest())
        except OSError as error:
            problem = str(error)
            if attempt < attempts:
                time.sleep(backoff * 2 ** (attempt - 1))
    return (path, "failed", False, problem, None, attempts, None)
