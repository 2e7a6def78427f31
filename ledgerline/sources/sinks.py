"""Publishing result tables by atomic overwrite.

The reference empties its targets first and refills them much later, so readers
see empty tables in between. Here every refresh writes a complete new version
into its own folder ``v=<version>`` and then adds a small numbered file to the
commit log; readers take the version that the last commit names. Nothing is
renamed, so this also holds on object stores, and the order of versions is the
order of commits, whatever the versions are called. Versions of commits before
the ``keep`` latest are removed once the new one is visible.

``publish_together`` writes new versions of several tables and names them all in one commit of
their common base folder: a reader of any of them sees either all the old ones or all the new ones.
A table's newest commit in that common log comes before its own log.

A check may run between writing and committing; if it raises, what was written is removed and the old
version stays. Folders that no commit names are what an interrupted run left; the next run of the
(one) writer removes them.

Columns are matched to the target by name and order (``conform``), never by
position alone.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


COMMITS = "_commits"


class SchemaMismatch(ValueError):
    pass


def conform(df: DataFrame, target: Sequence[tuple[str, DataType | None]]) -> DataFrame:
    """Select the target columns in order, casting where a type is given.

    Raises if a target column is missing or the frame carries columns the target
    does not have.
    """
    have = df.columns
    names = [n for n, _ in target]
    missing = [n for n in names if n not in have]
    extra = [c for c in have if c not in names]
    if missing or extra:
        raise SchemaMismatch(f"missing {missing}, unexpected {extra}")
    return df.select(*[(F.col(n).cast(t) if t is not None else F.col(n)).alias(n) for n, t in target])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def _commits(spark: SparkSession, base: str) -> list[tuple[int, str]]:
    """(number, text) of the finished commits, oldest first. A commit file that was cut short has no
    closing newline and does not count. The text is a version, or in a common log a JSON object of them."""
    fs, log, jvm = _fs(spark, f"{base.rstrip('/')}/{COMMITS}")
    if not fs.exists(log):
        return []
    out = []
    for st in fs.listStatus(log):
        name = st.getPath().getName()
        if name.isdigit():
            stream = fs.open(st.getPath())
            try:
                text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                out.append((int(name), text[:-1]))
    return sorted(out)


def _commit(spark: SparkSession, base: str, version: str) -> None:
    """Add the next commit file; of two writers of one number the later takes the next."""
    number = max([n for n, _ in _commits(spark, base)], default=0) + 1
    while True:
        fs, path, jvm = _fs(spark, f"{base.rstrip('/')}/{COMMITS}/{number:020d}")
        if not fs.exists(path):
            try:
                stream = fs.create(path, False)
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in str(e.java_exception):
                    raise
            else:
                stream.write(bytearray(f"{version}\n".encode()))
                stream.close()
                return
        number += 1


def _named(spark: SparkSession, base: str) -> list[tuple[int, dict[str, str]]]:
    """(number, table -> version) of the commits of a common log, oldest first."""
    return [(n, json.loads(text)) for n, text in _commits(spark, base) if text.startswith("{")]


def _split(base: str) -> tuple[str, str]:
    parent, _, name = base.rstrip("/").rpartition("/")
    return parent, name


def _versions(spark: SparkSession, base: str) -> list[str]:
    """The versions that commits name, oldest first; the last one is current."""
    parent, name = _split(base)
    own = [v for _, v in _commits(spark, base) if not v.startswith("{")]
    return own + [v[name] for _, v in _named(spark, parent) if name in v]


def _remove(spark: SparkSession, path: str) -> None:
    fs, hpath, _ = _fs(spark, path)
    fs.delete(hpath, True)


def remove_orphans(spark: SparkSession, base: str) -> list[str]:
    """Remove the version folders at ``base`` that no commit names; return their versions."""
    fs, folder, _ = _fs(spark, base)
    if not fs.exists(folder):
        return []
    known = set(_versions(spark, base))
    found = [st.getPath().getName() for st in fs.listStatus(folder) if st.isDirectory()]
    orphans = [f[2:] for f in found if f.startswith("v=") and f[2:] not in known]
    for version in orphans:
        _remove(spark, f"{base.rstrip('/')}/v={version}")
    return orphans


def _new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def _write(df: DataFrame, base: str, target, version: str, partition_by: Sequence[str] = ()) -> str:
    if target is not None:
        df = conform(df, target)
    final = f"{base.rstrip('/')}/v={version}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(final)
    return final


def _checked(spark: SparkSession, check: Callable[[], None] | None, written: Sequence[str]) -> None:
    try:
        if check:
            check()
    except Exception:
        for path in written:
            _remove(spark, path)
        raise


def publish(
    df: DataFrame,
    base: str,
    target: Sequence[tuple[str, DataType | None]] | None = None,
    version: str | None = None,
    keep: int = 2,
    partition_by: Sequence[str] = (),
    check: Callable[[], None] | None = None,
) -> str:
    """Write ``df`` as the new current version of the table at ``base``; return its path.

    ``partition_by`` lays the version out in folders (e.g. an event-month column of a
    log), so later reads that filter on it prune whole folders. The ``keep`` latest
    commits stay (the one just made always does). ``check`` runs between writing and committing.
    """
    spark = df.sparkSession
    remove_orphans(spark, base)
    version = version or _new_version()
    final = _write(df, base, target, version, partition_by)
    _checked(spark, check, [final])
    _commit(spark, base, version)
    done = _commits(spark, base)
    current = {v for _, v in done[-max(1, keep) :]}
    for number, old in done[: -max(1, keep)]:
        if old not in current:
            _remove(spark, f"{base.rstrip('/')}/v={old}")
        _remove(spark, f"{base.rstrip('/')}/{COMMITS}/{number:020d}")
    return final


def publish_together(
    tables: Mapping[str, tuple[DataFrame, Sequence[tuple[str, DataType | None]] | None]],
    base: str,
    keep: int = 2,
    check: Callable[[], None] | None = None,
) -> dict[str, str]:
    """Write new versions of all ``tables`` (name -> frame and target) below ``base`` and make them
    current with one commit; return their paths. ``check`` runs between the last write and the commit."""
    spark = next(iter(tables.values()))[0].sparkSession
    base, version = base.rstrip("/"), _new_version()
    for name in tables:
        remove_orphans(spark, f"{base}/{name}")
    out: dict[str, str] = {}
    for name, (df, target) in tables.items():
        out[name] = _write(df, f"{base}/{name}", target, version)
    _checked(spark, check, list(out.values()))
    _commit(spark, base, json.dumps({name: version for name in tables}))
    done = _named(spark, base)
    current = {pair for _, named in done[-max(1, keep) :] for pair in named.items()}
    for number, named in done[: -max(1, keep)]:
        if set(named) <= set(tables):  # a commit that is another table's newest stays
            for name, old in set(named.items()) - current:
                _remove(spark, f"{base}/{name}/v={old}")
            _remove(spark, f"{base}/{COMMITS}/{number:020d}")
    return out


def read_published(spark: SparkSession, base: str) -> DataFrame:
    """The last committed version of a published table."""
    done = _versions(spark, base)
    if not done:
        raise FileNotFoundError(f"nothing published at {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v={done[-1]}")


def warehouse_dir(spark: SparkSession, *parts: str) -> str:
    """A folder in the warehouse (``spark.sql.warehouse.dir``), where published tables live."""
    return "/".join([spark.conf.get("spark.sql.warehouse.dir").rstrip("/"), *parts])
