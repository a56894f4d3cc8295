"""Sinks: CSV, JSON maps, lists, backups, and several tables committed at once behind one pointer."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.runtime import Observation


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    of = jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put what was staged in the place of ``path``; the old content is only deleted after that, and comes back on a failure."""
    fs, of = _fs(spark, path)
    old = f"{path}.old-{uuid.uuid4().hex[:8]}"
    there = fs.exists(of(path))
    if there and not fs.rename(of(path), of(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(of(staged), of(path)):
        if there:
            fs.rename(of(old), of(path))
        raise OSError(f"cannot put {path} in place")
    if there:
        fs.delete(of(old), True)


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """To a sibling first, since the frame may read what it replaces; with ``order`` the parts are in that order."""
    staged = f"{path}.staged-{uuid.uuid4().hex[:8]}"
    (df.orderBy(*order) if order else df).write.csv(staged, header=True, quote='"', escape='"')
    _swap(df.sparkSession, staged, path)


def write_json_map(df: DataFrame, key: str, path: str) -> None:
    """A folder of lines with key and value, which ``read_json_map`` takes back."""
    staged = f"{path}.staged-{uuid.uuid4().hex[:8]}"
    df.select(F.col(key).alias("key"), F.struct(*[c for c in df.columns if c != key]).alias("value")).write.json(staged, ignoreNullFields=False)
    _swap(df.sparkSession, staged, path)


def write_lists(df: DataFrame, column: str, path: str) -> None:
    """The values as text lines, all of them and, beside it with the ending _unique, each once."""
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).where("value <> ''")
    for out, name in ((values, path), (values.distinct(), f"{path}_unique")):
        staged = f"{name}.staged-{uuid.uuid4().hex[:8]}"
        out.orderBy("value").write.text(staged)
        _swap(df.sparkSession, staged, name)


def backup(spark: SparkSession, path: str, first_only: bool = False, suffix: str = ".bak") -> str | None:
    """A copy beside ``path`` under the first free number; ``first_only`` keeps an earlier one. None where nothing is there."""
    fs, of = _fs(spark, path)
    if not fs.exists(of(path)):
        return None
    target, n = path + suffix, 0
    while fs.exists(of(target)):
        if first_only:
            return target
        n += 1
        target = f"{path}{suffix}{n}"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, of(path), fs, of(target), False, conf)
    if _sizes(fs, of(path)) != _sizes(fs, of(target)):
        raise OSError(f"{target} is no copy of {path}")
    return target


def _sizes(fs, path) -> tuple[int, int]:
    s = fs.getContentSummary(path)
    return s.getLength(), s.getFileCount()


def _pointers(spark: SparkSession, root: str) -> list[int]:
    fs, of = _fs(spark, root)
    if not fs.exists(of(root)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(of(root))]
    return sorted(int(n[len("CURRENT-"):]) for n in names if n.startswith("CURRENT-") and n[len("CURRENT-"):].isdigit())


def commit(tables: dict[str, DataFrame], root: str, dry_run: bool = False, expected: int | None = None) -> str | dict[str, int]:
    """Stage all tables, read them back, then add a pointer; a failure leaves the old version in force.

    Rows and an order-free hash are taken while a table is written and compared with what is read back. A pointer is a
    new numbered file that must not exist yet, so two commits cannot both win; ``expected`` is the number that the caller
    has read from. Earlier versions stay, see ``rollback``. ``dry_run`` computes all, writes nothing and returns the rows.
    """
    spark = next(iter(tables.values())).sparkSession
    if dry_run:
        return {name: df.count() for name, df in tables.items()}
    have = _pointers(spark, root)
    number = (have[-1] if have else 0) + 1
    if expected is not None and expected != number - 1:
        raise ValueError("the library has changed since it was read")
    version = f"v-{uuid.uuid4().hex}"
    fs, of = _fs(spark, root)
    try:
        for name, df in tables.items():
            seen, print_ = Observation(), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
            df.observe(seen, F.count(F.lit(1)).alias("n"), print_.alias("h")).write.parquet(f"{root}/{version}/{name}")
            back = spark.read.parquet(f"{root}/{version}/{name}")
            got = back.agg(F.count(F.lit(1)), print_).first()
            if back.columns != df.columns or (seen.get["n"], seen.get["h"]) != tuple(got):
                raise ValueError(f"{name} was not written as it is")
        out = fs.create(of(f"{root}/CURRENT-{number:012d}"), False)
        out.write(bytearray(json.dumps({"version": version, "tables": sorted(tables)}).encode()))
        out.close()
    except Exception:
        fs.delete(of(f"{root}/{version}"), True)
        raise
    return version


def rollback(spark: SparkSession, root: str) -> int:
    """Take back the latest pointer; the version before it is in force again."""
    have = _pointers(spark, root)
    if len(have) < 2:
        raise ValueError("no earlier version")
    fs, of = _fs(spark, root)
    fs.delete(of(f"{root}/CURRENT-{have[-1]:012d}"), False)
    return have[-2]


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = json.loads(spark.read.text(f"{root}/CURRENT-{_pointers(spark, root)[-1]:012d}").first()[0])["version"]
    return spark.read.parquet(f"{root}/{version}/{name}")
