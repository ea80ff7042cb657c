"""Versions of the readings table and its load ledger, committed together.

A commit writes its rows to ``data/lote=<id>/ano=/estacao=`` and its ledger
rows to ``ledger/lote=<id>``; nothing reads them until a manifest names both.
Manifest ``n + 1`` is manifest ``n`` with the touched partitions pointing to the
new folder, and it becomes visible by one rename.  A failure anywhere before
leaves the old version as it was, rows and ledger alike, so a replay counts
like the first try.  Every old version stays readable.

A manifest has one entry per station-year and load, so it is read by the
driver.  One writer at a time is meant (the ingest stream); a commit that finds
its version taken raises.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from horavento.session import _hadoop


@dataclass
class Version:
    number: int = 0
    #: partition folder (``ano=2024/estacao=A``) -> folder of the load that wrote it
    data: dict[str, str] = field(default_factory=dict)
    ledger: list[str] = field(default_factory=list)


def _manifest(root: str, number: int) -> str:
    return f"{root}/_versions/v{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _hadoop(spark, f"{root}/_versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def version(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The latest version, or the numbered one; version 0 is empty."""
    have = _numbers(spark, root)
    number = (have[-1] if have else 0) if number is None else number
    if number == 0:
        return Version()
    if number not in have:
        raise ValueError(f"no version {number} of {root}")
    text = "\n".join(r.value for r in spark.read.text(_manifest(root, number), wholetext=True).collect())
    m = json.loads(text)
    return Version(number, m["data"], m["ledger"])


def read_data(spark: SparkSession, root: str, schema: str, v: Version) -> DataFrame:
    """The rows of a version; partition columns come from the folders."""
    if not v.data:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/{load}/{part}" for part, load in sorted(v.data.items())]
    columns = spark.createDataFrame([], schema).columns
    return spark.read.schema(f"{schema}, lote string").option("basePath", f"{root}/data").parquet(*paths).select(*columns)


def read_loads(spark: SparkSession, root: str, schema: str, v: Version) -> DataFrame:
    """The ledger rows of a version."""
    if not v.ledger:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/ledger/{load}" for load in v.ledger])


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders below ``folder``, ``depth`` levels down."""
    fs, at = _hadoop(spark, folder)
    if not fs.exists(at):
        return []
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{s.getPath().getName()}".lstrip("/") for p in found
                 for s in fs.listStatus(_hadoop(spark, f"{folder}/{p}")[1]) if "=" in s.getPath().getName()]
    return found


def _publish(spark: SparkSession, root: str, v: Version) -> None:
    """Make the manifest visible by one rename."""
    target = _manifest(root, v.number)
    fs, final = _hadoop(spark, target)
    draft = _hadoop(spark, f"{root}/_versions/.draft-{uuid.uuid4().hex}")[1]
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps({"data": v.data, "ledger": v.ledger}, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {v.number} of {root} was committed by another writer")


def commit(spark: SparkSession, root: str, base: Version, rows: DataFrame, loads: DataFrame, partitions: list[str]) -> Version:
    """The version after ``base``: ``rows`` replace the partitions they lie in,
    ``loads`` are added to the ledger."""
    load = f"lote={uuid.uuid4().hex}"
    rows.write.mode("errorifexists").partitionBy(*partitions).parquet(f"{root}/data/{load}")
    loads.write.mode("errorifexists").parquet(f"{root}/ledger/{load}")
    touched = {p: load for p in _partitions(spark, f"{root}/data/{load}", len(partitions))}
    after = Version(base.number + 1, base.data | touched, [*base.ledger, load])
    _publish(spark, root, after)
    return after
