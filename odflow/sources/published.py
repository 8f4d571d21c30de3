"""Result sink that publishes at once.

A version's rows go to a folder of their own, are read back and counted, and only then a small manifest with schema, rows and
checksum is renamed into place. Readers follow the highest manifest, so a write that breaks anywhere leaves the version before
as it was, and a reader never sees half a result.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PREFIX = "manifest-"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    _, folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX) and n[len(_PREFIX):].isdigit())


def _row_hash(df: DataFrame) -> Column:
    """64 bits of a row; nulls count by place. Maps have no hash, so rows with one are hashed as JSON."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    if any(t in df.schema.simpleString() for t in ("map<", "variant")):
        return F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false", "timeZone": "UTC"}))
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def fingerprint(df: DataFrame) -> dict:
    """Rows, and the sum of all rows' hashes as text: the same for the same rows in any order. One aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_hash(df).cast("decimal(20,0)")).alias("total")).first()
    return {"rows": row["rows"], "checksum": str(row["total"] or 0)}


def publish_result(df: DataFrame, path: str) -> dict:
    """Write ``df`` as the next version of the result at ``path`` and return its manifest.

    Of two writers of one version the second to finish gets an error; its rows stay unseen. Empty results are published
    like any other; column names must be distinct.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    version = max(_versions(spark, path), default=0) + 1
    data = f"rows-{version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{data}")
    back = spark.read.schema(df.schema).parquet(f"{path}/{data}")
    manifest = {"version": version, "data": data, "schema": json.loads(df.schema.json()), **fingerprint(back)}
    jvm, _, fs = _folder(spark, path)
    staged, final = (jvm.org.apache.hadoop.fs.Path(f"{path}/{n}") for n in (f"_staged-{uuid.uuid4().hex}", f"{_PREFIX}{version}"))
    out = fs.create(staged, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise FileExistsError(f"publish: version {version} of {path} was published by another writer")
    return manifest


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The manifest of a version, by default the last one."""
    path, known = path.rstrip("/"), _versions(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"read: {path} has no published {'result' if version is None else f'version {version}'}")
    text = spark.read.text(f"{path}/{_PREFIX}{known[-1] if version is None else version}", wholetext=True).first()[0]
    return json.loads(text)


def read_result(spark: SparkSession, path: str, version: int | None = None, verify: bool = False) -> DataFrame:
    """The rows of a published version. ``verify`` first reads them once and compares rows and checksum with the manifest."""
    manifest = read_manifest(spark, path, version)
    df = spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(f"{path.rstrip('/')}/{manifest['data']}")
    if verify and (got := fingerprint(df)) != {k: manifest[k] for k in got}:
        raise ValueError(f"read: version {manifest['version']} of {path} is not as it was published: {got}")
    return df


def retire_versions(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Remove all versions but the last ``keep`` (at least one): the manifest first, then its rows. Returns the removed ones."""
    path = path.rstrip("/")
    gone = _versions(spark, path)[:-max(keep, 1)]
    jvm, _, fs = _folder(spark, path)
    for v in gone:
        data = read_manifest(spark, path, v)["data"]
        for name in (f"{_PREFIX}{v}", data):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return gone
