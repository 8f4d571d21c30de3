"""Parquet directory source (S1-S4) and result sinks.

Files are listed through the Hadoop FileSystem of the session, so the same
code reads a local folder, HDFS or an object store. Only metadata touches the
driver; the rows are read by one Parquet scan per distinct file layout.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _data_files(fs, status) -> list[str]:
    """The data files of one listed entry: the file itself, or all files of a folder that Spark would read."""
    if status.isFile():
        return [status.getPath().toString()]
    out = []
    for st in fs.listStatus(status.getPath()):
        if not st.getPath().getName().startswith(("_", ".")):
            out += _data_files(fs, st)
    return sorted(out)


def list_parquet_files(spark: SparkSession, path: str, names: list[str] | None = None) -> list[str]:
    """Data files of the entries of ``path`` whose names end in ``.parquet``, in order of the entries' names.

    An entry is a file, or a folder as Spark writes it (its files count, in order). ``names`` limits the
    entries, in the order given.
    """
    if path is None or str(path).strip() == "":
        raise ValueError("load: no folder was named")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(str(path))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder) or not fs.getFileStatus(folder).isDirectory():
        raise ValueError(f"load: {path} is no folder that can be listed")
    entries = {st.getPath().getName(): st for st in fs.listStatus(folder) if st.getPath().getName().endswith(".parquet")}
    missing = [n for n in names or [] if n not in entries]
    if missing:
        raise ValueError(f"load: {path} lacks {', '.join(missing)}")
    files = [f for n in (names or sorted(entries)) for f in _data_files(fs, entries[n])]
    if not files:
        raise ValueError(f"load: nothing in {path} ends in .parquet")
    return files


def footer_layouts(spark: SparkSession, files: list[str], threads: int = 32) -> list[str]:
    """The Parquet schema of each file, read from its footer through the Hadoop
    FileSystem of the session (any store Spark reads), ``threads`` files at a
    time. Only footers are read; rows never touch the driver."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()

    def layout(path: str) -> str:
        inp = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), hconf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(inp)
        try:
            meta = reader.getFooter().getFileMetaData()
            # Spark's own row schema, if a Spark job wrote the file, refines the types.
            spark_meta = meta.getKeyValueMetaData().get("org.apache.spark.sql.parquet.row.metadata")
            return f"{meta.getSchema().toString()}\n{spark_meta or ''}"
        finally:
            reader.close()

    if len(files) <= 1:
        return [layout(f) for f in files]
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        return list(pool.map(layout, files))


def load_trips(spark: SparkSession, path: str, merge: str = "position", names: list[str] | None = None,
               width: int | None = None) -> DataFrame:
    """Load the Parquet files and Parquet folders of a directory as one DataFrame.

    ``merge='position'`` unions files by column position with the first file
    naming the columns. Files are grouped by their
    footer's schema, read concurrently, and each distinct layout is one scan,
    so a directory of thousands of same-schema files is a single scan.
    ``merge='name'`` is a single scan with schema merging by column name
    (missing columns become null). ``names`` limits the entries read, ``width`` keeps the first
    columns of every file only (by position).
    """
    files = list_parquet_files(spark, path, names)
    if merge == "name":
        return spark.read.option("mergeSchema", "true").parquet(*files)
    if merge != "position":
        raise ValueError("merge must be 'position' or 'name'")
    groups: dict[str, list[str]] = {}  # layout -> files, in order of first appearance
    for f, lay in zip(files, footer_layouts(spark, files)):
        groups.setdefault(lay, []).append(f)
    frames = [spark.read.parquet(*fs) for fs in groups.values()]
    if width is not None:
        frames = [fr.select(*[F.col(f"`{c}`") for c in fr.columns[:width]]) for fr in frames]
    first = frames[0].columns
    frames = [frames[0]] + [fr.toDF(*first) if len(fr.columns) == len(first) else fr for fr in frames[1:]]
    return reduce(lambda a, b: a.union(b), frames)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type, nullable."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = "position int, column string, type string, nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Results stay DataFrames; this writes one to a folder."""
    df.write.mode(mode).format(fmt).save(path)
