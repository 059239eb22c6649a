"""Delimited-text sources.

Tab-separated, one header line, UTF-8, ``\\N`` as NULL, no quoting, declared
all-string schema, plain or gzip. Existence checks go through the session's
Hadoop FileSystem, so they work for HDFS and object stores as well as local
paths.

Scale: a plain file is split into many tasks; a ``.gz`` file is not
splittable and arrives as one task per file. The reader adds no shuffle: the
join or writer that follows deals the rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediamart.sources.fs import exists, size_bytes
from mediamart.specs import NULL_SENTINEL, DatasetSpec

TSV_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "nullValue": NULL_SENTINEL,
    "quote": "",           # no quoting: a quote character is plain text
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",  # short rows padded with NULL, extra fields dropped
}


def resolve_path(spark: SparkSession, base: str) -> str:
    """``base`` if it exists, else ``base.gz``; else FileNotFoundError naming
    both. Never a glob: when both exist only the plain one is read."""
    if exists(spark, base):
        return base
    if exists(spark, base + ".gz"):
        return base + ".gz"
    raise FileNotFoundError(f"neither '{base}' nor '{base}.gz' exists")


def check_inputs(spark: SparkSession, input_dir: str, specs: list[DatasetSpec]) -> dict[str, str]:
    """Resolve every required input up front and report *all* missing ones
    in one error, before any job starts."""
    found, missing = {}, []
    for spec in specs:
        try:
            found[spec.name] = resolve_path(spark, f"{input_dir.rstrip('/')}/{spec.file_stem}")
        except FileNotFoundError:
            missing.append(spec.file_stem)
    if missing:
        raise FileNotFoundError(f"missing inputs in {input_dir}: {', '.join(missing)} (plain or .gz)")
    return found


def read_tsv(spark: SparkSession, path: str, spec: DatasetSpec, check_header: bool = False) -> DataFrame:
    """Read one raw source with its declared all-string schema.

    ``check_header=True`` makes Spark compare the header line with the
    schema's names and fail on a mismatch. A gzip file cannot be split, so
    each is one task; nothing is shuffled here, as the joins and writers that
    follow deal the rows out anyway. Ship large inputs as several files."""
    actual = resolve_path(spark, path)
    reader = spark.read.schema(spec.raw_schema).options(**TSV_OPTIONS)
    if check_header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(actual)


def write_tsv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a DataFrame of strings in the same raw format (header, tab,
    NULL as the sentinel, no quoting). Blanks are kept as they are: the CSV
    writer would trim them by default."""
    w = (df.write.mode("overwrite").option("sep", "\t").option("header", "true")
         .option("nullValue", NULL_SENTINEL).option("quote", "").option("escape", "")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
