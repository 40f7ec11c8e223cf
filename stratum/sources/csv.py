"""Positional CSV bulk load with a quarantine for malformed rows.

Every field is read as text (typing happens in the bronze models). Rows
with the wrong number of fields are not dropped silently: they come back
as a separate rejects DataFrame so the load can continue and the bad lines
stay inspectable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratum import fixed
from stratum.operators.cleanse import null_tokens
from stratum.session import shared_dir
from stratum.sources.records import csv_records

CORRUPT = "_corrupt_record"
#: quoting of the landing files: double quotes, doubled inside
DIALECT = {"quote": '"', "escape": '"'}


def text_schema(columns: Sequence[str], corrupt: bool = True) -> StructType:
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt:
        fields.append(StructField(CORRUPT, StringType(), True))
    return StructType(fields)


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_positional(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str],
                        encoding: str = "UTF-8", multiline: bool = True,
                        tokens: Sequence[str] = fixed.NULL_TOKENS,
                        header: bool = True,
                        stage_to: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Load CSV text by position; returns ``(good, rejects)``.

    * one header line is skipped; header names are ignored (columns are positional);
    * fields may be enclosed in double quotes, a doubled quote is a literal quote;
    * ``tokens`` (and empty fields) become NULL in every column;
    * rows with too many or too few fields go to ``rejects``: the fields
      Spark could parse plus the whole ``line``.

    Spark only counts the fields of a line when every column is read; a
    projection that prunes columns would let malformed lines through (and
    a query on the corrupt-record column alone is refused). So the full
    parse is written once as Parquet, the raw table of a bulk load, to
    ``stage_to`` or a fresh folder under the shared checkpoint directory;
    both outputs read that table, whatever later stages select. The write
    also cuts the lineage back to the text files.

    With ``multiline`` (the default) a quoted field may hold line breaks (read as newlines);
    the records are found by a prefix scan over the lines (:mod:`stratum.sources.records`), so
    one large file is parsed by all tasks. Without it, for files known to hold no quoted line
    break, lines are records and no scan is needed; a record with one would be cut in two and
    quarantined.
    """
    schema = text_schema(columns)
    options = {**DIALECT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if stage_to is None:
        stage_to = shared_dir(spark, "csv-stage")
    if multiline:
        raw = csv_records(spark, path, lambda record: F.from_csv(record, ddl(schema), options), stage_to, encoding, header)
    else:
        (spark.read.schema(schema).options(**options)
         .option("header", header).option("encoding", encoding).option("enforceSchema", True)
         .csv(path if isinstance(path, str) else list(path)).write.mode("overwrite").parquet(stage_to))
        raw = spark.read.parquet(stage_to)
    good = null_tokens(raw.where(F.col(CORRUPT).isNull()).select(*columns), tokens)
    rejects = (raw.where(F.col(CORRUPT).isNotNull())
               .select(*columns, F.col(CORRUPT).alias("line")))
    return good, rejects


def read_csv_named(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8",
                   multiline: bool = True) -> DataFrame:
    """Header-named scan for profiling: every column as text, names from the header.

    No type inference (it would cost a full extra pass over the files);
    profiling classifies the text itself. Records are found as in
    :func:`read_csv_positional` and staged as Parquet; only the header is read on its own.
    """
    paths = path if isinstance(path, str) else list(path)
    scan = (spark.read.option("header", True).option("inferSchema", False).options(**DIALECT)
            .option("multiLine", multiline).option("encoding", encoding).csv(paths))
    if not multiline:
        return scan
    names = StructType([StructField(f"c{i}", StringType()) for i in range(len(scan.columns))])
    return csv_records(spark, paths, lambda record: F.from_csv(record, ddl(names), dict(DIALECT)),
                       shared_dir(spark, "csv-named"), encoding).toDF(*scan.columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Write text columns in the same dialect the loader reads (header in every part file)."""
    (df.write.mode(mode)
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("encoding", encoding)
     .csv(path))
