"""Loading delimited text files into typed tables, with a quarantine.

Every line of the input ends up in exactly one of two tables. Spark's CSV
source reads in permissive mode: a line with too few or too many fields keeps
its text in a corrupt-record column. The fields are then converted as the
dialect does (see ``lenient``); a field that does not convert, or is missing
where the table wants one, is a reason. One pass writes both tables: good rows
typed, bad ones as file, line text and reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.sources.lenient import lenient_date, lenient_number

CORRUPT = "_line"
QUARANTINED = "_quarantined"


@dataclass(frozen=True)
class Field:
    """A field of the file: its name, the type it loads into, and whether it must be there."""
    name: str
    type: T.DataType
    required: bool = False


def _converted(f: Field) -> Column:
    c = F.when(F.trim(F.col(f.name)) != "", F.col(f.name))      # an empty field is NULL, as in the dialect
    if isinstance(f.type, T.DateType):
        return lenient_date(c)
    if isinstance(f.type, T.DecimalType):
        return lenient_number(c, f.type.precision, f.type.scale)
    if isinstance(f.type, T.StringType):
        return c
    return F.trim(c).try_cast(f.type)


def read_delimited(spark: SparkSession, path: str, fields: list[Field], sep: str = ";",
                   header: bool = False) -> DataFrame:
    """Typed columns, plus ``_file``, ``_line`` (the text of a line with reasons) and
    ``_reasons`` (empty: a good row). Nothing is dropped."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("sep", sep).option("header", header).option("enforceSchema", True).csv(path))
    raw = raw.withColumn("_file", F.col("_metadata.file_name"))
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("fields"))]
    typed = {}
    for f in fields:
        typed[f.name] = _converted(f)
        blank = F.col(f.name).isNull() | (F.trim(F.col(f.name)) == "")
        whole = F.col(CORRUPT).isNull()
        reasons.append(F.when(whole & ~blank & typed[f.name].isNull(), F.lit(f"{f.name}: not {f.type.simpleString()}")))
        if f.required:
            reasons.append(F.when(whole & blank, F.lit(f"{f.name}: missing")))
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.coalesce(F.col(f.name), F.lit("")) for f in fields]))
    return (raw.withColumn("_reasons", found)
            .select(*[F.when(F.size("_reasons") == 0, typed[f.name]).alias(f.name) for f in fields], "_file",
                    F.when(F.size("_reasons") > 0, line).alias(CORRUPT), "_reasons"))


def load_delimited(spark: SparkSession, path: str, fields: list[Field], target: str, **options
                   ) -> tuple[DataFrame, DataFrame]:
    """Load ``path`` once and write it to the folder ``target``, good rows and
    quarantined ones in folders of their own -> ``(rows, quarantine)``: the
    typed table, and ``(_file, _line, _reasons)``."""
    read = read_delimited(spark, path, fields, **options)
    (read.withColumn(QUARANTINED, F.size("_reasons") > 0).write.mode("errorifexists")
     .partitionBy(QUARANTINED).parquet(target))
    both = spark.read.schema(T.StructType([*read.schema.fields, T.StructField(QUARANTINED, T.BooleanType())])).parquet(target)
    good = both.filter(~F.col(QUARANTINED)).select(*[f.name for f in fields])
    return good, both.filter(QUARANTINED).select("_file", CORRUPT, "_reasons")
