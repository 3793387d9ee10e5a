"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from commerce_lake.sources.storage import shared_folder

TEXTS_AT_ONCE = 2000


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the folder all executors share and read it back.

    This cuts lineage: a lost executor repeats nothing before this table, and
    what follows sees the same rows however often it reads them. Every call
    takes a folder of its own.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema = StructType.fromJson(df.schema.jsonValue())
    for field in schema.fields:
        field.nullable = True
    return spark.read.schema(schema).parquet(path)


def unused(df: DataFrame, wanted: str) -> str:
    """`wanted`, or the first name derived from it that `df` has no column of."""
    taken = {column.lower() for column in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def with_text_columns(
    df: DataFrame, text: str, make: Callable[[], Callable[[list[str]], list]], added: str, drop_text: bool = False
) -> DataFrame:
    """`df` plus columns that a task computes from one text column, null read as empty.

    `make` runs once per task and returns a function from a batch of texts to
    the lists of values of the added columns; a batch has `TEXTS_AT_ONCE` texts
    at most, for they and what is made of them are held several times over. All
    other columns pass through as Arrow data, but columns of the added names are
    replaced. Nothing is shuffled; a lost task repeats only its split.
    """
    new = StructType.fromDDL(added)
    kept = df.drop(*new.names, *[text] * drop_text)
    schema = StructType([*kept.schema.fields, *new.fields])
    names, types = kept.columns, to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (whole.slice(k, TEXTS_AT_ONCE) for whole in batches for k in range(0, max(whole.num_rows, 1), TEXTS_AT_ONCE)):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            columns = [pa.array(values, type=field.type) for values, field in zip(work(texts), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], *columns], names=[*names, *types.names]
            )

    return df.mapInArrow(run, schema)


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
