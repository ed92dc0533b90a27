"""What several corpus operators need: tables in the shared folder, ASCII lower case, word counts, Arrow batches."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import new_folder

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: it survives lost executors and is computed once."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. A text as many bytes as characters long is ASCII and takes the short way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def whole_row(docs: DataFrame) -> Column:
    """All columns of a table as one named ``row``, out of the way of others' names."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def word_count(text: Column) -> Column:
    """Words of a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of ``text``, or one longer row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows and column.nbytes > limit:
            step = max(1, batch.num_rows * limit // column.nbytes)
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)
        elif batch.num_rows:
            yield batch


def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file; every executor has it in the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)
