"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plantwatch.session import shuffles_end_with_jobs  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def wrap(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``_text`` and the whole row as ``_row``: no column of the caller can clash."""
    return docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(text_column).alias("_text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )


def unwrap(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns again, some of them replaced."""
    return df.select(*[replaced.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the quick way where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def carry(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Like ``wrap`` for Python stages: the text goes through them once, as ``_text`` only."""
    rest = [c for c in docs.columns if c != text_column]
    return docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(text_column).alias("_text"),
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"),
    )


def restore(df: DataFrame, columns: list[str], text_column: str = "text") -> DataFrame:
    return df.select(*[
        (F.col("_text") if c == text_column else F.col("_rest").getField(c)).alias(c) for c in columns
    ])
