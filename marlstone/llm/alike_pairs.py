"""Documents that look the same but are made of different characters.

Null, empty and blank texts are in no pair; texts equal as strings neither. Rows
are told apart by their key, rows of a null key are in no pair, and a repeated row adds
nothing. Further columns are ignored. Texts travel as digests, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.lookalike import Normaliser
from marlstone.session import materialise, spread


def normalised(df: DataFrame, key: str, text: str, kinds: bool = False) -> DataFrame:
    """(id, text, form): form is the consistent form of the whole text, null for null. With kinds, also mixed and
    whole: how many of its tokens mix scripts, and are of another script but wholly of letters that look Latin."""
    norm = Normaliser()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            columns = {"id": batch.column(0), "text": batch.column(1).cast(pa.string()), "form": pa.array([None if t is None else norm.form(t) for t in texts], pa.string())}
            if kinds:
                counts = [(0, 0) if t is None else norm.kinds(t) for t in texts]
                columns |= {name: pa.array([c[i] for c in counts], pa.int64()) for i, name in enumerate(("mixed", "whole"))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = f"id {dict(df.dtypes)[key]}, text string, form string" + (", mixed long, whole long" if kinds else "")
    return spread(df.select(F.col(key).alias("id"), F.col(text).alias("text"))).mapInArrow(run, schema)


def _digests(df: DataFrame, key: str, text: str, kinds: bool = False) -> DataFrame:
    """(id, form, spelled): 128-bit digests of rows whose text isn't blank."""
    rows = normalised(df, key, text, kinds).where(F.trim(F.regexp_replace("form", r"\s+", " ")) != "")
    return materialise(rows.select("id", F.unhex(F.md5("form")).alias("form"), F.unhex(F.md5("text")).alias("spelled"), *(["mixed", "whole"] if kinds else [])), "forms")


def pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b), a < b: each pair of rows whose texts differ and have one form. As many rows as there are pairs: where forms
    are shared by very many rows, `classes` says the same in one row each.

    Forms with a single spelling, however many copies it has, are dropped by an
    aggregation before anything is joined; the rest is joined by form, where adaptive
    execution splits a form that a large part of all rows share.
    """
    digests = _digests(df, key, text)
    several = digests.groupBy("form").agg(F.min("spelled").alias("lo"), F.max("spelled").alias("hi")).where("lo != hi").select("form")
    rows = materialise(digests.join(several, "form", "left_semi"), "alike")
    other = rows.select("form", F.col("id").alias("b"), F.col("spelled").alias("spelled_b"))
    met = rows.join(other, "form").where((F.col("id") < F.col("b")) & (F.col("spelled") != F.col("spelled_b")))
    return met.select(F.col("id").alias("a"), "b")


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, class, spellings, mixed, whole): each non-blank row with the smallest key of its look-alikes, their number of
    spellings, and its own tokens that mix scripts or are wholly confusable. One row per row, however many copies a form has."""
    digests = _digests(df, key, text, kinds=True)
    spelled = digests.groupBy("form", "spelled").agg(F.min("id").alias("first"))
    groups = spelled.groupBy("form").agg(F.min("first").alias("class"), F.count(F.lit(1)).alias("spellings"))
    return digests.join(groups, "form").select("id", "class", "spellings", "mixed", "whole")
