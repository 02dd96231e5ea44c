"""Turns of conversations in order, and digests of ordered parts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.materialize import stored
from basketry.operators.ordered import bucketed_row_number


def placed_turns(turns: DataFrame, conversation: str, *ties: str) -> DataFrame:
    """``turns`` with ``place``: each row's position from 1 in its conversation by ``turn`` (null first), then ``ties``.

    The rows are range-partitioned on the full order and stored, so that a conversation of any
    length is numbered piece by piece. ``conversation`` holds no nulls.
    """
    order = [F.col("turn").asc_nulls_first(), *ties]
    pieces = turns.repartitionByRange(conversation, *order).withColumn("piece", F.spark_partition_id())
    return bucketed_row_number(stored(pieces, "turns"), [conversation], F.col("piece"), order, "place").drop("piece")


def joined_digests(parts: DataFrame, keys: list[str], order: list[str], part: str, glue: str, name: str) -> DataFrame:
    """``keys, name``: the lowercase SHA-256 of every key's parts, in order and joined by ``glue``.

    A digest must see its parts one after the other; they stream through a task in sorted order, so
    a key of any size needs the memory of one batch.
    """
    keyed = parts.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, F.col(part).cast("string"))
    schema = ", ".join(f"{c} {keyed.schema[c].dataType.simpleString()}" for c in keys) + f", {name} string"
    types = [pa.string() if keyed.schema[c].dataType.simpleString() == "string" else pa.int64() for c in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []

        def batch() -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in done], kind) for i, kind in enumerate([*types, pa.string()])]
            return pa.RecordBatch.from_arrays(columns, [*keys, name])

        for got in batches:
            for *key, text in zip(*(c.to_pylist() for c in got.columns), strict=True):
                if key == now:
                    digest.update(glue.encode())
                else:
                    if digest is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, sha256()
                digest.update((text or "").encode())
            if done:
                yield batch()
                done.clear()
        if digest is not None:
            done.append((*now, digest.hexdigest()))
            yield batch()

    return keyed.mapInArrow(run, schema)
