"""Filling fixed-capacity containers (problem 9).

Vector bin packing by the dot-product heuristic: a container has simultaneous
limits on tokens, segments and loss-bearing tokens; the open container takes,
again and again, the item that fits and whose size vector has the largest
weighted dot product with what is left, until none fits.

Items are spread over independent groups by a hash of their id and place, so
rows without an id spread as well; a group's last, half-empty container is the
only one its split costs, so groups of ``group_items`` items lose well under one
percent.  A text longer than the capacity is cut into full pieces and a
remainder, each with its own loss-bearing tokens; nothing else is split.  Null
and empty texts take no part.  Ties go to the smaller id; repeated rows are
packed each for itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tokenize import Tokenizer, token_pieces


@dataclass(frozen=True)
class Limits:
    """Capacity of a container in each dimension."""

    tokens: int = 4096
    segments: int = 32
    loss_tokens: int = 4096


#: For instruction data: few segments, and room for the questions that bear no loss.
INSTRUCTION = Limits(4096, 16, 2560)


def pack(sizes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Container number of each row of ``sizes`` (items x dimensions).

    ``sizes`` must fit ``limits`` row by row.  Items with equal vectors are
    interchangeable, so the search runs over distinct vectors with counts.
    """
    out = np.full(len(sizes), -1, np.int64)
    if not len(sizes):
        return out
    kinds, which = np.unique(sizes, axis=0, return_inverse=True)
    which = which.ravel()
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(kinds) + 1))
    taken, upto = first[:-1].copy(), first[1:]
    unit = kinds / limits
    alive = np.arange(len(kinds))
    container, left = 0, len(sizes)
    while left:
        room = limits.astype(np.float64)
        while True:
            fits = alive[(kinds[alive] <= room).all(axis=1)]
            if not len(fits):
                break
            best = fits[np.argmax(unit[fits] @ (room / limits))]
            out[order[taken[best]]] = container
            taken[best] += 1
            room = room - kinds[best]
            left -= 1
            if taken[best] == upto[best]:
                alive = alive[alive != best]
        container += 1
    return out


def pack_corpus(documents: DataFrame, limits: Limits = Limits(), tokenizer: Tokenizer = Tokenizer(), id_col: str = "doc_id", text_col: str = "text", kind_col: str | None = "doc_kind", group_items: int = 5_000) -> DataFrame:
    """``doc_id, part_no, start_token, tokens, loss_tokens, container_id``: one row per placed piece."""
    groups = max(1, math.ceil(documents.count() / group_items))
    pieces = token_pieces(documents, limits.tokens, limits.loss_tokens, tokenizer, id_col, text_col, kind_col)
    parts = pieces.withColumn("grp", F.pmod("place", F.lit(groups)).cast("int"))
    bounds = np.array([limits.tokens, limits.segments, limits.loss_tokens])

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id", "part_no"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sizes = np.stack([pdf["tokens"].to_numpy(), np.ones(len(pdf), np.int64), np.minimum(pdf["loss_tokens"].to_numpy(), limits.loss_tokens)], axis=1)
        number = pack(sizes, bounds)
        return pd.DataFrame({**{c: pdf[c] for c in ("doc_id", "part_no", "start_token", "tokens", "loss_tokens")}, "container_id": [f"{g}-{n}" for g, n in zip(pdf["grp"], number)]})

    # A number of partitions that is asked for isn't merged again: few groups still make several tasks.
    spread = parts.repartition(min(groups, max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "grp")
    return spread.groupBy("grp").applyInPandas(place, "doc_id long, part_no int, start_token long, tokens long, loss_tokens long, container_id string")


def container_report(packed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``containers, tokens, fill``, and of how many containers the segments or the loss-bearing tokens are at their limit."""
    each = packed.groupBy("container_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("s"), F.sum("loss_tokens").alias("l"))
    return each.agg(
        F.count("*").alias("containers"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"),
        F.coalesce(F.round(F.avg(F.col("t") / limits.tokens), 6), F.lit(0.0)).alias("fill"),
        F.count_if(F.col("s") >= limits.segments).alias("full_segments"),
        F.count_if(F.col("l") >= 0.99 * limits.loss_tokens).alias("full_loss"),
    )
