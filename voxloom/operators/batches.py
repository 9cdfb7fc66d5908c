"""Training batches: padding to the longest row of a batch, attention masks and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.constants import LABEL_IGNORE


def pad_and_mask(
    df: DataFrame, batch: str, ids: str, prefix_size: str, pad_id: int, padding_side: str = "left"
) -> DataFrame:
    """Adds width, input_ids, attention_mask and labels. Labels ignore the true prefix and the pads.

    The prefix is masked where it really is, behind the pads with left padding. Ids equal to the pad id are ignored in
    the labels as well. The width comes from an aggregate, so only one small row per batch is joined back.
    """
    if padding_side not in ("left", "right"):
        raise ValueError(f"padding_side must be left or right, got {padding_side}")
    widths = df.groupBy(batch).agg(F.max(F.size(ids)).alias("width"))
    df = df.join(widths, batch)
    size = F.size(ids)
    gap = F.col("width") - size
    ignore = F.lit(LABEL_IGNORE)
    kept = F.transform(ids, lambda x, i: F.when((i < F.col(prefix_size)) | (x == pad_id), ignore).otherwise(x))

    def joined(filler, body):
        return F.concat(filler, body) if padding_side == "left" else F.concat(body, filler)

    one, zero, pad = F.lit(1), F.lit(0), F.lit(pad_id)
    return (
        df.withColumn("input_ids", joined(F.array_repeat(pad, gap), F.col(ids)))
        .withColumn("attention_mask", joined(F.array_repeat(zero, gap), F.array_repeat(one, size)))
        .withColumn("labels", joined(F.array_repeat(ignore, gap), kept))
    )
