"""Retrieval quality against known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlake.operators.search import attach_sources


def precision_recall_at_k(
    hits: DataFrame,
    query_labels: DataFrame,
    item_labels: DataFrame,
    skip_self: bool = False,
    max_hits: int | None = None,
) -> DataFrame:
    """Per query: hits, relevant hits, precision@k and recall@k.

    ``query_labels(query_id, label)``, ``item_labels(id, label)``. A hit is relevant when
    its label equals the query's. Relevant totals come from label counts, not from pairs.
    ``max_hits`` (queries x k), when known, lets the label table be reduced to the hits by a
    broadcast of their ids.
    """
    totals = item_labels.groupBy("label").agg(F.count(F.lit(1)).alias("relevant_total"))
    if skip_self:
        hits = hits.where(F.col("id") != F.col("query_id"))
    judged = (
        attach_sources(
            hits, item_labels.withColumnRenamed("label", "item_label"), max_hits, ("item_label",)
        )
        .join(query_labels, "query_id")
        .groupBy("query_id", "label")
        .agg(
            F.count(F.lit(1)).alias("returned"),
            F.count_if(F.col("item_label") == F.col("label")).alias("relevant"),
        )
    )
    total = F.coalesce("relevant_total", F.lit(0)) - (1 if skip_self else 0)
    return judged.join(totals, "label", "left").select(
        "query_id",
        "label",
        "returned",
        "relevant",
        F.try_divide("relevant", "returned").alias("precision_at_k"),
        F.try_divide(F.col("relevant").cast("double"), total).alias("recall_at_k"),
    )
