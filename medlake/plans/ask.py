"""Single questions as one-row batches of the search and answer jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

from medlake.operators.answering import answer_queries
from medlake.operators.embedding import TEXT_DIM, EmbedFn, embed_texts
from medlake.operators.search import TOP_K, search_text, top_k_single


def search_similar(
    text: str,
    corpus: DataFrame,
    k: int = TOP_K,
    embed_fn: EmbedFn | None = None,
    dim: int = TEXT_DIM,
    **options,
) -> list[Row]:
    """The k nearest documents of a text, best first: id and distance."""
    question = corpus.sparkSession.createDataFrame([(0, text)], "query_id int, text string")
    hits = search_text(
        question, corpus, lambda df: embed_texts(df, embed_fn=embed_fn, dim=dim), dim, k, **options
    )
    return top_k_single(hits, k).select("id", "distance").collect()


def ask(
    question: str,
    corpus: DataFrame,
    registry: DataFrame,
    embed_fn: EmbedFn | None = None,
    dim: int = TEXT_DIM,
    **options,
) -> Row:
    """The answer record of one question."""
    one = corpus.sparkSession.createDataFrame([(0, question)], "query_id int, query string")
    embedded = embed_texts(one, "query", embed_fn, dim)
    return answer_queries(embedded, corpus, registry, dim, **options).drop("query_id").first()
