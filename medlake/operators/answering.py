"""Context assembly, prompts, answers and confidence for batches of questions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from inspect import signature

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlake.operators.search import (
    MIN_SCORE,
    TOP_K,
    above_threshold,
    attach_sources,
    hits_bound,
    top_k,
)
from medlake.plans.durable import cut

# Context length in characters, hits in the confidence, block header.
MAX_CONTEXT = 8000
CONFIDENCE_HITS = 3
HEADER = "[Source %d: %s]\n%s"
CITATION = r"Source (\d+)"

DISCLAIMER = "For study and research only; ask a clinician before acting on this text."
NO_ANSWER = "The indexed sources do not answer this question."
PROMPT = (
    "Role: assistant for clinical record questions.\n"
    "Rules:\n"
    "- rely on the context alone and name the sources you use\n"
    "- say so when the context is not enough\n\n"
    "Context:\n{context}\n\n"
    "Question: {query}\n"
    "Answer:"
)

GenerateFn = Callable[[list[str]], list[str]]


def source_name() -> Column:
    return F.coalesce("source", F.concat(F.lit("Document "), F.col("rank").cast("string")))


def build_context(
    sourced_hits: DataFrame,
    max_chars: int = MAX_CONTEXT,
) -> DataFrame:
    """One row per query with hits: context, confidence, sources, top text.

    ``sourced_hits(query_id, id, distance, rank, text, source[, content])``; groups hold at
    most k rows because the search ranked them before.
    """
    texts = [c for c in ("text", "content") if c in sourced_hits.columns]
    text = F.coalesce(*texts, F.lit(""))
    # A block can add at most max_chars + 1 characters to a context cut at max_chars.
    block = F.substring(F.format_string(HEADER, "rank", "source_name", "body"), 1, max_chars + 1)
    rows = sourced_hits.withColumns({"body": text, "source_name": source_name()})
    grouped = (
        rows.withColumn("block", block)
        .groupBy("query_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("rank", "block"))).alias("blocks"),
            F.sort_array(
                F.collect_list(F.struct("rank", "id", "distance", "source", "body"))
            ).alias("ranked"),
            F.avg(F.when(F.col("rank") <= CONFIDENCE_HITS, F.coalesce("distance", F.lit(0.0)))).alias(
                "confidence"
            ),
        )
    )
    joined = F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n")
    return grouped.withColumn("joined", joined).select(
        "query_id",
        F.when(
            F.length("joined") > max_chars,
            F.concat(F.substring("joined", 1, max_chars), F.lit("...")),
        )
        .otherwise(F.col("joined"))
        .alias("context"),
        "confidence",
        F.transform(
            "ranked",
            lambda r: F.struct(
                r["id"].alias("id"),
                r["distance"].alias("distance"),
                r["source"].alias("source"),
                r["body"].alias("text"),
            ),
        ).alias("sources"),
        F.get("ranked", F.lit(0))["body"].alias("top_text"),
    )


def with_contexts(queries: DataFrame, contexts: DataFrame) -> DataFrame:
    """Every query, with an empty context and confidence 0 where nothing was found."""
    return (
        queries.join(contexts, "query_id", "left")
        .withColumn("context", F.coalesce("context", F.lit("")))
        .withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    )


def build_prompt(context: Column, query: Column, template: str = PROMPT) -> Column:
    """The template with ``{context}`` and ``{query}`` filled in."""
    before, rest = template.split("{context}")
    between, after = rest.split("{query}")
    return F.concat(F.lit(before), context, F.lit(between), query, F.lit(after))


def extractive_answer(top_text: Column) -> Column:
    """First sentence of the best source with its citation; a fixed text without one."""
    sentence = F.trim(F.regexp_extract(top_text, r"^\s*([^.!?\n]+[.!?]?)", 1))
    return F.when(F.coalesce(sentence, F.lit("")) == "", F.lit(NO_ANSWER)).otherwise(
        F.concat(sentence, F.lit(" [Source 1]"))
    )


@dataclass(frozen=True)
class GenerationSettings:
    """What a text model is asked to keep to."""

    # Generation defaults.
    temperature: float = 0.2
    max_output_tokens: int = 2048


def _with_settings(generate_fn: GenerateFn, settings: GenerationSettings) -> GenerateFn:
    """``generate_fn`` of prompts alone; one that takes a second argument is given the settings."""
    places = [p for p in signature(generate_fn).parameters.values() if p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)]
    return partial(_call, generate_fn, settings) if len(places) > 1 else generate_fn


def _call(generate_fn, settings: GenerationSettings, prompts: list[str]) -> list[str]:
    return generate_fn(prompts, settings)


def generate(
    df: DataFrame, generate_fn: GenerateFn, batch_size: int = 8, settings: GenerationSettings = GenerationSettings()
) -> DataFrame:
    """Append ``answer`` from a batch text model fed with the ``prompt`` column, and with ``settings`` if it takes them."""
    generate_fn = _with_settings(generate_fn, settings)
    schema = T.StructType(df.schema.fields + [T.StructField("answer", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = batch.column(batch.schema.get_field_index("prompt")).to_pylist()
            answers: list[str] = []
            for start in range(0, len(prompts), batch_size):
                answers += generate_fn(prompts[start : start + batch_size])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(answers, pa.string())],
                names=[*batch.schema.names, "answer"],
            )

    return df.mapInArrow(run, schema)


def answer_queries(
    queries: DataFrame,
    corpus: DataFrame,
    registry: DataFrame,
    dim: int,
    k: int = TOP_K,
    min_score: float = MIN_SCORE,
    max_chars: int = MAX_CONTEXT,
    generate_fn: GenerateFn | None = None,
    template: str = PROMPT,
    disclaimer: str = DISCLAIMER,
    settings: GenerationSettings = GenerationSettings(),
    **search_options,
) -> DataFrame:
    """``queries(query_id, query, embedding)`` -> answer records, one per query.

    Retrieval, threshold, texts, context, answer, confidence; queries without hits stay.
    The embedded queries are stored once, since several steps read them.
    """
    queries = cut(queries.select("query_id", "query", "embedding"), "queries")
    hits = above_threshold(top_k(queries, corpus, dim, k, **search_options), min_score)
    return answer_hits(
        queries.select("query_id", "query"),
        hits,
        registry,
        hits_bound(queries, dim, k),
        max_chars,
        generate_fn,
        template,
        disclaimer,
        settings,
    )


def answer_text(
    query: str, context: str, generate_fn: GenerateFn, template: str = PROMPT, settings: GenerationSettings = GenerationSettings()
) -> str:
    """One question with a given context, outside any job."""
    prompt = template.replace("{context}", context, 1)
    at = prompt.rindex("{query}")
    return _with_settings(generate_fn, settings)([prompt[:at] + query + prompt[at + len("{query}") :]])[0]


def answer_hits(
    queries: DataFrame,
    hits: DataFrame,
    registry: DataFrame,
    max_hits: int | None = None,
    max_chars: int = MAX_CONTEXT,
    generate_fn: GenerateFn | None = None,
    template: str = PROMPT,
    disclaimer: str = DISCLAIMER,
    settings: GenerationSettings = GenerationSettings(),
) -> DataFrame:
    sourced = attach_sources(hits, registry, max_hits)
    ready = with_contexts(queries, build_context(sourced, max_chars)).withColumn(
        "prompt", build_prompt(F.col("context"), F.col("query"), template)
    )
    if generate_fn is None:
        ready = ready.withColumn("answer", extractive_answer(F.col("top_text")))
    else:
        ready = generate(ready, generate_fn, settings=settings)
    empty = F.array().cast(ready.schema["sources"].dataType)
    return ready.select(
        "query_id",
        "query",
        "answer",
        F.coalesce("sources", empty).alias("sources"),
        "confidence",
        F.lit(disclaimer).alias("disclaimer"),
    )


def citations(answers: DataFrame) -> DataFrame:
    """One row per distinct source cited in an answer: query_id, source_no, id, source."""
    numbers = F.array_distinct(F.regexp_extract_all("answer", F.lit(CITATION), 1))
    return (
        answers.select("query_id", "sources", F.explode(numbers).alias("n"))
        .withColumn("source_no", F.col("n").try_cast("int"))
        .withColumn("cited", F.get("sources", F.col("source_no") - 1))
        .where(F.col("cited").isNotNull())
        .select("query_id", "source_no", "cited.id", "cited.source")
    )
