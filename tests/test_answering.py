import pytest
from pyspark.sql import functions as F

from medlake.operators import answering


def hits(spark, rows):
    return spark.createDataFrame(
        rows, "query_id int, id int, distance double, rank int, text string, content string, source string"
    )


def test_context_blocks_and_fallbacks(spark):
    rows = [
        (1, 9, 0.8, 2, None, "from content", None),
        (1, 8, 0.9, 1, "first", None, "a.txt"),
        (1, 7, 0.7, 3, None, None, "c"),
    ]
    row = answering.build_context(hits(spark, rows)).first()
    assert row.context == "[Source 1: a.txt]\nfirst\n\n[Source 2: Document 2]\nfrom content\n\n[Source 3: c]\n"
    assert [s.id for s in row.sources] == [8, 9, 7] and row.top_text == "first"


def test_context_length_limit(spark):
    header = "[Source 1: s]\n"
    exact = 100 - len(header)
    for extra, tail in ((0, ""), (1, "...")):
        row = answering.build_context(
            hits(spark, [(1, 1, 0.9, 1, "x" * (exact + extra), None, "s")]), max_chars=100
        ).first()
        assert row.context == header + "x" * exact + tail
    two = answering.build_context(
        hits(spark, [(1, 1, 0.9, 1, "x" * 500, None, "s"), (1, 2, 0.8, 2, "y" * 500, None, "t")]), max_chars=100
    ).first()
    assert len(two.context) == 103 and two.context.endswith("x...")


@pytest.mark.parametrize("n,want", [(1, 0.9), (2, 0.85), (3, 0.8), (4, 0.8)])
def test_confidence_uses_first_three(spark, n, want):
    scores = [0.9, 0.8, 0.7, 0.1][:n]
    rows = [(1, i, s, i + 1, "t", None, "s") for i, s in enumerate(scores)]
    assert answering.build_context(hits(spark, rows)).first().confidence == pytest.approx(want)


def corpus(spark):
    return spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 1.0])], "id int, embedding array<float>")


def registry(spark):
    return spark.createDataFrame(
        [(1, "Lungs clear. More text.", "r1"), (2, "Second", None)], "id int, text string, source string"
    )


def questions(spark):
    return spark.createDataFrame(
        [(1, "clear?", [1.0, 0.0]), (2, "none", [-1.0, -1.0])], "query_id int, query string, embedding array<float>"
    )


def test_answer_records(spark):
    got = {r.query_id: r for r in answering.answer_queries(questions(spark), corpus(spark), registry(spark), 2).collect()}
    assert got[1].answer == "Lungs clear. [Source 1]"
    assert [s.id for s in got[1].sources] == [1, 2]
    assert got[1].confidence == pytest.approx(0.9) and got[1].disclaimer == answering.DISCLAIMER
    assert (got[2].answer, got[2].sources, got[2].confidence) == (answering.NO_ANSWER, [], 0.0)


def test_generate_hook_and_citations(spark):
    def model(prompts):
        return [
            "Seen in Source 2 and Source 1, not Source 9." if "Lungs" in p else "no source" for p in prompts
        ]

    answers = answering.answer_queries(
        questions(spark), corpus(spark), registry(spark), 2, generate_fn=model
    )
    cited = answering.citations(answers).orderBy("source_no").collect()
    assert [(r.query_id, r.source_no, r.id, r.source) for r in cited] == [(1, 1, 1, "r1"), (1, 2, 2, None)]


def test_prompt_template(spark):
    row = spark.range(1).select(
        answering.build_prompt(F.lit("CTX"), F.lit("Q?"), "a {context} b {query} c").alias("p")
    ).first()
    assert row.p == "a CTX b Q? c"


def test_empty_corpus_gives_zero_confidence(spark):
    none = corpus(spark).where("id > 10")
    rows = answering.answer_queries(questions(spark), none, registry(spark), 2).collect()
    assert [r.confidence for r in rows] == [0.0, 0.0]


def test_single_questions(spark):
    from medlake.operators.embedding import embed_text, embed_texts
    from medlake.plans.ask import ask, search_similar

    docs = spark.createDataFrame(
        [(1, "opacity in the left lung", "a"), (2, "broken wrist", "b")], "id int, text string, source string"
    )
    stored = embed_texts(docs, dim=64).select("id", "embedding")
    assert [r.id for r in search_similar("left lung opacity", stored, 1, dim=64)] == [1]
    record = ask("left lung opacity", stored, docs, dim=64, min_score=0.4)
    assert record.answer == "opacity in the left lung [Source 1]" and [s.id for s in record.sources] == [1]
    assert len(embed_text("lung")) == 768
    said = answering.answer_text("why?", "because {query}", lambda p: [p[0].split("Context:\n")[1]])
    assert said == "because {query}\n\nQuestion: why?\nAnswer:"


def test_generation_settings_reach_hooks_that_take_them(spark):
    from medlake.operators.answering import GenerationSettings, answer_text, generate

    df = spark.createDataFrame([(1, "a"), (2, "b")], "query_id int, prompt string")
    told = lambda prompts, settings: [f"{p} {settings.temperature} {settings.max_output_tokens}" for p in prompts]
    assert sorted(r.answer for r in generate(df, told).collect()) == ["a 0.2 2048", "b 0.2 2048"]
    cold = GenerationSettings(0.0, 10)
    assert sorted(r.answer for r in generate(df, told, settings=cold).collect()) == ["a 0.0 10", "b 0.0 10"]
    assert answer_text("q", "c", told, "{context}{query}", cold) == "cq 0.0 10"
    assert sorted(r.answer for r in generate(df, lambda prompts: prompts).collect()) == ["a", "b"]
