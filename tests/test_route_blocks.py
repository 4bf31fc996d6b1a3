"""How many queries a task of the tree search routes at once."""

from medlake.operators import tree_index


def test_leaves_are_weighed_for_few_queries_at_once(spark):
    lists = "array<double>"
    leaves = [(i, 3, [float(i), 1.0], [0.5, 0.5], 1.0, 40.0) for i in range(30)]
    leaves = spark.createDataFrame(leaves, f"leaf long, n long, mean {lists}, variance {lists}, radius double, longest double")
    index, m, most = tree_index.TreeIndex(leaves, leaves, 2, "dot"), 400, tree_index.ROUTED
    queries = spark.createDataFrame([(i, [1.0, float(i)], None) for i in range(m)], "query_id long, embedding array<double>, floor double")

    def choose(floor, middle, reach, spread, n):
        if len(middle) > most:
            raise ValueError(f"{len(middle)} queries at once")
        return middle >= middle.max(axis=1, keepdims=True) - 1.5, middle

    got = tree_index._meetings(queries, m, index, 30, choose)
    assert sorted((r["query_id"], r["leaf"], r["weight"]) for r in got.collect()) == [
        (q, leaf, float(leaf + q)) for q in range(m) for leaf in (28, 29)
    ]
