from sensorloom.llm.cross_polytope import PROBES, bucket_links


def test_equal_keys_of_two_dimensions(spark):
    """Vectors of 4 and 3 numbers whose short bucket keys are equal do not meet."""
    keys = [7] * (2 * (1 + PROBES))
    rows = [(1, 1, [1.0, 0.0, 0.0, 0.0], 4, keys), (2, 1, [1.0, 0.01, 0.0, 0.0], 4, keys), (3, 1, [1.0, 0.0, 0.0], 3, keys), (4, 1, [1.0, 0.01, 0.0], 3, keys), (5, 1, [1.0, 0.0], 2, keys)]
    coded = spark.createDataFrame(rows, "rep long, copies long, vector array<double>, d int, keys array<int>")
    got = {}
    for r in bucket_links(coded, 0.95).collect():
        got.setdefault(r.root, {}).setdefault(r.rep, []).append(r.links)
    assert {root: {rep: sum(n) for rep, n in x.items()} for root, x in got.items()} == {1: {1: 1, 2: 1}, 3: {3: 1, 4: 1}}
