import random
import re
from collections import Counter, defaultdict

import pytest

from sensorloom.operators import templates as tm

HOLE = "<_>"


def brute(lines, depth, most, share):
    """The tree in plain Python: template by masked line, and lines by template."""
    masked = [re.sub(r"\d+", HOLE, x).strip() for x in lines if x is not None]
    tokens = {m: re.split(r"\s+", m) for m in masked}
    count = Counter(masked)

    def stays(counts):
        total = sum(counts.values())
        return set(counts) if len(counts) <= most else {t for t, n in counts.items() if n >= share * total}

    path = {m: (len(t),) for m, t in tokens.items()}
    for level in range(depth):
        nodes = defaultdict(Counter)
        for m, t in tokens.items():
            if len(t) > level:
                nodes[path[m]][t[level]] += count[m]
        kept = {n: stays(c) for n, c in nodes.items()}
        path = {m: path[m] + ((t[level] if t[level] in kept[path[m]] else HOLE),) if len(t) > level else path[m] for m, t in tokens.items()}
    places = defaultdict(Counter)
    for m, t in tokens.items():
        for i in range(depth, len(t)):
            places[path[m], i][t[i]] += count[m]
    kept = {p: stays(c) for p, c in places.items()}
    out = {m: " ".join([*path[m][1:], *(x if x in kept[path[m], i] else HOLE for i, x in list(enumerate(t))[depth:])]) for m, t in tokens.items()}
    made = Counter()
    for m, n in count.items():
        made[out[m]] += n
    return out, made


def log(seed=1, n=900):
    rnd = random.Random(seed)
    names = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(120)]
    shapes = [
        lambda: f"open session for {rnd.choice(names)} on port {rnd.randint(1, 9999)}",
        lambda: f"close session for {rnd.choice(names)} on port {rnd.randint(1, 9999)}",
        lambda: f"{rnd.choice(names)} disk   {rnd.choice(['full', 'slow'])}",
        lambda: f"alarm {rnd.choice(names)} {rnd.choice(names)} {rnd.choice(['red', 'red', 'red', 'green'])}",
        lambda: rnd.choice(["", "  ", "one", None, "é ü", names[0]]),
    ]
    return [rnd.choice(shapes)() for _ in range(n)]


@pytest.mark.parametrize("depth, most, share", [(3, 20, 0.05), (1, 5, 0.2), (0, 3, 0.3), (6, 10, 0.5)])
def test_equal_to_a_plain_tree_in_any_partitioning(spark, depth, most, share):
    lines = log()
    want, counts = brute(lines, depth, most, share)
    for parts, seed in ((1, 0), (7, 5)):
        rows = [(i, x) for i, x in enumerate(lines)]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id long, line string").repartition(parts)
        options = {"depth": depth, "max_children": most, "min_share": share}
        got = {r.template: (r.n_lines, r.n_forms) for r in tm.mined_templates(df, **options).collect()}
        assert got == {t: (n, sum(x == t for x in want.values())) for t, n in counts.items()}
    each = {r.id: r.template for r in tm.with_template(df, **options).collect()}
    assert len(each) == len(lines)
    assert all(each[i] == (None if x is None else want[re.sub(r"\d+", HOLE, x).strip()]) for i, x in enumerate(lines))


def test_words_that_masks_do_not_find(spark):
    rows = [(f"login of {a}{b} failed",) for a in "abcdefgh" for b in "klmnopqr"] + [("login of root failed",)] * 30
    got = {r.template: r.n_lines for r in tm.mined_templates(spark.createDataFrame(rows, "line string")).collect()}
    assert got == {"login of <_> failed": 64, "login of root failed": 30}


def test_empty(spark):
    none = spark.createDataFrame([], "line string")
    assert tm.mined_templates(none).count() == 0 and tm.with_template(none).count() == 0
    assert tm.mined_templates(spark.createDataFrame([(None,)], "line string")).count() == 0
