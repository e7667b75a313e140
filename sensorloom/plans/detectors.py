"""Catalogue: anomaly and drift detectors."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.timefn import time_text
from ..operators.detect import bands, clusters, cumulative, drift, forest, neighbours
from ..operators.detect.nearest import knn_score_whole
from ..operators.detect.online_clusters import online_kmeans
from ..session import scratch_path
from .registry import query, r4, r6, r8, table
from .timeseries import SMALL
from .views import ORDER, SERIES, SQL_GAPPY, SQL_READINGS, gappy, readings, vectors


@query(
    "ksigma_flag",
    f"""WITH r AS ({SQL_READINGS}), s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM r WHERE data_type = 'train')
    SELECT event_id, CASE WHEN value > m + sd OR value < m - sd THEN 1 ELSE 0 END AS anomaly_flag
    FROM r, s WHERE data_type = 'test'""",
)
def ksigma(spark, d):
    r = readings(spark, d)
    stats = bands.ksigma_fit(r, "value", F.col("data_type") == "train")
    return bands.ksigma_flag(r.where(F.col("data_type") == "test"), "value", stats).select("event_id", "anomaly_flag")


# Baselines made for the test columns: (mean, deviation).
BASELINES = {
    "l_quantity": (25, 14),
    "l_extendedprice": (35000, 20000),
    "l_discount": (0.05, 0.03),
    "l_tax": (0.04, 0.025),
}


@query(
    "zscore_flag",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - {m}) / {s}, 8) AS z_{c}, CASE WHEN abs(({c} - {m}) / {s}) > 1.5 THEN 1 ELSE 0 END AS anomaly_{c}"
        for c, (m, s) in BASELINES.items()
    )
    + " FROM lineitem",
)
def zscore(spark, d):
    out = bands.zscore_flag(table(spark, d, "lineitem"), BASELINES, 1.5)
    return out.select(
        "l_orderkey", "l_linenumber", *[r8(f"z_{c}") for c in BASELINES], *[f"anomaly_{c}" for c in BASELINES]
    )


_CUSUM = f"""WITH z AS (SELECT event_type, event_id, ts, CASE WHEN isnan(value) THEN NULL ELSE (value - 50) / 49 END AS z
        FROM ({SQL_GAPPY})),
    p AS (SELECT *, sum(coalesce(z - 0.5, 0)) OVER w AS up, sum(coalesce(-z - 0.5, 0)) OVER w AS down
        FROM z WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
    s AS (SELECT *, up - least(0, min(up) OVER w) AS a, down - least(0, min(down) OVER w) AS b
        FROM p WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
    SELECT event_id, CASE WHEN z IS NOT NULL THEN round(a, 6) END AS cusum_pos, CASE WHEN z IS NOT NULL THEN round(b, 6) END AS cusum_neg,
        CASE WHEN z IS NOT NULL AND greatest(a, b) > 5 THEN 1 ELSE 0 END AS alarm FROM s"""


def _cusum(spark, d, chunk_rows=None):
    out = cumulative.cusum(gappy(spark, d), SERIES, ORDER, "value", 50, 49, chunk_rows=chunk_rows)
    return out.select("event_id", r6("cusum_pos"), r6("cusum_neg"), "alarm")


@query("cusum_two_sided", _CUSUM)
def cusum(spark, d):
    return _cusum(spark, d)


@query("cusum_two_sided_chunked", _CUSUM)
def cusum_chunked(spark, d):
    return _cusum(spark, d, SMALL)


@query(
    "ewma_lag1",
    """WITH l AS (SELECT event_id, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS b FROM events)
    SELECT event_id, round(CASE WHEN b IS NULL THEN value ELSE 0.2 * value + 0.8 * b END, 6) AS ewma FROM l""",
)
def ewma_lag1(spark, d):
    return cumulative.ewma_lag1(table(spark, d, "events"), SERIES, ORDER, "value").select("event_id", r6("ewma"))


_EWMA = """WITH RECURSIVE r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i
        FROM events),
    e AS (SELECT event_type, event_id, i, value AS ewma FROM r WHERE i = 1
        UNION ALL SELECT r.event_type, r.event_id, r.i, 0.2 * r.value + 0.8 * e.ewma FROM e
        JOIN r ON r.event_type = e.event_type AND r.i = e.i + 1)
    SELECT event_id, round(ewma, 6) AS ewma FROM e"""


@query("ewma_recursive", _EWMA)
def ewma(spark, d):
    return cumulative.ewma(table(spark, d, "events"), SERIES, ORDER, "value").select("event_id", r6("ewma"))


@query("ewma_recursive_chunked", _EWMA)
def ewma_chunked(spark, d):
    out = cumulative.ewma(table(spark, d, "events"), SERIES, ORDER, "value", chunk_rows=SMALL)
    return out.select("event_id", r6("ewma"))


_BAND = """WITH w AS (SELECT event_id, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 49 PRECEDING))
    SELECT event_id, CASE WHEN value > m + 2 * s OR value < m - 2 * s THEN 1 ELSE 0 END AS anomaly FROM w"""


@query("rolling_band_flag", _BAND)
def band(spark, d):
    out = bands.adaptive_band_flag(table(spark, d, "events"), SERIES, ORDER, "value")
    return out.select("event_id", "anomaly")


@query("rolling_band_total", f"SELECT CAST(sum(anomaly) AS BIGINT) AS anomalies, count(*) AS n_rows FROM ({_BAND})")
def band_total(spark, d):
    out = bands.adaptive_band_flag(table(spark, d, "events"), SERIES, ORDER, "value", chunk_rows=SMALL)
    return out.agg(F.sum("anomaly").alias("anomalies"), F.count(F.lit(1)).alias("n_rows"))


@query(
    "ewma_band_flag",
    """WITH l AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS b FROM events),
    e AS (SELECT *, CASE WHEN b IS NULL THEN value ELSE 0.2 * value + 0.8 * b END AS ewma FROM l),
    w AS (SELECT event_id, ewma, avg(ewma) OVER w AS m, stddev_samp(ewma) OVER w AS s
        FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 49 PRECEDING))
    SELECT event_id, round(ewma, 8) AS ewma, CASE WHEN ewma > m + 2 * s OR ewma < m - 2 * s THEN 1 ELSE 0 END AS anomaly FROM w""",
)
def ewma_band(spark, d):
    """Band around the smoothed reading: smoothing, rolling statistics and flag in a row."""
    smooth = cumulative.ewma_lag1(table(spark, d, "events"), SERIES, ORDER, "value")
    return bands.adaptive_band_flag(smooth, SERIES, ORDER, "ewma").select("event_id", r8("ewma"), "anomaly")


def adwin_sql(rows: str, block: int, levels: int = 14) -> str:
    """The whole test as a recursion over looks and dropped buckets.

    ``rows`` has ``event_id, event_type, data_type, ts, value``. The state of a series is the look it has come to and its number of
    buckets per level ``c0, c1, ...``; sums of buckets are differences of running sums. A step either drops
    the oldest bucket, if the window has a cut, or goes to the next look.
    """
    every = -(-32 // block)
    each = range(levels)
    names = ", ".join(f"c{i}" for i in each)
    width = " + ".join(f"c{i} * {1 << i}" for i in each)
    slots = ", ".join(
        f"{{'ok': c{i} >= {s}, 'p': look - ({' + '.join([f'c{j} * {1 << j}' for j in range(i)] + [str(s << i)])})}}" for i in each for s in range(1, 6)
    )
    # A level of more than five buckets sends pairs up: how many, level by level.
    sent = ["", *[f"(c{i} + x{i})" for i in each]]
    growing = f"SELECT *, {every} AS x0 FROM judged"
    for i in each:
        growing = f"SELECT *, greatest(0, (c{i} + x{i} - 4) // 2) AS x{i + 1} FROM ({growing})"
    top = "CASE " + " ".join(f"WHEN c{i} > 0 THEN {i}" for i in reversed(each)) + " END"
    moved = ", ".join(f"CASE WHEN hit THEN c{i} - CASE WHEN top = {i} THEN 1 ELSE 0 END ELSE {sent[i + 1]} - 2 * x{i + 1} END AS c{i}" for i in each)
    first, start = f"SELECT 0 AS z, {every} AS x0", []
    for i in each:
        first = f"SELECT *, greatest(0, (x{i} - 4) // 2) AS x{i + 1} FROM ({first})"
        start.append(f"x{i} - 2 * x{i + 1} AS c{i}")
    return f"""WITH RECURSIVE known AS (
        SELECT event_type, data_type, event_id, value - avg(value) OVER (PARTITION BY event_type, data_type) AS x,
            row_number() OVER (PARTITION BY event_type, data_type ORDER BY ts, event_id) AS i
        FROM ({rows}) WHERE value IS NOT NULL AND NOT isnan(value)),
    items AS (
        SELECT event_type, data_type, (i - 1) // {block} + 1 AS item, count(*) AS n, sum(x) AS t, sum(x * x) AS q, arg_max(event_id, i) AS last_id
        FROM known GROUP BY ALL),
    running AS (
        SELECT *, sum(n) OVER w AS sn, sum(t) OVER w AS st, sum(q) OVER w AS sq FROM items
        WINDOW w AS (PARTITION BY event_type, data_type ORDER BY item)),
    series AS (
        SELECT event_type, data_type, max(item) AS items, arg_max(n, item) AS last_rows, list_prepend(0, list(CAST(sn AS DOUBLE) ORDER BY item)) AS sn,
            list_prepend(0, list(st ORDER BY item)) AS st, list_prepend(0, list(sq ORDER BY item)) AS sq
        FROM running GROUP BY ALL),
    walk AS (
        SELECT event_type, data_type, {every} AS look, FALSE AS was_cut, {", ".join(start)} FROM series, ({first}) WHERE items >= {every}
        UNION ALL
        SELECT event_type, data_type, CASE WHEN hit THEN look ELSE look + {every} END, hit, {moved}
        FROM (
            WITH sized AS (
                SELECT walk.*, items, sn, st, sq, sn[look + 1] - sn[look + 1 - ({width})] AS n, st[look + 1] - st[look + 1 - ({width})] AS t,
                    sq[look + 1] - sq[look + 1 - ({width})] AS q, look - ({width}) AS begin, {top} AS top
                FROM walk JOIN series USING (event_type, data_type)
                WHERE look < items OR (look = items AND {(every - 1) * block} + last_rows >= 32)),
            spread AS (SELECT *, greatest(q - t * t / n, 0) / n AS v, ln(2 * ln(greatest(n, 2)) / 0.002) AS s FROM sized),
            splits AS (
                SELECT * EXCLUDE (sn, st, sq), list_transform(list_filter([{slots}], lambda x: x.ok AND x.p > begin),
                    lambda x: {{'n1': sn[look + 1] - sn[x.p + 1], 't1': st[look + 1] - st[x.p + 1]}}) AS parts FROM spread),
            judged AS (
                SELECT * EXCLUDE (parts), n > 10 AND len(list_filter(parts, lambda x: x.n1 >= 5 AND n - x.n1 >= 5
                    AND abs((t - x.t1) / (n - x.n1) - x.t1 / x.n1) > sqrt(2 * (1 / (n - x.n1 - 4) + 1 / (x.n1 - 4)) * v * s)
                        + 2 / 3 * (1 / (n - x.n1 - 4) + 1 / (x.n1 - 4)) * s)) > 0 AS hit FROM splits)
            {growing}) WHERE hit OR look < items),
    cuts AS (SELECT DISTINCT event_type, data_type, look AS item FROM walk WHERE was_cut)
    SELECT r.event_id, r.event_type, r.data_type, CASE WHEN c.last_id IS NULL THEN 0 ELSE 1 END AS drift_detected
    FROM ({rows}) r LEFT JOIN (SELECT last_id FROM cuts JOIN items USING (event_type, data_type, item)) c ON r.event_id = c.last_id"""


@query("adwin", adwin_sql(SQL_READINGS, 32))
def adwin(spark, d):
    out = drift.adwin(readings(spark, d), ["event_type", "data_type"], ORDER, "value")
    return out.select("event_id", "event_type", "data_type", "drift_detected")


#: Readings whose level changes every nine days.
SQL_SHIFTED = f"SELECT * REPLACE (value + 60 * ((extract(day FROM ts) // 9) % 3) AS value) FROM ({SQL_READINGS})"


def shifted(df):
    """Readings with the level changes of :data:`SQL_SHIFTED`."""
    return df.withColumn("value", F.col("value") + 60 * (F.floor(F.dayofmonth("ts") / 9) % 3))


@query("adwin_shifts", adwin_sql(SQL_SHIFTED, 32))
def adwin_shifts(spark, d):
    """Series with many cuts, cut into chunks that are walked at once."""
    out = drift.adwin(shifted(readings(spark, d)), ["event_type", "data_type"], ORDER, "value", chunk_blocks=64)
    return out.select("event_id", "event_type", "data_type", "drift_detected")


@query(
    "adwin_blocks",
    f"""WITH r AS (SELECT event_type, data_type, event_id, value,
            row_number() OVER (PARTITION BY event_type, data_type ORDER BY ts, event_id) AS i FROM ({SQL_READINGS}))
    SELECT event_type, data_type, (i - 1) // 32 AS block, CAST(count(*) AS DOUBLE) AS n, round(sum(value), 4) AS total,
        arg_max(event_id, i) AS last_id FROM r GROUP BY 1, 2, 3""",
)
def adwin_blocks(spark, d):
    out = drift.adwin_blocks(readings(spark, d), ["event_type", "data_type"], ORDER, "value", 32, chunk_rows=SMALL)
    return out.select("event_type", "data_type", "block", "n", r4("total"), F.col("end.event_id").alias("last_id"))


_KNN = """WITH r AS (SELECT {id} AS id, {v} AS v, (row_number() OVER (ORDER BY {order}) - 1) // 500 AS block FROM ({src})),
    p AS (SELECT a.id, a.block, list_distance(a.v, b.v) AS dist,
            row_number() OVER (PARTITION BY a.block, a.id ORDER BY list_distance(a.v, b.v)) AS rn
        FROM r a JOIN r b ON a.block = b.block AND a.id <> b.id),
    m AS (SELECT id, block, avg(dist) AS mean FROM p WHERE rn <= 5 GROUP BY 1, 2)
    SELECT id AS {id}, block, round(mean / max(mean) OVER (PARTITION BY block), 6) AS knn_score FROM m"""


#: Neighbours among all rows of a group, however many; equal rows count each.
KNN_WHOLE = """WITH r AS (SELECT event_id, {v} AS v, {group} AS g FROM ({src})),
    p AS (SELECT a.event_id, a.g, list_distance(a.v, b.v) AS dist,
            row_number() OVER (PARTITION BY a.event_id ORDER BY list_distance(a.v, b.v)) AS rn
        FROM r a JOIN r b ON a.g = b.g AND a.event_id <> b.event_id),
    m AS (SELECT event_id, g, avg(dist) AS mean FROM p WHERE rn <= 5 GROUP BY 1, 2)
    SELECT event_id, round(mean / max(mean) OVER (PARTITION BY g), 6) AS knn_score FROM r LEFT JOIN m USING (event_id, g)"""


@query("knn_score_by_day", KNN_WHOLE.format(src=SQL_READINGS, v="[value, CAST(user_id AS DOUBLE), CAST(k AS DOUBLE)]", group="date_trunc('day', ts)"))
def knn_by_day(spark, d):
    """Each event against all of its day, in cells of a few hundred points."""
    rows = readings(spark, d).select("event_id", F.date_trunc("day", "ts").alias("day"), "value", "user_id", "k")
    return knn_score_whole(rows, ["day"], ["value", "user_id", "k"], cell_points=200).select("event_id", r6("knn_score"))


@query(
    "knn_score",
    _KNN.format(
        id="event_id", order="ts, event_id", src=SQL_READINGS,
        v="[value, CAST(user_id AS DOUBLE), CAST(k AS DOUBLE)]",
    ),
)
def knn(spark, d):
    out = neighbours.knn_score(
        readings(spark, d).select("event_id", "ts", "value", "user_id", "k"), ORDER, ["value", "user_id", "k"]
    )
    return out.select("event_id", "block", r6("knn_score"))


@query(
    "knn_score_vectors",
    _KNN.format(id="vec_id", order="vec_id", src="SELECT * FROM embeddings", v="CAST(embedding AS DOUBLE[])"),
)
def knn_vectors(spark, d):
    e, names = vectors(spark, d)
    out = neighbours.knn_score(e, ["vec_id"], names)
    return out.select("vec_id", "block", r6("knn_score"))


@query(
    "minmax_scale",
    """WITH f AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_discount) AS c, max(l_discount) AS e
        FROM lineitem WHERE l_linestatus = 'O')
    SELECT l_orderkey, l_linenumber, round((l_quantity - a) / nullif(b - a, 0), 6) AS l_quantity_scaled,
        round((l_discount - c) / nullif(e - c, 0), 6) AS l_discount_scaled FROM lineitem, f WHERE l_linestatus = 'F'""",
)
def minmax(spark, d):
    li = table(spark, d, "lineitem")
    fit, apply = li.where(F.col("l_linestatus") == "O"), li.where(F.col("l_linestatus") == "F")
    out = clusters.minmax_scale(apply, ["l_quantity", "l_discount"], fit)
    return out.select("l_orderkey", "l_linenumber", r6("l_quantity_scaled"), r6("l_discount_scaled"))


CENTRES = [[10.0, 50.0], [60.0, 90.0], [150.0, 20.0]]
_D = [f"(value - {a}) * (value - {a}) + (user_id - {b}) * (user_id - {b})" for a, b in CENTRES]


@query(
    "nearest_centroid",
    f"""SELECT event_id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster,
        round(sqrt(least(d0, d1, d2)), 6) AS cluster_distance
    FROM (SELECT event_id, {_D[0]} AS d0, {_D[1]} AS d1, {_D[2]} AS d2 FROM events)""",
)
def nearest(spark, d):
    out = clusters.nearest_centroid(table(spark, d, "events"), ["value", "user_id"], CENTRES)
    return out.select("event_id", "cluster", r6("cluster_distance"))


def _fitted_kmeans(spark, d):
    r = readings(spark, d).select("event_id", "data_type", "value", "user_id", "k")
    train, test = (r.where(F.col("data_type") == t) for t in ("train", "test"))
    cols = ["value", "user_id", "k"]
    train_scaled = clusters.minmax_scale(train, cols)
    test_scaled = clusters.minmax_scale(test, cols, train)
    model = clusters.kmeans_fit(train_scaled, [f"{c}_scaled" for c in cols])
    return model, train_scaled, test_scaled


@query("kmeans_anomalies")
def kmeans(spark, d):
    """Clusters of scaled train rows; the smaller cluster is the anomaly, also for test rows."""
    model, train, test = _fitted_kmeans(spark, d)
    small = clusters.smallest_trained_cluster(model)
    return clusters.kmeans_anomalies(test, model, small).select("event_id", "cluster", "prediction")


@query(
    "kmeans_saved_model",
    f"SELECT count(*) AS n_rows, 0 AS other_labels, 0 AS not_nearest FROM ({SQL_READINGS}) WHERE data_type = 'test'",
)
def kmeans_saved(spark, d):
    """The same model after saving and loading: rows, rows labelled otherwise than by the unsaved
    model, and rows whose label is not the nearest centre. That the centres are a good
    clustering is not proved by it."""
    model, _, test = _fitted_kmeans(spark, d)
    path = scratch_path(spark, "kmeans")
    model.write().save(path)
    centres = [[float(x) for x in c] for c in model.stages[-1].clusterCenters()]
    columns = [f"{c}_scaled" for c in ("value", "user_id", "k")]
    one = clusters.kmeans_predict(test, model).withColumnRenamed("cluster", "first")
    two = clusters.kmeans_predict(one, PipelineModel.load(path)).withColumnRenamed("cluster", "second")
    out = clusters.nearest_centroid(two, columns, centres)
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("first") != F.col("second")).cast("int").alias("other_labels"),
        F.count_if(F.col("first") != F.col("cluster")).cast("int").alias("not_nearest"),
    )


@query(
    "isolation_forest_rules",
    f"SELECT count(*) AS n_rows, 0 AS out_of_range, 0 AS flag_differs, 0 AS after_reload FROM ({SQL_READINGS}) WHERE data_type = 'test'",
)
def iforest_rules(spark, d):
    """Rows, scores outside (0, 1], flags that are not those of the threshold, and scores that differ
    after saving and loading. That high scores are anomalies is not proved by it."""
    r = readings(spark, d)
    train, test = (r.where(F.col("data_type") == t) for t in ("train", "test"))
    model = forest.iforest_fit(train, "event_id", ["value", "user_id", "k"])
    path = scratch_path(spark, "forest")
    model.save(path)
    loaded = forest.IsolationForest.load(spark, path)
    one = forest.iforest_score(test, model).select("event_id", "anomaly_score", "anomaly")
    two = forest.iforest_score(test, loaded).select("event_id", F.col("anomaly_score").alias("again"))
    score = F.col("anomaly_score")
    return one.join(two, "event_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if((score <= 0) | (score > 1)).cast("int").alias("out_of_range"),
        F.count_if((score > loaded.threshold) != (F.col("anomaly") == 1)).cast("int").alias("flag_differs"),
        F.count_if(score != F.col("again")).cast("int").alias("after_reload"),
    )


@query("isolation_forest")
def iforest(spark, d):
    """Trained on the train rows, saved, loaded, applied to the test rows."""
    r = readings(spark, d)
    train, test = (r.where(F.col("data_type") == t) for t in ("train", "test"))
    model = forest.iforest_fit(train, "event_id", ["value", "user_id", "k"])
    path = scratch_path(spark, "forest")
    model.save(path)
    out = forest.iforest_score(test, forest.IsolationForest.load(spark, path))
    return out.select("event_id", time_text("ts").alias("time"), r6("anomaly_score"), "anomaly")


#: First centres of value and user, and the way a centre goes to a row.
FIRST_CENTRES = [[10.0, 100.0], [60.0, 400.0], [150.0, 800.0]]


def _online_sql(last: str) -> str:
    """Centres that move row by row over the train rows, as a recursion; ``last`` selects from ``folds`` and ``readings``."""
    three = range(len(FIRST_CENTRES))
    far = lambda j, v, u: f"(({v} - v{j}) * ({v} - v{j}) + ({u} - u{j}) * ({u} - u{j}))"
    near = lambda v, u: f"CASE WHEN {far(0, v, u)} <= {far(1, v, u)} AND {far(0, v, u)} <= {far(2, v, u)} THEN 0 WHEN {far(1, v, u)} <= {far(2, v, u)} THEN 1 ELSE 2 END"
    start = ", ".join(f"CAST({v} AS DOUBLE) AS v{j}, CAST({u} AS DOUBLE) AS u{j}" for j, (v, u) in enumerate(FIRST_CENTRES))
    move = ", ".join(f"CASE WHEN best = {j} THEN {c}{j} + 0.5 * ({x} - {c}{j}) ELSE {c}{j} END" for j in three for c, x in (("v", "x"), ("u", "y")))
    names = ", ".join(f"{c}{j}" for j in three for c in "vu")
    return f"""WITH RECURSIVE readings AS (SELECT event_id, ts, data_type, value, CAST(user_id AS DOUBLE) AS user FROM ({SQL_READINGS})),
    train AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS i FROM readings WHERE data_type = 'train'),
    listed AS (SELECT list(value ORDER BY i) AS vs, list(user ORDER BY i) AS us FROM train),
    folds AS (
        SELECT 0 AS i, -1 AS best, {start}
        UNION ALL
        SELECT i, best, {move} FROM (SELECT i + 1 AS i, x, y, {near("x", "y")} AS best, {names} FROM (
            SELECT folds.*, vs[i + 1] AS x, us[i + 1] AS y FROM folds, listed WHERE i < len(vs)))),
    final AS (SELECT {names} FROM folds ORDER BY i DESC LIMIT 1),
    labelled AS (SELECT event_id, {near("value", "user")} AS cluster FROM readings, final WHERE data_type = 'test')
    {last}"""


@query(
    "kmeans_online",
    _online_sql("""SELECT event_id, 'train' AS data_type, CAST(best AS INTEGER) AS cluster FROM train JOIN folds USING (i)
    UNION ALL SELECT event_id, 'test', CAST(cluster AS INTEGER) FROM labelled"""),
)
def kmeans_online(spark, d):
    """Train rows with the centre that each moved, test rows with the nearest of the last centres; folded in small chunks."""
    rows = readings(spark, d).select("event_id", "ts", "data_type", "value", "user_id")
    train, test = (rows.where(F.col("data_type") == kind) for kind in ("train", "test"))
    moved, centres = online_kmeans(train, ORDER, ["value", "user_id"], FIRST_CENTRES, chunk_rows=SMALL)
    labelled = clusters.nearest_centroid(test, ["value", "user_id"], centres)
    return moved.select("event_id", "data_type", "cluster").union(labelled.select("event_id", "data_type", "cluster"))
