"""Clustering: small k-means clusters, density noise, components, local outlier factor."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.operators.axes import along, principal_axes
from vitalgrid.operators.knn import nearest
from vitalgrid.schema import KEYS
from vitalgrid.session import stored

SMALL_SHARE = 0.05


def plane(df: DataFrame, keys=KEYS) -> DataFrame:
    """Each day as a point: standardised value ``z`` and place in the series ``p``. Needs ``moments``."""
    w = Window.partitionBy(*keys).orderBy("ds")
    return (df.withColumn("z", (F.col("y") - F.col("mean")) / (F.col("std") + 1e-6))
            .withColumn("p", (F.row_number().over(w) - 1) / F.col("n")))


def _lloyd(pdf: pd.DataFrame, clusters: int, iterations: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["z", "ds"])
    xy = pdf[["z", "p"]].to_numpy()
    n = len(xy)
    k = min(clusters, n // 2)
    centres = xy[np.floor((np.arange(k) + 0.5) * n / k).astype(int)]
    for turn in range(iterations + 1):
        nearest = ((xy[:, None, :] - centres[None, :, :]) ** 2).sum(-1).argmin(1)
        size = np.bincount(nearest, minlength=k)
        if turn < iterations:
            sums = np.column_stack([np.bincount(nearest, xy[:, c], k) for c in (0, 1)])
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return pdf.drop(columns=["z", "p"]).assign(cluster=nearest.astype(np.int32), cluster_size=size[nearest])


def cluster_days(points: DataFrame, clusters: int = 4, iterations: int = 10, keys=KEYS) -> DataFrame:
    """K-means per series: the key of each day with its ``cluster`` and ``cluster_size``.

    Centres start at evenly spaced ranks of ``z``. Grouped pandas, so only give it series that can have clusters; it is
    dealt to a fixed number of tasks, as few bytes may be much work.
    """
    slim = points.select(*keys, "ds", "z", "p")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name not in ("z", "p"))
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return slim.repartition(tasks, *keys).groupBy(*keys).applyInPandas(
        lambda pdf: _lloyd(pdf, clusters, iterations), f"{fields}, cluster int, cluster_size long")


def mark_small(points: DataFrame, clustered: DataFrame, share: float = SMALL_SHARE, keys=KEYS) -> DataFrame:
    """``is_small`` marks days of clusters with under ``share`` of the series' rows; days without cluster are not small."""
    return (points.join(clustered, [*keys, "ds"], "left")
            .withColumn("cluster_size", F.coalesce("cluster_size", F.col("n")))
            .withColumn("is_small", F.col("cluster_size") < F.col("n") * share))


def small_clusters(points: DataFrame, clusters: int = 4, iterations: int = 10, share: float = SMALL_SHARE,
                   min_points: int = 2, keys=KEYS) -> DataFrame:
    """``cluster_days`` and ``mark_small``; a series that is constant or has under ``min_points`` stays without clusters."""
    able = points.where((F.col("n") >= min_points) & (F.col("std") > 0))
    return mark_small(points, cluster_days(able, clusters, iterations, keys), share, keys)


def noise_points(points: DataFrame, eps: float = 0.5, min_samples: int = 3, keys=KEYS) -> DataFrame:
    """Keys of the points that density clustering leaves without a cluster.

    Only whether a point is noise matters, so no cluster is ever built. In
    cells of diagonal ``eps`` a point with ``min_samples`` cell mates is core;
    only points of thinner cells look at their neighbours, and the counts
    combine map-side.
    """
    side = eps / math.sqrt(2)
    near = F.sequence(F.lit(-2), F.lit(2))
    cells = (points.select(*keys, "ds", "z", "p", F.floor(F.col("z") / side).alias("cx"),
                           F.floor(F.col("p") / side).alias("cy"))
             .withColumn("dense", F.count(F.lit(1)).over(Window.partitionBy(*keys, "cx", "cy")) >= min_samples))
    thin = (cells.where(~F.col("dense"))
            .select(*keys, F.col("ds").alias("_ds"), F.col("z").alias("_z"), F.col("p").alias("_p"), "cx", "cy")
            .withColumn("_dx", F.explode(near)).withColumn("_dy", F.explode(near))
            .select(*keys, "_ds", "_z", "_p", (F.col("cx") + F.col("_dx")).alias("cx"),
                    (F.col("cy") + F.col("_dy")).alias("cy")))
    dz, dp = F.col("z") - F.col("_z"), F.col("p") - F.col("_p")
    seen = (thin.join(cells, [*keys, "cx", "cy"]).where(dz * dz + dp * dp <= eps * eps)
            .groupBy(*keys, "_ds").agg(
                F.count(F.lit(1)).alias("_n"), F.max("dense").alias("_near_dense"),
                # At most min_samples - 1 per thin cell, so at most 25 times that.
                F.collect_list(F.when(~F.col("dense"), F.col("ds"))).alias("_peers")))
    core = seen.where(F.col("_n") >= min_samples).select(*keys, F.col("_ds").alias("_peer"))
    lonely = seen.where((F.col("_n") < min_samples) & ~F.col("_near_dense"))
    reached = (lonely.select(*keys, "_ds", F.explode("_peers").alias("_peer"))
               .join(core, [*keys, "_peer"], "left_semi").select(*keys, "_ds").distinct())
    return (lonely.join(reached, [*keys, "_ds"], "left_anti")
            .select(*keys, F.col("_ds").alias("ds"), F.lit(True).alias("is_noise")))


def flag_noise(points: DataFrame, eps: float = 0.5, min_samples: int = 3, keys=KEYS) -> DataFrame:
    return mark_noise(points, noise_points(points, eps, min_samples, keys), keys)


def mark_noise(points: DataFrame, noise: DataFrame, keys=KEYS) -> DataFrame:
    return (points.join(noise, [*keys, "ds"], "left")
            .withColumn("is_noise", F.coalesce("is_noise", F.lit(False))))


def square_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


#: Principal axes a pair must be close on before its whole distance is computed, and those whose cells are joined.
AXES, JOINED_AXES = 8, 3


#: Points of a group that are compared with one another without cells.
ONE_CELL = 100


def occupied_neighbours(placed: DataFrame, by, cells) -> DataFrame:
    """``_to``: the cells next to each point's own, itself included, that hold points; only cells' keys are multiplied."""
    by, cells = list(by), list(cells)
    held = placed.select(*by, *cells).distinct()
    ahead = held.select(*by, *[F.col(c).alias(f"_{c}") for c in cells])
    for c in cells:
        ahead = ahead.withColumn(c, F.explode(F.sequence(F.col(f"_{c}") - 1, F.col(f"_{c}") + 1)))
    reach = (ahead.join(held, [*by, *cells], "left_semi").groupBy(*by, *[f"_{c}" for c in cells])
             .agg(F.collect_list(F.struct(*cells)).alias("_to")))
    return placed.join(reach.select(*by, *[F.col(f"_{c}").alias(c) for c in cells], "_to"), [*by, *cells])


def close_candidates(points: DataFrame, by, x: str, eps: float, axes: int = AXES) -> DataFrame:
    """Pairs (src, dst with its weight w, and both vectors) of a group that may be within ``eps``; each point is its own pair.

    A rotation keeps distances, so the distance over a few axes is never more than the whole one. Cells of width ``eps`` on
    the widest axes are joined by equality, and a point is only sent to cells that hold points; then all of the axes must
    agree. ``points``: by, pid, w and the vector.
    """
    by = list(by)
    found = principal_axes(points, x, axes)
    if not len(found):
        found = np.zeros((1, 1))
    # a hair wider, as the rotation rounds
    wide = eps * (1 + 1e-9) + 1e-9
    cells = [f"c{k}" for k in range(min(JOINED_AXES, len(found)))]
    placed = points.withColumn("_a", along(F.col(x), found))
    placed = placed.withColumns({c: F.floor(F.col("_a")[k] / wide) for k, c in enumerate(cells)})
    sent = occupied_neighbours(placed.drop("w"), by, cells).withColumn("_to", F.explode("_to"))
    probe = sent.select(*by, F.col("pid").alias("src"), F.col(x).alias("_x"), F.col("_a").alias("_b"), *[F.col(f"_to.{c}").alias(c) for c in cells])
    pairs = probe.join(placed, [*by, *cells])
    return pairs.where(square_distance(F.col("_b"), F.col("_a")) <= wide * wide).select(*by, "src", F.col("pid").alias("dst"), "w", "_x", x)


def near_candidates(points: DataFrame, by, x: str, eps: float, one_cell: int = ONE_CELL) -> DataFrame:
    """``close_candidates``, but all pairs of groups of up to ``one_cell`` points, whose vectors are sent once."""
    by = list(by)

    def all_pairs(some: DataFrame) -> DataFrame:
        own = some.select(*by, F.col("pid").alias("src"), F.col(x).alias("_x"))
        return own.join(some, by).select(*by, "src", F.col("pid").alias("dst"), "w", "_x", x)

    large = stored(points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > one_cell).select(*by), "large")
    if large.isEmpty():
        return all_pairs(points)
    apart = stored(points.join(large, by, "left_semi"), "large-points")
    return all_pairs(points.join(large, by, "left_anti")).unionByName(close_candidates(apart, by, x, eps))


def density_labels(matrix: DataFrame, by, row_id: str, x: str = "x", eps: float = 1.0,
                   min_samples: int = 2, one_cell: int = ONE_CELL) -> DataFrame:
    """Density clusters per group ``by``; label = smallest row id of the cluster, -1 for noise.

    Equal vectors collapse into one weighted point first, so copies cost
    nothing. Pairs come from ``near_candidates``. Labels spread along core-core
    edges and through each other's labels until nothing changes. What a later
    round reads again is a table in the shared folder: it survives lost
    executors, ends the lineage, and its known size lets Spark choose the joins.
    """
    by = list(by)
    matrix = stored(matrix, "matrix")
    points = stored(matrix.groupBy(*by, x).agg(F.min(row_id).alias("pid"), F.count(F.lit(1)).alias("w")), "points")
    edges = (near_candidates(points, by, x, eps, one_cell).where(square_distance(F.col("_x"), F.col(x)) <= eps * eps)
             .select(*by, "src", "dst", "w"))
    weighed = stored(edges.withColumn("_w", F.sum("w").over(Window.partitionBy(*by, "src"))), "edges")
    core = weighed.where(F.col("_w") >= min_samples).select(*by, F.col("src").alias("pid")).distinct()
    links = (weighed.where(F.col("_w") >= min_samples)
             .join(core.withColumnRenamed("pid", "dst"), [*by, "dst"], "left_semi").select(*by, "src", "dst"))
    links = stored(links, "links")
    labels = stored(links.groupBy(*by, F.col("src").alias("pid")).agg(F.min("dst").alias("label")), "labels")
    changed = 1
    while changed:
        # Every point learns the smallest label two steps away over its edges,
        # and passes it on to the point its own label names.
        far = labels.select(*by, F.col("pid").alias("label"), F.col("label").alias("far"))
        ahead = labels.join(far, [*by, "label"]).select(*by, "pid", "label", "far")
        near = (links.join(ahead.select(*by, F.col("pid").alias("dst"), "far"), [*by, "dst"])
                .groupBy(*by, F.col("src").alias("pid")).agg(F.min("far").alias("near")))
        told = (ahead.join(near, [*by, "pid"])
                .select(*by, F.inline(F.array(
                    F.struct("pid", F.col("label").alias("old"), F.least("label", "far", "near").alias("label")),
                    F.struct(F.col("label").alias("pid"), F.lit(None).cast("long").alias("old"),
                             F.col("near").alias("label"))))))
        moved = stored(told.groupBy(*by, "pid").agg(F.max("old").alias("old"), F.min("label").alias("label")), "labels")
        changed = moved.where(F.col("label") != F.col("old")).limit(1).count()
        labels = moved.drop("old")
    border = (weighed.join(labels.withColumnRenamed("pid", "dst"), [*by, "dst"])
              .groupBy(*by, F.col("src").alias("pid")).agg(F.min("label").alias("border_label")))
    final = (points.select(*by, x, "pid").join(labels, [*by, "pid"], "left").join(border, [*by, "pid"], "left")
             .select(*by, x, F.coalesce("label", "border_label", F.lit(-1)).alias("dbscan")))
    return matrix.join(final, [*by, x])


def _window_means(pdf: pd.DataFrame, x: str, order: list[str], clusters: int, iterations: int) -> pd.DataFrame:
    pdf = pdf.sort_values(order)
    pts = np.vstack(pdf[x].to_numpy())
    n, k = len(pts), min(clusters, len(pts))
    centres = pts[np.floor((np.arange(k) + 0.5) * n / k).astype(int)]
    for turn in range(iterations + 1):
        # rounded, so that ties of equal windows break alike everywhere
        nearest = np.round(((pts[:, None, :] - centres[None, :, :]) ** 2).sum(-1), 9).argmin(1)
        if turn < iterations:
            centres = np.stack([pts[nearest == j].mean(0) if (nearest == j).any() else centres[j] for j in range(k)])
    return pdf.drop(columns=[x]).assign(kmeans=nearest.astype(np.int32))


def kmeans_labels(matrix: DataFrame, x: str = "x", by=("user_id",), order=("metric", "win"), clusters: int = 4,
                  iterations: int = 10) -> DataFrame:
    """K-means over the windows of each user; the same labels on every run.

    Centres start at evenly spaced windows in ``order``. k is at most the number
    of windows. Grouped pandas: a user has one window per metric and 30 days.
    """
    rest = matrix.drop(x)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return matrix.groupBy(*by).applyInPandas(
        lambda pdf: _window_means(pdf, x, list(order), clusters, iterations), f"{fields}, kmeans int")


def nearest_centre(x: Column, centres: Column) -> Column:
    """Struct (d, j) of the closest centre; distances are rounded, so that ties of equal points break alike everywhere."""
    each = F.transform(centres, lambda c: F.struct(F.round(square_distance(x, c["c"]), 9).alias("d"), c["j"].alias("j")))
    return F.array_min(each)


def spaced_centres(matrix: DataFrame, by, order, x: str, clusters: int) -> DataFrame:
    """by, j, c: the points at evenly spaced places of each group; the same that ``kmeans_labels`` starts from."""
    w = Window.partitionBy(*by)
    n = F.count(F.lit(1)).over(w)
    placed = matrix.withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_k": F.least(F.lit(clusters).cast("long"), n), "_n": n})
    j = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))
    return (placed.withColumn("j", j).where(F.col("_i") == F.floor((F.col("j") + 0.5) * F.col("_n") / F.col("_k")))
            .select(*by, F.col("j").cast("int").alias("j"), F.col(x).alias("c")))


def scattered_centres(matrix: DataFrame, row_id, x: str, clusters: int, rounds: int = 5) -> list[list[float]]:
    """Centres by k-means|| over the whole matrix: a few rounds that draw points in proportion to their squared distance.

    Draws are hashes of the row's key, so reruns agree. The driver sees about two times ``clusters`` points a round, with
    the number of rows closest to each, and reduces them by weighted k-means++.
    """
    first = matrix.orderBy(F.xxhash64(*row_id), *row_id).select(x).head()
    if first is None:
        return []
    chosen = [list(first[0])]

    def own(points) -> Column:
        rows = [F.struct(F.lit(j).alias("j"), F.array(*[F.lit(float(v)) for v in p]).alias("c")) for j, p in enumerate(points)]
        return nearest_centre(F.col(x), F.array(*rows))

    for turn in range(rounds):
        d = own(chosen)["d"]
        total = matrix.agg(F.sum(d)).first()[0]
        if not total:
            break
        draw = F.pmod(F.xxhash64(F.lit(turn), *row_id), F.lit(1 << 40)) / float(1 << 40)
        drawn = matrix.where(draw < 2.0 * clusters * d / total).orderBy(F.xxhash64(*row_id), *row_id).select(x).limit(8 * clusters).collect()
        chosen += [list(r[0]) for r in drawn if list(r[0]) not in chosen]
    weights = {r.j: r["count"] for r in matrix.groupBy(own(chosen)["j"].alias("j")).count().collect()}
    pts, w = np.array(chosen), np.array([weights.get(j, 0) for j in range(len(chosen))], float)
    rng, picked = np.random.default_rng(0), []
    while len(picked) < min(clusters, len(pts)):
        far = w * (((pts[:, None] - pts[picked][None]) ** 2).sum(-1).min(1) if picked else 1.0)
        if not far.sum():
            break
        picked.append(int(rng.choice(len(pts), p=far / far.sum())))
    return [chosen[j] for j in picked]


def lloyd(matrix: DataFrame, centres: DataFrame, by, x: str = "x", iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """K-means for groups of any size: the matrix with ``kmeans``, and the centres (by, j, c).

    The centres are a small table that is joined to the rows; each partition adds up its own rows of a centre, so what is
    shuffled is one row a partition and centre. A centre that loses all rows stays where it is. ``by`` may be empty: one
    model of all rows.
    """
    by = list(by)
    matrix = stored(matrix, "matrix")
    row = matrix.select(x).head()
    dims = len(row[0]) if row else 0

    def labelled() -> DataFrame:
        table = centres.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("j", "c"))).alias("_centres"))
        both = matrix.join(table, by) if by else matrix.join(F.broadcast(table))  # one row of ``clusters`` vectors
        return both.withColumn("kmeans", nearest_centre(F.col(x), F.col("_centres"))["j"]).drop("_centres")

    for _ in range(iterations):
        means = labelled().groupBy(*by, F.col("kmeans").alias("j")).agg(F.array(*[F.avg(F.col(x)[d]) for d in range(dims)]).alias("m"))
        centres = stored(centres.join(means, [*by, "j"], "left").select(*by, "j", F.coalesce("m", "c").alias("c")), "centres")
    return labelled(), centres


def _lof(pdf: pd.DataFrame, x: str, contamination: float) -> pd.DataFrame:
    pts = np.vstack(pdf[x].to_numpy())
    n = len(pts)
    if n < 3:
        return pdf.assign(lof=np.nan, lof_label=0)
    k = min(20, max(2, n - 1), n - 1)
    near, dist = np.empty((n, k), dtype=int), np.empty((n, k))
    for lo in range(0, n, 1024):
        d = np.sqrt(((pts[lo:lo + 1024, None, :] - pts[None, :, :]) ** 2).sum(-1))
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        near[lo:lo + 1024], dist[lo:lo + 1024] = order, np.take_along_axis(d, order, 1)
    reach = np.maximum(dist, dist[near, -1])
    density = 1.0 / (reach.mean(axis=1) + 1e-10)
    score = density[near].mean(axis=1) / density
    cut = np.quantile(-score, contamination)
    return pdf.assign(lof=score, lof_label=np.where(-score < cut, -1, 0))


#: Rows of a group that one task compares with one another; larger groups are joined by pivots.
ONE_TASK = 4_000


def local_outlier_factor(matrix: DataFrame, by=KEYS, row_id: str = "win", x: str = "x",
                         contamination: float = 0.05, one_task: int = ONE_TASK) -> DataFrame:
    """Local outlier factor of the rows of each group; label -1 below the contamination quantile.

    Groups of up to ``one_task`` rows are grouped pandas, whose neighbours never leave the task. In larger ones the
    neighbours come from ``knn.nearest`` and the factor from joins on them; both give the same numbers.
    """
    by = list(by)
    slim = stored(matrix.select(*by, row_id, x), "matrix")
    large = slim.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > one_task).select(*by)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema)
    small = slim.join(large, by, "left_anti").groupBy(*by).applyInPandas(
        lambda pdf: _lof(pdf.sort_values(row_id), x, contamination), f"{fields}, lof double, lof_label long")
    if large.isEmpty():
        return small
    return small.unionByName(_lof_by_joins(slim.join(large, by, "left_semi"), by, row_id, x, contamination))


def _lof_by_joins(matrix: DataFrame, by, row_id: str, x: str, contamination: float) -> DataFrame:
    """The factor from three joins on the nearest neighbours."""
    near = stored(nearest(matrix, by, row_id, x, 20), "neighbours")
    reach = near.groupBy(*by, "src").agg(F.max("d").alias("reach")).withColumnRenamed("src", "dst")
    density = stored(near.join(reach, [*by, "dst"]).groupBy(*by, "src").agg((1.0 / (F.avg(F.greatest("d", "reach")) + 1e-10)).alias("density")), "densities")
    around = near.join(density.select(*by, F.col("src").alias("dst"), F.col("density").alias("other")), [*by, "dst"]).groupBy(*by, "src").agg(F.avg("other").alias("other"))
    scored = around.join(density, [*by, "src"]).select(*by, F.col("src").alias(row_id), (F.col("other") / F.col("density")).alias("lof"))
    cut = scored.groupBy(*by).agg(F.percentile(-F.col("lof"), contamination).alias("_cut"))
    label = F.when(-F.col("lof") < F.col("_cut"), -1).otherwise(0).cast("long")
    return matrix.join(scored, [*by, row_id]).join(cut, by).select(*by, row_id, x, "lof", label.alias("lof_label"))


def flag_small(labelled: DataFrame, by, label: str, share: float = SMALL_SHARE, min_rows: int = 3) -> DataFrame:
    """``cluster, cluster_anomaly, cluster_anomaly_reason`` from labels of any method.

    Clusters under ``share`` of their group's rows and the label -1 are
    anomalous; groups under ``min_rows`` rows get cluster -999 and no flag.
    """
    sizes = labelled.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_size"))
    total = F.sum("_size").over(Window.partitionBy(*by))
    verdicts = sizes.withColumn("_total", total).withColumn(
        "cluster_anomaly", ((F.col("_size") / F.col("_total") < share) | (F.col(label) == -1))
        & (F.col("_total") >= min_rows))
    return (labelled.join(verdicts, [*by, label])
            .withColumn("cluster", F.when(F.col("_total") < min_rows, -999).otherwise(F.col(label)).cast("long"))
            .withColumn("cluster_anomaly_reason",
                        F.when(F.col("cluster_anomaly"), F.concat(
                            F.lit("Belongs to anomalous cluster "), F.col("cluster").cast("string"))).otherwise(""))
            .drop("_size", "_total"))


def cluster_report(flagged: DataFrame, by) -> DataFrame:
    """Clusters, flagged rows, their share and the size of each cluster as JSON."""
    sizes = flagged.groupBy(*by, "cluster").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("cluster_anomaly").alias("_a"))
    real = F.col("cluster") != -999
    entry = F.when(real, F.struct("cluster", "_n"))
    return sizes.groupBy(*by).agg(
        F.count_if(real).alias("total_clusters"), F.sum("_a").alias("anomalies_detected"),
        (F.sum("_a") / F.sum("_n") * 100).alias("anomaly_percentage"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("cluster_distribution"))
