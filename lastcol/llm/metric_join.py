"""Near-duplicate embeddings by an exact metric range join.

Vectors are scaled to unit length, where cosine >= c means distance <= r =
sqrt(2 - 2c).  Equal vectors of one label are one point with a weight.  Per
label, pivots are taken from the points; a point's home cell is that of its
nearest pivot.  If x and y are within r and y's home is pivot q, the triangle
inequality gives d(x, q) <= d(x, p) + 2r for x's own pivot p.  On the unit
sphere the sharper form is used: y is no farther from q than from p, so x is
at most r beyond the plane halfway between p and q, that is
<x, p> - <x, q> <= r * |p - q|.  x is copied to just those cells.  Every link of
a home point is then inside its cell, and cells are joined on their own.

A cell is dealt into blocks of bounded size by a hash; home blocks meet copy
blocks in separate tasks.  A task multiplies two blocks, counts links per home
point and returns one edge per point and cluster, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, NO_ID, connected_components, null_id, plain_id, stored

MIN_COSINE = 0.98
#: Points per cell aimed at, and the most pivots of a label.  Beyond CELL *
#: MAX_PIVOTS points cells grow, and are joined in more blocks.
CELL = 1000
MAX_PIVOTS = 256
#: Points of a label that are placed in cells at once.
PLACED_AT_ONCE = 4096
#: Points of a block.
BLOCK = 2048
#: Slack of the boundary test, far above rounding.
SLACK = 1e-6


def _units(frames):
    """Every row, with its unit vector in double precision, or null where it
    links with nothing."""
    for pdf in frames:
        out = []
        for i, label, v in zip(pdf["vec_id"], pdf["label"], pdf["embedding"], strict=True):
            unit = None
            if i != NO_ID and label is not None and v is not None:
                x = np.asarray(v, dtype=np.float64)  # a null component becomes nan
                big = np.abs(x).max(initial=0.0)
                if big > 0 and np.isfinite(x).all():
                    x = x / big  # keeps squares of tiny or huge components finite
                    unit = x / np.sqrt(x @ x)
            out.append(unit)
        yield pd.DataFrame({"vec_id": pdf["vec_id"], "label": pdf["label"], "v": pd.Series(out, dtype=object)})


def _label(vectors: DataFrame) -> Column:
    """Labels of any type by their text; the two zeros are one."""
    col = F.col("label")
    return (col + F.lit(0.0) if vectors.schema["label"].dataType.typeName() in ("float", "double") else col).cast("string")


def _place(r: float):
    """Home rows and copies of some points of a label, from the label's pivots."""
    def run(own: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(pivots):
            return pd.DataFrame(columns=[c.split()[0] for c in _PLACED.split(", ")])
        p = np.stack([np.asarray(v, float) for v in pivots["pivots"].iloc[0]])
        gap = np.sqrt(np.maximum(0, 2 - 2 * (p @ p.T))) * r + SLACK
        s = np.stack(own["v"].to_numpy()) @ p.T
        home = s.argmax(1)
        i, c = np.nonzero(s[np.arange(len(s)), home][:, None] - s <= gap[home])
        part = own[["label", "dim", "point", "weight", "v"]].iloc[i].reset_index(drop=True)
        return part.assign(cell=c, home=home[i] == c)[[x.split()[0] for x in _PLACED.split(", ")]]
    return run


def _clusters(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable in the bipartite or plain graph of links."""
    low = np.arange(n)
    while True:
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == before).all():
            return low


def _join(min_cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        home, other = pdf[pdf["left"]], pdf[~pdf["left"]]
        if not len(home) or not len(other):
            return pd.DataFrame({"point": [], "other": [], "links": []})
        x, y = np.stack(home["v"].to_numpy()), np.stack(other["v"].to_numpy())
        hp, op = home["point"].to_numpy(np.int64), other["point"].to_numpy(np.int64)
        weight = other["weight"].to_numpy(np.int64)
        links, pairs = np.zeros(len(x), np.int64), []
        for at in range(0, len(x), 512):
            i, j = np.nonzero(x[at:at + 512] @ y.T >= min_cosine)
            i += at
            np.add.at(links, i, weight[j])
            pairs.append((i, j))
        ids, pos = np.unique(np.concatenate([hp, op]), return_inverse=True)
        a = pos[np.concatenate([i for i, _ in pairs])]
        b = pos[len(hp) + np.concatenate([j for _, j in pairs])]
        low = ids[_clusters(len(ids), a, b)]
        # each point with the smallest of its cluster; links only for home points, to be summed
        count = np.zeros(len(ids), np.int64)
        np.add.at(count, pos[:len(hp)], links)
        return pd.DataFrame({"point": ids, "other": low, "links": count})
    return run


def _pivots(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """``label, dim, pivots``: at most MAX_PIVOTS points of each label and length, by
    their hashes, in proportion to its points."""
    part = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32
    likely = points.join(sizes, ["label", "dim"]).filter(part <= 2.0 * F.col("k") / F.col("count")).withColumn(
        "at", F.row_number().over(Window.partitionBy("label", "dim").orderBy("h"))).filter("at <= k").select("label", "dim", "h", "v")
    least = points.groupBy("label", "dim").agg(F.min("h").alias("h"), F.min_by("v", "h").alias("v"))  # where no hash is that small
    return likely.unionByName(least).groupBy("label", "dim", "h").agg(F.first("v").alias("v")).groupBy("label", "dim").agg(
        F.collect_list("v").alias("pivots"))


_PLACED = "label string, dim int, cell int, home boolean, point long, weight long, v array<double>"


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Vectors of one label (of any type) link when their cosine, in double precision,
    is at least ``min_cosine``; a null id or label, a null, empty or zero vector
    and one with null or non-finite components link with nothing, nor do vectors of
    different lengths.  Repeated rows and rows that share an id count as vectors of their own.
    An empty table gives an empty result; other columns are ignored.
    """
    r = float(np.sqrt(2 - 2 * min_cosine))
    units = stored(vectors.select(plain_id("vec_id"), _label(vectors).alias("label"), "embedding").mapInPandas(
        _units, "vec_id long, label string, v array<double>"), "units")
    # equal vectors of a label are one point, with the smallest of their ids
    key = units.withColumn("h", F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))
    points = stored(key.filter("v is not null").groupBy("label", "h").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v")).withColumn("point", F.xxhash64("label", "h")), "points")

    sizes = stored(points.groupBy("label", "dim").count().withColumns({
        "k": F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("count") / CELL)).cast("int"),
        "salts": F.ceil(F.col("count") / PLACED_AT_ONCE).cast("int")}), "sizes")
    few = sizes.count() <= BROADCAST_IDS
    sized = F.broadcast(sizes) if few else sizes
    pivots = stored(_pivots(points, sized).join(sizes.select("label", "dim", "salts"), ["label", "dim"]).select(
        "label", "dim", "pivots", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), "pivots")
    salted = points.join(sized, ["label", "dim"]).withColumn("salt", F.pmod(F.col("point"), F.col("salts")).cast("int"))
    on = ["label", "dim", "salt"]
    placed = stored(salted.select(*on, "point", "weight", "v").groupBy(*on).cogroup(
        pivots.select(*on, "pivots").groupBy(*on)).applyInPandas(_place(r), _PLACED), "cells")
    blocks = (placed.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / BLOCK).cast("int").alias("nh"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("nc")))
    dealt = placed.join(blocks, ["label", "dim", "cell"]).filter("nh > 0")
    turn = lambda n: F.pmod(F.xxhash64("point"), n).cast("int")
    left = dealt.filter("home").select(
        "label", "dim", "cell", "point", "weight", "v", F.lit(True).alias("left"), turn(F.col("nh")).alias("hb"),
        F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("cb"))
    right = dealt.select(
        "label", "dim", "cell", "point", "weight", "v", F.lit(False).alias("left"),
        F.explode(F.sequence(F.lit(0), F.col("nh") - 1)).alias("hb"), turn(F.col("nc")).alias("cb"))
    found = stored(left.unionByName(right).groupBy("label", "dim", "cell", "hb", "cb")
                   .applyInPandas(_join(min_cosine), "point long, other long, links long"), "links")

    comp = connected_components(found.select(F.col("point").alias("a"), F.col("other").alias("b")))
    total = found.groupBy("point").agg(F.sum("links").alias("n"))
    by_point = stored(points.select("label", "h", "point", "id").join(total, "point", "left")
                      .join(comp, F.col("point") == F.col("node"), "left")
                      .select("label", "h", "id", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("component", "point").alias("root")), "points")
    first = by_point.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = key.filter("v is not null").drop("v").join(by_point.join(first, "root"), ["label", "h"]).select(
        "vec_id", (F.col("n") - 1).alias("n_links"), "component_id")
    rest = key.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).select(null_id("vec_id"), "n_links", null_id("component_id"), (
        F.col("vec_id") == F.col("component_id")).alias("kept"))
