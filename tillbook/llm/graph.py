"""Connected components: within a task over numpy arrays, and distributed over a DataFrame of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.session import pin


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a[i] and b[i] in ``labels`` (each entry: a smaller or equal member of its group), in place."""
    while len(a):
        while True:  # every entry points at its root
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a long, b long): root is one member's id, the same for the whole component.

    Each round every node moves to its smallest neighbour and links between
    the new nodes are kept once; at least half of the nodes that still have a
    link go each time, so rounds grow with the logarithm of the nodes.  Rounds
    are written to the shared folder, which cuts the lineage."""
    links = pin(links.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "links")
    found = None
    while not links.isEmpty():
        both = links.unionByName(links.selectExpr("b AS a", "a AS b"))
        moved = pin(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).selectExpr("node", "least(node, b) AS root"), "moves")
        if found is None:
            found = moved
        else:
            steps = moved.selectExpr("node AS root", "root AS next")
            found = pin(found.join(steps, "root", "left").selectExpr("node", "coalesce(next, root) AS root"), "roots")
        to = moved.selectExpr("node AS a", "root AS x")
        other = moved.selectExpr("node AS b", "root AS y")
        links = pin(links.join(to, "a").join(other, "b").where("x <> y").selectExpr("least(x, y) AS a", "greatest(x, y) AS b").distinct(), "links")
    return found if found is not None else links.selectExpr("a AS node", "b AS root")
