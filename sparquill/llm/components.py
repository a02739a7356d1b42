"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edges; a node's smallest neighbour
spreads to all of its neighbours, so path lengths shrink geometrically.  Rounds are written
to the shared folder: neither links nor labels ever reach the driver.

Nodes with a large share of all links (hubs) are few by count, whatever the size of the table: their
rows meet a broadcast list of them where they lie, and only the rest is joined by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm._runtime import drop_table, write_table


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return int(row["n"]), int(row["h"])


#: A key with more than one in this many rows of a table is a hub; there are fewer hubs than this.
SHARE = 256


def joined_with_least(rows: DataFrame, key: str, value: str, name: str, count: int | None = None) -> DataFrame:
    """``rows`` with the smallest ``value`` of their ``key`` as ``name``; ``rows`` is read several times.

    Rows of hubs are not moved: the hubs, fewer than :data:`SHARE`, are broadcast.  Null keys go.
    """
    count = rows.count() if count is None else count
    least = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(name), F.count("*").alias("_n"))
    hub = F.col("_n") * SHARE > F.lit(count)
    hubs = F.broadcast(least.where(hub).drop("_n"))
    rest = rows.join(hubs.select(key), key, "left_anti").join(least.where(~hub).drop("_n"), key)
    return rows.join(hubs, key).unionByName(rest)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``: the smallest node id reachable.

    Nodes without a link to another node are not listed.  Null ends, self links, repeated and
    reversed links are accepted and change nothing.
    """
    now = write_table(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
        .distinct(),
        "edges",
    )
    state = _state(now)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = now.union(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        near = joined_with_least(both, "src", "dst", "m", 2 * state[0]).where("dst > src")
        large = write_table(near.select(F.col("dst").alias("src"), F.least("src", "m").alias("dst")).distinct(), "stars")
        small = (
            joined_with_least(large, "src", "dst", "m")
            .select(F.explode(F.array(F.struct("src", F.col("m").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")))).alias("e"))
            .select("e.src", "e.dst")
            .where("src <> dst")
            .distinct()
        )
        new = write_table(small, "edges")
        new_state = _state(new)
        drop_table(now)
        drop_table(large)
        now, done, state = new, new_state == state, new_state
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(now.select(F.col("dst"), F.col("dst")).distinct())
