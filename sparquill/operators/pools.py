"""Topic pools: an anchor passage and its most similar passages, and near-duplicate pools removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.text import text
from sparquill.functions.values import padded_id
from sparquill.operators.vectors import neighbours_in_group
from sparquill.runtime import drop_table, write_table

# --- fixed values: content types that make a passage unusable ----------------------------------
UNUSABLE_TYPES = ("methods_or_search_strategy", "admin_or_metadata", "reference_like")
# ---------------------------------------------------------------------------------------------


def usable(seeds: DataFrame) -> DataFrame:
    """Seeds marked usable whose content type is not an unusable one; a null type passes."""
    return seeds.where(F.coalesce(F.col("usable"), F.lit(False)) & ~text("content_type").isin(*UNUSABLE_TYPES))


def members(passages: DataFrame, min_passages: int, max_passages: int, min_similarity: float) -> DataFrame:
    """``passages(group, id, vector)`` to pool members ``(group, anchor, rank, id, score)``.

    Of the ``max_passages`` nearest in the group those at ``min_similarity`` or more stay, the anchor always;
    ranks run without gaps.  Groups and pools below ``min_passages`` go.
    """
    passages = passages.withColumn("group", F.coalesce(F.col("group").cast("string"), F.lit("")))
    large = passages.groupBy("group").count().where(F.col("count") >= min_passages).select("group")
    rows = passages.join(large, "group", "left_semi")
    near = neighbours_in_group(rows, max_passages).where((F.col("score") >= min_similarity) | (F.col("id") == F.col("anchor")))
    pool = Window.partitionBy("group", "anchor")
    return (
        near.withColumn("rank", F.row_number().over(pool.orderBy("rank")))
        .withColumn("n", F.count("*").over(pool))
        .where(F.col("n") >= min_passages)
        .select("group", "anchor", "rank", "id", "score")
    )


def pools(member_rows: DataFrame) -> DataFrame:
    """One row per pool: size, mean similarity without the first member (1 if alone), smallest similarity, member ids."""
    return member_rows.groupBy("group", "anchor").agg(
        F.count("*").alias("num_passages"),
        F.coalesce(F.avg(F.when(F.col("rank") > 1, F.col("score"))), F.lit(1.0)).alias("avg_similarity"),
        F.min("score").alias("min_similarity"),
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda m: m["id"]).alias("passage_ids"),
    )


def conflicts(pool_rows: DataFrame, max_jaccard: float) -> DataFrame:
    """Pairs of pools ``(a, b)``, keys in order, whose member sets have at least that Jaccard similarity (above zero).

    An inverted index on the rarest members of each pool: two sets that are similar enough share one of the
    first ``n - ceil(t n) + 1`` members in any one order, so a passage of very many pools makes no pairs.
    """
    own = pool_rows.select("key", F.array_distinct("passage_ids").alias("ids")).withColumn("n", F.size("ids"))
    rows = own.select("key", "n", F.explode("ids").alias("id"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("count", "id"))
    needed = lambda n: F.ceil(n * F.lit(float(max_jaccard)) - 1e-9)
    rare = rows.join(rows.groupBy("id").count(), "id").withColumn("r", place).where(F.col("r") <= F.col("n") - needed(F.col("n")) + 1).select("key", "n", "id")
    other = rare.select(F.col("key").alias("b"), F.col("n").alias("m"), "id")
    pairs = rare.join(other, "id").where("key < b").where((F.col("m") >= needed(F.col("n"))) & (F.col("n") >= needed(F.col("m")))).select(F.col("key").alias("a"), "b").distinct()
    both = pairs.join(own.select(F.col("key").alias("a"), F.col("ids").alias("x")), "a").join(own.select(F.col("key").alias("b"), F.col("ids").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared / (F.size("x") + F.size("y") - shared) >= max_jaccard).select("a", "b")


def without_near_duplicates(pool_rows: DataFrame, max_jaccard: float, max_rounds: int = 200) -> DataFrame:
    """Pools kept by going through them by mean similarity, then size (larger first), group and anchor, and dropping
    each that is similar to a kept one.

    The same set comes out of rounds that all pools take at once: a pool with no undecided rival before it
    is kept, rivals of kept pools are dropped.  Rounds are written to the shared folder.
    """
    if max_jaccard <= 0:  # every pool conflicts with every other
        return pool_rows.orderBy(F.desc("avg_similarity"), F.desc("num_passages"), "group", "anchor").limit(1)
    # The key orders pools by priority without a global sort: its parts compare in that order.
    key = F.struct((-F.col("avg_similarity")).alias("s"), (-F.col("num_passages")).alias("n"), F.col("group").alias("g"), F.col("anchor").alias("a"))
    keyed = write_table(pool_rows.withColumn("key", key), "pools")
    edges = write_table(conflicts(keyed, max_jaccard), "rivals")
    kept = None
    for _ in range(max_rounds):
        if edges.isEmpty():
            break
        rivals = edges.select(F.col("b").alias("k")).distinct()
        sure = edges.select(F.col("a").alias("k")).distinct().join(rivals, "k", "left_anti")
        gone = edges.join(sure.withColumnRenamed("k", "a"), "a", "left_semi").select(F.col("b").alias("k")).distinct()
        gone = write_table(gone, "gone")
        left = edges.join(gone.withColumnRenamed("k", "a"), "a", "left_anti").join(gone.withColumnRenamed("k", "b"), "b", "left_anti")
        new = write_table(left.select("a", "b"), "rivals")
        drop_table(edges)
        edges = new
        kept = gone if kept is None else kept.union(gone)
    else:
        raise RuntimeError("pools did not settle")
    out = keyed if kept is None else keyed.join(kept.withColumnRenamed("k", "key"), "key", "left_anti")
    return out.drop("key")


def numbered(pool_rows: DataFrame) -> DataFrame:
    """Adds ``group_id`` in order of mean similarity, size, group and anchor.

    Numbers come from a range sort and per-partition offsets, so no task sees all rows.
    """
    ordered = pool_rows.repartitionByRange(F.desc("avg_similarity"), F.desc("num_passages"), "group", "anchor").sortWithinPartitions(F.desc("avg_similarity"), F.desc("num_passages"), "group", "anchor")
    part = write_table(ordered.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    counts = part.groupBy("_p").count()
    before = counts.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return part.join(F.broadcast(before.drop("count")), "_p").withColumn("group_id", padded_id("grp_", F.col("_before") + F.col("_i") + 1)).drop("_p", "_i", "_before")


def statistics(pool_rows: DataFrame) -> DataFrame:
    """One row: number of pools, and mean, smallest and largest size and mean similarity; zeros if there are none."""
    size, sim = F.col("num_passages"), F.col("avg_similarity")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("double"))
    return pool_rows.agg(
        F.count("*").alias("num_groups"),
        zero(F.avg(size)).alias("mean_size"), zero(F.min(size).cast("double")).alias("min_size"), zero(F.max(size).cast("double")).alias("max_size"),
        zero(F.avg(sim)).alias("mean_similarity"), zero(F.min(sim)).alias("min_similarity"), zero(F.max(sim)).alias("max_similarity"),
    )


def records(pool_rows: DataFrame, member_rows: DataFrame, passages: DataFrame) -> DataFrame:
    """Output records: each pool's anchor and hints, and its members with their passage fields, by rank.

    ``passages(id, ...)``: all other columns go into the member structs; ``passage_id`` names a member (its
    ``id`` if there is no such column).  A pool's group is its ``guideline_id``; similarities have six decimals.
    """
    fields = [c for c in passages.columns if c not in ("id", "passage_id")]
    name = F.col("passage_id") if "passage_id" in passages.columns else F.col("id").cast("string")
    detailed = member_rows.join(passages, "id").select(
        "group", "anchor", F.struct("rank", F.round("score", 6).alias("similarity_to_anchor"), name.alias("passage_id"), *fields).alias("m"), (F.col("id") == F.col("anchor")).alias("own")
    )
    lists = detailed.groupBy("group", "anchor").agg(F.array_sort(F.collect_list("m")).alias("passages"), F.max(F.when(F.col("own"), F.col("m"))).alias("first"))
    wanted = {"main_topic": "group_topic_hint", "semantic_summary": "group_summary_hint", "question_angles": "group_question_angles_hint", "patient_language_keywords": "group_patient_keywords_hint"}
    return pool_rows.drop("passage_ids").join(lists, ["group", "anchor"]).select(
        *(["group_id"] if "group_id" in pool_rows.columns else []),
        F.col("group").alias("guideline_id"), F.col("first.passage_id").alias("anchor_passage_id"), "num_passages",
        F.round("avg_similarity", 6).alias("avg_similarity_to_anchor"), F.round("min_similarity", 6).alias("min_similarity_to_anchor"),
        F.transform("passages", lambda m: m["passage_id"]).alias("passage_ids"), *(F.col(f"first.{f}").alias(n) for f, n in wanted.items() if f in fields), "passages",
    )
