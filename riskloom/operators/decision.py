"""The decision diagram: nodes from the rules, edges with the observations that flow along them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rules import RISK_FACTORS
from riskloom.operators.profile import decision_flow

ROOT, LEVEL = "patient", "level"


def weighted_edges(df: DataFrame, factors=RISK_FACTORS) -> DataFrame:
    """(source_factor, source_band, target_factor, target_band, n): all flows there are.

    Every observation flows from the root to its band of each factor, and from there to its risk level, so both
    halves sum to the observations times the factors. Bands of missing values are nodes like the others.
    """
    into = F.struct(F.lit(ROOT).alias("sf"), F.lit("all").alias("sb"), F.col("factor").alias("tf"), F.col("band").alias("tb"))
    out = F.struct(F.col("factor").alias("sf"), F.col("band").alias("sb"), F.lit(LEVEL).alias("tf"), F.col("risk_level").alias("tb"))
    return (
        decision_flow(df, factors)
        .select(F.inline(F.array(into, out)), "n")
        .groupBy(
            F.col("sf").alias("source_factor"),
            F.col("sb").alias("source_band"),
            F.col("tf").alias("target_factor"),
            F.col("tb").alias("target_band"),
        )
        .agg(F.sum("n").alias("n"))
    )


def nodes(edges: DataFrame) -> DataFrame:
    """(factor, band, n) of every node of the diagram, n being what flows through it."""
    inner = edges.groupBy(F.col("target_factor").alias("factor"), F.col("target_band").alias("band")).agg(F.sum("n").alias("n"))
    root = edges.where(F.col("source_factor") == ROOT).select(
        F.col("source_factor").alias("factor"), F.col("source_band").alias("band"), "n"
    )
    return inner.unionByName(root.groupBy("factor", "band").agg(F.sum("n").alias("n")))


def edges_with_nodes(edges: DataFrame, node_table: DataFrame) -> DataFrame:
    """Every edge with what flows through both its ends."""
    s = node_table.select(F.col("factor").alias("source_factor"), F.col("band").alias("source_band"), F.col("n").alias("source_n"))
    t = node_table.select(F.col("factor").alias("target_factor"), F.col("band").alias("target_band"), F.col("n").alias("target_n"))
    return edges.join(s, ["source_factor", "source_band"]).join(t, ["target_factor", "target_band"])
