"""Connected components of rows that share identifiers, without collecting any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.session import settle


def smallest_member(links: DataFrame, node: str, token: str) -> DataFrame:
    """(node, label) for every node in ``links``: the smallest node reachable over shared tokens.

    Each round takes minima over tokens, hooks whole labels onto smaller ones and follows one
    hook further, so even long chains settle in logarithmically many rounds. Minima combine on
    the map side; the joins back are unique on the minima's side, so AQE can split hot keys.
    Null tokens link nothing; a node whose tokens are all null keeps itself as label only if it
    occurs in ``links`` with a token. Rounds end when no label changes, which they must, as labels only fall.
    """
    state = links.filter(F.col(token).isNotNull() & F.col(node).isNotNull()).select(F.col(node).alias("node"), F.col(token).alias("token")).distinct().withColumn("label", F.col("node"))
    while True:
        by_token = state.groupBy("token").agg(F.min("label").alias("__m"))
        seen = state.join(by_token, "token")
        by_node = seen.groupBy("node").agg(F.min("__m").alias("__near"), F.min("label").alias("__old"))
        hooks = by_node.groupBy("__old").agg(F.min("__near").alias("__up"))
        moved = by_node.join(hooks.select(F.col("__old").alias("__near"), "__up"), "__near", "left")
        fresh = moved.select("node", F.least("__near", F.coalesce("__up", "__near")).alias("__new"), (F.least("__near", F.coalesce("__up", "__near")) != F.col("__old")).alias("__changed"))
        state = settle(state.join(fresh, "node").select("node", "token", F.col("__new").alias("label"), "__changed"))
        if state.filter("__changed").isEmpty():
            return state.groupBy("node").agg(F.min("label").alias("label"))
        state = state.drop("__changed")
