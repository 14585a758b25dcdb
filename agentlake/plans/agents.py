"""Which agent takes which task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from agentlake.operators.vectors import embed, top_match


def index_cards(cards: DataFrame, **options) -> DataFrame:
    """Card table with its vectors: ``card_uri, agent_card, card_embeddings``.

    Write it out once; the vectors do not change with the tasks.
    """
    return embed(cards.select("card_uri", "agent_card"), "agent_card", "card_embeddings", **options)


def assign_agents(
    tasks: DataFrame, indexed: DataFrame, task_key: str = "task_id", text: str = "description", **options
) -> DataFrame:
    """The best card of every task: ``task_key, card_uri, score``."""
    asked = embed(tasks.select(task_key, text), text, "embedding", **options)
    best = top_match(asked, indexed, task_key, "card_uri", "embedding", "card_embeddings")
    return best.select(task_key, best["item"].alias("card_uri"), "score")
