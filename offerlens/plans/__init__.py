"""Run plans: how operators are put together."""
