"""Runnable queries: each module registers its own."""

from importlib import import_module

MODULES = ("warehouse", "profile", "messages", "bets", "routing", "rules", "exports", "streams")

for _name in MODULES:
    import_module(f"playerflow.plans.{_name}")
