"""Queries over the transit-shaped views, by topic."""

from importlib import import_module

TOPICS = ("source_queries", "scalar_queries", "network_queries", "delay_queries", "search_queries", "route_queries",
          "report_queries")


def load_all() -> None:
    for topic in TOPICS:
        import_module(f"{__name__}.{topic}")
