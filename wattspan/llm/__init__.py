"""Operators for preparing training text; their queries are in ``wattspan.llm.queries``."""
