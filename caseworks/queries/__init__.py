"""Registered queries: name -> (Spark query, equivalent SQL or None)."""

from caseworks.queries import analytics, exchange, models, records, texts

REGISTRY = {**analytics.QUERIES, **records.QUERIES, **texts.QUERIES, **models.QUERIES, **exchange.QUERIES}
