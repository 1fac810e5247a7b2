"""starmart — a retail star-schema warehouse built on Spark SQL.

Raw order, item, customer, product and seller data is cleaned and
deduplicated, loaded into a star schema (customer, product, seller and date
dimensions around a sales fact) with surrogate keys and rerun-safe
insert-if-absent loads, audited, and queried by a library of analytics
DataFrames. Every step is a lazy DataFrame transformation; only
``sources``, ``sinks`` and ``pipeline`` touch storage.
"""

from starmart.plans.star import Star, build_star, CleanTables, clean_all

__all__ = ["Star", "build_star", "CleanTables", "clean_all"]
