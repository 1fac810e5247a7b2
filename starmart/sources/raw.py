"""The five raw inputs as one value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RawSources:
    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "orders": self.orders,
            "items": self.items,
            "customers": self.customers,
            "products": self.products,
            "sellers": self.sellers,
        }
