"""Hand-made input rows for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from starmart import schemas
from starmart.sources.raw import RawSources


def ts(y, m, d, hh=0, mm=0):
    return dt.datetime(y, m, d, hh, mm)


def order(oid, cid, status="delivered", purchase=None, delivered=None):
    return (oid, cid, status, purchase, None, None, delivered, None)


def item(oid, n, pid, sid, price="10.00", freight="1.00", limit=None):
    p = None if price is None else Decimal(price)
    f = None if freight is None else Decimal(freight)
    return (oid, n, pid, sid, limit, p, f)


def customer(cid, uid=None, zip_=None, city=None, state=None):
    return (cid, uid if uid is not None else cid, zip_, city, state)


def product(pid, category=None, length=None):
    return (pid, category, None, None, None, None, length, None, None)


def seller(sid, zip_=None, city=None, state=None):
    return (sid, zip_, city, state)


def raw(spark, orders=(), items=(), customers=(), products=(), sellers=()) -> RawSources:
    def df(rows, name):
        return spark.createDataFrame(list(rows), schemas.RAW_SCHEMAS[name])

    return RawSources(
        orders=df(orders, "orders"),
        items=df(items, "items"),
        customers=df(customers, "customers"),
        products=df(products, "products"),
        sellers=df(sellers, "sellers"),
    )
