"""Audits: the constraints the tables declare, and the load reconciliation.

Parquet tables enforce no keys, so what a constrained database would
refuse is counted here instead:

* ``primary key`` / ``unique`` — rows sharing their key with another row
  (NULL keys excluded for ``unique``, as NULLs never conflict);
* ``not null`` — NULL rows;
* ``foreign key`` — child rows (non-NULL key) with no parent;
* ``width`` — text longer than its declared width.

Each check is an aggregate that reduces map-side before its shuffle. Duplicates
of all declared text keys and the orphans of their children come from one
shuffle, the not-null and width checks of a table from one scan, and the fact's
keys from bounds and fingerprints that move no key at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import defaults as dv
from starmart.plans.star import CleanTables, Star

def _row(df: DataFrame, table: str, rule: str, value: Column) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def duplicates(df: DataFrame, table: str, keys: Sequence[str], rule: str = "primary key") -> DataFrame:
    keys = list(keys)
    src = df.select(*keys)
    if rule == "unique":
        src = src.dropna(how="any", subset=keys)
    counted = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _row(counted, table, f"{rule} ({', '.join(keys)})", F.sum(F.col("n") - 1))


def column_checks(
    df: DataFrame, table: str, not_null_cols: Sequence[str] = (), limits: dict[str, int] | None = None
) -> DataFrame:
    """NOT NULL and text-width checks of one table in a single scan.

    One aggregate with a conditional count per check, unpivoted into rows.
    """
    limits = limits or {}
    checks = [(f"not null ({c})", F.col(c).isNull()) for c in not_null_cols]
    checks += [(f"width ({c} <= {n})", F.length(c) > n) for c, n in limits.items()]
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    pairs = ", ".join(f"'{rule}', `c{i}`" for i, (rule, _) in enumerate(checks))
    return counts.selectExpr(f"stack({len(checks)}, {pairs}) as (rule, violations)").select(
        F.lit(table).alias("table_name"), "rule", F.col("violations").cast("bigint").alias("violations")
    )


def not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    return column_checks(df, table, cols)


def orphans(child: DataFrame, parent: DataFrame, table: str, fk: str, parent_table: str, pk: str | None = None) -> DataFrame:
    pk = pk or fk
    keys = child.select(F.col(fk).alias("__k")).where(F.col("__k").isNotNull())
    lost = keys.join(parent.select(F.col(pk).alias("__k")), "__k", "left_anti")
    return _row(lost, table, f"foreign key ({fk}) -> {parent_table}", F.count(F.lit(1)))


@dataclass(frozen=True)
class KeyFacts:
    """Of a table's surrogate key: rows, bounds, and whether it is each whole number between them once."""

    rows: int
    low: int | None
    high: int | None
    dense: bool

    def joined(self, had: Sequence) -> KeyFacts:
        """With the folders that were there, whose keys were checked when they came."""
        parts = [(f.low, f.high, f.rows) for f in had] + ([(self.low, self.high, self.rows)] if self.rows else [])
        parts = sorted(p for p in parts if p[0] is not None)
        if not parts:
            return self
        # Dense parts, end to end, are dense together.
        whole = self.dense and all(b[0] == a[1] + 1 for a, b in zip(parts, parts[1:]))
        whole = whole and all(n == high - low + 1 for low, high, n in parts)
        return KeyFacts(sum(n for _, _, n in parts), parts[0][0], parts[-1][1], whole)


def _fingerprint(key: str) -> list[Column]:
    """Two sums of 64-bit hashes: equal for two tables of keys if these hold the same keys equally often."""
    return [F.sum(F.xxhash64(F.lit(seed), F.col(key).cast("long")).cast("decimal(38,0)")) for seed in (1, 2)]


def key_facts(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> tuple[dict[str, KeyFacts], dict[str, dict]]:
    """One scan a table: facts of its first key, and counts, NULLs and bounds of all its keys.

    The first key is dense if it has as many values as its bounds are apart and
    its fingerprint is that of the whole numbers between them, which are made
    where they are summed. No key is shuffled. Keys that repeat or are missing
    pass only if two independent 64-bit sums agree by chance (2 to the -128).
    """
    names, found = list(tables), []
    width = max(len(k) for k in keys.values())
    for at, name in enumerate(names):
        cols = list(keys[name])
        facts = [F.struct(F.count(c), F.min(c), F.max(c)) for c in cols]
        blank = F.struct(F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long"))
        each = F.array(*[f.cast("struct<n:long,lo:long,hi:long>") for f in facts + [blank] * (width - len(cols))])
        found.append(
            tables[name].agg(F.lit(at).alias("at"), F.count(F.lit(1)).alias("rows"), each.alias("each"), F.array(*_fingerprint(cols[0])).alias("sums"))
        )
    rows = {names[r["at"]]: r for r in _union(found).collect()}
    spark = next(iter(tables.values())).sparkSession
    full = {n: r for n, r in rows.items() if r["rows"] and r["rows"] == r["each"][0]["n"] == r["each"][0]["hi"] - r["each"][0]["lo"] + 1}
    wanted = [
        spark.range(r["each"][0]["lo"], r["each"][0]["hi"] + 1).agg(F.lit(r["at"]).alias("at"), F.array(*_fingerprint("id")).alias("sums"))
        for r in full.values()
    ]
    sums = {names[r["at"]]: r["sums"] for r in (_union(wanted).collect() if wanted else [])}
    facts = {
        n: KeyFacts(r["rows"], r["each"][0]["lo"], r["each"][0]["hi"], not r["rows"] or r["sums"] == sums.get(n))
        for n, r in rows.items()
    }
    bounds = {n: {"rows": r["rows"]} | {c: r["each"][i] for i, c in enumerate(keys[n])} for n, r in rows.items()}
    return facts, bounds


@dataclass(frozen=True)
class KeyGroup:
    """A table's key, and the tables whose column of that name refers to it."""

    parent: DataFrame
    table: str
    keys: tuple[str, ...]
    rule: str = "primary key"
    children: tuple[tuple[DataFrame, str], ...] = ()

    def sides(self) -> list[DataFrame]:
        """``k, side``: the parent's keys as side 0, the children's as 1 and on."""
        whole = self.parent.dropna(how="any", subset=list(self.keys)) if self.rule == "unique" else self.parent
        if len(self.keys) == 1:
            k = F.col(self.keys[0]).cast("string")
        else:  # only the first part is text, so the last mark parts them
            k = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in self.keys])
        out = [whole.select(k.alias("k"), F.lit(0).alias("side"))]
        for at, (child, _) in enumerate(self.children, 1):
            known = child.select(F.col(self.keys[0]).cast("string").alias("k"), F.lit(at).alias("side"))
            out.append(known.where("k is not null"))
        return out

    def labels(self) -> list[tuple[str, str]]:
        own = (self.table, f"{self.rule} ({', '.join(self.keys)})")
        return [own, *[(name, f"foreign key ({self.keys[0]}) -> {self.table}") for _, name in self.children]]


def key_checks(groups: Sequence[KeyGroup]) -> DataFrame:
    """Duplicates of every group's key and orphans of its children, from one shuffle for all groups.

    Keys are counted by group and side where they are read, so a key with any
    number of rows sends one row from each task.
    """
    tagged = [side.select(F.lit(g).alias("g"), "k", "side") for g, group in enumerate(groups) for side in group.sides()]
    n = [F.count_if(F.col("side") == at).alias(f"n{at}") for at in range(max(len(g.children) for g in groups) + 1)]
    by_key = _union(tagged).groupBy("g", "k").agg(*n)
    found = [F.sum(F.greatest(F.col("n0") - 1, F.lit(0)))]
    found += [F.sum(F.when(F.col("n0") == 0, F.col(f"n{at}"))) for at in range(1, len(n))]
    sums = by_key.groupBy("g").agg(F.array(*found).alias("found")).select("g", F.posexplode("found").alias("side", "n"))
    said = [(g, at, *label) for g, group in enumerate(groups) for at, label in enumerate(group.labels())]
    labels = groups[0].parent.sparkSession.createDataFrame(said, "g int, side int, table_name string, rule string").coalesce(1)
    return labels.join(sums, ["g", "side"], "left").select(
        "table_name", "rule", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations")
    )


def clean_keys(tb: CleanTables) -> list[KeyGroup]:
    items = ((tb.order_items, "tb_order_items"),)
    return [
        KeyGroup(tb.customers, "tb_customers", ("customer_id",), children=((tb.orders, "tb_orders"),)),
        KeyGroup(tb.sellers, "tb_sellers", ("seller_id",), children=items),
        KeyGroup(tb.products, "tb_products", ("product_id",), children=items),
        KeyGroup(tb.orders, "tb_orders", ("order_id",), children=items),
        KeyGroup(tb.order_items, "tb_order_items", ("order_id", "order_item_id")),
    ]


def audit_clean(tb: CleanTables) -> list[DataFrame]:
    L = schemas.VARCHAR_LIMITS
    return [
        column_checks(tb.customers, "tb_customers", ["customer_id", "customer_unique_id"], L["customers"]),
        column_checks(tb.sellers, "tb_sellers", ["seller_id"], L["sellers"]),
        column_checks(tb.products, "tb_products", ["product_id"], L["products"]),
        column_checks(tb.orders, "tb_orders", ["order_id"], L["orders"]),
        column_checks(tb.order_items, "tb_order_items", ["order_id", "order_item_id"]),
    ]


#: Keys of the star's tables, the table's own first.
STAR_KEYS = {
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "dim_seller": ["seller_sk"],
    "dim_date": ["date_sk"],
    "fact_sales": ["sale_sk", "customer_sk", "product_sk", "seller_sk", "date_sk"],
}
UNIQUE_KEYS = {
    "dim_customer": ["customer_id", "effective_from"],
    "dim_product": ["product_id"],
    "dim_seller": ["seller_id"],
    "dim_date": ["full_date"],
}


def audit_star(star: Star, deltas: dict | None = None) -> list[DataFrame]:
    """Checks of the star, the fact read once and its keys not shuffled.

    A table whose keys are each whole number of a range once has no duplicate,
    and a fact key within its dimension's range has a parent; so bounds and
    fingerprints of one scan decide. A table or key that they do not clear is
    counted the long way. With ``deltas`` (a load's new rows, and the folders it
    found with their key ranges) only new rows are scanned: the old ones were
    checked when they came, and what remains is that the ranges don't meet.
    """
    whole = star.as_dict()
    scanned = {n: deltas[n].rows if deltas else whole[n] for n in STAR_KEYS}
    facts, seen = key_facts(scanned, STAR_KEYS)
    if deltas:
        facts = {n: f.joined(deltas[n].had) for n, f in facts.items()}
    known: list[tuple[str, str, int]] = []
    parts: list[DataFrame] = []
    for name, keys in STAR_KEYS.items():
        if facts[name].dense:
            known.append((name, f"primary key ({keys[0]})", 0))
        else:
            parts.append(duplicates(whole[name], name, keys[:1]))
        known += [(name, f"not null ({c})", seen[name]["rows"] - seen[name][c]["n"]) for c in keys]
    for key in STAR_KEYS["fact_sales"][1:]:
        parent, b = f"dim_{key[:-3]}", seen["fact_sales"][key]
        at = facts[parent]
        if not b["n"] or (at.dense and at.low is not None and at.low <= b["lo"] and b["hi"] <= at.high):
            known.append(("fact_sales", f"foreign key ({key}) -> {parent}", 0))
        else:
            parts.append(orphans(scanned["fact_sales"], whole[parent], "fact_sales", key, parent))
    spark = star.fact_sales.sparkSession
    return [spark.createDataFrame(known, "table_name string, rule string, violations bigint"), *parts]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_constraints(tb: CleanTables | None, star: Star | None, deltas: dict | None = None) -> DataFrame:
    """(table_name, rule, violations) for every declared constraint; ``deltas`` as in ``audit_star``."""
    parts: list[DataFrame] = []
    groups: list[KeyGroup] = []
    if tb is not None:
        parts += audit_clean(tb)
        groups += clean_keys(tb)
    if star is not None:
        parts += audit_star(star, deltas)
        groups += [KeyGroup(getattr(star, n), n, tuple(keys), "unique") for n, keys in UNIQUE_KEYS.items()]
    parts.append(key_checks(groups))
    return _union(parts)


def validate_counts(tb: CleanTables, star: Star) -> DataFrame:
    """Row counts of clean orders, clean items and the fact."""
    a, b, c = dv.COUNT_LABELS

    def one(df: DataFrame, text: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("total_registros")).select(
            F.lit(text).alias("tabela_origem"), "total_registros"
        )

    return _union([one(tb.orders, a), one(tb.order_items, b), one(star.fact_sales, c)])


def validate_null_keys(star: Star) -> DataFrame:
    """Fact rows with a NULL surrogate key, per key (all expected 0).

    One scan of the fact with four conditional counts, unpivoted.
    """
    cols = ("customer_sk", "product_sk", "seller_sk", "date_sk")
    counts = star.fact_sales.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{text}', `{c}`" for text, c in zip(dv.NULL_KEY_LABELS, cols))
    return counts.selectExpr(f"stack(4, {pairs}) as (validacao, qtd_erros)").select(
        "validacao", F.col("qtd_erros").cast("bigint").alias("qtd_erros")
    )


def validate_price_sum(tb: CleanTables, star: Star) -> DataFrame:
    """Total item price in the clean layer and in the fact."""
    a, b = dv.PRICE_SUM_LABELS

    def one(df: DataFrame, text: str) -> DataFrame:
        return df.agg(F.sum("price").cast("decimal(38,2)").alias("valor_total")).select(
            F.lit(text).alias("metrica"), "valor_total"
        )

    return _union([one(tb.order_items, a), one(star.fact_sales, b)])
