"""What happens to rows with equal keys: replace (the last wins), ignore (the first wins) or error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import written
from .encode import ROW_ID

POLICIES = ("replace", "ignore", "error")


def conflicts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys with several rows; rows with a NULL in the key never conflict."""
    whole = rows.where(" and ".join(f"`{k}` is not null" for k in keys))
    return whole.groupBy(*[f"`{k}`" for k in keys]).agg(F.count("*").alias("n")).where("n > 1")


def resolve(rows: DataFrame, keys: list[str], policy: str, order: list[Column] | None = None) -> DataFrame:
    """rows with one row a key, by the policy; order (default: the row id) says which came first and must be total.

    A key with very many rows is reduced before the shuffle: the winner is a min or max of a struct, a partial aggregate,
    not the first row of a sorted window.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown on-duplicate policy {policy}")
    order = order or [F.col(ROW_ID)]
    if policy == "error":
        entry = F.concat_ws("-", *[F.col(f"`{k}`").cast("string") for k in keys])
        bad = conflicts(rows, keys).select(entry.alias("k")).limit(1).collect()
        if bad:
            raise ValueError(f"Duplicate entry '{bad[0].k}' for key '{','.join(keys)}'")
        return rows
    rest = [c for c in rows.columns if c not in keys]
    packed = F.struct(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)]).alias("o"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("v"))
    pick = F.max_by if policy == "replace" else F.min_by
    whole = rows.where(" and ".join(f"`{k}` is not null" for k in keys))
    loose = rows.where(" or ".join(f"`{k}` is null" for k in keys))
    won = whole.groupBy(*[f"`{k}`" for k in keys]).agg(pick(packed["v"], packed["o"]).alias("v"))
    won = won.select(*[F.col(f"`{c}`") if c in keys else F.col(f"v.`{c}`").alias(c) for c in rows.columns])
    return won.unionByName(loose)


def resolve_all(rows: DataFrame, keys: list[list[str]], policy: str, order: list[Column] | None = None) -> DataFrame:
    """rows as a table with several unique keys holds them after they came one by one, in order (default: the row id).

    replace: a row removes every row before it with which it shares a key, so those stay that are the last under each of their keys.
    ignore: a row stays if it shares no key with a row before it that stayed; found in rounds, in each of which the rows that are the
    first under all their keys stay and those that share a key with them go.  Only rows with a key in conflict take part in the rounds.
    A NULL in a key conflicts with nothing.
    """
    keys = [k for k in keys if k]
    if policy == "error" or len(keys) < 2:
        for k in keys:
            rows = resolve(rows, k, policy, order)
        return rows
    whole = lambda k: F.when(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in k]), F.struct(*[F.col(f"`{c}`") for c in k]))
    place = F.struct(*[c.alias(f"o{j}") for j, c in enumerate(order or [F.col(ROW_ID)])])
    named = [f"k{j}" for j in range(len(keys))]
    every = rows.select(place.alias("place"), *[whole(k).alias(n) for k, n in zip(keys, named)])
    crowd = [every.where(f"{n} is not null").groupBy(n).agg(F.count("*").alias("n")).where("n > 1").select(n, F.lit(True).alias(f"of_{n}")) for n in named]
    undecided = every
    for n, c in zip(named, crowd):
        undecided = undecided.join(c, n, "left")
    undecided = written(undecided.where(" or ".join(f"of_{n}" for n in named)).select("place", *named))
    pick, gone = (F.max, F.min)[policy == "ignore"], []
    while True:
        lead = undecided
        for n in named:
            lead = lead.join(undecided.where(f"{n} is not null").groupBy(n).agg(pick("place").alias(f"at_{n}")), n, "left")
        leads = reduce(lambda a, b: a & b, [F.col(n).isNull() | (F.col(f"at_{n}") == F.col("place")) for n in named])
        if policy == "replace":
            gone.append(lead.where(~leads).select("place"))
            break
        first = written(lead.where(leads).select("place", *named))
        rest = undecided.join(first.select("place"), "place", "left_anti")
        for n in named:
            rest = rest.join(first.where(f"{n} is not null").select(n, F.lit(True).alias(f"of_{n}")), n, "left")
        out = F.coalesce(*[F.col(f"of_{n}") for n in named], F.lit(False))
        rest = written(rest.select("place", *named, out.alias("out")))
        gone.append(rest.where("out").select("place"))
        undecided = rest.where("not out").select("place", *named)
        if undecided.isEmpty():
            break
    lost = reduce(DataFrame.union, gone).select(F.col("place").alias("__place"))
    return rows.join(lost, place == F.col("__place"), "left_anti")
