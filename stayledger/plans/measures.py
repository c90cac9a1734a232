"""Measures over the star, evaluated under a filter context.

A measure is made of additive parts (sums and counts of fact rows) and a final expression
over them. So facts are first reduced by their own grouping and key columns, and only the
reduced rows are joined to dimensions and summed up again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayledger.constants import CANCELLED_STATUS
from stayledger.functions.text import is_member
from stayledger.plans.star import Star


@dataclass(frozen=True)
class Part:
    """Additive piece of a measure: sum of ``value`` over the facts in context.

    ``override`` replaces the context's selection on the named columns by its own values.
    """

    value: Column
    count: bool = False
    override: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    name: str
    parts: dict[str, Part]
    final: Callable[..., Column]


def _sum(column: str) -> Part:
    return Part(F.col(column))


def _count(column: str, **override: list) -> Part:
    return Part(F.when(F.col(column).isNotNull(), 1), True, override)


def total_revenue() -> Measure:
    return Measure("total_revenue", {"r": _sum("total_price_usd")}, lambda r: r)


def total_bookings() -> Measure:
    return Measure("total_bookings", {"n": _count("booking_id")}, lambda n: n)


def avg_revenue() -> Measure:
    """Revenue over bookings; a booking without a price still counts."""
    parts = {"r": _sum("total_price_usd"), "n": _count("booking_id")}
    return Measure("avg_revenue", parts, lambda r, n: F.try_divide(r, n))


def cancellation_rate() -> Measure:
    """Cancelled bookings over bookings; its status test replaces any status selection."""
    parts = {
        "c": _count("booking_id", booking_status=[CANCELLED_STATUS]),
        "n": _count("booking_id"),
    }
    return Measure("cancellation_rate", parts, lambda c, n: F.try_divide(c, n))


def share_of(column: str, members: list) -> Measure:
    """Revenue over the revenue of given members, whatever else is selected on their column."""
    parts = {"r": _sum("total_price_usd"), "base": Part(F.col("total_price_usd"), override={column: members})}
    return Measure("share", parts, lambda r, base: F.try_divide(r, base))


def implicit(column: str, fn: str, name: str | None = None) -> Measure:
    """A column's own aggregate: ``sum``, ``avg`` or ``count`` of its values."""
    name = name or f"{fn}_{column}"
    if fn == "sum":
        return Measure(name, {"s": _sum(column)}, lambda s: s)
    if fn == "count":
        return Measure(name, {"n": _count(column)}, lambda n: n)
    if fn == "avg":
        parts = {"s": _sum(column), "n": _count(column)}
        return Measure(name, parts, lambda s, n: F.try_divide(s, n))
    raise ValueError(f"unknown aggregate: {fn}")


Filters = dict[str, list]


def _selected(filters: Filters) -> Column:
    tests = [is_member(F.col(c), v) for c, v in filters.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _reduced(fact: DataFrame, star: Star, name: str, filters: Filters) -> DataFrame:
    """Facts whose member of a dimension is selected, before anything is summed.

    Only the keys of selected members meet the facts. Where blanks are selected, facts
    without a member stay, so the keys of all other members are taken away instead. A stored
    fact that is partitioned by a column of the dimension is joined by that column too, so
    partitions without a selected member are not read.
    """
    dim, fact_key, dim_key = star.dimensions()[name]
    selected = _selected(filters)
    blank = all(None in values for values in filters.values())
    pairs = {fact_key: dim_key, **({} if blank else star.partitions(name))}
    keys = dim.filter(~selected if blank else selected).select(
        *[F.col(d).alias(f"_key_{i}") for i, d in enumerate(pairs.values())]
    )
    same = reduce(lambda a, b: a & b, [fact[f] == keys[f"_key_{i}"] for i, f in enumerate(pairs)])
    return fact.join(keys, same, "left_anti" if blank else "left_semi")


def evaluate(
    star: Star,
    group_by: Sequence[str] = (),
    measures: Sequence[Measure] = (),
    filters: Filters | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One row per group with the value of each measure.

    Columns are named ``column`` for facts and ``dimension.column`` for dimensions, the
    latter coming out as ``dimension_column``. ``filters`` lists the selected members per
    column (None selects blanks), ``where`` is a further test on fact columns. Measures may
    replace the selection on columns of either kind.
    """
    filters = dict(filters or {})
    dims = star.dimensions()
    is_dim = lambda c: "." in c and c.split(".", 1)[0] in dims
    out = lambda c: c.replace(".", "_")

    parts = {f"{m.name}.{p}": part for m in measures for p, part in m.parts.items()}
    overridden = {c for part in parts.values() for c in part.override}
    closed = {c: v for c, v in filters.items() if c not in overridden}
    open_ = {c: v for c, v in filters.items() if c in overridden}
    of_fact = lambda chosen: {c: v for c, v in chosen.items() if not is_dim(c)}
    of_dims = lambda chosen: {c: v for c, v in chosen.items() if is_dim(c)}

    fact = star.fact if where is None else star.fact.filter(where)
    if of_fact(closed):
        fact = fact.filter(_selected(of_fact(closed)))
    # Selections that no measure replaces hold for all parts: they reduce the facts first.
    for name in dims:
        chosen = {c.split(".", 1)[1]: v for c, v in closed.items() if c.startswith(f"{name}.")}
        if chosen:
            fact = _reduced(fact, star, name, chosen)

    # Columns of dimensions that groups or replaced selections need beside the facts.
    needed = dict.fromkeys(c for c in [*group_by, *open_, *overridden] if is_dim(c))
    used = {c.split(".", 1)[0] for c in needed}
    keys = [dims[d][1] for d in dims if d in used]
    fact_groups = [c for c in group_by if not is_dim(c)]
    # A replaced selection on a grouping column reaches over all groups of that column.
    spread = {n: [out(c) for c in group_by if c in p.override] for n, p in parts.items()}

    def context(part: Part) -> Filters:
        return {**{c: v for c, v in open_.items() if c not in part.override}, **part.override}

    sums = {}
    for name, part in parts.items():
        own = of_fact(context(part))
        sums[name] = F.sum(F.when(_selected(own), part.value) if own else part.value).alias(name)
    in_context = F.sum(F.when(_selected(of_fact(open_)), 1)).alias("_rows")

    reduced = fact.groupBy(*dict.fromkeys([*fact_groups, *keys])).agg(*sums.values(), in_context)
    for name in dims:
        if name not in used:
            continue
        dim, fact_key, dim_key = dims[name]
        wanted = dict.fromkeys(c.split(".", 1)[1] for c in needed if c.startswith(f"{name}."))
        side = dim.select(
            F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(f"{name}_{c}") for c in wanted]
        )
        reduced = reduced.join(side, reduced[fact_key] == side["_dim_key"], "left").drop("_dim_key")

    groups = [out(c) for c in group_by]
    if used:

        def within(chosen: Filters, column: str) -> Column:
            col = F.col(f"`{column}`")
            tests = {out(c): v for c, v in of_dims(chosen).items()}
            return F.sum(F.when(_selected(tests), col) if tests else col).alias(column)

        reduced = reduced.groupBy(*groups).agg(
            *[within(context(p), n) for n, p in parts.items()], within(open_, "_rows")
        )
    for name in parts:
        if spread[name]:
            reduced = _spread_over(reduced, name, [g for g in groups if g not in spread[name]])

    def value(n: str) -> Column:
        col = F.col(f"`{n}`")
        return F.coalesce(col, F.lit(0)) if parts[n].count else col

    results = [m.final(*[value(f"{m.name}.{p}") for p in m.parts]).alias(m.name) for m in measures]
    if groups:
        reached = reduce(
            lambda a, b: a | b,
            [F.coalesce(F.col(f"`{n}`"), F.lit(0)) > 0 for n, p in parts.items()
             if p.override and not spread[n]],
            F.coalesce(F.col("_rows"), F.lit(0)) > 0,
        )
        reduced = reduced.filter(reached)
    return reduced.select(*groups, *results)


def _spread_over(reduced: DataFrame, part: str, others: list[str]) -> DataFrame:
    """Give every group the part's total over all groups that agree on ``others``."""
    col = F.col(f"`{part}`")
    if not others:
        total = reduced.agg(F.sum(col)).scalar()
        return reduced.withColumn(part, total)
    totals = reduced.groupBy(*[F.col(c).alias(f"_t_{c}") for c in others]).agg(
        F.sum(col).alias("_total")
    )
    same = reduce(
        lambda a, b: a & b, [reduced[c].eqNullSafe(totals[f"_t_{c}"]) for c in others]
    )
    joined = reduced.join(totals, same, "left")
    return joined.withColumn(part, F.col("_total")).drop("_total", *[f"_t_{c}" for c in others])
