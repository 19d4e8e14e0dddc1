"""Many trailing windows from running sums: the work of a row does not grow with the lengths of the windows.

Each block keeps running sums of every column: the number of values, their sum, the sum of squares, and the sum of
products with the position. A window of n rows is the running sums now less those n rows ago, so all windows of all
columns need one lag of one packed array for each length, where a sliding frame would add up n rows for each of them.

Differences of running sums lose digits, so the sums here lose none: values are taken about the median of the block, and
every term is split into a multiple of a power of two, coarse enough that such sums are exact in doubles, and a small
rest. A value far off the others then disturbs only the windows that hold it. That a window is constant is told by
counting, not by a difference that should be zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourloom.operators import rolling
from hourloom.operators.layout import POS, REL

#: kind of feature -> the running sums that it needs
NEEDS = {"mean": ("s",), "std": ("s", "q"), "trend": ("s", "r")}
LAGGED = ("lag", "change")

Spec = tuple[str, str, int]  # kind, column, rows


def _grid(bound: str) -> str:
    """A power of two so coarse that multiples of it up to the bound add up exactly."""
    return f"CASE WHEN {bound} > 0 THEN pow(2D, ceil(log2({bound})) - 51) ELSE 1D END"


def with_windows(df: DataFrame, w: WindowSpec, specs: dict[str, Spec]) -> DataFrame:
    """Add the features of ``specs`` to rows in block layout; ``w`` is the window of the blocks.

    Kinds: ``mean``, ``std`` and ``trend`` over the last n rows, ``max`` over the last n rows, ``lag`` by n rows, and
    ``change`` against n rows ago. Values as those of the functions in ``rolling``.
    """
    summed = {}
    for kind, c, _ in specs.values():
        summed[c] = summed.get(c, set()) | set(NEEDS.get(kind, ()))
    summed = {c: sorted(kinds) for c, kinds in summed.items() if kinds}
    spread = [c for c, kinds in summed.items() if "q" in kinds]
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    about = {"_rows": F.count(F.lit(1)).over(whole)}
    for c in summed:
        value = F.col(c).cast("double")
        about |= {f"_m_{c}": F.percentile_approx(value, 0.5, 100).over(whole), f"_lo_{c}": F.min(value).over(whole), f"_hi_{c}": F.max(value).over(whole)}
        about[f"_n_{c}"] = F.count(value).over(so_far)
    about |= {f"_was_{c}": F.last(c, ignorenulls=True).over(before) for c in spread}
    df = df.withColumns(about)

    # the terms of the sums, each as a coarse and a fine part
    centred = {f"_x_{c}": F.expr(f"cast({c} as double) - _m_{c}") for c in summed}
    grids = {}
    for c, kinds in summed.items():
        for kind, bound in {"s": "{d} * _rows", "q": "{d} * {d} * _rows", "r": "{d} * _rows * _rows"}.items():
            if kind in kinds:
                grids[f"_g_{kind}_{c}"] = F.expr(_grid(bound.format(d=f"(_hi_{c} - _lo_{c})")))
    df = df.withColumns(centred | grids)
    term = {"s": "_x_{c}", "q": "_x_{c} * _x_{c}", "r": "_x_{c} * " + REL}
    coarse, fine = {}, {}
    for c, kinds in summed.items():
        for kind in kinds:
            e, g, name = term[kind].format(c=c), f"_g_{kind}_{c}", f"_{kind}_{c}"
            coarse[f"{name}_hi"] = F.expr(f"rint({e} / {g}) * {g}")
            fine[f"{name}_lo"] = F.expr(f"{e} - {name}_hi")
    moved = {f"_k_{c}": F.expr(f"CASE WHEN {c} <> _was_{c} THEN _n_{c} END") for c in spread}
    df = df.withColumns(coarse | moved).withColumns(fine)

    parts = [f"_n_{c}" for c in summed] + sorted([*coarse, *fine])
    at = {name: i for i, name in enumerate([*parts, *(f"_k_{c}" for c in spread)])}
    sums = [F.col(p).cast("double") if p.startswith("_n_") else F.coalesce(F.sum(p).over(so_far), F.lit(0.0)) for p in parts]
    last_change = [F.coalesce(F.max(f"_k_{c}").over(so_far), F.lit(1)).cast("double") for c in spread]
    values = sorted({c for kind, c, _ in specs.values() if kind in LAGGED})
    packed = {"_v": F.array(*[F.col(c).cast("double") for c in values])} if values else {}
    packed |= {"_p": F.array(*sums, *last_change)} if summed else {}
    helpers = [*about, *centred, *grids, *coarse, *fine, *moved]
    kept = [c for c in df.columns if c not in helpers]
    df = df.select(*kept, *[f"_m_{c}" for c in summed], *[e.alias(n) for n, e in packed.items()])

    back = {f"_p_{n}": F.lag("_p", n).over(w) for n in sorted({n for kind, _, n in specs.values() if kind in NEEDS})}
    back |= {f"_v_{n}": F.lag("_v", n).over(w) for n in sorted({n for kind, _, n in specs.values() if kind in LAGGED})}
    back |= {name: rolling.rolling_max(c, n, w) for name, (kind, c, n) in specs.items() if kind == "max"}
    df = df.withColumns(back)

    def feature(kind: str, c: str, n: int) -> str:
        if kind in LAGGED:
            old = f"_v_{n}[{values.index(c)}]"
            return old if kind == "lag" else f"{c} - {old}"

        def since(name: str) -> str:
            return f"(_p[{at[name]}] - coalesce(_p_{n}[{at[name]}], 0D))"

        def total(k: str) -> str:
            return f"({since(f'_{k}_{c}_hi')} + {since(f'_{k}_{c}_lo')})"

        count, s = since(f"_n_{c}"), total("s")
        if kind == "mean":
            return f"_m_{c} + try_divide({s}, {count})"
        if kind == "std":
            constant = f"_p[{at[f'_n_{c}']}] - _p[{at[f'_k_{c}']}] + 1 >= {count}"
            return f"CASE WHEN {count} < 2 THEN NULL WHEN {constant} THEN 0D ELSE sqrt(greatest({total('q')} - {s} * {s} / {count}, 0D) / ({count} - 1)) END"
        rows = f"cast(least({POS}, {n}) as double)"
        slope = f"({total('r')} - ({REL} - ({rows} - 1) / 2) * {s}) * 12 / ({rows} * ({rows} * {rows} - 1))"
        return f"CASE WHEN {rows} >= 2 AND {count} = {rows} THEN {slope} END"

    told = [f"{feature(kind, c, n)} AS `{name}`" for name, (kind, c, n) in specs.items() if kind != "max"]
    largest = [name for name, (kind, _, _) in specs.items() if kind == "max"]
    return df.selectExpr(*[f"`{c}`" for c in kept], *[f"`{c}`" for c in largest], *told)
