"""Co-moments that merge: correlations from one pass over a table or over each batch of a stream.

A cell holds, for a pair of columns, the rows where both are present: (*by, x, y, n, mean_x, mean_y, m2_x, m2_y, c_xy) with the
sums of squared deviations m2 and of their products c. Cells of batches or of finer groups add up to those of the whole.
NULL and NaN count as missing; an infinite value leaves its column without correlations. Merging needs differences of means, which
are doubles: where values lie a factor f of their deviation away from 0, the merged r is right to about f * 1e-16.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.nulls import nan_to_null
from riskloom.operators.dims import local_table

PAIR = ("x", "y")
STATE = ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy")
HEAD = 100  # rows whose values serve as origins


def _origins(values: DataFrame, width: int) -> list[float]:
    """A finite value of each column v0, v1, ... from the first rows, 0 if there is none.

    Sums of distances from them lose few digits; which values they are does not matter otherwise.
    """
    first = values.limit(HEAD).selectExpr(*[f"min(v{i}) FILTER (WHERE abs(v{i}) < double('infinity')) AS v{i}" for i in range(width)]).first()
    return [0.0 if v is None else v for v in first]


def comoment_cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Cells of all pairs of columns, each column with itself included, x not after y in the order given.

    Rows are grouped by which columns they lack, so that within a group every column is complete: one sum per pair and one
    per column are enough, and what is shuffled is a row per such group. Columns in `by` may not be named like a cell's.
    """
    width, keys = range(len(columns)), [f"by{i}" for i in range(len(by))]
    pairs = [(i, j) for i in width for j in width if i <= j]
    # Columns by number, so that the caller's names cannot clash.
    groups = [F.col(b).alias(k) for k, b in zip(keys, by, strict=True)]
    values = df.select(*groups, *[nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    origins = _origins(values, len(columns))
    present = "concat(" + ", ".join(f"if(v{i} IS NULL, '0', '1')" for i in width) + ") AS present"
    rows = values.selectExpr(*keys, present, *[f"v{i} - {o!r}D AS d{i}" for i, o in enumerate(origins)])
    sums = rows.groupBy(*keys, "present").agg(
        F.expr("count(*) AS n"),
        *[F.expr(f"{f}(d{i}) AS {f}{i}") for f in ("sum", "min", "max") for i in width],
        *[F.expr(f"sum(d{i} * d{j}) AS sum{i}_{j}") for i, j in pairs],
    )

    def array(entries: list[str]) -> str:
        return f"array({', '.join(entries)})"

    packed = sums.selectExpr(
        *keys,
        "n",
        *[f"{array([f'{f}{i}' for i in width])} AS {f}" for f in ("sum", "min", "max")],
        f"{array([f'sum{i}_{j}' for i, j in pairs])} AS product",
        f"{array([str(pairs.index((i, i))) for i in width])} AS own",
        f"inline({array([f'struct({i} AS i, {j} AS j, {k} AS k)' for k, (i, j) in enumerate(pairs)])})",
    )

    def mean(i: str) -> str:
        return f"if(min[{i}] = max[{i}], min[{i}], sum[{i}] / n)"

    def co(i: str, j: str, k: str) -> str:
        return f"if(min[{i}] = max[{i}] OR min[{j}] = max[{j}], 0D, product[{k}] - sum[{i}] * sum[{j}] / n)"

    state = [mean("i"), mean("j"), co("i", "i", "own[i]"), co("j", "j", "own[j]"), co("i", "j", "k")]
    names = F.array(*[F.lit(c) for c in columns])
    found = packed.where("sum[i] IS NOT NULL AND sum[j] IS NOT NULL").select(
        *[F.col(k).alias(b) for k, b in zip(keys, by, strict=True)],
        F.get(names, F.col("i")).alias("x"),
        F.get(names, F.col("j")).alias("y"),
        "n",
        *[F.expr(e).alias(name) for e, name in zip(state, STATE[1:], strict=True)],
    )
    merged = merge_comoments(found, by)  # of distances from the origins, which would take digits from the means
    origin = F.create_map(*[e for c, o in zip(columns, origins, strict=True) for e in (F.lit(c), F.lit(o))])
    return merged.withColumns({f"mean_{s}": F.col(f"mean_{s}") + origin[F.col(s)] for s in PAIR})


def merge_comoments(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cells of the same groups and pairs added up; deviations are taken from the common mean, not from 0.

    The common mean is reached from the least mean, so cells of one constant merge into exactly that constant.
    """
    keys = [*by, *PAIR]
    of = Window.partitionBy(*keys)
    filled = cells.where("n > 0").select(*keys, *STATE)
    based = filled.withColumns({f"base_{s}": F.min(f"mean_{s}").over(of) for s in PAIR})
    shift = {s: F.expr(f"sum(n * (mean_{s} - base_{s}))").over(of) / F.expr("sum(n)").over(of) for s in PAIR}
    centred = based.withColumns({f"all_{s}": F.col(f"base_{s}") + shift[s] for s in PAIR})
    x, y = (f"(mean_{s} - all_{s})" for s in PAIR)
    return centred.groupBy(*keys).agg(
        F.expr("sum(n) AS n"),
        F.expr("first(all_x) AS mean_x"),
        F.expr("first(all_y) AS mean_y"),
        F.expr(f"sum(m2_x + n * {x} * {x}) AS m2_x"),
        F.expr(f"sum(m2_y + n * {y} * {y}) AS m2_y"),
        F.expr(f"sum(c_xy + n * {x} * {y}) AS c_xy"),
    )


def correlations(merged: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson (*by, x, y, r) of every ordered pair from merged cells; NULL for a constant column or one with infinite values.

    Without `by` all pairs of the columns are listed, also those never present together; else those of the groups that have a cell.
    """
    fit = " AND ".join(f"{m} > 0 AND {m} < double('infinity')" for m in ("m2_x", "m2_y"))
    r = F.expr(f"CASE WHEN {fit} THEN if(x = y, 1D, nanvl(c_xy / (sqrt(m2_x) * sqrt(m2_y)), NULL)) END AS r")
    both = F.expr("inline(if(x = y, array(struct(x, y)), array(struct(x, y), struct(y AS x, x AS y))))")
    found = merged.select(*by, "x", "y", r).select(*by, both, "r")
    if by:
        return found
    every = local_table(merged.sparkSession, "x string, y string", [(a, b) for a in columns for b in columns])
    return every.join(found, ["x", "y"], "left")
