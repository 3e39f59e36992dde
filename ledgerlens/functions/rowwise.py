"""Statistics across the columns of one row.

A block is handled as one array, so 339 columns need one expression instead of a
339-term sum, and the generated code stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .scalars import to_number


def row_statistics(df: DataFrame, blocks: dict[str, list[str]], names: dict[str, dict[str, str]]) -> DataFrame:
    """Add sum, mean, sample deviation and null count of each block of columns.

    `names[block]` maps any of `sum, mean, std, nulls, null_ratio` to an output name. The sum
    of an empty row is 0, its mean null; the deviation needs two values.
    """
    if not blocks:
        return df
    fresh = {v for per in names.values() for v in per.values()}
    helpers = [f"__held_{b}" for b in blocks] + [f"__sum_{b}" for b in blocks]
    arrays = df.selectExpr(
        "*",
        *[
            f"filter(array({', '.join(to_number(f'`{c}`') for c in cols)}), x -> x IS NOT NULL) AS __held_{b}"
            for b, cols in blocks.items()
        ],
    )
    sums = arrays.selectExpr("*", *[f"aggregate(__held_{b}, 0D, (a, x) -> a + x) AS __sum_{b}" for b in blocks])
    out = []
    for b, cols in blocks.items():
        width, n = len(cols), f"size(__held_{b})"
        mean = f"try_divide(__sum_{b}, {n})"
        squares = f"aggregate(__held_{b}, 0D, (a, x) -> a + (x - __sum_{b} / {n}) * (x - __sum_{b} / {n}))"
        available = {
            "sum": f"__sum_{b}",
            "mean": mean,
            "std": f"CASE WHEN {n} > 1 THEN sqrt({squares} / ({n} - 1)) END",
            "nulls": f"{width} - {n}",
            "null_ratio": f"({width} - {n}) / {width}D",
        }
        out += [f"{available[k]} AS `{v}`" for k, v in names[b].items()]
    replaced = [c for c in df.schema.names if c in fresh]
    hidden = ", ".join([*helpers, *[f"`{c}`" for c in replaced]])
    return sums.selectExpr(f"* EXCEPT ({hidden})", *out)
