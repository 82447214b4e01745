"""NTILE by exact cut points instead of sorting.

A tile's border is the row at a known position of the order (value, key). All
borders of all orders are found together by refining histograms: one pass counts the rows
of each border's interval in `BINS` bins, the bin that holds the position becomes
the interval, and an interval of a single value goes on with the keys of that
value. An interval of at most `FEW` rows is read out instead. So a refinement costs one scan and
at most orders x borders x BINS counts or as many x FEW rows, there is no range shuffle and
no join back, and a last scan labels every row by comparing it with the borders. Equal to `ntile(n) OVER (ORDER BY value, key)`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
FEW = 1024


@dataclass
class _Search:
    """A border: the row at position `rank` among those with x in [lo, hi], where x
    is the value, or the key of rows with value `value`."""
    value_col: Column
    rank: int
    rows: int
    lo: int
    hi: int
    value: int | None = None

    def done(self) -> bool:
        return self.value is not None and self.lo == self.hi

    def inside(self, key: Column) -> Column:
        if self.value is None:
            return self.value_col.between(self.lo, self.hi)
        return (self.value_col == self.value) & key.between(self.lo, self.hi)

    def width(self, bins: int) -> int:
        return (self.hi - self.lo) // bins + 1


def _bin(x: Column, width: int) -> Column:
    """x // width of bigints (the quotient is small, so a double holds it)."""
    w = F.lit(width).cast("bigint")
    return F.round((x - x % w) / w).cast("bigint")


def tile_borders(df: DataFrame, tiles: int, orders: dict[str, Column], key: Column, bins: int = BINS,
                 few: int = FEW) -> dict[str, list]:
    """For each order (name -> bigint value column, ascending), the (value, key) of the last
    row of tiles 1 .. tiles - 1; None for tiles before the first row."""
    edges = df.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("klo"), F.max(key).alias("khi"),
                   *[f(v).alias(f"{name}_{e}") for name, v in orders.items() for e, f in (("lo", F.min), ("hi", F.max))]).first()
    q, r = divmod(edges.n, tiles)
    found: dict[str, list] = {name: [None] * (tiles - 1) for name in orders}
    open_: dict[tuple[str, int], _Search] = {}
    for name, v in orders.items():
        for i in range(1, tiles):
            if rank := i * q + min(i, r):
                open_[name, i] = _Search(v, rank, edges.n, edges[f"{name}_lo"], edges[f"{name}_hi"])
    while open_:
        for at, s in list(open_.items()):
            if s.value is None and s.lo == s.hi:
                s.value, s.lo, s.hi = s.lo, edges.klo, edges.khi
            if s.done():
                found[at[0]][at[1] - 1] = (s.value, s.lo)
                del open_[at]
        ids = list(open_)
        if not ids:
            break
        small = [j for j, at in enumerate(ids) if open_[at].rows <= few]
        if small:       # their rows decide at once
            picks = [F.when(open_[ids[j]].inside(key), F.struct(F.lit(j).alias("s"), open_[ids[j]].value_col.alias("v"),
                                                                key.alias("k"))) for j in small]
            rows = _marked(df, picks).collect()
            for j in small:
                own = sorted((r.c.v, r.c.k) for r in rows if r.c.s == j)
                name, i = ids[j]
                found[name][i - 1] = own[open_.pop(ids[j]).rank - 1]
            continue
        cells = []
        for j, at in enumerate(ids):
            s = open_[at]
            x = s.value_col if s.value is None else key
            cells.append(F.when(s.inside(key), F.struct(F.lit(j).alias("s"), _bin(x - s.lo, s.width(bins)).alias("b"))))
        counts = _marked(df, cells).groupBy("c.s", "c.b").agg(F.count(F.lit(1)).alias("n")).collect()
        for j, at in enumerate(ids):
            s, before = open_[at], 0
            width = s.width(bins)
            for b, n in sorted((c.b, c.n) for c in counts if c.s == j):
                if before + n >= s.rank:
                    s.rank, s.rows = s.rank - before, n
                    s.lo, s.hi = s.lo + b * width, min(s.hi, s.lo + (b + 1) * width - 1)
                    break
                before += n
    return found


def _marked(df: DataFrame, marks: list[Column]) -> DataFrame:
    """One row `c` per row of `df` and mark that is not NULL."""
    return df.select(F.explode(F.filter(F.array(*marks), lambda c: c.isNotNull())).alias("c"))


def tile_of(borders: list, value: Column, key: Column) -> Column:
    """1 + the number of borders that the row lies behind."""
    out = F.lit(1)
    for b in borders:
        out = out + (F.lit(1) if b is None else
                     F.when((value > b[0]) | ((value == b[0]) & (key > b[1])), 1).otherwise(0))
    return out.cast("int")


def ntiles(df: DataFrame, tiles: int, orders: dict[str, Column], key: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """`df` with one column per order: its NTILE(tiles). `df` is scanned once per
    refinement, so hand in a written table. Values and keys are bigints; a NULL
    value comes first; keys are unique."""
    low = -(1 << 62)
    whole = {name: F.coalesce(v.cast("bigint"), F.lit(low)) for name, v in orders.items()}
    k = F.col(key).cast("bigint")
    borders = tile_borders(df, tiles, whole, k, bins, few)
    return df.withColumns({name: tile_of(borders[name], v, k) for name, v in whole.items()})
