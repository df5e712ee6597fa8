"""Dashboard tiles as data: what is grouped, by what, and how it is sorted.

All tiles of one dataset are computed in one scan of it: their groupings are grouping sets of one
aggregation, and every row of the result belongs to the tiles with that grouping.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge import presets
from sitegauge.functions.rules import custom_sort_order

FUNCTIONS = {"count": F.count, "count_distinct": F.count_distinct, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
BOARD = "tile string, dimensions map<string,string>, value double"


@dataclass(frozen=True)
class Tile:
    """function(measure) AS value of `dataset`, grouped by `dimensions`; `sort`: columns of the result, `-` in front for
    descending.  `positions` are fixed orders of dimension values; each gives a column <dimension>_order."""

    name: str
    dataset: str
    dimensions: tuple
    measure: str
    function: str
    value: str
    sort: tuple = ()
    positions: tuple = ()


TILES = tuple(Tile(*t) for t in presets.TILES)
BY_NAME = {t.name: t for t in TILES}


def _checked(tiles) -> list:
    for t in tiles:
        if t.function not in FUNCTIONS:
            raise ValueError(f"{t.name}: unknown function {t.function}")
    if len({t.name for t in tiles}) < len(tiles):
        raise ValueError("tiles need different names")
    return list(tiles)


def _grouped(df: DataFrame, tiles: list) -> tuple:
    """One aggregation for all tiles: the dimensions, a column m0, m1, ... for each tile, and _set, which tells the grouping;
    and the value of _set for each tile."""
    columns = list(dict.fromkeys(d for t in tiles for d in t.dimensions))
    measures = [FUNCTIONS[t.function](F.col(t.measure)).alias(f"m{i}") for i, t in enumerate(tiles)]
    if not columns:
        return df.agg(*measures).withColumn("_set", F.lit(0).cast("bigint")), [0] * len(tiles)
    sets = [list(s) for s in dict.fromkeys(tuple(c for c in columns if c in t.dimensions) for t in tiles)]
    # a bit for each column that is not in the grouping, the last column being the lowest
    number = lambda t: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in t.dimensions)
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(*measures, F.grouping_id().alias("_set"))
    return grouped, [number(t) for t in tiles]


def tile_rows(df: DataFrame, tile: Tile | str) -> DataFrame:
    """One tile of its dataset, in the types of the dataset and in the tile's order."""
    tile = BY_NAME[tile] if isinstance(tile, str) else tile
    grouped, _ = _grouped(df, _checked([tile]))
    rows = grouped.select(*tile.dimensions, F.col("m0").alias(tile.value))
    for dimension, order in tile.positions:
        rows = rows.withColumn(f"{dimension}_order", custom_sort_order(dimension, order))
    sort = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in tile.sort]
    return rows.orderBy(*sort) if sort else rows


def board(datasets: dict, tiles=TILES) -> DataFrame:
    """(tile, dimensions, value) of all tiles whose dataset is given; each dataset is read once.

    A tile without dimensions has one row, also for an empty dataset.  Values are doubles, dimensions text."""
    out = None
    for name, df in datasets.items():
        own = _checked([t for t in tiles if t.dataset == name])
        if not own:
            continue
        grouped, numbers = _grouped(df, own)
        cells = []
        for i, (t, number) in enumerate(zip(own, numbers, strict=True)):
            pairs = [x for d in t.dimensions for x in (F.lit(d), F.col(d).cast("string"))]
            dimensions = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
            cells.append(F.struct((F.col("_set") == number).alias("own"), F.lit(t.name).alias("tile"), dimensions.alias("dimensions"),
                                  F.col(f"m{i}").cast("double").alias("value")))
        rows = grouped.select(F.explode(F.filter(F.array(*cells), lambda c: c["own"])).alias("c")).select("c.tile", "c.dimensions", "c.value")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no tile belongs to the given datasets")
    return out
