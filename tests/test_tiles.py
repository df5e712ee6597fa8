"""Tiles from descriptions."""

import pytest

from sitegauge.plans import tiles as T


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([("a", "x", 1, 0.5), ("a", "y", 2, 0.5), ("b", "x", 4, 1.0), (None, "x", 8, 1.0)], "brand string, category string, pages int, share double")


TILES = [
    T.Tile("total", "d", (), "pages", "sum", "pages"), T.Tile("kinds", "d", (), "category", "count_distinct", "kinds"),
    T.Tile("by_brand", "d", ("brand",), "pages", "sum", "pages", ("-pages",)), T.Tile("grid", "d", ("category", "brand"), "share", "max", "share"),
    T.Tile("other", "e", (), "pages", "count", "n")]


def test_board_in_one_scan(rows):
    got = T.board({"d": rows}, TILES)
    assert got._jdf.queryExecution().executedPlan().toString().count("Expand") >= 1
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    values = {(r.tile, r.dimensions.get("category"), r.dimensions.get("brand"), len(r.dimensions)): r.value for r in got.collect()}
    assert values == {
        ("total", None, None, 0): 15.0, ("kinds", None, None, 0): 2.0, ("by_brand", None, "a", 1): 3.0, ("by_brand", None, "b", 1): 4.0, ("by_brand", None, None, 1): 8.0,
        ("grid", "x", "a", 2): 0.5, ("grid", "y", "a", 2): 0.5, ("grid", "x", "b", 2): 1.0, ("grid", "x", None, 2): 1.0}


def test_one_tile(rows):
    assert [tuple(r) for r in T.tile_rows(rows, TILES[2]).collect()] == [(None, 8), ("b", 4), ("a", 3)]
    placed = T.Tile("p", "d", ("category",), "pages", "count", "n", ("category_order",), (("category", ("y", "x")),))
    assert [tuple(r) for r in T.tile_rows(rows, placed).collect()] == [("y", 1, 1), ("x", 3, 2)]
    assert [tuple(r) for r in T.tile_rows(rows.limit(0), TILES[0]).collect()] == [(None,)]


def test_empty_and_wrong(rows):
    assert [(r.tile, r.value) for r in T.board({"d": rows.limit(0)}, TILES[:2]).collect()] == [("total", None), ("kinds", 0.0)]
    with pytest.raises(ValueError):
        T.board({"d": rows}, [T.Tile("x", "d", (), "pages", "median", "m")])
    with pytest.raises(ValueError):
        T.board({"z": rows}, TILES)
    with pytest.raises(ValueError):
        T.board({"d": rows}, [TILES[0], TILES[0]])
