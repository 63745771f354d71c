"""Court geometry. Only + - * / and sqrt are used, so results are reproducible bit for bit."""

from pyspark.sql import Column, functions as F

from rimline.constants import (
    ARC_THREE_FT,
    CORNER_THREE_FT,
    CORNER_Y,
    COURT_LENGTH,
    COURT_WIDTH,
    HALF_LENGTH,
    HOOP_Y,
    HOOPS,
)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def hoop_distance(x: Column, y: Column) -> Column:
    """Distance to the nearer hoop; NULL without a position (``least`` alone would skip NULLs)."""
    nearest = F.least(*(distance(x, y, F.lit(hx), F.lit(hy)) for hx, hy in HOOPS))
    return F.when(x.isNotNull() & y.isNotNull(), nearest)


def is_three(shot_distance: Column, y: Column) -> Column:
    """Three-point class: a straight line near the sidelines, the arc elsewhere."""
    return (
        F.when(shot_distance.isNull(), F.lit(None).cast("boolean"))
        .when(F.abs(y - HOOP_Y) >= CORNER_Y, shot_distance >= CORNER_THREE_FT)
        .otherwise(shot_distance >= ARC_THREE_FT)
    )


def fold_x(x: Column) -> Column:
    return F.when(x > HALF_LENGTH, COURT_LENGTH - x).otherwise(x)


def fold_y(x: Column, y: Column) -> Column:
    """Far-half shots are turned half a circle about the centre, so y turns with x."""
    return F.when(x > HALF_LENGTH, COURT_WIDTH - y).otherwise(y)
