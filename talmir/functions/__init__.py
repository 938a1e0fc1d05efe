from talmir.functions.expressions import (
    require,
    squared_distance,
    truncate_rating,
    unit_draw,
)

__all__ = ["require", "squared_distance", "truncate_rating", "unit_draw"]
