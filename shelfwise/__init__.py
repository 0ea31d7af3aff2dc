"""Stock rotation, seasonality and warehouse decisions as Spark jobs."""

from shelfwise.params import Params

__all__ = ["Params"]
