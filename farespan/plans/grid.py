"""Seat availability grid."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from farespan.functions import fixed, windows
from farespan.operators.capacity import availability_grid
from farespan.sources.tables import Tables


def seat_grid(t: Tables, now: datetime, departs_from: datetime | None = None, own_classes: bool = False) -> DataFrame:
    """Authorised and available seats per class of every open leg from today on.

    With ``own_classes`` the classes are those of the class table, else the usual list.
    """
    local = windows.to_local(now, windows.MALAYSIA)
    start = departs_from or windows.from_today(local).start
    return availability_grid(t, windows.stamp(start), windows.stamp(local), None if own_classes else fixed.GRID_CLASSES)
