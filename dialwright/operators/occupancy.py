"""Share of rooms in use per time slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.operators.aggregates import count_distinct, n_distinct
from dialwright.operators.clean import positive_intervals
from dialwright.operators.reshape import explode_slots


def occupancy(
    bookings: DataFrame,
    room: str,
    start: str,
    end: str,
    slot: str = "slot",
    step_minutes: int = 15,
    end_inclusive: bool = False,
) -> DataFrame:
    """Rooms in use per slot, and their share of all rooms ever booked.

    Distinct rooms are counted in two steps (slot and room, then slot), so a
    room with very many bookings is reduced before the shuffle.
    """
    valid = positive_intervals(bookings.select(room, start, end), start, end)
    slots = explode_slots(valid, start, end, slot, step_minutes, end_inclusive)
    used = count_distinct(slots, [slot], room, "rooms_occupied")
    return used.withColumn("room_occupation_pct", F.col("rooms_occupied") / n_distinct(valid, room))
