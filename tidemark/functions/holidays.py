"""US public holidays as a predicate on a date column."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, as_column

# Fixed values: (month, day, first year observed)
FIXED_HOLIDAYS = [
    (1, 1, 0),  # New Year
    (6, 19, 2021),  # Juneteenth
    (7, 4, 0),  # Independence
    (11, 11, 0),  # Veterans
    (12, 25, 0),  # Christmas
]

# Fixed values: (month, weekday with Monday = 0, first and last possible day of month)
FLOATING_HOLIDAYS = [
    (1, 0, 15, 21),  # Martin Luther King Jr.
    (2, 0, 15, 21),  # Presidents
    (5, 0, 25, 31),  # Memorial
    (9, 0, 1, 7),  # Labor
    (10, 0, 8, 14),  # Columbus
    (11, 3, 22, 28),  # Thanksgiving
]


def _fixed(day: Column) -> Column:
    rules = [
        (F.month(day) == month) & (F.dayofmonth(day) == number) & (F.year(day) >= since)
        for month, number, since in FIXED_HOLIDAYS
    ]
    return reduce(or_, rules)


def is_us_holiday(day: ColumnOrName, observed: bool = True) -> Column:
    """True on public holidays of any year; ``observed`` adds the Friday or Monday stand-in."""
    day = as_column(day)
    rules = [_fixed(day)]
    for month, weekday, first, last in FLOATING_HOLIDAYS:
        rules.append(
            (F.month(day) == month)
            & (F.weekday(day) == weekday)
            & F.dayofmonth(day).between(first, last)
        )
    if observed:
        rules.append((F.weekday(day) == 4) & _fixed(F.date_add(day, 1)))
        rules.append((F.weekday(day) == 0) & _fixed(F.date_sub(day, 1)))
    return reduce(or_, rules)
