"""Event classes, weather tags, flags and keyed draws."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartergrid.config import EVENT_CLASSES, EVENT_RENAMES, HOUR_CLASSES, OTHER_CLASS

# Words that mark a tag, tested in this order.
TAG_WORDS = (
    ("w_rain", "rain|drizzle|thunderstorm"),
    ("w_snow", "snow"),
    ("w_fog", "fog|haze|mist|smoke"),
    ("w_hail", "hail|ice pellets"),
)


def event_class(event_type: Column) -> Column:
    """Three types are renamed; any other is cut at its first hyphen."""
    chain = reduce(
        lambda c, item: c.when(event_type == item[0], item[1]), EVENT_RENAMES.items(), F
    )
    return chain.otherwise(F.substring_index(event_type, "-", 1))


def class_indicators(cls: Column) -> dict[str, Column]:
    """0/1 column per event class.

    A class literally named ``Other`` is known, yet has no indicator of its
    own: it sets none. ``t_other`` is for classes that are not known.
    """
    marks = {name: F.when(cls == c, 1).otherwise(0) for c, name in EVENT_CLASSES.items()}
    known = [*EVENT_CLASSES, OTHER_CLASS]
    marks["t_other"] = F.when(cls.isin(known), 0).otherwise(1)
    return marks


def tag_class(tag: Column) -> Column:
    """The flag a weather tag sets: the first matching word group, else null."""
    low = F.lower(tag)
    return reduce(lambda c, item: c.when(low.rlike(item[1]), item[0]), TAG_WORDS, F)


def positive(value: Column) -> Column:
    """1 above zero, else 0."""
    return F.when(value > 0, 1).otherwise(0)


def hour_onehot(cls: Column) -> list[Column]:
    """Five 0/1 columns, whatever classes occur."""
    return [
        F.when(cls == i, 1.0).otherwise(0.0).alias(f"hod_en{i}") for i in range(HOUR_CLASSES)
    ]


def keyed_draw(seed: int, *keys: Column) -> Column:
    """A number in 0..9999 fixed by the seed and the key of a row.

    The same row gets the same draw under any partitioning and after a retry.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10000
