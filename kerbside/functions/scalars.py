"""Small scalar expressions shared by loaders and views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a road without a name.
UNNAMED_ROAD = "Chưa có tên"

# Given and family names a seeded student may carry.
GIVEN_NAMES = [
    "Anh", "Minh", "Lan", "Thu", "Quyen", "Mai", "Hoa", "Duc", "Thanh", "Tuan",
    "Bich", "Hien", "Dai", "Kim", "Linh", "Bao", "Tung", "Hoai", "Trinh", "Vui",
    "Chau", "Quoc", "Tam", "Tram", "Yen", "Ha", "Cuong", "Hai", "Vi", "Tao",
]
FAMILY_NAMES = ["Nguyen", "Tran", "Le", "Pham", "Hoang", "Ngo", "Vu", "Dang", "Bui", "Do"]

# Seat counts of a seeded bus.
BUS_SEATS = [16, 29, 35, 45]


def through_float32(c: Column) -> Column:
    """Coordinates pass through single precision before they are stored as double."""
    return c.cast("float").cast("double")


def road_name(name: Column) -> Column:
    return F.coalesce(name, F.lit(UNNAMED_ROAD))


def whole_metres(distance: Column) -> Column:
    """Distance for display: rounded up, and zero when there is none."""
    return F.ceil(F.coalesce(distance, F.lit(0.0))).cast("long")


def utc_from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def same_id(id_column: Column, text: str) -> Column:
    """Ids are looked up by their text form, blanks around the search text ignored."""
    return id_column.cast("string") == F.trim(F.lit(text))


def key_hash(key: Column, seed: int, purpose: str) -> Column:
    """A repeatable number below 2**60 for a row's key, from a digest other engines share."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{purpose}"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def pick(values: list, key: Column, seed: int, salt: str) -> Column:
    """A value chosen by a hash of the row's key: random to the eye, repeatable, native."""
    slot = F.pmod(key_hash(key, seed, salt), F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), slot + 1)


def person_name(key: Column, seed: int) -> Column:
    return F.concat_ws(" ", pick(GIVEN_NAMES, key, seed, "given"),
                       pick(FAMILY_NAMES, key, seed, "family"))


def bus_seats(key: Column, seed: int) -> Column:
    return pick(BUS_SEATS, key, seed, "seats").cast("int")


def jitter(c: Column, seed: int, width: float = 0.001) -> Column:
    """Uniform shift of a coordinate by at most half of ``width``."""
    return c + (F.rand(seed) - 0.5) * width
