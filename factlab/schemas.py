"""Schemas of the review data set and its two lookup tables, declared once."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)


def _schema(*fields: tuple[str, DataType]) -> StructType:
    schema = StructType()
    for name, kind in fields:
        schema = schema.add(name, kind)
    return schema


# Column names and types of the stored tables. File sources drop
# NOT NULL on read, so every column is nullable and keys are filtered where it matters.
REVIEWS = _schema(
    ("steamid", LongType()),
    ("appid", IntegerType()),
    ("voted_up", BooleanType()),
    ("votes_up", IntegerType()),
    ("votes_funny", LongType()),
    ("weighted_vote_score", FloatType()),
    ("playtime_forever", LongType()),
    ("playtime_at_review", LongType()),
    ("num_games_owned", IntegerType()),
    ("num_reviews", IntegerType()),
    ("review", StringType()),
    ("unix_timestamp_created", LongType()),
    ("unix_timestamp_updated", LongType()),
)
APP_METADATA = _schema(
    ("appid", IntegerType()), ("app_name", StringType()), ("genre", StringType())
)
USER_PROFILES = _schema(
    ("steamid", LongType()),
    ("username", StringType()),
    ("account_age_days", IntegerType()),
    ("total_reviews", IntegerType()),
)

# The rows of the two lookup tables.
APP_METADATA_ROWS = [
    (10, "Counter-Strike", "Action"),
    (570, "Dota 2", "Strategy"),
    (730, "CS:GO", "FPS"),
    (578080, "PUBG", "Battle Royale"),
    (1172620, "Sea of Thieves", "Adventure"),
    (1091500, "Cyberpunk 2077", "RPG"),
    (945360, "Among Us", "Social Deduction"),
    (1422450, "Vampire Survivors", "Rogue-like"),
]
USER_PROFILES_ROWS = [
    (76561198107294407, "NightStrike", 1200, 315),
    (76561198011733201, "VoidWalker", 890, 42),
    (76561198000000003, "CatalystKing", 2100, 178),
    (76561198000000004, "LagSlayer", 450, 9),
    (76561198000000005, "FrostByte", 3300, 501),
    (76561198000000006, "GankMaster", 760, 88),
    (76561198000000007, "SparkArcher", 1980, 234),
    (76561198000000008, "ManaVault", 550, 61),
]


def column_types(schema: StructType) -> dict[str, str]:
    """Column name to SQL type name, as ``ingest_csv`` takes it."""
    return {field.name: field.dataType.simpleString() for field in schema}
