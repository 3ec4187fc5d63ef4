"""Schemas of the raw telemetry CSV and of the canonical ``player_rounds`` fact."""

from __future__ import annotations

from pyspark.sql import types as T

# The 31 raw CSV columns in their positional order (one row is
# one player in one round of one match).  Must stay in this order: the raw
# files are positional.
RAW_COLUMNS = [
    "dateid", "platform", "gamemode", "mapname", "matchid", "roundnumber",
    "objectivelocation", "winrole", "endroundreason", "roundduration",
    "clearancelevel", "skillrank", "role", "team", "haswon", "operator",
    "nbkills", "isdead", "primaryweapon", "primaryweapontype", "primarysight",
    "primarygrip", "primaryunderbarrel", "primarybarrel", "secondaryweapon",
    "secondaryweapontype", "secondarysight", "secondarygrip",
    "secondaryunderbarrel", "secondarybarrel", "secondarygadget",
]

# Every raw cell is read as text; casts happen in the projection.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Canonical fact, in canonical order.
PLAYER_ROUNDS_FIELDS = [
    ("date", T.StringType()),            # yyyyMMdd text, partition column of the store
    ("match_id", T.StringType()),
    ("game_mode", T.StringType()),
    ("map", T.StringType()),
    ("round_nb", T.IntegerType()),
    ("win_role", T.StringType()),
    ("round_duration", T.IntegerType()),  # seconds
    ("clearance_level", T.IntegerType()),
    ("role", T.StringType()),            # Attacker / Defender
    ("has_won", T.IntegerType()),        # 0/1
    ("operator", T.StringType()),        # DIVISION-NAME
    ("kills", T.IntegerType()),
    ("is_dead", T.IntegerType()),        # 0/1
    ("primary_weapon_type", T.StringType()),
    ("platform", T.StringType()),
]
PLAYER_ROUNDS_COLUMNS = [n for n, _ in PLAYER_ROUNDS_FIELDS]
PLAYER_ROUNDS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PLAYER_ROUNDS_FIELDS])
INT_COLUMNS = [n for n, t in PLAYER_ROUNDS_FIELDS if isinstance(t, T.IntegerType)]

# Raw column feeding each canonical column.
RAW_FOR_FACT = {
    "date": "dateid", "match_id": "matchid", "game_mode": "gamemode", "map": "mapname",
    "round_nb": "roundnumber", "win_role": "winrole", "round_duration": "roundduration",
    "clearance_level": "clearancelevel", "role": "role", "has_won": "haswon",
    "operator": "operator", "kills": "nbkills", "is_dead": "isdead",
    "primary_weapon_type": "primaryweapontype", "platform": "platform",
}

# Wire message layout: [[date, match_id], [the 13 remaining fields]].
WIRE_KEY = ["date", "match_id"]
WIRE_VALUE = ["game_mode", "map", "round_nb", "win_role", "round_duration",
              "clearance_level", "role", "has_won", "operator", "kills", "is_dead",
              "primary_weapon_type", "platform"]
# Fields the producer sends as JSON numbers (the rest are JSON strings).
WIRE_NUMERIC = {"round_nb", "has_won", "kills", "is_dead"}
