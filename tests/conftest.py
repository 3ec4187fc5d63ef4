import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roundlens.schema import PLAYER_ROUNDS_SCHEMA  # noqa: E402
from roundlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

# Golden micro-fixture (canonical column order), hand-checkable.
GOLDEN = """\
20170210|1|BOMB|BANK|1|Attacker|200|10|Attacker|1|SAS-SLEDGE|3|0|Rifle|PC
20170210|1|BOMB|BANK|1|Attacker|200|21|Defender|0|SAS-SMOKE|1|1|SMG|PC
20170210|1|BOMB|BANK|2|Defender|100|10|Attacker|0|SAS-SLEDGE|0|1|Rifle|PC
20170210|1|BOMB|BANK|2|Defender|100|21|Defender|1|SWAT-CASTLE|2|0|Shotgun|PC
20170210|2|HOSTAGE|CLUB|1|Defender|180|50|Defender|1|SWAT-CASTLE|2|1|Shotgun|PC
20170210|2|HOSTAGE|CLUB|1|Defender|180|30|Attacker|0|GIGN-RESERVE|0|1|Rifle|PC
20170210|2|HOSTAGE|CLUB|2|Attacker|150|30|Attacker|1|GIGN-RESERVE|1|0|Rifle|PC
20170210|3|BOMB|HOUSE|1|Attacker|360000|5|Attacker|1|SWAT-RESERVE|1|0|SMG|PS4
20170211|4|BOMB|BANK|1|Defender|61|8|Defender|1|SAS-SMOKE|4|0|SMG|XONE
20170211|4|BOMB|BANK|1|Defender|61|9|Attacker|0|SAS-SLEDGE|1|1|Rifle|XONE
"""


def golden_rows():
    rows = []
    for line in GOLDEN.strip().splitlines():
        cells = line.split("|")
        typed = []
        for field, v in zip(PLAYER_ROUNDS_SCHEMA.fields, cells):
            typed.append(int(v) if field.dataType.typeName() == "integer" else v)
        rows.append(tuple(typed))
    return rows


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden(spark):
    return spark.createDataFrame(golden_rows(), PLAYER_ROUNDS_SCHEMA)


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
