from .columns import (  # noqa: F401
    ATTACKER, DEFENDER, KILL_POINTS, ROLES, WIN_POINTS, day_label, division, half_even_2, hms,
    int_div, operator_name, platform_bucket, points, ratio2, role_flag, score,
)
