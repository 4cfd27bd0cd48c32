from .exprs import (  # noqa: F401
    calendar_flags, clip, day_string, elapsed_days, log_eps, money, nz, ratio, round6,
)
from .prefix import running_sum  # noqa: F401
