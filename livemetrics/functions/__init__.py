"""Column expressions shared by the operators (all JVM-side built-ins)."""

from livemetrics.functions.numeric import (
    avg_positive, decimal0, round_half_up, safe_div, tier,
)
from livemetrics.functions.predicates import Source, valid_trades
from livemetrics.functions.timefn import (
    duration_minutes, epoch_seconds, fmt_day, fmt_ts, parse_compact_day, parse_epoch_ms,
    parse_epoch_s, parse_ts, repair_interval, tag_replay,
)

__all__ = [
    "avg_positive", "decimal0", "round_half_up", "safe_div", "tier", "Source", "valid_trades",
    "duration_minutes", "epoch_seconds", "fmt_day", "fmt_ts", "parse_compact_day",
    "parse_epoch_ms", "parse_epoch_s", "parse_ts", "repair_interval", "tag_replay",
]
