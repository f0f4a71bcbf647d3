"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from wattflow.functions.parse import br_number, parse_date
from wattflow.functions.flags import classify, flag_in, flag_not_equal, any_match
from wattflow.functions.numeric import exact, ratio_pct, round_numeric, rounded_mean

__all__ = [
    "br_number", "parse_date", "classify", "flag_in", "flag_not_equal", "any_match",
    "exact", "rounded_mean", "ratio_pct", "round_numeric",
]
