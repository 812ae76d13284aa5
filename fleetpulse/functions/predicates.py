"""Rule predicates as intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetpulse.functions.messages import number

# option -> (lower end, is it inside, upper end, is it inside); None is unbounded. "low" and
# "high" are the rule's two values. Any other option never holds.
_INTERVALS = {
    "=": ("low", True, "low", True),
    ">": ("low", False, None, True),
    ">=": ("low", True, None, True),
    "<": (None, True, "low", False),
    "<=": (None, True, "low", True),
    "[between]": ("low", True, "high", True),
    "(between)": ("low", False, "high", False),
    "(between]": ("low", False, "high", True),
    "[between)": ("low", True, "high", False),
}
OPTIONS = tuple(_INTERVALS)
INTERVAL_FIELDS = ("lo", "lo_in", "hi", "hi_in")


def interval(option: Column, low: Column, high: Column) -> Column:
    """The rule's interval as a struct, computed once per rule and not per record."""
    ends = {"low": low.cast("double"), "high": high.cast("double")}
    below, above = F.lit(float("-inf")), F.lit(float("inf"))
    case = None
    for name, (lo, lo_in, hi, hi_in) in _INTERVALS.items():
        built = F.struct(
            (ends[lo] if lo else below).alias("lo"),
            F.lit(lo_in).alias("lo_in"),
            (ends[hi] if hi else above).alias("hi"),
            F.lit(hi_in).alias("hi_in"),
        )
        hit = option == F.lit(name)
        case = F.when(hit, built) if case is None else case.when(hit, built)
    never = F.struct(above.alias("lo"), F.lit(False).alias("lo_in"), below.alias("hi"), F.lit(False).alias("hi_in"))
    return case.otherwise(never)


def within(v: Column, lo: Column, lo_in: Column, hi: Column, hi_in: Column) -> Column:
    """Is the number inside? Null and NaN never are."""
    inside = ((v > lo) | (lo_in & (v == lo))) & ((v < hi) | (hi_in & (v == hi)))
    return F.coalesce(inside, F.lit(False))


def holds(option: Column, value: Column, low: Column, high: Column) -> Column:
    """Does the text ``value`` satisfy the rule? Junk, null and NaN values never do."""
    ends = interval(option, low, high)
    return within(number(value), *[ends[f] for f in INTERVAL_FIELDS])
