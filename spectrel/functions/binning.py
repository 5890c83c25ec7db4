"""Linear binning of a number, bin labels and mass-bin names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_count(max_value: float, size: float, min_value: float = 0.0) -> int:
    if max_value <= min_value or size <= 0:
        raise ValueError("bins need max > min and a positive size")
    return int((max_value - min_value) / size + 0.5)


def linear_bin(
    value: Column | str,
    max_value: float,
    size: float,
    min_value: float = 0.0,
    overflow: bool = True,
    min_bin: int = 0,
) -> Column:
    """Bin number; values outside the range go to the end bins, or to -1 without overflow.

    The upper edge itself belongs to the last bin.
    """
    value = _col(value).cast("double")
    last = min_bin + bin_count(max_value, size, min_value) - 1
    inside = F.least(F.floor((value - F.lit(float(min_value))) / F.lit(float(size))).cast("int") + F.lit(min_bin), F.lit(last))
    low, high = (min_bin, last) if overflow else (-1, -1)
    return F.when(value < min_value, F.lit(low)).when(value > max_value, F.lit(high)).otherwise(inside)


def half_offset_bin(value: Column | str, max_value: float, size: float, min_value: float = 0.0, **kwargs) -> Column:
    """The same bins moved down by half a bin."""
    return linear_bin(value, max_value, size, min_value - size / 2, **kwargs)


def bin_midpoint(bin_no: Column | str, max_value: float, size: float, min_value: float = 0.0, min_bin: int = 0) -> Column:
    """Middle of a bin; a number that is no bin raises."""
    bin_no = _col(bin_no)
    count = bin_count(max_value, size, min_value)
    middle = F.lit(float(min_value)) + (bin_no - F.lit(min_bin)) * F.lit(float(size)) + F.lit(size / 2)
    legal = (bin_no >= min_bin) & (bin_no < min_bin + count)
    error = F.raise_error(F.concat(F.lit("illegal bin "), bin_no.cast("string"))).cast("double")
    return F.when(legal, middle).when(bin_no.isNotNull(), error)


def bin_label(value: Column | str, max_value: float, size: float, min_value: float = 0.0, overflow: bool = True, min_bin: int = 0) -> Column:
    """``low-high`` with three decimals; null for a value outside the bins."""
    number = linear_bin(value, max_value, size, min_value, overflow, min_bin)
    low = F.lit(float(min_value)) + (number - F.lit(min_bin)) * F.lit(float(size))
    label = F.format_string("%.3f-%.3f", low, low + F.lit(float(size)))
    return F.when(number >= min_bin, label)


def wide_bins(bin_no: Column | str) -> Column:
    """A bin and its two neighbours."""
    bin_no = _col(bin_no)
    return F.array(bin_no - 1, bin_no, bin_no + 1)


def mass_bin_name(mass: Column | str) -> Column:
    return F.format_string("M%06d.peptide", _col(mass).cast("int"))


def mass_of_bin_name(name: Column | str) -> Column:
    return F.regexp_extract(_col(name), r"M(\d+)\.peptide$", 1).try_cast("int")
