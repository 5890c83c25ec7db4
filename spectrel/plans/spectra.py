"""Spectrum filter, precursor masses and correlation vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    FRAGMENT_BIN,
    FRAGMENT_OFFSET,
    MASS_TOLERANCE,
    MAX_PRECURSOR_CHARGE,
    MIN_PEAKS,
)
from ..functions.masses import MICRO, micro, precursor_mh
from ..sources.spectra import peak_arrays

# Published constants of the fast cross-correlation.
WINDOWS = 10
WINDOW_TOP = 50.0
NOISE_SHARE = 0.05
OFFSET_BINS = 75
XCORR_SCALE = 0.005
# Processed intensity is kept as a whole number of thousandths.
INTENSITY_UNIT = 1000


def filter_spectra(
    spectra: DataFrame,
    ms_level: int = 2,
    min_peaks: int = MIN_PEAKS,
    min_intensity: float = 0.0,
    max_charge: int = MAX_PRECURSOR_CHARGE,
    scan_range: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Spectra worth a search; peaks that are no numbers above zero and those under the minimum intensity are dropped first."""

    def usable(p):
        # a NaN is greater than any number and fails the upper bounds
        in_range = (p["mz"] > 0) & (p["mz"] < float("inf"))
        return in_range & (p["intensity"] >= max(min_intensity, 0.0)) & (p["intensity"] < float("inf"))

    kept = spectra.withColumn("peaks", F.filter("peaks", usable))
    kept = kept.where((F.col("ms_level") == ms_level) & (F.size("peaks") >= min_peaks))
    kept = kept.where(F.col("charge").isNull() | F.col("charge").between(1, max_charge))
    if scan_range[0]:
        kept = kept.where(F.col("scan_num") >= scan_range[0])
    if scan_range[1]:
        kept = kept.where(F.col("scan_num") <= scan_range[1])
    return kept


#: Micro-daltons in a unit of tolerance; ppm is relative to MH+.
TOLERANCE_UNITS = {"amu": float(MICRO), "mmu": MICRO / 1000.0, "ppm": None}


def with_precursor(spectra: DataFrame, tolerance: float = MASS_TOLERANCE, unit: str = "amu", of_mz: bool = False) -> DataFrame:
    """MH+ and its window in micro-daltons; an unknown charge is tried as 2 and as 3.

    ``unit`` is amu, mmu or ppm; a tolerance ``of_mz`` is on the measured m/z and grows with the charge.
    """
    if unit not in TOLERANCE_UNITS:
        raise ValueError(f"unknown tolerance unit {unit}")
    if tolerance <= 0:
        raise ValueError("the tolerance is a positive number")
    charges = F.when(F.col("charge").isNull(), F.array(F.lit(2), F.lit(3))).otherwise(F.array("charge"))
    mh = micro(precursor_mh("precursor_mz", "charge"))
    if unit == "ppm":
        width = F.floor(F.col("mh_uda").cast("double") * F.lit(float(tolerance)) / F.lit(1e6)).cast("bigint")
    else:
        width = F.lit(int(tolerance * TOLERANCE_UNITS[unit])).cast("bigint")
        if of_mz:
            width = width * F.col("charge")
    return (
        spectra.where("precursor_mz is not null")
        .withColumn("charge", F.explode(charges))
        .withColumn("mh_uda", mh)
        .withColumn("low_uda", F.col("mh_uda") - width)
        .withColumn("high_uda", F.col("mh_uda") + width)
    )


def strong_peaks(
    mz: np.ndarray, intensity: np.ndarray, fragment_bin: float = FRAGMENT_BIN, fragment_offset: float = FRAGMENT_OFFSET
) -> tuple[np.ndarray, np.ndarray]:
    """Fragment bins (sorted) and scaled intensities of the peaks that count.

    Square root, strongest peak per bin, ten windows scaled to 50 with peaks under a twentieth of the strongest left out.
    The memory is that of the peaks, however high their m/z is.
    """
    if not len(mz):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.minimum(np.floor(mz / fragment_bin + (1.0 - fragment_offset)), float(1 << 62)).astype(np.int64)
    bins, owner = np.unique(places, return_inverse=True)
    roots = np.zeros(len(bins))
    np.maximum.at(roots, owner, np.sqrt(intensity))
    window = bins // (int(bins[-1]) // WINDOWS + 1)
    tops = np.zeros(WINDOWS)
    np.maximum.at(tops, window, roots)
    strong = roots > NOISE_SHARE * roots.max()
    scaled = np.floor(roots[strong] * (WINDOW_TOP * INTENSITY_UNIT) / tops[window][strong] + 0.5).astype(np.int64)
    return bins[strong], scaled


def values_at(bins: np.ndarray, values: np.ndarray, at: np.ndarray, flanking: bool = False) -> np.ndarray:
    """The correlation vector at some bins, in units of 1 / (INTENSITY_UNIT * 2 * OFFSET_BINS).

    The scaled intensity minus the mean of the 75 bins on each side, from sums over the peaks. With ``flanking`` the value
    and half of both neighbours, in units half as large.
    """
    if flanking:
        return 2 * values_at(bins, values, at) + values_at(bins, values, at - 1) + values_at(bins, values, at + 1)
    running = np.concatenate([[0], np.cumsum(values)])
    around = running[np.searchsorted(bins, at + OFFSET_BINS, side="right")] - running[np.searchsorted(bins, at - OFFSET_BINS)]
    own = np.zeros(len(at), np.int64)
    if len(bins):
        spot = np.minimum(np.searchsorted(bins, at), len(bins) - 1)
        own = np.where(bins[spot] == at, values[spot], 0)
    return (2 * OFFSET_BINS + 1) * own - around


def dense_values(bins: np.ndarray, values: np.ndarray, size: int, flanking: bool = False) -> np.ndarray:
    """The values of ``values_at`` at the bins below ``size``: for the few bins that fragments of a mass range can have."""
    if flanking:
        one = dense_values(bins, values, size + 1)
        out = 2 * one[:size]
        out[1:] += one[: size - 1]
        out += one[1:]
        out[0] += values_at(bins, values, np.array([-1]))[0]
        return out
    near = bins < size + OFFSET_BINS + 1
    bins, values = bins[near], values[near]
    running = np.zeros(size + 2 * OFFSET_BINS + 2, np.int64)
    running[bins + OFFSET_BINS + 1] = values
    np.cumsum(running, out=running)
    out = running[:size] - running[2 * OFFSET_BINS + 1 : 2 * OFFSET_BINS + 1 + size]
    inside = bins < size
    out[bins[inside]] += (2 * OFFSET_BINS + 1) * values[inside]
    return out


def _list_column(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _peak_rows(spectra: DataFrame, of_row, columns: tuple[str, str]) -> DataFrame:
    others = [f for f in spectra.schema if f.name != "peaks"]
    names = [f.name for f in others]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                peaks, starts = peak_arrays(part.column("peaks"))
                rows = [of_row(peaks["mz"][a:b], peaks["intensity"][a:b]) for a, b in zip(starts[:-1], starts[1:])]
                made = [_list_column([r[k] for r in rows]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *made], names=[*names, *columns])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return spectra.mapInArrow(batches, f"{fields}, {columns[0]} array<bigint>, {columns[1]} array<bigint>")


def with_strong_peaks(spectra: DataFrame, fragment_bin: float = FRAGMENT_BIN, fragment_offset: float = FRAGMENT_OFFSET) -> DataFrame:
    """Replaces ``peaks`` by ``bins`` and ``values``, the strong peaks; one row in, one row out, no shuffle."""
    check_fragment_bins(fragment_bin, fragment_offset)
    return _peak_rows(spectra, lambda mz, intensity: strong_peaks(mz, intensity, fragment_bin, fragment_offset), ("bins", "values"))


def check_fragment_bins(fragment_bin: float, fragment_offset: float) -> None:
    if not 1e-6 <= fragment_bin or not 0.0 <= fragment_offset <= 1.0:
        raise ValueError("fragment bins are at least a millionth wide, and their offset is from 0 to 1")


def processed_bins(
    spectra: DataFrame, keep: list[str] = ("spectrum_id",), fragment_bin: float = FRAGMENT_BIN, fragment_offset: float = FRAGMENT_OFFSET
) -> DataFrame:
    """The correlation vector as rows (spectrum, bin, value), zero values left out: only bins near a peak have one."""
    check_fragment_bins(fragment_bin, fragment_offset)
    reach = np.arange(-OFFSET_BINS, OFFSET_BINS + 1)

    def near(mz: np.ndarray, intensity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins, values = strong_peaks(mz, intensity, fragment_bin, fragment_offset)
        at = np.unique((bins[:, None] + reach).ravel())
        at = at[at >= 0]
        found = values_at(bins, values, at)
        return at[found != 0], found[found != 0]

    rows = _peak_rows(spectra.select(*keep, "peaks"), near, ("bins", "values"))
    return rows.select(*keep, F.inline(F.arrays_zip("bins", "values"))).select(
        *keep, F.col("bins").cast("int").alias("bin"), F.col("values").alias("value")
    )
