"""Mass column functions: integer micro-daltons inside, daltons at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    CLEAVE_C_DALTON,
    FRAGMENT_BIN,
    FRAGMENT_OFFSET,
    PROTON_DALTON,
    RESIDUE_MASS,
    STATIC_ADDED,
    VARIABLE_ADDED,
    WATER,
    PROTON,
)

MICRO = 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def residue_table() -> dict[str, int]:
    """Residue masses with static additions; a modified residue is written in lower case."""
    table = {r: m + STATIC_ADDED.get(r, 0) for r, m in RESIDUE_MASS.items()}
    table.update({r.lower(): table[r] + added for r, added in VARIABLE_ADDED.items()})
    return table


def residue_mass(sequence: Column, modified: bool = False) -> Column:
    """Sum of residue masses: count of each letter times its mass."""
    total = None
    for residue, mass in residue_table().items():
        if residue.islower() and not modified:
            continue
        count = F.length(sequence) - F.length(F.replace(sequence, F.lit(residue), F.lit("")))
        term = count.cast("bigint") * F.lit(mass).cast("bigint")
        total = term if total is None else total + term
    return total


def peptide_mass(sequence: Column | str, modified: bool = False) -> Column:
    """MH+ of a peptide: residues, water and one proton."""
    return residue_mass(_col(sequence), modified) + F.lit(WATER + PROTON).cast("bigint")


def micro(dalton: Column | str) -> Column:
    return F.floor(_col(dalton) * F.lit(float(MICRO)) + F.lit(0.5)).cast("bigint")


def dalton(micro_dalton: Column | str) -> Column:
    return _col(micro_dalton).cast("double") / F.lit(float(MICRO))


def precursor_mh(mz: Column | str, charge: Column | str) -> Column:
    """MH+ of the uncharged precursor plus one proton, from m/z and charge."""
    neutral = _col(mz) * _col(charge).cast("double") - F.lit(PROTON_DALTON) * _col(charge).cast("double")
    return neutral + F.lit(PROTON_DALTON)


def matching_mass(mass: Column | str) -> Column:
    return _col(mass) + F.lit(CLEAVE_C_DALTON)


def mass_from_matching(mass: Column | str) -> Column:
    return _col(mass) - F.lit(CLEAVE_C_DALTON)


def within(a: Column | str, b: Column | str, tolerance: float = 0.0001) -> Column:
    return F.abs(_col(a) - _col(b)) < F.lit(tolerance)


def close_to(a: Column | str, b: Column | str) -> Column:
    """Relative test: the difference is under a 300th of the larger magnitude (0.01 at least)."""
    a, b = _col(a), _col(b)
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(0.01))
    return F.abs(a - b) < scale / F.lit(300.0)


def near_integer(value: Column | str, tolerance: float = 0.00001) -> Column:
    """The digits after the decimal point are smaller than the tolerance."""
    value = _col(value)
    return F.abs(value - value.cast("bigint")) < F.lit(tolerance)


def fragment_bin(mz_micro: Column) -> Column:
    """Fragment bin of an m/z in micro-daltons."""
    mz = mz_micro.cast("double") / F.lit(float(MICRO))
    return F.floor(mz / F.lit(FRAGMENT_BIN) + F.lit(1.0 - FRAGMENT_OFFSET)).cast("int")
