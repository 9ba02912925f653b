"""Harmonic-mixing expressions (P11-P14, P16) as Column expressions, plus
their SQL text for the oracle. Both sides use the same operation order so the
double results agree bit for bit before rounding."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadence.config import (ARC_BONUS, ARC_EXPECTED_LENGTH, ARC_PENALTY, CAMELOT,
                            W_BPM, W_ENERGY, W_HARMONIC, W_VALENCE)


def _camelot_map() -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(k * 2 + m), F.lit(code)) for (k, m), code in sorted(CAMELOT.items())))


def camelot(key: Column, mode: Column) -> Column:
    """Camelot code of (pitch class, mode); NULL or unknown -> NULL."""
    ki, mi = key.cast("int"), mode.cast("int")
    ok = ki.between(0, 11) & mi.between(0, 1) & (ki == key) & (mi == mode)
    return F.when(ok, F.element_at(_camelot_map(), ki * 2 + mi))


def camelot_number(code: Column) -> Column:
    return code.substr(F.lit(1), F.length(code) - 1).cast("int")


def camelot_letter(code: Column) -> Column:
    return F.substring(code, -1, 1)


def camelot_compatible(code_a: Column, code_b: Column) -> Column:
    """Same number, or same letter and numbers one apart on the 12-wheel.
    A NULL code is never compatible."""
    na, nb = camelot_number(code_a), camelot_number(code_b)
    d = F.abs(na - nb)
    same_letter = camelot_letter(code_a) == camelot_letter(code_b)
    return F.coalesce((same_letter & ((d <= 1) | (d == 11))) | (na == nb), F.lit(False))


def bpm_compatible(ta: Column, tb: Column, tol: float) -> Column:
    """Within tolerance, or one tempo double / half the other."""
    t = F.lit(float(tol))
    return F.coalesce(
        (F.abs(ta - tb) <= t) | (F.abs(ta - tb * 2.0) <= t) | (F.abs(ta * 2.0 - tb) <= t),
        F.lit(False))


def transition_score(a: dict, b: dict, tol: float) -> Column:
    """0.40 harmonic + 0.30 BPM closeness + 0.20 (1 - energy gap)
    + 0.10 (1 - valence gap), rounded to 4 places.

    ``a`` / ``b`` map ``code``, ``tempo``, ``energy``, ``valence`` to Columns;
    ``code`` is the Camelot code. NULL tempo gives no BPM part, NULL energy or
    valence count as 0.5.
    """
    t = F.lit(float(tol))
    ta, tb = F.coalesce(a["tempo"], F.lit(0.0)), F.coalesce(b["tempo"], F.lit(0.0))
    ea, eb = F.coalesce(a["energy"], F.lit(0.5)), F.coalesce(b["energy"], F.lit(0.5))
    va, vb = F.coalesce(a["valence"], F.lit(0.5)), F.coalesce(b["valence"], F.lit(0.5))
    harmonic = F.when(camelot_compatible(a["code"], b["code"]), F.lit(W_HARMONIC)).otherwise(F.lit(0.0))
    bpm = F.when((ta > 0) & (tb > 0) & bpm_compatible(ta, tb, tol),
                 F.lit(W_BPM) * (F.lit(1.0) - F.least(F.abs(ta - tb), t) / t)).otherwise(F.lit(0.0))
    energy = F.lit(W_ENERGY) * (F.lit(1.0) - F.abs(ea - eb))
    valence = F.lit(W_VALENCE) * (F.lit(1.0) - F.abs(va - vb))
    return F.round(((harmonic + bpm) + energy) + valence, 4)


def energy_arc_bonus(path_len: Column, energy_sum: Column, next_energy: Column,
                     arc: str = "gradual") -> Column:
    """Bonus for following the energy arc, from the path's running energy sum."""
    avg = energy_sum / path_len
    up = F.when(next_energy > avg, F.lit(ARC_BONUS)).otherwise(F.lit(ARC_PENALTY))
    down = F.when(next_energy < avg, F.lit(ARC_BONUS)).otherwise(F.lit(ARC_PENALTY))
    if arc == "gradual":
        b = up
    elif arc == "dramatic":
        b = F.when(path_len / F.lit(float(ARC_EXPECTED_LENGTH)) < 0.5, up).otherwise(down)
    else:
        b = F.lit(0.0)
    return F.when(path_len < 2, F.lit(0.0)).otherwise(b)


# ---------------------------------------------------------------------------
# SQL text of the same expressions (oracle side)
# ---------------------------------------------------------------------------

def camelot_sql(key: str, mode: str) -> str:
    cases = " ".join(f"WHEN {key} = {k} AND {mode} = {m} THEN '{code}'"
                     for (k, m), code in sorted(CAMELOT.items()))
    return f"(CASE {cases} END)"


def camelot_compatible_sql(a: str, b: str) -> str:
    na = f"CAST(substr({a}, 1, length({a}) - 1) AS INTEGER)"
    nb = f"CAST(substr({b}, 1, length({b}) - 1) AS INTEGER)"
    la, lb = f"right({a}, 1)", f"right({b}, 1)"
    return (f"coalesce(({la} = {lb} AND (abs({na} - {nb}) <= 1 OR abs({na} - {nb}) = 11))"
            f" OR {na} = {nb}, false)")


def bpm_compatible_sql(ta: str, tb: str, tol: float) -> str:
    t = f"{float(tol)}e0"
    return (f"coalesce(abs({ta} - {tb}) <= {t} OR abs({ta} - {tb} * 2e0) <= {t}"
            f" OR abs({ta} * 2e0 - {tb}) <= {t}, false)")


def transition_score_sql(a: dict, b: dict, tol: float) -> str:
    t = f"{float(tol)}e0"
    ta, tb = f"coalesce({a['tempo']}, 0e0)", f"coalesce({b['tempo']}, 0e0)"
    ea, eb = f"coalesce({a['energy']}, 0.5e0)", f"coalesce({b['energy']}, 0.5e0)"
    va, vb = f"coalesce({a['valence']}, 0.5e0)", f"coalesce({b['valence']}, 0.5e0)"
    harmonic = f"(CASE WHEN {camelot_compatible_sql(a['code'], b['code'])} THEN {W_HARMONIC}e0 ELSE 0e0 END)"
    bpm = (f"(CASE WHEN {ta} > 0 AND {tb} > 0 AND {bpm_compatible_sql(ta, tb, tol)} "
           f"THEN {W_BPM}e0 * (1e0 - least(abs({ta} - {tb}), {t}) / {t}) ELSE 0e0 END)")
    energy = f"({W_ENERGY}e0 * (1e0 - abs({ea} - {eb})))"
    valence = f"({W_VALENCE}e0 * (1e0 - abs({va} - {vb})))"
    return f"round((({harmonic} + {bpm}) + {energy}) + {valence}, 4)"


def energy_arc_bonus_sql(path_len: str, energy_sum: str, next_energy: str,
                         arc: str = "gradual") -> str:
    avg = f"({energy_sum} / {path_len})"
    up = f"(CASE WHEN {next_energy} > {avg} THEN {ARC_BONUS}e0 ELSE {ARC_PENALTY}e0 END)"
    down = f"(CASE WHEN {next_energy} < {avg} THEN {ARC_BONUS}e0 ELSE {ARC_PENALTY}e0 END)"
    if arc == "gradual":
        b = up
    elif arc == "dramatic":
        b = f"(CASE WHEN {path_len} / {float(ARC_EXPECTED_LENGTH)}e0 < 0.5e0 THEN {up} ELSE {down} END)"
    else:
        b = "0e0"
    return f"(CASE WHEN {path_len} < 2 THEN 0e0 ELSE {b} END)"
