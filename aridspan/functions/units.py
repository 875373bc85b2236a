"""Units of precipitation."""

from __future__ import annotations

#: Factors to millimetres a day, by what files write as units (fixed values; blanks and case do not matter).
TO_MM = {
    "kg m-2 s-1": 86_400.0, "kg/m2/s": 86_400.0, "kg m**-2 s**-1": 86_400.0, "kg m^-2 s^-1": 86_400.0, "mm s-1": 86_400.0, "mm/s": 86_400.0,
    "mm/day": 1.0, "mm day-1": 1.0, "mm d-1": 1.0, "mm/d": 1.0, "kg m-2 day-1": 1.0, "kg m-2 d-1": 1.0,
}
_KNOWN = {k.replace(" ", ""): v for k, v in TO_MM.items()}
#: Variables that are kept in millimetres a day; others stay as they are.
PRECIPITATION = frozenset({"pr"})


def mm_factor(variable: str, units: object) -> float:
    """What values of a variable are multiplied by; a file without units holds the flux, unknown units are an error."""
    if variable not in PRECIPITATION:
        return 1.0
    text = "".join(str(units or "kg m-2 s-1").lower().split())
    if text not in _KNOWN:
        raise ValueError(f"units {units!r} of {variable} are not known")
    return _KNOWN[text]
