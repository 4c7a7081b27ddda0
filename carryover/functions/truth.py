"""V2: how the first value of an assertion's first row is judged.

The reference judges Python truthiness, so NULL, 0, 0.0 and '' fail and
every non-empty string (also ``'false'``) passes.  We keep that for
booleans and numbers, and turn a string result into a failed check with a
message: a check that returns text is almost always a mistake.
"""

from __future__ import annotations

import datetime as _dt
import decimal as _decimal


def judge(value: object) -> tuple[bool, str]:
    """Return ``(passed, detail)`` for one assertion value."""
    if value is None:
        return False, "assertion returned NULL"
    if isinstance(value, bool):
        return value, "" if value else "assertion returned false"
    if isinstance(value, (int, float, _decimal.Decimal)):
        return (value != 0), "" if value != 0 else f"assertion returned {value}"
    if isinstance(value, (str, bytes, bytearray)):
        return False, f"assertion returned a string ({value!r}); return a boolean"
    if isinstance(value, (_dt.date, _dt.datetime)):
        return True, ""
    return bool(value), "" if bool(value) else f"assertion returned {value!r}"
