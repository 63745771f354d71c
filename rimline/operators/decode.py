"""Typed moments from parsed JSON: one decode per event window, into Arrow columns.

A moment is a list of period, timestamp, game clock, shot clock, something unused, and positions; a position is a list of team, player, x, y
and z. Lists of other lengths are malformed: left out and counted. Numbers may be written as text; what is no number is
NULL, and so is a whole number that has no place in its type.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StructType

from rimline.operators.moments import MOMENT_SIZE, POSITION_SIZE

#: Windows that become Python objects at a time.
WINDOWS = 64

_POSITION = pa.struct([("team_id", pa.int64()), ("player_id", pa.int64()), ("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])


def number(value) -> float | int | None:
    if isinstance(value, str):
        try:
            value = float(value)
        except ValueError:
            return None
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
        return None
    return value


def whole(value, bits: int = 64) -> int | None:
    """A number without its fraction, if it fits."""
    if isinstance(value, str):
        try:
            value = int(value)
        except ValueError:
            value = number(value)
    value = number(value)
    return int(value) if value is not None and -(1 << bits - 1) <= int(value) < 1 << bits - 1 else None


def _real(value) -> float | None:
    value = number(value)
    return None if value is None else float(value)


def _column(values: list, kind: pa.DataType, convert) -> pa.Array:
    try:
        return pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, TypeError, OverflowError):
        return pa.array([convert(v) for v in values], kind)


def _well_formed(moment) -> bool:
    return (
        type(moment) is list
        and len(moment) == MOMENT_SIZE
        and type(moment[5]) is list
        and all(type(p) is list and len(p) == POSITION_SIZE for p in moment[5])
    )


class Windows:
    """Event windows that become one Arrow column of typed moments, and a count of malformed ones for each."""

    def __init__(self) -> None:
        self.ends, self.missing, self.malformed = [0], [], []
        self.scalars: tuple[list, list, list, list] = ([], [], [], [])
        self.position_ends, self.numbers = [0], []

    def add(self, moments) -> None:
        """A window's moments as parsed; what is no list is a window without moments."""
        self.missing.append(type(moments) is not list)
        good = [m for m in moments if _well_formed(m)] if type(moments) is list else []
        for column, at in zip(self.scalars, range(4)):
            column.extend([m[at] for m in good])
        for moment in good:
            for position in moment[5]:
                self.numbers.extend(position)
            self.position_ends.append(len(self.numbers) // POSITION_SIZE)
        self.ends.append(self.ends[-1] + len(good))
        self.malformed.append(len(moments) - len(good) if type(moments) is list else 0)

    def _positions(self) -> pa.Array:
        flat = _column(self.numbers, pa.float64(), _real).to_numpy(zero_copy_only=False).reshape(-1, POSITION_SIZE)
        fields = []
        for at, field in enumerate(_POSITION):
            values = flat[:, at]
            none = np.isnan(values)
            if field.type == pa.int64():
                none = none | (np.abs(values) >= 2.0**63)
                values = np.where(none, 0, values).astype(np.int64)
            fields.append(pa.array(values, field.type, mask=none))
        rows = pa.StructArray.from_arrays(fields, fields=list(_POSITION))
        return pa.ListArray.from_arrays(pa.array(self.position_ends, pa.int32()), rows)

    def columns(self) -> tuple[pa.Array, pa.Array]:
        period, stamp, clock, shot = self.scalars
        fields = {
            "period": _column(period, pa.int32(), lambda v: whole(v, 32)),
            "moment_id": _column(stamp, pa.int64(), whole),
            "game_clock": _column(clock, pa.float64(), _real),
            "shot_clock": _column(shot, pa.float64(), _real),
            "positions": self._positions(),
        }
        rows = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        ends = pa.array(self.ends, pa.int32())
        moments = pa.ListArray.from_arrays(ends, rows, mask=pa.array(self.missing, pa.bool_())) if any(self.missing) else pa.ListArray.from_arrays(ends, rows)
        return moments, pa.array(self.malformed, pa.int64())


def with_columns(schema: StructType, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    fitted = [columns[f.name] if columns[f.name].type == f.type else columns[f.name].cast(f.type) for f in arrow]
    return pa.RecordBatch.from_arrays(fitted, schema=arrow)
