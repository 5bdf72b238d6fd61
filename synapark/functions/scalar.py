"""Column functions: scaling, coding, array and geometric helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int16(x: Column) -> Column:
    """Rounded half away from zero and saturated, where a plain cast would cut off and overflow."""
    return F.greatest(F.lit(-32768.0), F.least(F.lit(32767.0), F.round(x))).cast("smallint")


def adc_to_uv(adc: Column, volts_per_bit: float, bits: int = 16) -> Column:
    return to_int16((adc - 2 ** (bits - 1)) * volts_per_bit * 1e6)


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def bits_to_number(bits: Sequence[Column]) -> Column:
    """Whole number of flags, the first one lowest; anything but 0 counts as set."""
    total = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        total = total + F.when(b != 0, F.lit(1 << k)).otherwise(F.lit(0))
    return total


def number_to_bits(x: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.getbit(x, k).cast("int"))


def first_match(rules: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first rule that holds; a rule on null or NaN doesn't."""
    out = F.when(F.coalesce(rules[0][0], F.lit(False)), F.lit(rules[0][1]))
    for rule, value in rules[1:]:
        out = out.when(F.coalesce(rule, F.lit(False)), F.lit(value))
    return out.otherwise(F.lit(otherwise))


def center_of_mass(name: str) -> Column:
    """Mean place in an array, weighted by the squares of its positive values."""
    square = F.transform(name, lambda x: F.greatest(x, F.lit(0.0)) * F.greatest(x, F.lit(0.0)))
    add = lambda s, x: s + x
    return F.aggregate(F.transform(square, lambda x, i: x * i), F.lit(0.0), add) / F.nullif(F.aggregate(square, F.lit(0.0), add), F.lit(0.0))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def tone(x: str, sample: str, period: float) -> Column:
    """Amplitude of one period's sine in a group of whole periods."""
    turn = F.lit(2.0) * F.pi() * F.col(sample) / period
    return 2 * F.hypot(F.avg(F.col(x) * F.cos(turn)), F.avg(F.col(x) * F.sin(turn)))


def pad(name: str, n: int, kind: str = "mirror") -> Column:
    """An array with ``n`` values before and after: ``zero``, ``nan``, ``edge``, ``mirror``, ``mean`` or ``localmean`` (of the n values next to the end); ``remove`` takes n away at both ends."""
    x = F.col(name)
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    if kind == "remove":
        return F.slice(x, n + 1, F.greatest(F.lit(0), F.size(x) - 2 * n))
    if kind == "mirror":
        return F.concat(F.reverse(F.slice(x, 2, n)), x, F.reverse(F.slice(x, F.size(x) - n, F.lit(n))))
    if kind == "edge":
        return F.concat(F.array_repeat(F.element_at(x, 1), n), x, F.array_repeat(F.element_at(x, -1), n))
    if kind == "localmean":
        return F.concat(F.array_repeat(mean(F.slice(x, 1, n)), n), x, F.array_repeat(mean(F.slice(x, -n, n)), n))
    value = {"zero": F.lit(0.0), "nan": F.lit(float("nan")), "mean": mean(x)}[kind]
    return F.concat(F.array_repeat(value, n), x, F.array_repeat(value, n))


def scale_motion(x: Column, bits: int, largest: float) -> Column:
    """Signed sensor counts in units of the sensor's range."""
    return x / F.lit(float(1 << (bits - 1))) * largest


def scale_audio(x: Column, bits: int, signed: bool) -> Column:
    """Audio counts from 0 to 1 over the type's range."""
    low = 1.0 - (1 << (bits - 1)) if signed else 0.0
    high = float(1 << (bits - 1)) if signed else float(1 << bits)
    return (x - low) / (high - low)


def superlet_order(freq: Column, low: Column, high: Column, least: int, most: int) -> Column:
    """Order of a superlet, linear over the frequencies from ``least`` to ``most``."""
    return F.lit(least) + F.round(F.lit(most - least) * (freq - low) / F.nullif(high - low, F.lit(0.0))).cast("int")


def gaussian_cut(x: Column, height: float, middle: float, sigma: float, cut: float) -> Column:
    """A normal curve that is 0 below ``cut``."""
    return F.when(x < cut, 0.0).otherwise(height * F.exp(-F.pow(x - middle, 2.0) / (2 * sigma**2)))


def evenly(first: Column, n: Column, rate: float) -> Column:
    """Times in ms of sample ``n`` (from 0) of a stream that began at ``first``."""
    return first + n * (1000.0 / rate)


def euler_to_quaternion(yaw: Column, pitch: Column, roll: Column) -> Column:
    """Unit quaternion (w, x, y, z) of turns about z, then y, then x, in radians."""
    cy, sy, cp, sp, cr, sr = F.cos(yaw / 2), F.sin(yaw / 2), F.cos(pitch / 2), F.sin(pitch / 2), F.cos(roll / 2), F.sin(roll / 2)
    return F.array(cr * cp * cy + sr * sp * sy, sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy, cr * cp * sy - sr * sp * cy)


def axis_remap(x: Column, y: Column, z: Column) -> list[Column]:
    """From x-right, y-forward, z-up to north-east-down."""
    return [y, x, -z]


def iso_micros(text: Column) -> Column:
    """Microseconds since 1970 in UTC of an ISO 8601 time: a date, ``T`` or a space, hours and minutes, seconds with any fraction if there are any, and ``Z``, an offset (+hh, +hhmm, +hh:mm) or nothing, which is taken as UTC. Null where it isn't one."""
    form = r"^\s*(\d{4}-\d{2}-\d{2})[T ](\d{2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?\s*(?:([Zz])|([+-])(\d{2}):?(\d{2})?)?\s*$"
    part = lambda k: F.regexp_extract(text, form, k)
    number = lambda k: F.coalesce(part(k).try_cast("long"), F.lit(0).cast("long"))
    day = F.unix_date(part(1).try_cast("date")).cast("long")
    clock = number(2) * 3600 + number(3) * 60 + number(4)
    zone = (number(8) * 3600 + number(9) * 60) * F.when(part(7) == "-", -1).otherwise(1)
    micros = F.rpad(F.substring(part(5), 1, 6), 6, "0").try_cast("long")
    sound = F.regexp_like(text, F.lit(form)) & (number(2) < 24) & (number(3) < 60) & (number(4) <= 60) & (number(8) < 24) & (number(9) < 60)
    return F.when(sound, (day * 86_400 + clock - zone) * 1_000_000 + F.coalesce(micros, F.lit(0)))
