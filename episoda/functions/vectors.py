"""Functions of array columns (states, actions, hashes), all inside Catalyst expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
SIZE = 20


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def all_finite(vector: Column) -> Column:
    """Whether no element is null, NaN or infinite; false for a null vector."""
    return F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == INF)), F.lit(False))


def well_formed(vector: Column, size: int = SIZE) -> Column:
    return F.coalesce((F.size(vector) == size) & all_finite(vector), F.lit(False))


def total(vector: Column, of=lambda x: x) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + of(x))


def norm(vector: Column) -> Column:
    return F.sqrt(total(vector, lambda x: x * x))


def difference(a: Column, b: Column) -> Column:
    """Element by element; null for different lengths."""
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: x - y))


def rmse(delta: Column) -> Column:
    return F.sqrt(F.try_divide(total(delta, lambda x: x * x), F.size(delta).cast("double")))


def max_abs(vector: Column) -> Column:
    return F.array_max(F.transform(vector, F.abs))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def finite_parts(vector: Column) -> Column:
    """The elements that are numbers."""
    return F.filter(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INF))


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two bit strings; null if either is empty or their lengths differ."""
    places = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 0).otherwise(1))
    return F.when((F.length(a) > 0) & (F.length(a) == F.length(b)), F.aggregate(places, F.lit(0), lambda s, x: s + x))


def best_alignment(action: Column, states: dict[int, Column]) -> Column:
    """struct(rmse, lag, max_abs) of the state, among {lag: state}, that is closest to the action; of equals the smallest lag. Null if none is well formed."""
    tried = [
        F.when(well_formed(action) & well_formed(s), F.struct(rmse(difference(action, s)).alias("rmse"), F.lit(lag).alias("lag"), max_abs(difference(action, s)).alias("max_abs")))
        for lag, s in sorted(states.items())
    ]
    return F.array_min(F.array_compact(F.array(*tried)))


@dataclass(frozen=True)
class Limits:
    """Physical envelope of one vector; places are counted from 0."""

    position: float = 1.0
    position_hard: float = 2.0
    rotation: float = 1.05
    rotation_hard: float = 1.2
    norm_tolerance: float = 0.08
    orthogonality_tolerance: float = 0.08
    gripper_low: float = -0.05
    gripper_high: float = 1.05
    gripper_hard: float = 1.2


#: Layout of the 20 numbers, two arms of position, two rotation columns and a gripper.
POSITIONS = ((0, 3), (10, 3))
ROTATIONS = ((3, 3), (6, 3), (13, 3), (16, 3))
GRIPPERS = (9, 19)


def physical_flags(vector: Column, limits: Limits = Limits()) -> Column:
    """struct of flags and measures. A vector that is not 20 finite numbers is bad in every way and has no measures but, if it has 20 elements, infinite ones."""
    shaped, sound = F.coalesce(F.size(vector) == SIZE, F.lit(False)), well_formed(vector)
    part = lambda at, n: F.slice(vector, at + 1, n)
    positions = F.concat(*[part(*p) for p in POSITIONS])
    rotations = F.concat(*[part(*r) for r in ROTATIONS])
    grippers = F.concat(*[part(g, 1) for g in GRIPPERS])
    columns = [part(*r) for r in ROTATIONS]
    norm_dev = F.greatest(*[F.abs(norm(c) - 1.0) for c in columns])
    orth_dev = F.greatest(F.abs(dot(columns[0], columns[1])), F.abs(dot(columns[2], columns[3])))
    over = lambda v, limit: F.exists(v, lambda x: F.abs(x) > limit)
    bad = lambda test: F.when(sound, test).otherwise(F.lit(True))
    measure = lambda m, broken=INF: F.when(sound, m).when(shaped, F.lit(broken))
    gripper_out = F.exists(grippers, lambda x: (x < limits.gripper_low) | (x > limits.gripper_high))
    return F.struct(
        shaped.alias("shape_ok"),
        sound.alias("finite_ok"),
        bad(over(positions, limits.position_hard) | over(rotations, limits.rotation_hard) | over(grippers, limits.gripper_hard)).alias("hard_range_bad"),
        bad(over(rotations, limits.rotation) | (norm_dev > limits.norm_tolerance) | (orth_dev > limits.orthogonality_tolerance)).alias("rotation_bad"),
        bad(gripper_out).alias("gripper_bad"),
        bad(over(positions, limits.position)).alias("position_bad"),
        measure(max_abs(vector)).alias("abs_max"),
        measure(max_abs(positions)).alias("position_abs_max"),
        measure(norm_dev).alias("rotation_norm_dev"),
        measure(orth_dev).alias("rotation_orth_dev"),
        measure(F.array_min(grippers), None).alias("gripper_min"),
        measure(F.array_max(grippers), None).alias("gripper_max"),
    )
