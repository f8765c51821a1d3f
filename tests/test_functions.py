import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from episoda.functions import pixels, png, scalars, vectors

NAN, INF = float("nan"), float("inf")


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in ((k, {float: "double", str: "string", int: "bigint", list: "array<double>", type(None): "double", bool: "boolean"}[type(v)]) for k, v in values.items())))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("x", "want"), [(1.5, 1.5), (NAN, 7.0), (INF, 7.0), (-INF, 7.0), (None, 7.0)])
def test_finite_or(spark, x, want):
    assert one(spark, scalars.finite_or(F.col("x"), 7.0), x=x) == want


@pytest.mark.parametrize(("n", "d", "want"), [(1.0, 2.0, 0.5), (3.0, 2.0, 1.0), (-1.0, 2.0, 0.0), (1.0, 0.0, 1.0), (0.0, 0.0, 0.0), (1.0, -4.0, 1.0), (1.0, NAN, 1.0), (0.0, INF, 0.0)])
def test_safe_ratio(spark, n, d, want):
    assert one(spark, scalars.safe_ratio(F.col("n"), F.col("d")), n=n, d=d) == want


def test_small_scalars(spark):
    assert one(spark, scalars.number(F.col("s")), s="abc") is None and one(spark, scalars.number(F.col("s")), s="1e3") == 1000
    assert [one(spark, scalars.truth(F.col("s")), s=s) for s in (" True ", "1", "YES", "no", "")] == [True, True, True, False, False]
    assert one(spark, scalars.last_parts(F.col("s")), s="/a/b/c/d.parquet") == "b/c/d.parquet"
    assert one(spark, scalars.last_parts(F.col("s")), s="d.parquet") == "d.parquet"
    assert one(spark, scalars.categories(F.array(F.lit("C_PARQUET_CORRUPT"), F.lit("T_X"), F.lit("C_Y"))), s="") == ["content", "temporal"]
    assert one(spark, scalars.safe_rate(F.col("a"), F.col("b")), a=1, b=0) is None


def test_vector_checks(spark):
    good = [float(i) for i in range(20)]
    assert one(spark, vectors.well_formed(F.col("v")), v=good)
    for bad in (good[:18], [*good[:19], NAN], [*good[:19], INF], [*good[:19], None]):
        assert one(spark, vectors.well_formed(F.col("v")), v=bad) is False
    assert one(spark, vectors.norm(F.col("v")), v=[3.0, 4.0]) == 5
    assert one(spark, vectors.hamming(F.col("a"), F.col("b")), a="0110", b="0011") == 2
    assert one(spark, vectors.hamming(F.col("a"), F.col("b")), a="", b="") is None
    assert one(spark, vectors.hamming(F.col("a"), F.col("b")), a="01", b="011") is None


def sound():
    v = [0.0] * 20
    v[3] = v[7] = v[13] = v[17] = 1.0
    v[9] = v[19] = 0.5
    return v


@pytest.mark.parametrize(("place", "value", "flags"), [(0, 1.5, {"position_bad"}), (0, 2.5, {"position_bad", "hard_range_bad"}), (3, 1.04, set()), (3, 1.1, {"rotation_bad"}), (9, 1.1, {"gripper_bad"}), (19, -1.3, {"gripper_bad", "hard_range_bad"}), (4, 0.2, {"rotation_bad"}), (5, NAN, {"position_bad", "hard_range_bad", "rotation_bad", "gripper_bad"})])
def test_physical_flags(spark, place, value, flags):
    v = sound()
    v[place] = value
    got = one(spark, vectors.physical_flags(F.col("v")), v=v).asDict()
    assert {k for k, x in got.items() if k.endswith("_bad") and x} == flags
    assert got["finite_ok"] == math.isfinite(value) and (math.isfinite(value) or got["abs_max"] == INF)


def test_wrong_length_is_bad_without_measures(spark):
    got = one(spark, vectors.physical_flags(F.col("v")), v=sound()[:18]).asDict()
    assert not got["shape_ok"] and got["position_bad"] and got["abs_max"] is None


def test_best_alignment_takes_the_smallest_lag_of_equals(spark):
    a = sound()
    far = [x + 1 for x in a]
    got = one(spark, vectors.best_alignment(F.col("a"), {-1: F.col("b"), 0: F.col("c"), 1: F.col("b")}), a=a, b=a, c=far)
    assert (got.lag, got.rmse, got.max_abs) == (-1, 0.0, 0.0)
    assert one(spark, vectors.best_alignment(F.col("a"), {0: F.col("b")}), a=a, b=a[:3]) is None


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.booleans(), st.integers(0, 2**32 - 1))
def test_png_round_trip(h, w, colour, seed):
    x = np.random.default_rng(seed).integers(0, 256, (h, w, 3) if colour else (h, w), dtype=np.uint8)
    assert (png.decode(png.encode(x)).squeeze() == x.squeeze()).all()


def filtered(x: np.ndarray, kind: int, mix: bool = False) -> bytes:
    """A PNG whose rows all use one filter, written the slow way."""
    import struct
    import zlib

    h, w, c = x.shape
    raw, above = b"", [0] * (w * c)
    first = kind
    for y, row in enumerate(x.reshape(h, -1).tolist()):
        kind = (first + y) % 5 if mix else first
        out = []
        for i, v in enumerate(row):
            a = row[i - c] if i >= c else 0
            b, d = above[i], above[i - c] if i >= c else 0
            p = a + b - d
            paeth = min((a, b, d), key=lambda q: (abs(p - q), [a, b, d].index(q)))
            out.append((v - {0: 0, 1: a, 2: b, 3: (a + b) // 2, 4: paeth}[kind]) & 255)
        raw += bytes([kind, *out])
        above = row
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png_filters(kind, channels):
    x = np.random.default_rng(kind).integers(0, 256, (7, 5, channels), dtype=np.uint8)
    assert (png.decode(filtered(x, kind)) == x).all()


def test_images_of_mixed_filters_are_decoded_together():
    rng = np.random.default_rng(5)
    images = [rng.integers(0, 256, (h, w, 3), dtype=np.uint8) for h, w in ((7, 5), (7, 5), (5, 9), (1, 6), (6, 1), (7, 5))]
    payloads = [filtered(x, [0, 1, 4][i % 3], mix=True) for i, x in enumerate(images)]
    got = png.decode_many([*payloads, b"bad", payloads[0][:-3]])
    assert all((a == b).all() for a, b in zip(images, got)) and all(isinstance(e, png.PngError) for e in got[6:])


def test_png_refuses_damage():
    good = png.encode(np.arange(48, dtype=np.uint8).reshape(4, 4, 3))
    for bad in (b"", b"not a png", good[:-1], good[:40], good[:50] + bytes([good[50] ^ 1]) + good[51:]):
        with pytest.raises(png.PngError):
            png.decode(bad)


def test_pixel_measures_of_known_images():
    flat = pixels.measure(png.encode(np.full((32, 32, 3), 128, np.uint8)))
    assert flat["mean_luma"] == pytest.approx(128) and flat["std_luma"] == pytest.approx(0, abs=1e-9) and flat["laplacian_var"] == pytest.approx(0, abs=1e-9) and flat["ahash"] == "1" * 64
    black = pixels.measure(png.encode(np.zeros((32, 32, 3), np.uint8)))
    assert black["dark_fraction"] == 1 and black["chroma_spread"] is None
    board = np.indices((32, 32)).sum(0) % 2 * 255
    b = pixels.measure(png.encode(board.astype(np.uint8)))
    assert b["gradient_energy"] == pytest.approx(255) and b["laplacian_var"] == pytest.approx((4 * 255) ** 2, rel=0.01)
    ramp = np.tile(np.linspace(0, 255, 64), (64, 1)).astype(np.uint8)
    assert pixels.measure(png.encode(ramp))["ahash"] == "0000" "1111" * 1 + ("00001111" * 8)[8:]


@given(st.integers(8, 80))
@settings(max_examples=15, deadline=None)
def test_resample_keeps_constant_images(n):
    assert (pixels.resample(np.full((n, n + 3), 77.0), 8) == 77).all()


@pytest.mark.parametrize("channels", [1, 3, 4])
def test_channels_are_those_stored(channels):
    from episoda.functions import pixels

    assert pixels.measures(np.full((9, 9, channels), 77, np.uint8))["channels"] == channels
