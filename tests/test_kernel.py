"""The frame kernel against known shapes and plain versions of its steps."""

import math
import tracemalloc

import numpy as np
import pytest

from skiagram.config import Config, Flatfield, load_config
from skiagram.kernel import frame, outlines, pixels, shapes, sharpness
from skiagram.kernel import synthetic as S
from skiagram.sources import images

CFG = Config()


def found(image, cfg=CFG, blank=None):
    return frame.particles(image, blank, 1.0, cfg)[0]


def test_clean_circle():
    r = found(S.frame(256, 256, [S.Disc("ellipse", 128, 128, 40, 40)]))[0]
    assert r["area_px"] == pytest.approx(math.pi * 1600, rel=0.01)
    assert r["perimeter_um"] == pytest.approx(80 * math.pi, rel=0.02)
    assert r["feret_max_um"] == pytest.approx(80, rel=0.01) and r["feret_min_um"] == pytest.approx(80, rel=0.01)
    assert r["perimeter_crofton_px"] == pytest.approx(80 * math.pi, rel=0.02)
    assert r["wadell_roundness"] > 0.95 and r["wadell_sphericity"] > 0.98 and r["fourier_power_cum_90"] == 1
    assert (r["centroid_x"], r["centroid_y"]) == (128, 128) and r["has_polygon"] and not r["touches_border"]


def test_ellipse_axes_and_tilt_invariance():
    a, b = (found(S.frame(200, 200, [S.Disc("ellipse", 100, 100, 40, 20, t)]))[0] for t in (0.0, 0.7))
    assert a["aspect_ratio"] == pytest.approx(2, rel=0.02) and b["aspect_ratio"] == pytest.approx(2, rel=0.02)
    assert abs(a["efd_1_d"]) == pytest.approx(abs(b["efd_1_d"]), abs=0.01)
    assert a["eccentricity"] == pytest.approx(math.sqrt(0.75), abs=0.02)


def test_first_harmonic_equals_a_discrete_transform():
    t = np.linspace(0, 2 * np.pi, 5000, endpoint=False)
    ring = np.column_stack([40 * np.cos(t), 20 * np.sin(t)])
    x, y = np.fft.rfft(shapes.resampled(ring, 2048), axis=0)[1]
    efd, cum90 = shapes.fourier(outlines.Polygon(ring, []), 3, 2048)
    assert abs(efd[0, 3]) == pytest.approx(abs(y) / abs(x), rel=0.01) and cum90 == 1


@pytest.mark.parametrize(
    ("image", "n"),
    [
        (S.frame(256, 256, [S.Disc("ellipse", 80, 80, 18, 18), S.Disc("ellipse", 180, 180, 14, 14)]), 2),
        (S.frame(256, 256, [S.Disc("ellipse", 128, 128, 40, 40)], gradient=0.2), 1),
        (S.frame(256, 256, [S.Disc("ellipse", 128, 128, 10, 9)], noise=3), 1),
        (S.frame(256, 256, []), 0),
        (S.frame(64, 64, [], noise=3), 0),
    ],
)
def test_counts(image, n):
    rows = found(image)
    assert len(rows) == n and all(r["has_polygon"] for r in rows)


def test_noise_alone_is_nothing_and_small_is_filtered():
    noise = (1 + np.random.default_rng(0).normal(0, 0.03, (256, 256))).astype(np.float32)
    assert pixels.level(noise, CFG.threshold, 25) < noise.min() and frame.detections(noise, CFG)[1] == []
    assert found(S.frame(128, 128, [S.Disc("ellipse", 60, 60, 5, 5)]), load_config(overlay={"detect": {"min_area_px": 2000}})) == []


def test_shaded_frame_with_blank_gives_equal_areas():
    discs = [S.Disc("ellipse", 40, 128, 25, 25), S.Disc("ellipse", 216, 128, 25, 25)]
    a, b = found(S.frame(256, 256, discs, gradient=0.4), blank=S.frame(256, 256, [], gradient=0.4))
    assert a["area_px"] == pytest.approx(b["area_px"], rel=0.02)


def test_ring_keeps_its_hole():
    image = np.full((100, 100), 200, np.uint8)
    y, x = np.indices(image.shape)
    far = np.hypot(x - 50, y - 50)
    image[(far < 30) & (far > 15)] = 15
    r = found(image)[0]
    assert r["area_px"] == pytest.approx(math.pi * (900 - 225), rel=0.02)
    p = outlines.from_wkt(frame.particles(image, None, 1.0, CFG)[1][0])
    assert len(p.holes) == 1 and outlines.area(p) == r["area_px"]
    assert outlines.rasterised(p, image.shape).sum() == pytest.approx(r["area_px"], rel=0.02)


def test_border_and_defocus():
    assert found(S.frame(256, 256, [S.Disc("rect", 3, 128, 30, 20)]))[0]["touches_border"]
    rng, blurred, false = np.random.default_rng(1), 0, 0
    flag = lambda r: r["edge_width_px"] > CFG.qc.defocus_edge_width_px or r["contrast"] < CFG.qc.defocus_contrast_min
    for _ in range(30):
        cx, cy = rng.uniform(50, 78, 2)
        blurred += any(map(flag, found(S.frame(128, 128, [S.Disc("ellipse", cx, cy, 20, 18, 0, 5.0)]))))
        false += any(map(flag, found(S.frame(128, 128, [S.Disc("ellipse", cx, cy, 20, 18)]))))
    assert blurred / 30 >= 0.95 and false / 30 <= 0.02


def test_components_holes_and_closing_against_plain_versions():
    rng = np.random.default_rng(3)
    for diagonal in (True, False):
        m = rng.random((40, 50)) < 0.5
        plain, n = np.zeros(m.shape, int), 0
        for r, c in zip(*np.nonzero(m), strict=True):
            if plain[r, c]:
                continue
            n, stack = n + 1, [(r, c)]
            while stack:
                y, x = stack.pop()
                if not (0 <= y < 40 and 0 <= x < 50) or not m[y, x] or plain[y, x]:
                    continue
                plain[y, x] = n
                stack += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or i == 0 or j == 0]
        got, k = pixels.components(m, diagonal)
        assert k == n and (got == plain).all()
    a = rng.random((21, 30))
    p = np.pad(a, 3, mode="symmetric")
    assert (pixels.square_extreme(a, 7, np.minimum) == [[p[r : r + 7, c : c + 7].min() for c in range(30)] for r in range(21)]).all()
    assert pixels.guarded_kernel(201, (64, 100)) == 63 and pixels.guarded_kernel(4, (50, 50)) == 3 and pixels.guarded_kernel(9, (1, 1)) == 1


def test_outlines_of_noise_are_closed_and_hold_the_dark_area():
    a = pixels.background_field(np.random.default_rng(5).random((40, 40)), 3)
    wide = np.pad(a, 1, constant_values=2.0)
    total = sum(outlines.signed_area(r) for r in outlines.rings(wide, 0.9))
    y, x = np.mgrid[0:41:410j, 0:41:410j]
    assert abs(total) == pytest.approx(float((pixels.bilinear(wide, x, y) < 0.9).mean()) * 41 * 41, rel=0.05)


def test_degenerate_shapes_give_nan_or_defined_values():
    assert all(math.isnan(v) for v in shapes.polygon_measures(None, 1.0).values())
    line = outlines.Polygon(np.array([[0.0, 0], [5, 0], [2, 0]]), [])
    assert all(math.isnan(v) for v in shapes.polygon_measures(line, 1.0).values())
    assert sharpness.mask_shape(np.zeros((5, 5), bool)) == (0.0, 1.0, 1.0)
    assert shapes.crofton(np.zeros((4, 4), bool)) == 0 and shapes.chain_perimeter(np.zeros((4, 4), bool)) == 0
    one_row = np.zeros((9, 40), bool)
    one_row[4, 5:35] = True
    assert sharpness.mask_shape(one_row)[1:] == (float("inf"), 1.0)
    assert outlines.from_wkt("POLYGON EMPTY") is None and outlines.from_wkt(None) is None and outlines.from_wkt("POLYGON ((1 a, 2 3))") is None
    with pytest.raises(ValueError):
        pixels.flat(np.ones((4, 4), np.uint8), None, Flatfield(method="blank"))


def test_square_by_digital_perimeters():
    m = np.zeros((30, 30), bool)
    m[5:25, 5:25] = True
    assert shapes.chain_perimeter(m) == 76
    assert shapes.enclosing_radius(np.array([[0.0, 0], [3, 0], [3, 4], [0, 4], [1, 2]])) == pytest.approx(2.5)


def test_codecs():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (13, 22)).astype(np.uint8)
    assert (images.decode(images.encode_bmp(image)) == image).all() and (images.decode(images.encode_png(image)) == image).all()
    colour = rng.integers(0, 256, (13, 22, 3)).astype(np.uint8)
    assert (images.decode(images.encode_png(colour)) == colour[:, :, 0]).all()
    assert (images.block_mean(np.full((5, 4), 100, np.uint8), 4) == [[100], [25]]).all()
    with pytest.raises(ValueError):
        images.decode(b"GIF89a")


@pytest.mark.parametrize("kind", [0, 1, 2, 3, 4])
def test_png_filters(kind):
    """Filtered by the published rules, each line with the same filter."""
    import struct
    import zlib

    image = np.random.default_rng(kind).integers(0, 256, (7, 9)).astype(int)
    lines = bytearray()
    for r in range(7):
        lines.append(kind)
        for c in range(9):
            a, b, d = image[r, c - 1] if c else 0, image[r - 1, c] if r else 0, image[r - 1, c - 1] if r and c else 0
            p = a + b - d
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - d) else b if abs(p - b) <= abs(p - d) else d
            lines.append((image[r, c] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
    body = b"".join(struct.pack(">I", len(x)) + k + x + b"\0\0\0\0" for k, x in ((b"IHDR", struct.pack(">IIBBBBB", 9, 7, 8, 0, 0, 0, 0)), (b"IDAT", zlib.compress(bytes(lines)))))
    assert (images.decode(b"\x89PNG\r\n\x1a\n" + body) == image).all()


def test_tiff():
    import struct

    image = np.arange(20, dtype=np.uint8).reshape(4, 5)
    tags = [(256, 5), (257, 4), (258, 8), (259, 1), (262, 1), (273, 8), (277, 1), (278, 4), (279, 20)]
    data = b"II*\0" + struct.pack("<I", 28) + image.tobytes() + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0" * 4
    assert (images.decode(data) == image).all()


def tiff(image, packing, tile=None, predictor=1, order="<", bits=8):
    """As the published format has it: blocks, then tags."""
    import struct
    import zlib

    rows, cols = image.shape
    high, wide = tile or (3, cols)
    blocks = []
    for top in range(0, rows, high):
        for left in range(0, cols, wide):
            b = image[top : top + high, left : left + wide].astype(f"{order}u{bits // 8}")
            if tile:
                b = np.pad(b, ((0, high - b.shape[0]), (0, wide - b.shape[1])))
            if predictor == 2:
                b = np.diff(b, axis=1, prepend=b[:, :1] * 0).astype(b.dtype)
            raw = b.tobytes()
            blocks.append({1: bytes, 5: packed_lzw, 8: zlib.compress, 32773: packed_bits}[packing](raw))
    at, places = 8, []
    for b in blocks:
        places.append(at)
        at += len(b)
    sizes = [len(b) for b in blocks]
    lists = struct.pack(f"{order}{len(places)}I", *places) + struct.pack(f"{order}{len(sizes)}I", *sizes)
    where = (places[0], sizes[0]) if len(blocks) == 1 else (at, at + 4 * len(places))
    of = (324, 325) if tile else (273, 279)
    tags = [(256, cols), (257, rows), (258, bits), (259, packing), (262, 1), (277, 1), (317, predictor)]
    tags = [(t, 4, 1, v) for t, v in tags] + [(of[0], 4, len(places), where[0]), (of[1], 4, len(sizes), where[1])]
    tags += [(322, 4, 1, wide), (323, 4, 1, high)] if tile else [(278, 4, 1, high)]
    ifd = struct.pack(order + "H", len(tags)) + b"".join(struct.pack(order + "HHII", *t) for t in sorted(tags)) + b"\0" * 4
    head = (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", at + len(lists))
    return head + b"".join(blocks) + lists + ifd


def packed_bits(raw):
    out, k = bytearray(), 0
    while k < len(raw):
        n = next((m for m in range(1, 128) if k + m >= len(raw) or raw[k + m] != raw[k]), 128)
        out += bytes([257 - n, raw[k]]) if n > 1 else bytes([0, raw[k]])
        k += n
    return bytes(out)


def packed_lzw(raw):
    table, bits, width = {bytes([k]): k for k in range(256)}, f"{256:09b}", 9
    now = b""
    n = 258
    for c in raw:
        if now + bytes([c]) in table:
            now += bytes([c])
            continue
        bits += f"{table[now]:0{width}b}"
        table[now + bytes([c])] = n
        n += 1
        now = bytes([c])
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        if n == 4094:
            bits += f"{256:0{width}b}"
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
    if now:
        bits += f"{table[now]:0{width}b}"
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    bits += f"{257:0{width}b}"
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))


@pytest.mark.parametrize("packing", [1, 5, 8, 32773])
@pytest.mark.parametrize("tile", [None, (16, 32)])
def test_tiff_strips_and_tiles(packing, tile):
    rng = np.random.default_rng(packing)
    image = np.where(rng.random((61, 83)) < 0.5, rng.integers(0, 256, (61, 83)), 7).astype(np.uint8)
    for predictor in (1, 2):
        for order in "<>":
            assert (images.decode(tiff(image, packing, tile, predictor, order)) == image).all()
    deep = image.astype(np.uint16) * 256 + rng.integers(0, 256, image.shape).astype(np.uint16)
    assert (images.decode(tiff(deep, packing, tile, 2, ">", 16)) == image).all()


def test_lzw_of_every_width_and_damage():
    rng = np.random.default_rng(1)
    for raw in (b"", b"a", b"a" * 9000, rng.integers(0, 256, 20_000).astype(np.uint8).tobytes(), rng.integers(0, 3, 60_000).astype(np.uint8).tobytes()):
        assert images.unpacked_lzw(packed_lzw(raw)) == raw
    with pytest.raises(ValueError, match="damaged"):
        images.unpacked_lzw(b"\x00\x00\x00")


@pytest.mark.parametrize(("depth", "colour"), [(8, 0), (1, 0), (4, 3), (8, 2), (16, 0), (8, 6)])
@pytest.mark.parametrize("shape", [(13, 22), (1, 1), (3, 5), (8, 2)])
def test_interlaced_png(depth, colour, shape):
    import struct
    import zlib

    rng = np.random.default_rng(depth)
    channels = {0: 1, 2: 3, 3: 1, 6: 4}[colour]
    px = rng.integers(0, 1 << depth, (*shape, channels))
    body = b""
    for top, left, down, right in images.PASSES:
        for line in px[top::down, left::right]:
            bits = "".join(f"{v:0{depth}b}" for v in line.ravel())
            if bits:
                bits += "0" * (-len(bits) % 8)
                body += b"\0" + bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))
    palette = bytes(range(48))
    parts = [(b"IHDR", struct.pack(">IIBBBBB", shape[1], shape[0], depth, colour, 0, 0, 1)), (b"PLTE", palette), (b"IDAT", zlib.compress(body))]
    data = b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(x)) + k + x + b"\0\0\0\0" for k, x in parts)
    first = px[:, :, 0]
    want = np.array(list(palette))[first * 3] if colour == 3 else first * (255 // ((1 << depth) - 1)) if depth < 8 else first >> (depth - 8)
    assert (images.decode(data) == want).all()


def rounded_square(half, radius, turn=0.0):
    t = np.arange(20) * math.pi / 38
    quarter = (half - radius) * np.array([1, 1]) + radius * np.column_stack([np.cos(t), np.sin(t)])
    ring = np.vstack([quarter @ np.array([[math.cos(k * math.pi / 2 + turn), math.sin(k * math.pi / 2 + turn)], [-math.sin(k * math.pi / 2 + turn), math.cos(k * math.pi / 2 + turn)]]) for k in range(4)])
    return outlines.Polygon(ring + 50, [])


@pytest.mark.parametrize("turn", [0.0, 0.4])
def test_roundness_is_that_of_the_corners(turn):
    for radius in (6, 10, 14):
        assert shapes.wadell(rounded_square(20, radius, turn), 1.0)[0] == pytest.approx(radius / 20, abs=0.1)
    assert shapes.wadell(rounded_square(20, 0.5, turn), 1.0)[0] < 0.2
    t = np.arange(90) * 2 * math.pi / 90
    assert shapes.wadell(outlines.Polygon(20 * np.column_stack([np.cos(t), np.sin(t)]) + 50, []), 1.0)[0] > 0.97
    r = shapes.wadell(rounded_square(20, 6)._replace(exterior=rounded_square(20, 6).exterior[::-1]), 1.0)[0]
    assert r == pytest.approx(0.3, abs=0.1)


@pytest.mark.parametrize("at", [(30.0, 33.0), (-3.0, 60.0), (70.0, 2.0), (200.0, 200.0)])
def test_drawing_costs_what_the_particle_covers(at):
    d = S.Disc("blob", *at, 9.5, 6.25, 0.7)
    p = outlines.Polygon((S.outline(d) + 0.5) * 8 - 0.5, [])
    c, r = np.meshgrid(np.arange(96 * 8), np.arange(64 * 8))
    x, y, nx, ny = *p.exterior.T, *np.roll(p.exterior, -1, axis=0).T
    odd = np.zeros(c.shape, bool)
    for i in range(len(x)):  # point by point, side by side
        odd ^= ((y[i] >= r) != (ny[i] >= r)) & (c >= x[i] + (r - y[i]) / (ny[i] - y[i]) * (nx[i] - x[i]))
    assert (outlines.rasterised(p, c.shape) == odd).all()
    assert (outlines.covered(p, (64, 96), 8) == odd.reshape(64, 8, 96, 8).mean(axis=(1, 3))).all()
    tracemalloc.start()
    try:
        S.frame(64, 64, [d])
        assert tracemalloc.get_traced_memory()[1] < 1 << 20  # not the 512 x 512 points of the frame
        tracemalloc.reset_peak()
        outlines.rasterised(p, (2048, 2048))
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()


def test_masks_of_one_run_a_row_have_no_holes():
    rng = np.random.default_rng(5)
    for _ in range(20):
        start, end = np.sort(rng.integers(0, 13, (2, 9)), axis=0)
        one = (np.arange(12) >= start[:, None]) & (np.arange(12) < end[:, None])
        assert (pixels.without_holes(one) == one).all()
        holed = one.copy()
        holed[4, (start[4] + end[4]) // 2] = False
        outside, _ = pixels.components(~holed, diagonal=False)
        edge = np.unique(np.concatenate([outside[0], outside[-1], outside[:, 0], outside[:, -1]]))
        assert (pixels.without_holes(holed) == (holed | ~np.isin(outside, edge))).all()


def test_several_grey_values_are_reached_as_one_by_one():
    rise = np.cumsum(np.random.default_rng(2).uniform(0, 1, (7, 9)), axis=1)
    at, grey = np.arange(9.0), np.array([0.5, 2.0, 20.0])
    assert (sharpness.reached(rise, at, grey) == [sharpness.reached(rise, at, float(g)) for g in grey]).all()
    for row, found in zip(rise, sharpness.reached(rise, at, 2.0), strict=True):
        assert found == pytest.approx(np.interp(2.0, row, at))


@pytest.mark.parametrize("kind", [np.uint8, np.float64])
def test_running_extremes_of_every_width(kind):
    a = np.random.default_rng(8).integers(0, 256, (17, 23)).astype(kind)
    for k in range(1, 24, 2):
        p = np.pad(a, k // 2, mode="symmetric")
        assert (pixels.running_extreme(a, k, np.maximum, 1) == [[p[k // 2 + r, c : c + k].max() for c in range(23)] for r in range(17)]).all()
        assert (pixels.running_extreme(a, k, np.minimum, 0) == [[p[r : r + k, k // 2 + c].min() for c in range(23)] for r in range(17)]).all()
