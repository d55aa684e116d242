"""NumPy kernels on blocks of spectra (rows x channels, 64-bit); no Spark here."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Array = np.ndarray


def _basis(n: int, order: int) -> Array:
    return np.polynomial.legendre.legvander(np.linspace(-1, 1, n) if n > 1 else np.zeros(1), order)


def _fit(y: Array, use: Array, basis: Array) -> Array:
    """Least-squares curves of all rows at once, from the channels in use."""
    w = use.astype(np.float64)
    gram = np.einsum("rc,ck,cl->rkl", w, basis, basis, optimize=True)
    right = np.where(use, y, 0.0) @ basis
    tiny = 1e-12 * np.maximum(np.trace(gram, axis1=1, axis2=2), 1e-300)
    gram += tiny[:, None, None] * np.eye(basis.shape[1])
    return np.linalg.solve(gram, right[:, :, None])[:, :, 0] @ basis.T


def masked_std(x: Array, use: Array) -> Array:
    """Population deviation of each row's used channels; NaN without any."""
    n = use.sum(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(use, x, 0).sum(1) / n
        return np.sqrt(np.where(use, (x - mean[:, None]) ** 2, 0).sum(1) / n)


def baseline(y: Array, order: int = 1, window: tuple[int, int] | None = None, exclude: Array | None = None, clip: float = 3.0, rounds: int = 3) -> Array:
    """Subtracts a polynomial fitted to finite channels outside the window [start, end) and the excluded ones.

    Up to `rounds` times, channels whose residuals exceed clip deviations leave the fit; a row stops
    when none does. Rows with too few channels come back as they are; missing channels stay missing.
    """
    y = np.array(y, np.float64)
    good = np.isfinite(y)
    if window:
        good[:, max(0, window[0]) : max(0, window[1])] = False
    if exclude is not None:
        good &= ~exclude
    enough = good.sum(1) > order
    use = good.copy()
    basis = _basis(y.shape[1], order)
    at = np.flatnonzero(enough)
    for _ in range(rounds):
        if not len(at):
            break
        residual = np.where(np.isfinite(y[at]), y[at], 0) - _fit(y[at], use[at], basis)
        sigma = masked_std(residual, use[at])
        with np.errstate(invalid="ignore"):
            new = use[at] & (np.abs(residual) <= clip * sigma[:, None])
        go = np.isfinite(sigma) & (sigma > 0) & (new.sum(1) != use[at].sum(1))
        use[at[go]] = new[go]
        at = at[go]
    thin = use.sum(1) <= order
    use[thin] = good[thin]
    out = y.copy()
    if enough.any():
        out[enough] = y[enough] - _fit(y[enough], use[enough], basis)
    out[~np.isfinite(y)] = np.where(enough[:, None], np.nan, y)[~np.isfinite(y)]
    return out


def auto_order(y: Array, theoretical: Array, window: tuple[int, int] | None = None, most: int = 3, slack: float = 1.15, gain: float = 0.02) -> tuple[Array, Array]:
    """Baseline of the lowest order whose line-free deviation is within slack of the theoretical one.

    Where none is, orders rise while each lowers the deviation by at least `gain`. Returns the
    corrected rows and the orders.
    """
    free = np.ones(y.shape[1], bool)
    if window:
        free[max(0, window[0]) : max(0, window[1])] = False
    fitted = [baseline(y, k, window) for k in range(most + 1)]
    left = np.stack([masked_std(f, np.isfinite(f) & free) for f in fitted])
    with np.errstate(invalid="ignore"):
        fine = left <= slack * theoretical[None, :]
    order = np.argmax(fine, 0)
    for i in np.flatnonzero(~fine.any(0)):
        k = 0
        while k < most and left[k + 1, i] < (1 - gain) * left[k, i]:
            k += 1
        order[i] = k
    return np.stack(fitted)[order, np.arange(len(y))], order


def lower_envelope(y: Array, order: int = 3, rounds: int = 20) -> Array:
    """A polynomial below the spectrum: fitted again and again to the lower of curve and data."""
    basis = _basis(y.shape[1], order)
    work = np.where(np.isfinite(y), y, np.nanmin(np.where(np.isfinite(y), y, np.inf), 1, keepdims=True))
    use = np.ones(y.shape, bool)
    curve = _fit(work, use, basis)
    for _ in range(rounds):
        work = np.minimum(work, curve)
        curve = _fit(work, use, basis)
    return curve


def smooth(y: Array, k: int) -> Array:
    """Boxcar of k channels with zeros beyond the ends, as long as the input; NaN spreads."""
    if k <= 1:
        return np.array(y, np.float64)
    box = np.ones(k) / k
    start = (k - 1) // 2
    return np.stack([np.convolve(row, box)[start : start + len(row)] for row in np.asarray(y, np.float64)]) if len(y) else np.array(y, np.float64)


def smooth_edges(y: Array, k: int) -> Array:
    """Boxcar of an odd number of channels; the end channels are repeated beyond the ends."""
    k += 1 - k % 2
    pad = k // 2
    return smooth(np.pad(np.asarray(y, np.float64), ((0, 0), (pad, pad)), mode="edge"), k)[:, pad : pad + y.shape[1]]


def interpolated(y: Array) -> Array:
    """Missing channels filled along each row by straight lines, constant beyond the last finite ones; 0 in rows without any."""
    out = np.array(y, np.float64)
    x = np.arange(y.shape[1])
    for row in out:
        good = np.isfinite(row)
        if not good.all():
            row[~good] = np.interp(x[~good], x[good], row[good]) if good.any() else 0.0
    return out


def noise_like(rows: Array, channels: int, seed: int) -> Array:
    """Normal deviates keyed by seed and row id: the same row gets the same noise in any partition."""
    return np.stack([np.random.Generator(np.random.Philox(key=[seed, int(r) & 0xFFFFFFFFFFFFFFFF])).standard_normal(channels) for r in rows]) if len(rows) else np.zeros((0, channels))


def fill_with_noise(y: Array, mask: Array, row_ids: Array, seed: int, centered: bool, window: tuple[int, int] | None = None) -> Array:
    """Replaces masked channels by noise of the other channels' deviation; around 0, or around the row's continuum line if centered."""
    out = np.array(y, np.float64)
    good = np.isfinite(out) & ~mask
    if window:
        good[:, max(0, window[0]) : max(0, window[1])] = False
    few = good.sum(1) < 2
    center = np.zeros_like(out)
    if centered and (~few).any():
        center[~few] = _fit(np.where(good, out, 0)[~few], good[~few], _basis(out.shape[1], 1))
    sigma = masked_std(np.where(np.isfinite(out), out, 0) - center, good)
    fresh = center + np.nan_to_num(sigma)[:, None] * noise_like(row_ids, out.shape[1], seed)
    put = mask & ~few[:, None]
    out[put] = fresh[put]
    return out


def ripple_ratio(y: Array, line_free: Array) -> Array:
    """Total deviation from the means of the line-free runs, over the white part seen in channel differences; NaN with fewer than 8 values or differences."""
    out = np.full(len(y), np.nan)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], line_free, [False]]).astype(np.int8)))
    runs = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= 2]
    for i, row in enumerate(y):
        total, n, steps = 0.0, 0, []
        for a, b in runs:
            part = row[a:b]
            good = np.isfinite(part)
            if good.any():
                total += ((part[good] - part[good].mean()) ** 2).sum()
                n += int(good.sum())
            step = np.diff(part)
            steps.append(step[np.isfinite(step)])
        joined = np.concatenate(steps) if steps else np.zeros(0)
        white = joined.std() / np.sqrt(2) if len(joined) else 0.0
        if n >= 8 and len(joined) >= 8 and white > 0:
            out[i] = np.sqrt(total / n) / white
    return out


def whiteness(y: Array, line_free: Array, k: int) -> Array:
    """Deviation of means of k channels times sqrt k, over that of single channels: 1 for white noise. NaN with fewer than 2 k channels."""
    k = max(2, k)
    x = np.asarray(y, np.float64)[:, line_free]
    m = x.shape[1] // k * k
    if x.shape[1] < 2 * k:
        return np.full(len(y), np.nan)
    good = np.isfinite(x)
    blocks, ok = np.where(good, x, 0)[:, :m].reshape(len(x), -1, k), good[:, :m].reshape(len(x), -1, k)
    with np.errstate(invalid="ignore", divide="ignore"):
        means = blocks.sum(2) / ok.sum(2)
        return np.sqrt(k) * masked_std(np.nan_to_num(means), np.isfinite(means)) / masked_std(x, good)


def resample(y: Array, velocity: Array, start: float, step: float, n: int) -> Array:
    """Means of the finite channels whose velocity (rows x channels) is nearest to each of n grid points; NaN where there is none."""
    place = np.rint((velocity - start) / step)
    good = np.isfinite(y) & (place >= 0) & (place < n)
    row = np.broadcast_to(np.arange(len(y))[:, None], y.shape)[good]
    code = row * n + place[good].astype(np.int64)
    total = np.bincount(code, y[good], len(y) * n)
    count = np.bincount(code, minlength=len(y) * n)
    with np.errstate(invalid="ignore", divide="ignore"):
        return (total / count).reshape(len(y), n)


def detect_line(y: Array, method: str = "waterfall", kernel: int = 5, prominence: float = 5.0) -> tuple[int, float]:
    """Channel of a science line in many rows, and a confidence from 0 to 1.

    waterfall: peak of the smoothed mean, confidence its height in deviations over `prominence`;
    max: where most rows have their maximum; centroid: of the positive mean.
    """
    mean = np.nanmean(np.where(np.isfinite(y), y, np.nan), 0)
    if method == "max":
        tops = np.nanargmax(np.where(np.isfinite(y), y, -np.inf), 1)
        count = np.bincount(tops, minlength=y.shape[1])
        return int(np.argmax(count)), float(count.max() / len(y))
    if method == "centroid":
        weight = np.clip(np.nan_to_num(mean - np.nanmedian(mean)), 0, None)
        return (int(round(float((weight * np.arange(len(mean))).sum() / weight.sum()))), 1.0) if weight.sum() > 0 else (len(mean) // 2, 0.0)
    flat = smooth_edges(np.nan_to_num(mean)[None, :], kernel)[0]
    top = int(np.argmax(flat))
    spread = flat.std()
    height = (flat[top] - np.median(flat)) / spread if spread > 0 else 0.0
    return top, float(np.clip(height / prominence, 0, 1))


def width_at_half(y: Array, center: int) -> int:
    """Channels around the centre of a mean spectrum that stay above half its height over the median."""
    level = np.nanmedian(y) + (y[center] - np.nanmedian(y)) / 2
    lo = hi = center
    while lo > 0 and y[lo - 1] > level:
        lo -= 1
    while hi < len(y) - 1 and y[hi + 1] > level:
        hi += 1
    return hi - lo + 1


def gauss_kernel(k: int) -> Array:
    """Normalised Gaussian of k taps whose width follows from k."""
    sigma = 0.3 * ((k - 1) / 2 - 1) + 0.8
    x = np.arange(k) - (k - 1) / 2
    g = np.exp(-(x**2) / (2 * sigma**2))
    return g / g.sum()


def blur(image: Array, k: int) -> Array:
    """Separable Gaussian blur; the image is mirrored at its edges without repeating them."""
    g, pad = gauss_kernel(k), k // 2

    def along(a: Array) -> Array:
        index = np.arange(-pad, a.shape[1] + pad)
        period = max(1, 2 * (a.shape[1] - 1))
        index = np.abs(index) % period if a.shape[1] > 1 else np.zeros(len(index), int)
        index = np.where(index >= a.shape[1], period - index, index)
        wide = a[:, index]
        return sum(g[j] * wide[:, j : j + a.shape[1]] for j in range(k))

    return along(along(np.asarray(image, np.float64)).T).T


def blurred_rows(image: Array, k: int, at: int, begin: int, end: int, height: int) -> Array:
    """Rows begin to end of the blurred image of `height` rows, from its rows from `at` on with k // 2 more on both sides."""
    g, pad = gauss_kernel(k), k // 2
    index = np.arange(begin - pad, end + pad)
    period = max(1, 2 * (height - 1))
    index = np.abs(index) % period
    index = np.where(index >= height, period - index, index) - at
    n = image.shape[1]
    across = np.arange(-pad, n + pad)
    turn = max(1, 2 * (n - 1))
    across = np.abs(across) % turn if n > 1 else np.zeros(len(across), int)
    across = np.where(across >= n, turn - across, across)
    wide = np.asarray(image, np.float64)[:, across]
    soft = sum(g[j] * wide[:, j : j + n] for j in range(k))[index]
    return sum(g[j] * soft[j : j + end - begin] for j in range(k))


def windowed(y: Array, window: tuple[int, int]) -> Array:
    """The finite values in the window, zero elsewhere."""
    image = np.where(np.isfinite(y), y, 0.0)
    image[:, : max(0, window[0])] = 0
    image[:, max(0, window[1]) :] = 0
    return image


def levels(image: Array, low: float, high: float) -> Array:
    """The image in whole levels from 0 to 100, by way of 8 bits."""
    return np.rint(np.rint((image - low) / (high - low) * 255) / 255 * 100)


def odd_kernel(kernel: int) -> int:
    return max(3, kernel - (1 - kernel % 2))


def find_lines(y: Array, window: tuple[int, int], kernel: int, factor: float) -> Array | None:
    """Which channels of the rows of a group show a line; None if none does.

    The rows make an image of 8 bits: zero outside the window, blurred, and cut at mean + factor *
    deviation of what is not zero. Detected pixels leave those statistics until they settle.
    """
    n = len(y)
    image = windowed(y, window)
    if n == 1:
        image = np.repeat(image, 10, axis=0)
    kernel = odd_kernel(kernel)
    size = np.abs(image).max(1)
    live = size > 1e-10 * size.max() if size.max() > 0 else np.zeros(len(image), bool)
    if not live.any():
        return None
    low, high = image.min(), image.max()
    if high <= low:
        return None
    bytes_ = np.rint((image - low) / (high - low) * 255)
    soft = blur(np.rint((bytes_ - bytes_.min()) / max(1.0, np.ptp(bytes_)) * 100), kernel)
    rest = soft.copy()
    old = None
    found = np.zeros(soft.shape, bool)
    for _ in range(100):
        seen = rest[rest != 0]
        if not len(seen):
            break
        now = (float(seen.mean()), float(seen.std()))
        found = soft > now[0] + factor * now[1]
        if old is not None and (now[0] == old[0] or now[1] == old[1]):
            break
        old = now
        rest[found] = 0
    found[:, : max(0, window[0])] = False
    found[:, max(0, window[1]) :] = False
    found[~live] = False
    found = found[:1] if n == 1 else found
    return found if found.any() else None


def parabola_peaks(y: Array) -> Array:
    """Where each row's maximum is, by the parabola through it and its neighbours."""
    n = y.shape[1]
    filled = interpolated(y)
    top = np.clip(np.argmax(filled, 1), 1, max(1, n - 2))
    r = np.arange(len(y))
    a, b, c = filled[r, top - 1], filled[r, top], filled[r, np.minimum(top + 1, n - 1)]
    bend = a - 2 * b + c
    return top + np.where(bend < 0, 0.5 * (a - c) / np.where(bend == 0, 1, bend), 0.0)


def moved_rows(y: Array, shift: Array) -> Array:
    """Rows read at i + shift by straight lines; missing channels are filled first, places beyond the ends are missing."""
    x = np.arange(y.shape[1])
    return np.stack([np.interp(x + s, x, row, left=np.nan, right=np.nan) for s, row in zip(shift, interpolated(y), strict=True)]) if len(y) else np.array(y, np.float64)


def peak_aligned_mean(y: Array) -> Array:
    """Mean of rows shifted, by parts of channels, so that their parabola peaks meet at the median peak."""
    peak = parabola_peaks(y)
    moved = moved_rows(y, peak - np.median(peak))
    good = np.isfinite(moved)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(good, moved, 0).sum(0) / good.sum(0)


def gauss_smooth(y: Array, sigma: float) -> Array:
    """Gaussian smoothing along rows that leaves missing channels out of its means."""
    if sigma <= 0:
        return np.array(y, np.float64)
    reach = int(np.ceil(4 * sigma))
    g = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    good = np.isfinite(y)
    apply = lambda rows: np.stack([np.convolve(row, g, "full")[reach : reach + y.shape[1]] for row in rows])
    with np.errstate(invalid="ignore", divide="ignore"):
        return apply(np.where(good, y, 0.0)) / np.where((w := apply(good.astype(float))) > 0, w, np.nan)


def shift_rows(y: Array, shift: Array) -> Array:
    """Rows read at i + shift, linearly between channels; where one neighbour is out of range the other counts alone."""
    n = y.shape[1]
    whole = np.floor(shift).astype(np.int64)
    w = shift - whole
    i = np.arange(n)[None, :] + whole[:, None]
    ok_a, ok_b = (i >= 0) & (i < n), (i + 1 >= 0) & (i + 1 < n)
    r = np.arange(len(y))[:, None]
    a = np.where(ok_a, y[r, np.clip(i, 0, n - 1)], np.nan)
    b = np.where(ok_b, y[r, np.clip(i + 1, 0, n - 1)], np.nan)
    mixed = (1 - w[:, None]) * a + w[:, None] * b
    return np.where(ok_a & ok_b, np.where(w[:, None] == 0, a, mixed), np.where(ok_a, a, b))


@dataclass
class Model:
    """Principal components of a group's reference spectra, on the channels first..last."""

    mean: Array
    components: Array
    variance: Array
    ratio: Array
    first: int
    last: int


def decompose(y: Array, k: int, excluded: Array | None = None, core: tuple[int, int] | None = None, smooth_width: int = 1, reject_sigma: float | None = None, nan_below: float = 0.2) -> Model | None:
    """Components of a group's reference spectra; None if fewer than two rows are fit for it.

    Rows with nan_below or more missing channels leave; channels are trimmed to those that any row has;
    missing ones get the channel's mean, infinities 0. An order-1 baseline without the excluded
    channels and the core (the science line) is subtracted. The components are taken on the other channels, smoothed,
    interpolated across the excluded, and tapered to zero over the core.
    """
    y = np.array(y, np.float64)
    y = y[np.isnan(y).mean(1) < nan_below] if len(y) else y
    if len(y) < 2:
        return None
    some = np.flatnonzero((~np.isnan(y)).any(0))
    first, last = int(some[0]), int(some[-1])
    with np.errstate(invalid="ignore"):
        means = np.nan_to_num(np.nanmean(np.where(np.isinf(y[:, first : last + 1]), np.nan, y[:, first : last + 1]), 0))
    out, inner = zones(first, last, excluded, core)
    y = levelled(y, first, last, means, out | inner)
    if reject_sigma and inner.any():
        score = y[:, inner].mean(1)
        sigma = score.std()
        keep = np.abs(score - np.median(score)) <= reject_sigma * sigma if sigma > 0 else np.ones(len(y), bool)
        if keep.sum() >= max(k + 2, 10):
            y = y[keep]
    if (~(out | inner)).sum() < 2:
        return None
    return model_of(moments(y, ~(out | inner)), k, out, inner, first, last, smooth_width)


def zones(first: int, last: int, excluded: Array | None, core: tuple[int, int] | None) -> tuple[Array, Array]:
    """The excluded channels and those of the core, among channels first to last."""
    n = last - first + 1
    out = np.zeros(n, bool) if excluded is None else np.asarray(excluded, bool)[first : last + 1].copy()
    inner = np.zeros(n, bool)
    if core:
        inner[max(0, core[0] - first) : max(0, core[1] - first)] = True
    return out, inner


def levelled(y: Array, first: int, last: int, means: Array, off: Array) -> Array:
    """Channels first to last, missing ones filled with the channels' means and infinities with 0, less a baseline without the channels `off`."""
    y = y[:, first : last + 1]
    y = np.where(np.isnan(y), means[None, :], y)
    y[np.isinf(y)] = 0
    return baseline(y, 1, exclude=np.broadcast_to(off, y.shape))


def moments(y: Array, use: Array) -> tuple[int, Array, Array]:
    """Number of rows, mean of all channels, and the triangular factor of the rows less their mean in the used channels."""
    mean = y.mean(0)
    return len(y), mean, _triangle(y[:, use] - mean[use])


def joined_moments(a: tuple[int, Array, Array], b: tuple[int, Array, Array], use: Array) -> tuple[int, Array, Array]:
    """The moments of two sets of rows taken together."""
    n = a[0] + b[0]
    step = b[1] - a[1]
    return n, a[1] + step * (b[0] / n), _triangle(np.concatenate([a[2], b[2], (np.sqrt(a[0] * b[0] / n) * step[use])[None, :]]))


def _triangle(rows: Array) -> Array:
    return np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows


def model_of(known: tuple[int, Array, Array], k: int, out: Array, inner: Array, first: int, last: int, smooth_width: int) -> Model:
    count, mean, triangle = known
    n = len(mean)
    use = ~(out | inner)
    _, s, v = np.linalg.svd(triangle, full_matrices=False)
    k = min(k, int((s > 1e-12 * max(s[0], 1e-300)).sum()) or 1)
    variance = s**2 / (count - 1)
    x = np.arange(n)
    parts = np.zeros((k, n))
    rough = v[:k]
    rough = rough * np.where(rough[np.arange(k), np.argmax(np.abs(rough), 1)] < 0, -1, 1)[:, None]
    parts[:, use] = smooth(rough, smooth_width)
    for row in parts:
        row[~use] = np.interp(x[~use], x[use], row[use])
    if inner.any():
        parts *= taper(n, int(np.flatnonzero(inner)[0]), int(np.flatnonzero(inner)[-1]) + 1)[None, :]
    filled = np.interp(x, x[use], mean[use])
    return Model(np.where(use, mean, filled), parts, variance[:k], (variance / max(variance.sum(), 1e-300))[:k], first, last)


def taper(n: int, low: int, high: int) -> Array:
    """1 outside [low, high), 0 inside, with cosine ramps at its edges."""
    out = np.ones(n)
    width = high - low
    ramp = min(4, width // 4)
    out[low:high] = 0
    for i in range(ramp):
        level = 0.5 * (1 + np.cos(np.pi * (i + 1) / (ramp + 1)))
        out[low + i] = out[high - 1 - i] = level
    return out


@dataclass(frozen=True)
class Gates:
    """When a component is used: its share of the variance, its coefficient, and its noise ratio."""

    variance: float = 0.0
    coefficient: float = 0.0
    noise: float = np.inf
    smooth: int = 5
    least_squares: bool = True


def coefficients(y: Array, parts: Array, use: Array, least_squares: bool) -> Array:
    """Of one row: plain projections if all channels are used; else least squares on those that are, or projections normalised there."""
    if not len(parts) or not use.any():
        return np.zeros(len(parts))
    p = parts[:, use]
    if use.all():
        return p @ y
    if least_squares:
        return np.linalg.lstsq(p.T, y[use], rcond=None)[0]
    dot = p @ y[use]
    norm = (p * p).sum(1)
    return np.where(norm > 0, dot / np.where(norm > 0, norm, 1), 0.0)


def noise_ratios(y: Array, parts: Array, coeff: Array, use: Array, smooth_width: int) -> Array:
    """The spectrum's deviation, smoothed, on the used channels over each fitted component's deviation."""
    spec = smooth(interpolated(y[None, :]), smooth_width)[0][use].std() if use.any() else 0.0
    part = (coeff[:, None] * parts).std(1)
    return np.where(part < 1e-15, 1e10, np.where(spec < 1e-15, 1e5, spec / np.where(part < 1e-15, 1, part)))


def fitted(y: Array, parts: Array, gates: Gates) -> tuple[Array, Array, Array, Array]:
    """Row numbers, components, coefficients and noise ratios of all rows with enough channels (finite and not 0)."""
    ids, places, coefficient, ratio = [], [], [], []
    use = np.isfinite(y) & (y != 0)
    whole = use.all(1)
    plain = y @ parts.T if whole.all() else None
    for i in np.flatnonzero(use.sum(1) > len(parts)).tolist():
        clean = np.where(use[i], y[i], 0.0)
        c = plain[i] if plain is not None else coefficients(clean, parts, use[i], gates.least_squares)
        ids.append(np.full(len(parts), i))
        places.append(np.arange(len(parts)))
        coefficient.append(c)
        ratio.append(noise_ratios(np.where(use[i], y[i], np.nan), parts, c, use[i], gates.smooth))
    none = [np.zeros(0)]
    return np.concatenate(ids or none).astype(np.int64), np.concatenate(places or none).astype(np.int32), np.concatenate(coefficient or none), np.concatenate(ratio or none)


def correct(y: Array, model: Model, fit_mask: Array, subtract_mask: Array, gates: Gates, cutoffs: Array | None = None) -> tuple[Array, Array]:
    """Rows less their components, in two passes: coefficients, gates, coefficients of what passes.

    fit_mask and subtract_mask (rows x channels) say where to fit and where to subtract. cutoffs: a
    noise ratio for each component, which goes before the gate; NaN: never use it. Returns rows and how many components each used.
    """
    out = np.array(y, np.float64)
    used = np.zeros(len(y), np.int64)
    a, b = model.first, model.last + 1
    for i in range(len(y)):
        row = out[i, a:b]
        bad = ~np.isfinite(row) | (row == 0)
        use = fit_mask[i, a:b] & ~bad
        if use.sum() <= len(model.components):
            continue
        clean = np.where(bad, 0.0, row)
        coeff = coefficients(clean, model.components, use, gates.least_squares)
        ratio = np.nan_to_num(noise_ratios(np.where(bad, np.nan, row), model.components, coeff, use, gates.smooth), nan=np.inf)
        limit = np.full(len(coeff), gates.noise) if cutoffs is None else np.asarray(cutoffs, np.float64)[: len(coeff)]
        keep = (model.ratio > gates.variance) & (np.abs(coeff) >= gates.coefficient) & ~np.isnan(limit) & ~(np.isfinite(limit) & (ratio > limit))
        if not keep.any():
            continue
        parts = model.components[keep]
        again = coefficients(clean, parts, use, gates.least_squares)
        where = subtract_mask[i, a:b] & np.isfinite(row)
        row[where] -= (again @ parts)[where]
        used[i] = int(keep.sum())
    return out, used


def kde_peak(values: Array, bandwidth: float = 1.5, top: float = 60.0, points: int = 60, counts: Array | None = None) -> tuple[float, float] | None:
    """Centre and deviation of the first peak of the values' density: a Gaussian fitted to the peak and two points on each side. counts: how often each value stands."""
    good = np.isfinite(values)
    v, w = np.abs(values[good]), np.ones(good.sum()) if counts is None else np.asarray(counts, np.float64)[good]
    if w.sum() < 3:
        return None
    x = np.linspace(0, top, points)
    density = np.exp(-((x[:, None] - v[None, :]) ** 2) / (2 * bandwidth**2)) @ (w / w.sum()) / (bandwidth * np.sqrt(2 * np.pi))
    floor = density.min() + 0.3 * (density.max() - density.min())
    peaks = [i for i in range(1, points - 1) if density[i] >= floor and density[i] > density[i - 1] and density[i] >= density[i + 1]]
    if not peaks:
        return None
    lo, hi = max(0, peaks[0] - 2), min(points, peaks[0] + 3)
    xs, ys = x[lo:hi], density[lo:hi]
    p = np.array([density[peaks[0]], x[peaks[0]], bandwidth])
    damp = 1e-3
    cost = np.inf
    for _ in range(100):
        g = np.exp(-((xs - p[1]) ** 2) / (2 * p[2] ** 2))
        residual = ys - p[0] * g
        new = float((residual**2).sum())
        if not np.isfinite(new):
            return None
        jac = np.stack([g, p[0] * g * (xs - p[1]) / p[2] ** 2, p[0] * g * (xs - p[1]) ** 2 / p[2] ** 3], 1)
        step = np.linalg.lstsq(jac.T @ jac + damp * np.diag(np.diag(jac.T @ jac) + 1e-30), jac.T @ residual, rcond=None)[0]
        p = p + step
        damp = damp / 3 if new < cost else damp * 3
        if abs(cost - new) < 1e-14:
            break
        cost = new
    return float(p[1]), float(p[2])


def component_cutoffs(ratios: Array, overall: float | None, fixed: float | None, counts: Array | None = None) -> Array:
    """Noise-ratio limits of a group's components (ratios: rows x components; counts: how often each row stands); NaN: do not use, inf: no limit."""
    out = np.full(ratios.shape[1], np.inf)
    if not overall:
        return out
    for j in range(ratios.shape[1]):
        peak = kde_peak(ratios[:, j], counts=counts)
        out[j] = np.nan if peak is None or peak[0] >= overall else fixed if fixed else peak[0] + 3 * abs(peak[1])
    return out
