"""Small dense numerics for k x k matrices and single series. No Spark here."""

from __future__ import annotations

import math

import numpy as np


def solve_sym(xtx: np.ndarray, xty: np.ndarray) -> np.ndarray:
    """Solve a symmetric system; singular ones by pseudo-inverse."""
    k = xty.size
    a = xtx.reshape(k, k)
    if not (np.isfinite(a).all() and np.isfinite(xty).all()):
        return np.zeros(k)
    try:
        if np.linalg.cond(a) < 1e13:
            return np.linalg.solve(a, xty)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(a, hermitian=True) @ xty


def nnls_normal(xtx: np.ndarray, xty: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """Least squares with non-negative coefficients: active sets on the normal equations."""
    k = xty.size
    a = xtx.reshape(k, k)
    x = np.zeros(k)
    free = np.zeros(k, bool)
    for _ in range(10 * k + 10):
        grad = xty - a @ x
        grad[free] = -np.inf
        if free.all() or grad.max() <= tol * max(1.0, np.abs(xty).max()):
            break
        free[int(np.argmax(grad))] = True
        while True:
            s = np.zeros(k)
            s[free] = np.linalg.pinv(a[np.ix_(free, free)], hermitian=True) @ xty[free]
            bad = free & (s <= 0)
            if not bad.any():
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = x + step * (s - x)
            free &= x > tol
            x[~free] = 0.0
            if not free.any():
                s = np.zeros(k)
                break
        x = s
    return x


def null_space(c: np.ndarray) -> np.ndarray:
    """Orthonormal basis of the null space of ``c`` (rows are constraints)."""
    _, s, vt = np.linalg.svd(c)
    rank = int((s > 1e-12 * max(1.0, s.max(initial=0.0))).sum())
    return vt[rank:].T


def constrained_normal(xtx: np.ndarray, xty: np.ndarray, r: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Minimise b'Ab - 2b'c subject to R b = q."""
    b0 = np.linalg.pinv(r) @ q
    z = null_space(r)
    if z.shape[1] == 0:
        return b0
    k = xty.size
    a = xtx.reshape(k, k)
    return b0 + z @ (np.linalg.pinv(z.T @ a @ z, hermitian=True) @ (z.T @ (xty - a @ b0)))


def add_labelled(a, b):
    """Sum of two labelled square matrices, aligned on the union of labels."""
    if not a[0]:
        return b
    names = sorted(set(a[0]) | set(b[0]))
    at = {k: i for i, k in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for labels, v in (a, b):
        ix = [at[k] for k in labels]
        m[np.ix_(ix, ix)] += v
    return names, m


def floor_eigenvalues(m: np.ndarray, floor: float = 1e-10) -> np.ndarray:
    """Nearest-by-eigenvalues matrix without eigenvalues under ``floor``."""
    m = (m + m.T) / 2
    d, v = np.linalg.eigh(m)
    if d.min() >= floor:
        return m
    out = (v * np.maximum(d, floor)) @ v.T
    return (out + out.T) / 2


def matrix_root(m: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Symmetric square root (or its inverse), tiny eigenvalues dropped."""
    d, v = np.linalg.eigh((m + m.T) / 2)
    keep = d > 1e-12 * max(d.max(), 1e-300)
    r = np.zeros_like(d)
    r[keep] = np.sqrt(d[keep])
    if inverse:
        r[keep] = 1.0 / r[keep]
    return (v * r) @ v.T


def nested_normal(xtx: np.ndarray, xty: np.ndarray, blocks: list[list[int]], orthogonal: bool) -> np.ndarray:
    """Coefficients of blocks fitted in turn to what is left, from sums of products alone. Columns without any
    square are left out and get 0, as do columns in no block."""
    out = np.zeros(len(xty))
    used: list[int] = []
    for block in blocks:
        at = [i for i in block if xtx[i, i] > 0]
        if not at:
            continue
        left = xty[at] - xtx[np.ix_(at, used)] @ out[used]
        own = xtx[np.ix_(at, at)]
        if orthogonal and used:
            cross = xtx[np.ix_(at, used)]
            inner = np.linalg.pinv(xtx[np.ix_(used, used)], hermitian=True)
            own = own - cross @ inner @ cross.T
            left = xty[at] - cross @ inner @ xty[used]
        out[at] = np.linalg.pinv(own, hermitian=True) @ left
        used += at
    return out


def cross_correlation(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted correlations about zero of columns of x with columns of y, each pair over the rows that both have; 0 where there are none."""
    w = np.asarray(w, float)[:, None]
    (sx, zx), (sy, zy) = ((np.isfinite(m).astype(float), np.where(np.isfinite(m), m, 0.0)) for m in (x, y))
    xy = (zx * w).T @ zy
    # the sum of squares of i over the rows that j has, and of j over those that i has
    size = np.sqrt(((zx * w * zx).T @ sy) * (sx.T @ (zy * w * zy)))
    out = np.divide(xy, size, out=np.zeros_like(xy), where=size > 0)
    return np.clip(out, -1.0, 1.0)


def pair_correlation(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted correlations about zero of columns, each pair over the rows that both have; 0 where there are none."""
    out = cross_correlation(x, x, w)
    np.fill_diagonal(out, 1.0)
    return out


def unit_diagonal(corr: np.ndarray, floor: float = 1e-8) -> np.ndarray:
    """Nearest shape with no eigenvalue under ``floor`` and ones on the diagonal."""
    d, v = np.linalg.eigh((corr + corr.T) / 2)
    if d.size and d.min() < floor:
        corr = (v * np.maximum(d, floor)) @ v.T
    s = np.sqrt(np.diag(corr))
    return corr / np.outer(s, s)


def impose_block(cov: np.ndarray, index: list[int], target: np.ndarray) -> np.ndarray:
    """T S T' with T chosen so the block at ``index`` becomes ``target``.

    T acts on the block only: target^(1/2) O block^(-1/2), O the rotation that moves least.
    """
    t = np.eye(cov.shape[0])
    t[np.ix_(index, index)] = block_transform(cov[np.ix_(index, index)], target)
    out = t @ cov @ t.T
    return (out + out.T) / 2


def block_transform(block: np.ndarray, target: np.ndarray) -> np.ndarray:
    """T with T block T' = target: target^(1/2) O block^(-1/2), O the rotation that moves least."""
    rs, rt = matrix_root(block), matrix_root(target)
    u, _, vt = np.linalg.svd(rt @ rs)
    return rt @ (u @ vt) @ matrix_root(block, inverse=True)


def cubic_spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Not-a-knot cubic interpolation (natural under four knots), linear for two, flat for one."""
    n = len(x)
    if n == 1:
        return np.full(len(at), y[0], float)
    if n == 2:
        return y[0] + (at - x[0]) * (y[1] - y[0]) / (x[1] - x[0])
    h = np.diff(x)
    a = np.zeros((n, n))
    b = np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1], a[i, i], a[i, i + 1] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    if n > 3:
        a[0, :3] = h[1], -(h[0] + h[1]), h[0]
        a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    else:
        a[0, 0] = a[-1, -1] = 1.0
    m = np.linalg.solve(a, b)
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    t0, t1 = at - x[i], x[i + 1] - at
    return (
        (m[i] * t1**3 + m[i + 1] * t0**3) / (6 * h[i])
        + (y[i] / h[i] - m[i] * h[i] / 6) * t1
        + (y[i + 1] / h[i] - m[i + 1] * h[i] / 6) * t0
    )


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    f = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            f *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * f


def t_two_sided(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    if not math.isfinite(t) or dof <= 0:
        return float("nan")
    return beta_inc(dof / 2.0, 0.5, dof / (dof + t * t))


#: Passes in which a robust fit takes its scale anew; afterwards the scale stands, so the fit is convex and settles.
SCALE_PASSES = 2


def mad_scale(e: np.ndarray) -> float:
    """Median distance from the median, as a standard deviation."""
    return float(np.median(np.abs(e - np.median(e))) / 0.67449)


def huber_solve(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, k: float = 1.345, tol: float = 1e-10, most: int = 1000) -> tuple[np.ndarray, bool, int]:
    """Huber M-estimate by reweighted least squares: coefficients, whether they settled, and passes.

    The first ``SCALE_PASSES`` passes scale by the MAD of weighted residuals about their median. From then
    on the scale stands: each pass lowers one convex loss, so passes cannot swing between two fits. Without
    any spread (half of the residuals or more are equal) the least-squares fit stays.
    """
    root = np.ones(len(y)) if w is None else np.sqrt(w)
    xw, yw = x * root[:, None], y * root
    b = np.linalg.lstsq(xw, yw, rcond=None)[0]
    s = 0.0
    for i in range(1, most + 1):
        e = yw - xw @ b
        if i <= SCALE_PASSES:
            s = mad_scale(e)
        if s <= 1e-300:
            return b, True, i
        r = np.sqrt(np.minimum(1.0, k * s / np.maximum(np.abs(e), 1e-300)))
        new = np.linalg.lstsq(xw * r[:, None], yw * r, rcond=None)[0]
        moved = np.max(np.abs(new - b), initial=0.0) > tol * max(1e-12, np.max(np.abs(new), initial=0.0))
        b = new
        if i > SCALE_PASSES and not moved:
            return b, True, i
    return b, False, most


def huber_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None, k: float = 1.345) -> np.ndarray:
    """Coefficients of ``huber_solve``."""
    return huber_solve(x, y, w, k)[0]


def huber_location(v: np.ndarray, w: np.ndarray, k: float = 1.345) -> float:
    """Weighted Huber location with the scale of ``huber_solve``, exactly: the sum of clipped residuals falls
    from piece to piece as the centre rises; its zero lies on the piece where the sign changes."""
    root = np.sqrt(w)
    c, s = float((w * v).sum() / w.sum()), 0.0
    for i in range(SCALE_PASSES):
        e = root * (v - c)
        s = mad_scale(e)
        if s <= 1e-300:
            return c
        if i < SCALE_PASSES - 1:
            u = w * np.minimum(1.0, k * s / np.maximum(np.abs(e), 1e-300))
            c = float((u * v).sum() / u.sum())
    reach = k * s / root
    at, slope = np.concatenate([v - reach, v + reach]), np.concatenate([-w, w])
    order = np.argsort(at, kind="stable")
    at, slope = at[order], slope[order]
    run = np.cumsum(slope)
    total = (root * k * s).sum() + np.append(0.0, np.cumsum(run[:-1] * np.diff(at)))  # the sum at each place
    i = int(np.flatnonzero(total >= 0)[-1])
    return float(at[i] - total[i] / run[i]) if run[i] < 0 else float(at[i])


def adf_t(e: np.ndarray, lags: int = 2) -> float:
    """Dickey-Fuller t without constant: d e_t on e_{t-1} and ``lags`` earlier differences."""
    d = np.diff(e)
    n = len(d) - lags
    if n <= lags + 1:
        return float("nan")
    x = np.column_stack([e[lags:-1]] + [d[lags - i : len(d) - i] for i in range(1, lags + 1)])
    y = d[lags:]
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    r = y - x @ b
    dof = n - x.shape[1]
    if dof <= 0:
        return float("nan")
    s2 = float(r @ r) / dof
    v = np.linalg.pinv(x.T @ x)[0, 0] * s2
    return float(b[0] / math.sqrt(v)) if v > 0 else float("nan")


# Published response-surface constants for the no-constant Dickey-Fuller test
# (critical value = b0 + b1/n + b2/n^2 at 1, 5 and 10 percent).
ADF_SURFACE = {0.01: (-2.56574, -2.2358, -3.627), 0.05: (-1.941, -0.2686, -3.365), 0.10: (-1.61682, 0.2656, -2.714)}


def adf_level(t: float, n: int) -> float:
    """Smallest of 1, 5 and 10 percent at which a unit root is rejected; 1 when none."""
    for level, (b0, b1, b2) in ADF_SURFACE.items():
        if t <= b0 + b1 / n + b2 / n**2:
            return level
    return 1.0


def shrink_eigenvalues(m: np.ndarray, n_obs: int) -> np.ndarray:
    """Rotationally invariant shrinkage of a covariance's eigenvalues (published closed form).

    Each eigenvalue is divided by |1 - q + q z s(z)|^2 with s the resolvent of the others,
    and raised where the small-eigenvalue correction exceeds one.
    """
    lam, vec = np.linalg.eigh((m + m.T) / 2)
    n = lam.size
    q = n / float(n_obs)
    low = max(float(lam.min()), 0.0)
    edge = (1 - math.sqrt(q)) ** 2
    z = lam - 1j / math.sqrt(n)
    inv = 1.0 / (z[:, None] - lam[None, :])
    np.fill_diagonal(inv, 0.0)
    s = inv.sum(axis=1) / n
    new = lam / np.abs(1 - q + q * z * s) ** 2
    if low > 0 and edge > 0:
        sigma2 = low / edge
        high = low * (1 + math.sqrt(q)) ** 2 / edge
        g = (z + sigma2 * (q - 1) - np.sqrt(z - low) * np.sqrt(z - high)) / (2 * q * z * sigma2)
        gamma = sigma2 * np.abs(1 - q + q * z * g) ** 2 / lam
        new = np.where(gamma > 1, gamma * new, new)
    out = (vec * new) @ vec.T
    return (out + out.T) / 2


def top_vectors(g: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest k eigenvalues and vectors, each vector's sum made non-negative."""
    d, v = np.linalg.eigh((g + g.T) / 2)
    at = np.argsort(d)[::-1][:k]
    v = v[:, at] * np.where(v[:, at].sum(axis=0) < 0, -1.0, 1.0)
    return d[at], v
