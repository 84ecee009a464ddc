"""Small state-space models of one table: dynamic factors by expectation maximisation, and series made daily.

Everything here works on one group's table of some hundred months by up to about a hundred series.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Variance of what is left of a value beside factors and its own autoregressive noise; only keeps matrices regular.
EXACT = 1e-6
#: Largest absolute autoregression that a fit may take.
MOST_RHO = 0.98


class FactorFit(NamedTuple):
    """factors (steps x k), loadings (series x k), var (k x k), shock (k x k), rho and sigma2 of each series' noise,
    log-likelihoods by pass, whether they settled."""

    factors: np.ndarray
    loadings: np.ndarray
    var: np.ndarray
    shock: np.ndarray
    rho: np.ndarray
    sigma2: np.ndarray
    loglik: list[float]
    converged: bool


class Moments(NamedTuple):
    mean: np.ndarray
    cov: np.ndarray
    lag: np.ndarray
    loglik: float


def smooth(z: np.ndarray, loadings: np.ndarray, var: np.ndarray, shock: np.ndarray, rho: np.ndarray, sigma2: np.ndarray) -> Moments:
    """Means, covariances and lag-one covariances of the state (factors, then each series' noise) given all
    values of z that are not NaN. The state starts from its stationary distribution."""
    steps, n = z.shape
    k = loadings.shape[1]
    d = k + n
    move = np.zeros((d, d))
    move[:k, :k] = var
    move[range(k, d), range(k, d)] = rho
    noise = np.zeros((d, d))
    noise[:k, :k] = shock
    noise[range(k, d), range(k, d)] = sigma2
    read = np.hstack([loadings, np.eye(n)])
    p = np.zeros((d, d))
    p[:k, :k] = np.linalg.solve(np.eye(k * k) - np.kron(var, var), shock.ravel()).reshape(k, k)
    p[range(k, d), range(k, d)] = sigma2 / (1 - rho**2)
    a = np.zeros(d)
    seen = np.isfinite(z)
    ahead, ahead_p = np.empty((steps, d)), np.empty((steps, d, d))
    now, now_p = np.empty((steps, d)), np.empty((steps, d, d))
    loglik = 0.0
    for t in range(steps):
        if t:
            a, p = move @ a, move @ p @ move.T + noise
        ahead[t], ahead_p[t] = a, p
        ok = seen[t]
        if ok.any():
            h = read[ok]
            hp = h @ p
            s = hp @ h.T + EXACT * np.eye(int(ok.sum()))
            e = z[t, ok] - h @ a
            gain = np.linalg.solve(s, hp).T
            loglik -= 0.5 * (ok.sum() * np.log(2 * np.pi) + np.linalg.slogdet(s)[1] + e @ np.linalg.solve(s, e))
            a, p = a + gain @ e, p - gain @ hp
            p = (p + p.T) / 2
        now[t], now_p[t] = a, p
    mean, cov, lag = now.copy(), now_p.copy(), np.zeros((steps, d, d))
    for t in range(steps - 2, -1, -1):
        back = np.linalg.solve(ahead_p[t + 1], move @ now_p[t]).T
        mean[t] = now[t] + back @ (mean[t + 1] - ahead[t + 1])
        cov[t] = now_p[t] + back @ (cov[t + 1] - ahead_p[t + 1]) @ back.T
        lag[t + 1] = cov[t + 1] @ back.T  # of step t + 1 with step t
    return Moments(mean, cov, lag, loglik)


def _filled(z: np.ndarray, k: int, passes: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Factors and loadings of rank k that fit the values there are; the others are replaced by the fit until it stands."""
    seen = np.isfinite(z)
    full = np.where(seen, z, 0.0)
    for _ in range(passes):
        u, s, v = np.linalg.svd(full, full_matrices=False)
        fit = (u[:, :k] * s[:k]) @ v[:k]
        new = np.where(seen, z, fit)
        if np.abs(new - full).max(initial=0.0) < 1e-6:
            break
        full = new
    f = u[:, :k] * s[:k]
    scale = np.where(f.std(axis=0) > 0, f.std(axis=0), 1.0)
    return f / scale, v[:k].T * scale


def _stable(var: np.ndarray) -> np.ndarray:
    size = np.abs(np.linalg.eigvals(var)).max(initial=0.0)
    return var * (MOST_RHO / size) if size > MOST_RHO else var


def _start(z: np.ndarray, k: int):
    f, lam = _filled(z, k)
    var = _stable(np.linalg.lstsq(f[:-1], f[1:], rcond=None)[0].T)
    eta = f[1:] - f[:-1] @ var.T
    e = z - f @ lam.T
    both = np.isfinite(e[1:]) & np.isfinite(e[:-1])
    one, two = np.where(both, e[:-1], 0.0), np.where(both, e[1:], 0.0)
    rho = np.clip((one * two).sum(axis=0) / np.maximum((one**2).sum(axis=0), 1e-12), -0.9, 0.9)
    sigma2 = np.maximum(np.nanvar(e, axis=0) * (1 - rho**2), 1e-4)
    return lam, var, eta.T @ eta / max(len(eta), 1) + 1e-6 * np.eye(k), rho, sigma2


def _maximised(z: np.ndarray, m: Moments, k: int):
    """Parameters that maximise the expected log-likelihood given the state's moments."""
    steps, n = z.shape
    f, e = m.mean[:, :k], m.mean[:, k:]
    ff = np.einsum("ti,tj->tij", f, f) + m.cov[:, :k, :k]
    cross = np.einsum("ti,tj->ij", f[1:], f[:-1]) + m.lag[1:, :k, :k].sum(axis=0)
    var = _stable(np.linalg.solve(ff[:-1].sum(axis=0), cross.T).T)
    shock = (ff[1:].sum(axis=0) - var @ cross.T - cross @ var.T + var @ ff[:-1].sum(axis=0) @ var.T) / (steps - 1)
    at = np.arange(k, k + n)
    ee = e**2 + m.cov[:, at, at]
    lagged = (e[1:] * e[:-1] + m.lag[1:, at, at]).sum(axis=0)
    rho = np.clip(lagged / np.maximum(ee[:-1].sum(axis=0), 1e-12), -MOST_RHO, MOST_RHO)
    sigma2 = np.maximum((ee[1:].sum(axis=0) - 2 * rho * lagged + rho**2 * ee[:-1].sum(axis=0)) / (steps - 1), 1e-6)
    lam = np.zeros((n, k))
    for i in range(n):  # released steps only
        ok = np.isfinite(z[:, i])
        right = (z[ok, i, None] * f[ok] - (e[ok, i, None] * f[ok] + m.cov[ok, k + i, :k])).sum(axis=0)
        lam[i] = np.linalg.solve(ff[ok].sum(axis=0) + 1e-9 * np.eye(k), right)
    return lam, var, (shock + shock.T) / 2 + 1e-9 * np.eye(k), rho, sigma2


def _turned(f, lam, var, shock):
    """The same model with uncorrelated factors of unit variance, in the order of what they explain, loadings
    summing to something positive."""
    c = np.linalg.cholesky(f.T @ f / len(f) + 1e-12 * np.eye(f.shape[1]))
    value, turn = np.linalg.eigh(c.T @ lam.T @ lam @ c)
    turn = turn[:, np.argsort(value)[::-1]]
    to = c @ turn  # lam_new = lam @ to, f_new = f @ inv(to).T
    sign = np.where((lam @ to).sum(axis=0) < 0, -1.0, 1.0)
    to = to * sign
    back = np.linalg.inv(to)
    return f @ back.T, lam @ to, back @ var @ to, back @ shock @ back.T


def dynamic_factors(x: np.ndarray, k: int, tol: float = 1e-5, most: int = 200) -> FactorFit:
    """Factors of a table (steps x series, NaN where not released) in which factors follow a first-order vector
    autoregression and each series' own noise a first-order autoregression.

    Expectation maximisation over released values only: what is missing is neither filled nor counted. Passes
    go on until the log-likelihood rises by less than ``tol`` of its size, ``most`` at most. Series with
    fewer than three values or without spread have no loading. Factors have unit variance (``_turned``).
    """
    steps, n = x.shape
    mu, sd = np.full(n, np.nan), np.zeros(n)
    count = np.isfinite(x).sum(axis=0)
    some = count >= 3
    mu[some], sd[some] = np.nanmean(x[:, some], axis=0), np.nanstd(x[:, some], axis=0)
    use = some & (sd > 1e-12)
    k = min(k, int(use.sum()))
    if not k or steps < 3:
        return FactorFit(np.zeros((steps, k)), np.zeros((n, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(n), np.zeros(n), [], True)
    z = (x[:, use] - mu[use]) / sd[use]
    p = _start(z, k)
    history: list[float] = []
    converged = False
    while len(history) < most:
        m = smooth(z, *p)
        history.append(m.loglik)
        if len(history) > 1 and abs(history[-1] - history[-2]) <= tol * (abs(history[-1]) + abs(history[-2])) / 2:
            converged = True
            break
        p = _maximised(z, m, k)
    m = smooth(z, *p) if not converged else m
    lam, var, shock, rho, sigma2 = p
    f, lam, var, shock = _turned(m.mean[:, :k], lam, var, shock)
    loadings, all_rho, all_sigma2 = np.zeros((n, k)), np.zeros(n), np.zeros(n)
    loadings[use], all_rho[use], all_sigma2[use] = lam * sd[use, None], rho, sigma2 * sd[use] ** 2
    return FactorFit(f, loadings, var, shock, all_rho, all_sigma2, history, converged)


# --- low to high frequency ---------------------------------------------------------------------


def _both_ways(w: np.ndarray, rho: float) -> np.ndarray:
    """Sums over all days j of rho ** |d - j| w_j, by one pass in each direction."""
    ahead, back = w.astype(float).copy(), w.astype(float).copy()
    for i in range(1, len(w)):
        ahead[i] += rho * ahead[i - 1]
    for i in range(len(w) - 2, -1, -1):
        back[i] += rho * back[i + 1]
    return ahead + back - w


def _block_cov(counts: np.ndarray, rho: float) -> np.ndarray:
    """Covariances of the sums over consecutive blocks of days of an autoregression with unit variance."""
    if rho == 0:
        return np.diag(counts.astype(float))
    m = len(counts)
    end = np.cumsum(counts)
    run = (1 - rho**counts) / (1 - rho)
    out = np.empty((m, m))
    i, j = np.triu_indices(m, 1)
    gap = (end[j] - counts[j]) - (end[i] - 1)
    out[i, j] = out[j, i] = run[i] * run[j] * rho**gap
    out[range(m), range(m)] = counts + 2 * (rho / (1 - rho)) * (counts - run)
    return out


def spread(total: np.ndarray, counts: np.ndarray, x: np.ndarray, rho: float | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Daily values that add up to each block's total (published method of Chow and Lin): days, coefficients, rho.

    ``counts`` are the days of each block in order, ``x`` (days x indicators) explains a day; what it leaves is an
    autoregression, whose parameter is found on a grid by likelihood unless given. A block whose total is NaN
    gets what indicators and its neighbours say.
    """
    block = np.repeat(np.arange(len(counts)), counts)
    sums = np.add.reduceat(x, np.append(0, np.cumsum(counts)[:-1])) if len(x) else np.zeros((len(counts), x.shape[1]))
    ok = np.isfinite(total)
    y, a = total[ok], sums[ok]
    best = None
    for r in [rho] if rho is not None else np.linspace(0, 0.95, 20):
        v = _block_cov(counts, float(r))[np.ix_(ok, ok)]
        va = np.linalg.solve(v, a)
        b = np.linalg.lstsq(va.T @ a, va.T @ y, rcond=None)[0]
        e = y - a @ b
        q = np.linalg.solve(v, e)
        fit = -0.5 * (len(y) * np.log(max(e @ q, 1e-300)) + np.linalg.slogdet(v)[1])
        if best is None or fit > best[0]:
            best = (fit, float(r), b, q)
    _, r, b, q = best
    w = np.zeros(len(counts))
    w[ok] = q
    return x @ b + _both_ways(w[block], r), b, r
