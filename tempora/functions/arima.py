"""Seasonal ARIMA kernel (numpy only), called inside Spark tasks.

Model: phi(B) PHI(B^s) (1-B)^d (1-B^s)^D y_t = theta(B) THETA(B^s) e_t, no constant.
Fit: conditional sum of squares (residuals before the AR order are taken as 0),
Levenberg-Marquardt with the exact Jacobian of the residual recursion, at most ``max_iter`` steps; no
stationarity or invertibility constraint.
AIC = n * ln(SSE / n) + 2 (k + 1) on a sample common to every candidate of a grid, so
candidates with different differencing compare on the same observations.
Forecast: recursion on the original scale with future shocks 0; variance from the
psi-weights of the full (differenced) model.

``fit_many`` fits one candidate order to a batch of series at once (shorter series are
front-padded and masked): every array carries the series as its first axis, and each
series keeps its own sample, damping factor, step acceptance and stopping point, so the
result per series is the one a single-series fit gives. The residual recursion is one loop
over time for the whole batch (the seasonal MA part in blocks of s steps), so its cost is
shared by all series of the batch. Spark groups the rows so that a task's batch holds many
series for each candidate.
"""

from __future__ import annotations

import math

import numpy as np


def _diff_poly(d: int, D: int, s: int) -> np.ndarray:
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(D):
        seas = np.zeros(s + 1)
        seas[0], seas[s] = 1.0, -1.0
        poly = np.convolve(poly, seas)
    return poly


def _lag_poly(coefs: np.ndarray, s: int, sign: float) -> np.ndarray:
    """(B, c) coefficients -> (B, c*s+1) polynomial 1 + sign * sum_i c_i B^(i s)."""
    out = np.zeros((coefs.shape[0], coefs.shape[1] * s + 1))
    out[:, 0] = 1.0
    if coefs.shape[1]:
        out[:, s::s] = sign * coefs
    return out


class Candidate:
    def __init__(self, p, d, q, P, D, Q, s):
        self.p, self.d, self.q, self.P, self.D, self.Q, self.s = p, d, q, P, D, Q, max(int(s), 1)
        self.k = p + q + P + Q
        self.r = p + P * self.s                      # AR lags conditioned on
        self.lead = d + D * self.s                   # observations lost to differencing
        self.m_len = q + Q * self.s + 1
        lags = set(range(1, q + 1)) | {j * self.s + i for j in range(1, Q + 1) for i in range(q + 1)}
        self.ma_lags = sorted(lags)                  # non-zero MA lags

    def split(self, theta):
        p, q, P = self.p, self.q, self.P
        return theta[..., :p], theta[..., p:p + P], theta[..., p + P:p + P + q], theta[..., p + P + q:]

    def polys_batch(self, thetas: np.ndarray):
        """(B, k) -> AR polynomial (B, r+1) and MA polynomial (B, m_len)."""
        ar, sar, ma, sma = self.split(thetas)
        a = _mul_polys(_lag_poly(ar, 1, -1.0), _lag_poly(sar, self.s, -1.0))
        m = _mul_polys(_lag_poly(ma, 1, 1.0), _lag_poly(sma, self.s, 1.0))
        return a, m

    def polys(self, theta):
        a, m = self.polys_batch(np.asarray(theta, dtype=float)[None, :])
        return a[0], m[0]

    def poly_derivs_batch(self, thetas: np.ndarray):
        """d(AR poly)/d(theta) (B, k, r+1) and d(MA poly)/d(theta) (B, k, m_len)."""
        ar, sar, ma, sma = self.split(thetas)
        ar_p, sar_p = _lag_poly(ar, 1, -1.0), _lag_poly(sar, self.s, -1.0)
        ma_p, sma_p = _lag_poly(ma, 1, 1.0), _lag_poly(sma, self.s, 1.0)
        b = thetas.shape[0]
        da, dm = np.zeros((b, self.k, self.r + 1)), np.zeros((b, self.k, self.m_len))
        row = 0
        for i in range(1, self.p + 1):                       # phi_i: -B^i * seasonal AR
            da[:, row, i:i + sar_p.shape[1]] -= sar_p
            row += 1
        for j in range(1, self.P + 1):                       # PHI_j: -B^(js) * AR
            da[:, row, j * self.s:j * self.s + ar_p.shape[1]] -= ar_p
            row += 1
        for i in range(1, self.q + 1):                       # theta_i: B^i * seasonal MA
            dm[:, row, i:i + sma_p.shape[1]] += sma_p
            row += 1
        for j in range(1, self.Q + 1):                       # THETA_j: B^(js) * MA
            dm[:, row, j * self.s:j * self.s + ma_p.shape[1]] += ma_p
            row += 1
        return da, dm


def _mul_polys(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise product of polynomials (B, a) x (B, b) -> (B, a+b-1); y is sparse."""
    out = np.zeros((x.shape[0], x.shape[1] + y.shape[1] - 1))
    for j in np.flatnonzero(np.any(y != 0.0, axis=0)):
        out[:, j:j + x.shape[1]] += x * y[:, j:j + 1]
    return out


def _ma_filter(x: np.ndarray, coefs: np.ndarray, lags: list[int]) -> np.ndarray:
    """Solve e_t = x_t - sum_l coefs_l e_(t - lag_l) along the last axis (e = 0 before the
    sample) for a batch. x: (B, ..., size); coefs: (B, L). Time is moved to the first axis so
    each step reads contiguous rows. With no lag-1 term the steps go in blocks of the
    smallest lag, inside which no value depends on another; with one, step by step with
    in-place products (few lags here: the seasonal part is filtered separately)."""
    if not lags:
        return x
    size, pad = x.shape[-1], lags[-1]
    to_front = (x.ndim - 1,) + tuple(range(x.ndim - 1))
    xt = x.transpose(to_front)                                       # (size, B, ...)
    out = np.zeros((pad + size,) + xt.shape[1:])
    c = coefs.T.reshape((len(lags), coefs.shape[0]) + (1,) * (x.ndim - 2))   # (L, B, ...)
    step = lags[0]
    with np.errstate(all="ignore"):
        if step == 1:
            tmp = np.empty(xt.shape[1:])
            c0, rest = c[0], [(c[li], pad - lags[li]) for li in range(1, len(lags))]
            mul, sub = np.multiply, np.subtract
            for t in range(size):
                dst = out[pad + t]
                mul(c0, out[pad + t - 1], out=tmp)
                sub(xt[t], tmp, out=dst)
                for cl, off in rest:
                    mul(cl, out[off + t], out=tmp)
                    sub(dst, tmp, out=dst)
        else:
            for t0 in range(0, size, step):
                t1 = min(t0 + step, size)
                acc = xt[t0:t1].copy()
                for li, lag in enumerate(lags):
                    acc -= c[li] * out[pad + t0 - lag:pad + t1 - lag]
                out[pad + t0:pad + t1] = acc
    return out[pad:].transpose(tuple(range(1, x.ndim)) + (0,))


class _Batch:
    """Per-(candidate, batch of series) constants of the residual recursion.

    Series of different lengths are front-padded to one length: ``pad[b]`` leading values of
    series b are padding, and its recursion input is held at zero before its own first
    residual, so its residuals are those of the unpadded series (zero history before the
    sample) preceded by zeros.

    The MA operator is theta(B) THETA(B^s); its (lower-triangular Toeplitz) inverse is applied
    as two filters, the seasonal one in blocks of s steps, then the non-seasonal one (q lags)."""

    def __init__(self, cand: Candidate, w: np.ndarray, pad=None):
        n, r = w.shape[1], cand.r
        self.cand, self.size = cand, n - r
        self.lagged = np.stack([w[:, r - i:n - i] for i in range(r + 1)], axis=1)   # (B, r+1, size)
        self.lags = [j for j in cand.ma_lags if j < self.size]                       # of the full MA poly
        self.n_lags = [i for i in range(1, cand.q + 1) if i < self.size]
        self.s_lags = [j * cand.s for j in range(1, cand.Q + 1) if j * cand.s < self.size]
        self.live = None
        if pad is not None and np.any(pad):
            self.live = np.arange(self.size)[None, :] >= np.asarray(pad)[:, None]   # (B, size)

    def _inverse_ma(self, x: np.ndarray, thetas: np.ndarray) -> np.ndarray:
        _ar, _sar, ma, sma = self.cand.split(thetas)
        x = _ma_filter(x, sma[:, :len(self.s_lags)], self.s_lags)
        return _ma_filter(x, ma[:, :len(self.n_lags)], self.n_lags)

    def residuals(self, thetas: np.ndarray, rows=None) -> np.ndarray:
        """CSS residuals e_t, t = r..n-1 -> (B, size) for the series ``rows`` (all if None)."""
        ar, sar, _ma, _sma = self.cand.split(thetas)
        a = _mul_polys(_lag_poly(ar, 1, -1.0), _lag_poly(sar, self.cand.s, -1.0))
        lagged = self.lagged if rows is None else self.lagged[rows]
        with np.errstate(all="ignore"):
            rhs = np.matmul(a[:, None, :], lagged)[:, 0, :]
        if self.live is not None:
            rhs = np.where(self.live if rows is None else self.live[rows], rhs, 0.0)
        return self._inverse_ma(rhs, thetas)

    def jacobian(self, thetas: np.ndarray, e: np.ndarray, rows) -> np.ndarray:
        """Exact derivatives of the residuals ``e`` (computed at ``thetas``): with
        T e = A w, de/dtheta = T^-1 (dA w - dT e), solved by the same filters -> (B, k, size)."""
        da, dm = self.cand.poly_derivs_batch(thetas)
        with np.errstate(all="ignore"):
            drhs = np.matmul(da, self.lagged[rows])
            if self.live is not None:
                drhs = np.where(self.live[rows][:, None, :], drhs, 0.0)
            if self.lags:
                size = self.size
                shifted = np.zeros((e.shape[0], len(self.lags), size))
                for li, lag in enumerate(self.lags):
                    shifted[:, li, lag:] = e[:, :size - lag]
                drhs = drhs - np.matmul(dm[:, :, self.lags], shifted)
        return self._inverse_ma(drhs, thetas)


def _solve_damped(hess: np.ndarray, grad: np.ndarray, lam: np.ndarray):
    """Steps of the damped normal equations for a batch; ok=False where singular or not finite."""
    diag = np.diagonal(hess, axis1=1, axis2=2)
    mats = hess + (lam[:, None] * (diag + 1e-12))[:, :, None] * np.eye(hess.shape[1])[None]
    with np.errstate(all="ignore"):
        try:
            steps = np.linalg.solve(mats, -grad[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:              # one singular matrix fails the stack: go one by one
            steps = np.full(grad.shape, np.nan)
            for i in range(len(mats)):
                try:
                    steps[i] = np.linalg.solve(mats[i], -grad[i])
                except np.linalg.LinAlgError:
                    pass
    return steps, np.all(np.isfinite(steps), axis=1)


def common_start(grid, n: int, min_obs: int = 12) -> int:
    """First original index used by every candidate of ``grid`` (tuples p,d,q,P,D,Q,s);
    0 when the series is too short for a shared sample (each candidate then uses its own)."""
    start = max(c[1] + c[4] * c[6] + c[0] + c[3] * c[6] for c in grid)
    return start if n - start >= min_obs else 0


# damping values tried per pass of the Levenberg-Marquardt step search
TRIES = 3


def fit_many(ys, order, seasonal, start=0, max_iter: int = 200, tol: float = 1e-6) -> list:
    """Fit one candidate to each series of ``ys`` (a 2-D array, or a list of 1-D series of
    any lengths; ``start`` is one index or one per series). Returns per series
    dict(params, sse, n, sigma2, aic, iterations) or None on failure (too short, non-finite)."""
    cand = Candidate(*order, *seasonal)
    series = [np.asarray(y, dtype=float) for y in ys]
    total = len(series)
    lens = np.array([len(y) for y in series], dtype=int)
    starts = np.broadcast_to(np.asarray(start, dtype=int), (total,))
    dp = _diff_poly(cand.d, cand.D, cand.s)
    width, k = len(dp), cand.k
    firsts = np.maximum(starts - cand.lead, cand.r)  # first residual index (in each w) that counts
    n_obs_all = lens - width + 1 - firsts
    usable = np.flatnonzero((lens >= width) & (n_obs_all > k + 1))
    results = [None] * total
    if not len(usable):
        return results
    n = int(lens[usable].max())
    pad = n - lens[usable]
    ys = np.zeros((len(usable), n))
    for j, b in enumerate(usable):
        ys[j, pad[j]:] = series[b]
    nb = len(usable)
    w = sum(dp[i] * ys[:, width - 1 - i:n - i] for i in range(width))       # differenced, (B, n-width+1)
    system = _Batch(cand, w, pad)
    n_obs = n_obs_all[usable]
    cuts = firsts[usable] - cand.r + pad           # first counted residual (padded coordinates)
    cut = int(cuts.min())
    counted = None if np.all(cuts == cut) else (np.arange(system.size - cut)[None, :] >= (cuts - cut)[:, None])

    def obs(x, rows):
        """The counted residuals (or Jacobian rows) of series ``rows``; zero where not counted."""
        x = x[..., cut:]
        if counted is None:
            return x
        m = counted[rows]
        return np.where(m if x.ndim == 2 else m[:, None, :], x, 0.0)

    theta = np.zeros((nb, k))
    full = system.residuals(theta)
    every = np.arange(nb)
    with np.errstate(all="ignore"):
        e0 = obs(full, every)
        sse = np.einsum("bt,bt->b", e0, e0)
    iters = np.zeros(nb, dtype=int)
    lam = np.full(nb, 1e-3)
    active = np.isfinite(sse) if k else np.zeros(nb, dtype=bool)
    while active.any():
        rows = np.flatnonzero(active)
        iters[rows] += 1
        jac = obs(system.jacobian(theta[rows], full[rows], rows), rows)    # (A, k, counted)
        e = obs(full[rows], rows)
        with np.errstate(all="ignore"):
            grad = np.matmul(jac, e[:, :, None])[:, :, 0]
            hess = np.matmul(jac, jac.transpose(0, 2, 1))
        improved = np.zeros(len(rows), dtype=bool)
        done = np.zeros(len(rows), dtype=bool)
        pending = lam[rows] < 1e12
        while pending.any():
            # The next TRIES damping values of every pending series are tried at once (a
            # series stops at the first that lowers its SSE, as when trying them in turn),
            # so a pass over time is not spent on each rejection of one series.
            pi = np.flatnonzero(pending)
            lam_try = np.empty((len(pi), TRIES))
            lam_try[:, 0] = lam[rows[pi]]
            for j in range(1, TRIES):
                lam_try[:, j] = lam_try[:, j - 1] * 10.0
            valid = lam_try < 1e12
            steps, ok = _solve_damped(np.repeat(hess[pi], TRIES, axis=0), np.repeat(grad[pi], TRIES, axis=0),
                                      lam_try.ravel())
            ok &= valid.ravel()
            tried = np.flatnonzero(ok)                                       # flat (series, try) index
            s_new = np.full(len(pi) * TRIES, np.inf)
            if len(tried):
                src = rows[pi[tried // TRIES]]
                cand_theta = theta[src] + steps[tried]
                new_full = system.residuals(cand_theta, src)
                with np.errstate(all="ignore"):
                    e_new = obs(new_full, src)
                    s_new[tried] = np.einsum("bt,bt->b", e_new, e_new)
            s_old = sse[rows[pi]]
            with np.errstate(all="ignore"):
                better = (np.isfinite(s_new) & (s_new < np.repeat(s_old, TRIES))).reshape(len(pi), TRIES)
            has = better.any(axis=1)
            acc = np.flatnonzero(has)                                        # into pi
            if len(acc):
                first = better[acc].argmax(axis=1)
                pos = np.searchsorted(tried, acc * TRIES + first)            # into the tried rows
                g = rows[pi[acc]]
                s_acc, s_prev = s_new[tried[pos]], s_old[acc]
                with np.errstate(all="ignore"):
                    small_gain = s_prev - s_acc <= tol * np.maximum(s_prev, 1e-300)
                    small_step = (np.linalg.norm(steps[tried[pos]], axis=1)
                                  <= 1e-8 * (np.linalg.norm(theta[g], axis=1) + 1e-8))
                theta[g], full[g], sse[g] = cand_theta[pos], new_full[pos], s_acc
                lam[g] = np.maximum(lam_try[acc, first] / 10.0, 1e-12)
                improved[pi[acc]] = True
                done[pi[acc]] = small_gain | small_step
                pending[pi[acc]] = False
            rej = np.flatnonzero(~has)                                       # every valid try failed
            if len(rej):
                last = valid[rej].sum(axis=1) - 1
                lam[rows[pi[rej]]] = lam_try[rej, last] * 10.0
            pending &= lam[rows] < 1e12
        stop = ~improved | done | (iters[rows] >= max_iter) | ~np.isfinite(sse[rows])
        active[rows[stop]] = False

    for j, b in enumerate(usable):
        if not np.isfinite(sse[j]) or sse[j] < 0:
            continue
        sigma2 = max(float(sse[j]) / n_obs[j], 1e-300)
        aic = n_obs[j] * math.log(sigma2) + 2 * (k + 1)
        results[b] = {"params": theta[j].copy(), "sse": float(sse[j]), "n": int(n_obs[j]), "sigma2": float(sigma2),
                      "aic": float(aic), "iterations": int(iters[j]), "cand": cand, "first": int(firsts[b])}
    return results


def fit(y, order, seasonal, start: int = 0, max_iter: int = 200, tol: float = 1e-6):
    """Fit one candidate to one series (``fit_many`` with a batch of one)."""
    return fit_many([y], order, seasonal, start, max_iter, tol)[0]


def forecast(y, fitted: dict, steps: int, z: float = 1.959963984540054):
    """Point forecasts and symmetric intervals for ``steps`` months after the sample."""
    cand, theta = fitted["cand"], fitted["params"]
    y = np.asarray(y, dtype=float)
    a, m = cand.polys(theta)
    dp = _diff_poly(cand.d, cand.D, cand.s)
    full_a = np.convolve(a, dp)
    w = np.convolve(y, dp)[len(dp) - 1:len(y)]
    e_w = np.zeros(len(w))
    e_w[cand.r:] = _Batch(cand, w[None, :]).residuals(theta[None, :])[0]
    e = np.concatenate([np.zeros(cand.lead), e_w])   # residuals on the original index
    hist_y, hist_e = list(y), list(e)
    means = []
    for _ in range(steps):
        t = len(hist_y)
        v = 0.0
        for i in range(1, len(full_a)):
            if t - i >= 0 and full_a[i] != 0.0:
                v -= full_a[i] * hist_y[t - i]
        for j in range(1, len(m)):
            if t - j >= 0 and m[j] != 0.0:
                v += m[j] * hist_e[t - j]
        hist_y.append(v)
        hist_e.append(0.0)
        means.append(v)
    psi = np.zeros(steps)
    for j in range(steps):
        v = m[j] if j < len(m) else 0.0
        for i in range(1, min(j, len(full_a) - 1) + 1):
            v -= full_a[i] * psi[j - i]
        psi[j] = v if j else 1.0
    sd = np.sqrt(fitted["sigma2"] * np.cumsum(psi ** 2))
    means = np.array(means)
    return means, means - z * sd, means + z * sd
