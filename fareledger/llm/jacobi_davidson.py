"""Largest eigenpairs of a symmetric matrix that is known by its products only: block Jacobi-Davidson.

Each round projects the matrix on the search space (Rayleigh-Ritz), locks the leading pairs whose
residuals have reached double precision, and widens the space by corrections of the others. The
corrections solve (1 - QQ')(A - theta)(1 - QQ') t = -r, with Q the locked and current vectors, by a few
steps of MINRES; all wanted pairs take their steps together, so a product serves all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Apply = Callable[[np.ndarray], np.ndarray]
EPS = np.finfo(np.float64).eps
RESIDUAL = 32 * EPS  # of a pair, relative to the largest eigenvalue
STEPS, ROUNDS = 6, 300


def orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``columns`` have outside ``against``; what is dependent goes."""
    out = np.zeros((len(columns), 0))
    for column in columns.T:
        length = np.linalg.norm(column)
        for _ in range(3):
            for known in (against, out):
                column = column - known @ (known.T @ column)
        rest = np.linalg.norm(column)
        if rest > 1e-10 * length:
            out = np.column_stack([out, column / rest])
    return out


def minres(apply: Apply, right: np.ndarray, steps: int, least: float = 0.05) -> np.ndarray:
    """Solutions of ``apply(t) = right``, a column each, after ``steps`` products at most.

    Ends early once every residual has come down to ``least`` of its start.
    """
    start = np.linalg.norm(right, axis=0)
    beta, eta = start.copy(), start.copy()
    v_old, v = np.zeros_like(right), right / np.where(beta > 0, beta, 1)
    w_older, w_old, t = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    for _ in range(steps):
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        image = image - alpha * v - beta * v_old
        beta_new = np.linalg.norm(image, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, beta_new)
        safe = np.where(rho > 0, rho, 1)
        w = (v - s_old * beta * w_older - (s * alpha + c_old * c * beta) * w_old) / safe
        c_old, s_old, c, s = c, s, delta / safe, beta_new / safe
        t = t + np.where(rho > 0, c * eta, 0) * w
        eta = -s * eta
        w_older, w_old = w_old, w
        v_old, v, beta = v, image / np.where(beta_new > 0, beta_new, 1), beta_new
        if (np.abs(eta) <= least * start).all():
            break
    return t


def largest(apply: Apply, dim: int, count: int, steps: int = STEPS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    count = min(count, dim)
    if count < 1:
        return np.zeros(0), np.zeros((dim, 0))
    rng = np.random.default_rng(seed)
    most = min(dim, 8 * count)
    locked, values = np.zeros((dim, 0)), []
    basis = orthonormal(rng.normal(size=(dim, min(dim, 2 * count))), locked)
    image = apply(basis)
    best, idle = np.inf, 0
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        want = count - len(values)
        rest = image[:, :want] - basis[:, :want] * theta[:want]
        rest -= locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        scale = max([*values[:1], *np.abs(theta[:1])])
        whole = basis.shape[1] + locked.shape[1] >= dim  # nothing is outside: what is left is rounding
        # The products' own rounding ends the descent a little above the aim at times.
        idle = idle + 1 if size[0] > best / 2 else 0
        best = min(best, size[0])
        even = idle >= 3 and best <= 64 * RESIDUAL * scale
        good = np.ones(want, bool) if whole else size <= (64 if even else 1) * RESIDUAL * scale
        ready = want if good.all() else int(np.argmin(good))
        if ready:
            locked = np.column_stack([locked, basis[:, :ready]])
            values += list(theta[:ready])
            if len(values) == count:
                return polished(apply, locked)
            basis, image, best, idle = basis[:, ready:], image[:, ready:], np.inf, 0
            want -= ready
            rest = rest[:, ready:]
        current = np.column_stack([locked, basis[:, :want]])

        def projected(t: np.ndarray, q: np.ndarray = current, shift: np.ndarray = theta[ready:ready + want]):
            t = t - q @ (q.T @ t)
            t = apply(t) - shift * t
            return t - q @ (q.T @ t)

        right = -(rest - current @ (current.T @ rest))
        new = minres(projected, right, steps)
        if basis.shape[1] + want > most:
            keep = max(2 * want, most // 2)
            basis, image = basis[:, :keep], image[:, :keep]
        new = orthonormal(new, np.column_stack([locked, basis]))
        if not new.shape[1]:  # every correction lies in the space already
            new = orthonormal(rng.normal(size=(dim, want)), np.column_stack([locked, basis]))
        basis, image = np.column_stack([basis, new]), np.column_stack([image, apply(new)])
    raise RuntimeError(f"eigenpairs did not reach double precision in {ROUNDS} rounds")


def polished(apply: Apply, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A last Rayleigh-Ritz step on the locked vectors; each vector's largest entry becomes positive."""
    q = np.linalg.qr(vectors)[0]
    small = q.T @ apply(q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = q @ turn[:, ::-1]
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return values[::-1], vectors * np.where(top < 0, -1, 1)
