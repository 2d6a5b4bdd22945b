"""Eigenvectors of a symmetric matrix by QDWH spectral divide and conquer, on the driver: the matrix is dimensions by dimensions."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a square matrix: Halley's iteration with dynamic weights, in its form by QR, which needs no inverse.

    Six steps suffice for any condition up to 1 / eps; smaller singular values count as eps.
    """
    n, scale = len(a), np.linalg.norm(a)
    x, low = a / (scale or 1.0), _EPS
    for _ in range(30):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        s = np.sqrt(1 + d)
        wa = s + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * s)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if 1 - low < 10 * _EPS and moved < np.cbrt(_EPS):
            break
    return (x + x.T) / 2 if np.array_equal(a, a.T) else x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift; None where it parts nothing or hits an eigenvalue."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-8 * n:
        return None
    basis = rng.standard_normal((n, k))
    for _ in range(3):
        basis = np.linalg.qr(projector @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    return whole[:, :k], whole[:, k:]


def eigen(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns; all by default.

    The polar factor of the matrix less a shift gives the projectors to the eigenvalues above and
    below it; each invariant subspace is split again until a block is diagonal to rounding.
    Subspaces that hold none of the wanted eigenvalues are left.
    """
    rng, whole = np.random.default_rng(7), np.linalg.norm(a)
    most = len(a) if most is None else min(most, len(a))

    def parts(a: np.ndarray, basis: np.ndarray, wanted: int):
        n, diagonal = len(a), np.diag(a)
        if n == 1 or np.linalg.norm(a - np.diag(diagonal)) <= _EPS * whole:
            order = np.argsort(-diagonal, kind="stable")[:wanted]
            return [(diagonal[order], basis[:, order])]
        spread = np.linalg.norm(a - diagonal.mean() * np.eye(n)) / np.sqrt(n)
        tries = [np.median(diagonal), diagonal.mean()] + [diagonal.mean() + spread * t for t in (0.11, -0.13, 0.37, -0.41, 0.71, -0.73)]
        found = next((f for f in (_split(a, t, rng) for t in tries) if f is not None), None)
        if found is None:  # alike to rounding
            order = np.argsort(-diagonal, kind="stable")[:wanted]
            return [(diagonal[order], basis[:, order])]
        out = []
        for side in found:
            if wanted > 0:
                block = side.T @ a @ side
                out += parts((block + block.T) / 2, basis @ side, wanted)
                wanted -= side.shape[1]
        return out

    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    found = parts((a + a.T) / 2, np.eye(len(a)), most)
    values, vectors = np.concatenate([v for v, _ in found]), np.hstack([q for _, q in found])
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order]
