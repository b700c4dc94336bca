"""Eigenvectors of a symmetric matrix by spectral divide and conquer.

The polar factor of ``A - shift`` (QDWH: dynamically weighted Halley iteration) has
eigenvalue 1 where ``A`` lies above the shift and -1 below, so half of it plus one is the
projector on the upper invariant subspace. Bases of that subspace and its complement
split ``A`` into two smaller matrices, which are split in turn down to single components.
No other eigen or singular value solver is used.
"""

import numpy as np

_EPS = np.finfo(float).eps
_SHIFTS = 12


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric, non-singular matrix."""
    x = a / np.linalg.norm(a)
    # The least singular value, from below.
    least = min(1.0, max(1.0 / np.linalg.norm(np.linalg.inv(x)), _EPS))
    unit = np.eye(len(a))
    for _ in range(30):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, unit]))[0]
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:len(a)] @ q[len(a):].T)
        else:
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(unit + wc * (x.T @ x), x.T).T
        x = (x + x.T) / 2
        least = min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if abs(1 - least) < 10 * _EPS and np.linalg.norm(x - before) < np.cbrt(5 * _EPS):
            return x
    return x


def split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if one is empty."""
    try:
        projector = (polar(a - shift * np.eye(len(a))) + np.eye(len(a))) / 2
    except np.linalg.LinAlgError:
        return None
    size = int(round(float(np.trace(projector))))
    if not 0 < size < len(a):
        return None
    basis = projector @ rng.standard_normal((len(a), size))
    basis = projector @ np.linalg.qr(basis)[0]
    q = np.linalg.qr(np.hstack([basis, rng.standard_normal((len(a), len(a) - size))]))[0]
    above, below = q[:, :size], q[:, size:]
    loose = np.linalg.norm(below.T @ a @ above)
    return (above, below) if loose <= 50 * len(a) * _EPS * np.linalg.norm(a) else None


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; the largest entry of each is positive."""
    a = (a + a.T) / 2
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    rng = np.random.default_rng(0)
    scale = np.linalg.norm(a)
    found: list[np.ndarray] = []
    todo = [(a, np.eye(len(a)))]
    while todo:
        block, basis = todo.pop()
        centre = np.trace(block) / len(block)
        spread = np.linalg.norm(block - centre * np.eye(len(block)))
        if len(block) == 1 or spread <= len(block) * _EPS * scale:
            found.extend(basis.T)  # one component, or equal ones: any basis will do
            continue
        parts = None
        for turn in range(_SHIFTS):
            # The mean has eigenvalues on both sides; later tries move off an eigenvalue that it hit.
            shift = float(np.median(np.diag(block))) if turn == 0 else centre + spread * rng.uniform(-1, 1) * (turn - 1) / 20
            parts = split(block, shift, rng)
            if parts:
                break
        if parts is None:
            raise np.linalg.LinAlgError("no shift splits the matrix")
        for part in parts:
            own = part.T @ block @ part
            todo.append(((own + own.T) / 2, basis @ part))
    vectors = np.array(found).T
    for _ in range(2):
        values, vectors = refined(a, vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(len(values))] < 0, -1.0, 1.0)


def refined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One Newton step on the rounding that the splits left, by first-order perturbation."""
    loose = np.eye(len(a)) - vectors.T @ vectors
    turned = vectors.T @ a @ vectors
    values = np.diag(turned) / (1 - np.diag(loose))
    gap = values[None, :] - values[:, None]
    near = np.abs(gap) <= 1e3 * len(a) * _EPS * np.linalg.norm(a)
    step = np.where(near, loose / 2, (turned + values[None, :] * loose) / np.where(near, 1.0, gap))
    return values, vectors + vectors @ step
