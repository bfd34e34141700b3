"""Leading eigenpairs of a symmetric matrix without negative eigenvalues, by contour integration.

Inertia counts (signs of the pivots of a symmetric factorisation of ``V - s I``) tell how many eigenvalues lie
above s; by them an interval is found that holds the leading ones. A circle through its ends is the
contour: the integral of ``(z I - V)^-1`` along it is the projector onto the eigenvectors of the
eigenvalues inside. Gauss quadrature of it takes one complex shifted solve per node. Projected
subspaces go through Rayleigh-Ritz, and round again until the residuals are at rounding level. A last
count verifies that no eigenvalue above the least one taken is missing.
"""

from __future__ import annotations

import numpy as np

NODES = 8
MOST_ROUNDS = 100
ROUNDS_EACH = 8
GAP_STEPS = 12
# Of the trace. Below, an eigenvalue counts as zero.
SMALLEST = 1e-12
_PIVOT = (1 + 17**0.5) / 8


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """Positive pivots of the factorisation of ``matrix - shift I`` with blocks of one and two rows."""
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        size = np.abs(rest)
        diagonal = size.diagonal().copy()
        one = int(diagonal.argmax())
        np.fill_diagonal(size, 0)
        pair = np.unravel_index(size.argmax(), size.shape)
        if diagonal[one] == 0 and size[pair] == 0:
            break
        picked = [one] if diagonal[one] >= _PIVOT * size[pair] else [int(i) for i in pair]
        others = np.delete(np.arange(len(rest)), picked)
        block = rest[np.ix_(picked, picked)]
        # A block of two has one eigenvalue of either sign.
        above += 1 if len(picked) == 2 or block[0, 0] > 0 else 0
        side = rest[np.ix_(others, picked)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(block, side.T)
        rest = (rest + rest.T) / 2
    return above


def _projected(matrix: np.ndarray, low: float, high: float, basis: np.ndarray) -> np.ndarray:
    """Quadrature over the upper half of the circle; the lower half is its conjugate."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(basis)
    for node, weight in zip(*np.polynomial.legendre.leggauss(NODES), strict=True):
        turn = np.exp(1j * np.pi / 2 * (1 - node))
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        out += weight / 2 * (radius * turn * np.linalg.solve(shifted, basis)).real
    return out


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, with vectors and residuals."""
    basis, _ = np.linalg.qr(basis)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1], basis @ turned[:, ::-1]
    return values, vectors, np.linalg.norm(matrix @ vectors - vectors * values, axis=0)


def _interval(matrix: np.ndarray, wanted: int, low: float, high: float) -> tuple[float, float, int]:
    """An interval with at least ``wanted`` of the greatest eigenvalues, and few more if they can be told apart.

    Its upper end lies close above the greatest one; its lower end between the least one inside and
    the next one outside, as the projector tells eigenvalues apart by their distance from the ends.
    """
    inside, top = eigenvalues_above(matrix, low), high
    least = low
    while high - least > 0.05 * (high - low):
        middle = (least + high) / 2
        if eigenvalues_above(matrix, middle):
            least = middle
        else:
            high = middle
    end = high
    while inside > wanted + wanted // 2 and end - low > 1e-9 * top:
        middle = (low + end) / 2
        count = eigenvalues_above(matrix, middle)
        if count >= wanted:
            low, inside = middle, count
        else:
            end = middle
    # From here up to ``same`` there is no eigenvalue.
    same, end = low, high
    for _ in range(GAP_STEPS):
        middle = (same + end) / 2
        if eigenvalues_above(matrix, middle) == inside:
            same = middle
        else:
            end = middle
    return (low + same) / 2, high, inside


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` of the greatest eigenvalues above zero, falling, and unit eigenvectors as columns."""
    size, trace = len(matrix), float(np.trace(matrix)) if len(matrix) else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((size, 0))
    matrix = matrix / trace
    wanted = min(most, eigenvalues_above(matrix, SMALLEST))
    bound = float(np.abs(matrix).sum(1).max()) * (1 + 1e-6)
    low, high, inside = _interval(matrix, wanted, SMALLEST, bound)
    random = np.random.default_rng(size)
    accuracy = 8 * np.finfo(float).eps * size**0.5
    width = min(size, 2 * inside + 4)
    basis = random.standard_normal((size, width))
    for rounds in range(1, MOST_ROUNDS + 1):
        values, vectors, residuals = _ritz(matrix, _projected(matrix, low, high, basis))
        if (residuals[:wanted] <= accuracy).all():
            # Ritz values lie within their residuals of eigenvalues; as many as counted means none is missing.
            least = values[wanted - 1] - 1e-10
            if eigenvalues_above(matrix, least) == int((values > least).sum()):
                signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(width)])
                return values[:wanted] * trace, (vectors * signs)[:, :wanted]
        basis = vectors
        if rounds % ROUNDS_EACH == 0 and width < size:
            # Eigenvalues that lie too close to tell apart need a larger subspace, of all of them if need be.
            more = min(size, 2 * width) - width
            basis, width = np.hstack([vectors, random.standard_normal((size, more))]), width + more
    raise ArithmeticError("the leading eigenvalues did not settle")
