"""Logistic regression on sparse rows, for samples of bounded size."""

import numpy as np


Chunk = tuple[np.ndarray, np.ndarray | None, np.ndarray]


def fit_converged(
    chunks: list[Chunk],
    y: np.ndarray,
    share: np.ndarray,
    scale: np.ndarray,
    intercept: float,
    l2: float,
    tolerance: float,
    most_rounds: int = 50,
    most_steps: int = 100,
) -> tuple[np.ndarray, float, float]:
    """Weights, intercept and the largest entry of the gradient, by Newton's method with conjugate gradients.

    A chunk holds rows one after the other: the columns of their entries, the entries (None: all ones), and how many
    each row has, none of them 0. Every column is multiplied by its `scale`. `y` and `share` are those of all rows in
    order; `share` weighs the rows and sums to one. The same input gives the same result.

    It ends when no entry of the gradient, that of the intercept included, exceeds `tolerance`, or when no step lowers
    the loss in double precision; at most `most_rounds` rounds of `most_steps` passes over the rows. Besides the
    input, memory is that of some weights and of the largest chunk.
    """
    first = np.cumsum([0, *(len(lengths) for _, _, lengths in chunks)])
    rows = [slice(a, b) for a, b in zip(first, first[1:])]
    starts = [np.cumsum(lengths) - lengths for _, _, lengths in chunks]

    def margins(weight: np.ndarray, constant: float) -> np.ndarray:
        scaled, found = weight * scale, np.empty(len(y))
        for (at, values, _), part, begin in zip(chunks, rows, starts):
            entries = scaled[at] if values is None else scaled[at] * values
            found[part] = constant + np.add.reduceat(entries, begin)
        return found

    def pulled(errors: np.ndarray) -> np.ndarray:
        total = np.zeros(len(scale))
        for (at, values, lengths), part in zip(chunks, rows):
            pull = np.repeat(errors[part], lengths)
            total += np.bincount(at, weights=pull if values is None else pull * values, minlength=len(scale))
        return total * scale

    def loss(margin: np.ndarray, weight: np.ndarray) -> float:
        return float((share * (np.logaddexp(0, margin) - y * margin)).sum() + l2 / 2 * (weight @ weight))

    # The intercept is the last entry of steps and gradients.
    weight, margin = np.zeros(len(scale)), np.full(len(y), float(intercept))
    now = loss(margin, weight)
    for left in range(most_rounds, -1, -1):
        chance = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        errors = share * (chance - y)
        slope = np.append(pulled(errors) + l2 * weight, errors.sum())
        largest = float(np.abs(slope).max())
        if largest <= tolerance or not left:
            break
        curve = share * chance * (1 - chance)
        step, rest = np.zeros(len(slope)), -slope
        along, size = rest, float(rest @ rest)
        goal = size * min(0.25, np.sqrt(size))
        for _ in range(most_steps):
            bent = curve * margins(along[:-1], along[-1])
            turned = np.append(pulled(bent) + l2 * along[:-1], bent.sum())
            length = float(along @ turned)
            if length <= 0:
                break
            step = step + size / length * along
            rest = rest - size / length * turned
            size, before = float(rest @ rest), size
            if size <= goal:
                break
            along = rest + size / before * along
        moved, down, part = margins(step[:-1], step[-1]), float(slope @ step), 1.0
        while (then := loss(margin + part * moved, weight + part * step[:-1])) > now + 1e-4 * part * down and part > 1e-9:
            part /= 2
        if not then < now:
            break
        weight, intercept, margin, now = weight + part * step[:-1], intercept + part * step[-1], margin + part * moved, then
    return weight, float(intercept), largest
