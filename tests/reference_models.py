"""The forecast models by numpy, which the library's native ones are held against."""

from __future__ import annotations

import numpy as np

# Autoregressive order after one difference, Fourier orders, seasonal prior scale, interval.
AR_ORDER = 5
YEARLY = (365.25, 10)
WEEKLY = (7.0, 3)
SEASONAL_PRIOR = 10.0
INTERVAL_Z = 1.2815515655446004  # 80 % of a normal distribution lies within +- z
# Share of the series scale below which noise is not resolved; keeps short series solvable.
NOISE_FLOOR = 1e-3


def fit_autoregressive(y: np.ndarray, horizon: int, order: int = AR_ORDER) -> np.ndarray:
    """Forecast of an AR model on the first difference, without constant, by conditional least squares."""
    z = np.diff(y)
    if len(z) <= order or not np.isfinite(z).all():
        return np.full(horizon, np.nan)
    lags = np.column_stack([z[order - k : len(z) - k] for k in range(1, order + 1)])
    weights = np.linalg.lstsq(lags, z[order:], rcond=None)[0]
    recent = list(z[-1 : -order - 1 : -1])
    steps = []
    for _ in range(horizon):
        step = float(np.dot(weights, recent))
        steps.append(step)
        recent = [step, *recent[:-1]]
    return y[-1] + np.cumsum(steps)


def _seasonal_design(days: np.ndarray, origin: float, span: float) -> np.ndarray:
    columns = [np.ones_like(days), (days - origin) / span]
    for period, order in (YEARLY, WEEKLY):
        for k in range(1, order + 1):
            angle = 2 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def fit_seasonal(days: np.ndarray, y: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend plus yearly and weekly Fourier terms by ridge regression, with an 80 % interval."""
    known = np.isfinite(y)
    days_known, y_known = days[known].astype(float), y[known]
    nothing = np.full(horizon, np.nan)
    if len(y_known) < 2:
        return nothing, nothing, nothing
    scale = np.abs(y_known).max() or 1.0
    origin, span = days_known[0], max(days_known[-1] - days_known[0], 1.0)
    design = _seasonal_design(days_known, origin, span)
    target = y_known / scale
    trend = design[:, :2]
    noise = np.std(target - trend @ np.linalg.lstsq(trend, target, rcond=None)[0])
    # Only the seasonal terms are held back by their prior; the trend is free.
    penalty = np.full(design.shape[1], max(noise, NOISE_FLOOR) / SEASONAL_PRIOR)
    penalty[: trend.shape[1]] = 0.0
    weights = np.linalg.lstsq(
        np.vstack([design, np.diag(penalty)]), np.concatenate([target, np.zeros(len(penalty))]), rcond=None
    )[0]
    spread = INTERVAL_Z * np.std(target - design @ weights) * scale
    ahead = _seasonal_design(days[-1] + np.arange(1.0, horizon + 1), origin, span) @ weights * scale
    return ahead, ahead - spread, ahead + spread
