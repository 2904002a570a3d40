"""Power law between rain rate and attenuation (ITU-R P.838-3) and wet-antenna curves."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of ITU-R P.838-3: (a, b, c) terms, slope m, offset q over x = log10(f / GHz).
ITU_K = {
    "H": (
        ((-5.33980, -0.10008, 1.13098), (-0.35351, 1.26970, 0.45400),
         (-0.23789, 0.86036, 0.15354), (-0.94158, 0.64552, 0.16817)),
        -0.18961, 0.71147,
    ),
    "V": (
        ((-3.80595, 0.56934, 0.81061), (-3.44965, -0.22911, 0.51059),
         (-0.39902, 0.73042, 0.11899), (0.50167, 1.07319, 0.27195)),
        -0.16398, 0.63297,
    ),
}
ITU_ALPHA = {
    "H": (
        ((-0.14318, 1.82442, -0.55187), (0.29591, 0.77564, 0.19822), (0.32177, 0.63773, 0.13164),
         (-5.37610, -0.96230, 1.47828), (16.1721, -3.29980, 3.43990)),
        0.67849, -1.95537,
    ),
    "V": (
        ((-0.07771, 2.33840, -0.76284), (0.56727, 0.95545, 0.54039), (-0.20238, 1.14520, 0.26809),
         (-48.2991, 0.791669, 0.116226), (48.5833, 0.791459, 0.116479)),
        -0.053739, 0.83433,
    ),
}

MIN_RATE = 0.1  # mm/h; smaller rates count as 0


def _bell_sum(f_ghz: str, terms, m: float, q: float) -> str:
    x = f"log10({f_ghz})"
    bells = " + ".join(f"({a}D) * exp(-power(({x} - ({b}D)) / ({c}D), 2))" for a, b, c in terms)
    return f"({bells} + ({m}D) * {x} + ({q}D))"


def kr_k(f_ghz: str, pol: str) -> Column:
    """Factor of the power law for the frequency (GHz) and polarisation columns."""
    h, v = _bell_sum(f_ghz, *ITU_K["H"]), _bell_sum(f_ghz, *ITU_K["V"])
    return F.expr(f"CASE WHEN {pol} = 'H' THEN power(10D, {h}) ELSE power(10D, {v}) END")


def kr_alpha(f_ghz: str, pol: str) -> Column:
    """Exponent of the power law for the frequency (GHz) and polarisation columns."""
    h, v = _bell_sum(f_ghz, *ITU_ALPHA["H"]), _bell_sum(f_ghz, *ITU_ALPHA["V"])
    return F.expr(f"CASE WHEN {pol} = 'H' THEN {h} ELSE {v} END")


def rain_rate(a: Column, k: Column, alpha: Column, length: Column) -> Column:
    """mm/h from the attenuation in dB along `length` km; NULL stays NULL."""
    r = F.pow(a / (k * length), F.lit(1.0) / alpha)
    return F.when(r < MIN_RATE, 0.0).otherwise(r)


# --- wet antenna -----------------------------------------------------------------------------

# Rain rates at which a wet-antenna curve is tabulated: 0, then 1e-10 to 1e3 mm/h in 510 even steps of the logarithm.
RATE_GRID = [0.0] + [10.0 ** (-10 + 13 * i / 510) for i in range(511)]


def pastorek_curve(amax: float, zeta: float, d: float) -> list[float]:
    """Wet-antenna attenuation at the grid rates."""
    return [amax * (1.0 - math.exp(-zeta * r**d)) for r in RATE_GRID]


def _water_index(f_hz: np.ndarray, t_kelvin: float) -> np.ndarray:
    """Complex refractive index of liquid water, double Debye model (Liebe et al. 1991)."""
    theta = 1.0 - 300.0 / t_kelvin
    e0 = 77.66 - 103.3 * theta
    e1, e2 = 0.0671 * e0, 3.52
    g1 = 20.20 + 146.4 * theta + 316.0 * theta**2
    g2 = 39.8 * g1
    f = f_hz / 1e9
    eps = e2 + (e1 - e2) / (1 - 1j * f / g2) + (e0 - e1) / (1 - 1j * f / g1)
    return np.sqrt(eps)


def leijnse_curve(
    f_ghz: float,
    t_kelvin: float = 293.0,
    gamma: float = 2.06e-5,
    delta: float = 0.24,
    n_antenna: complex = 1.73 + 0.014j,
    l_antenna: float = 0.001,
) -> list[float]:
    """Loss of a water film of thickness gamma*R^delta on an antenna cover (Leijnse et al. 2008).

    Transmission through the layers air | cover | water | air, relative to the dry cover.
    """
    f = f_ghz * 1e9
    wave = 2 * np.pi * f / 299_792_458.0
    n_water = complex(_water_index(np.array([f]), t_kelvin)[0])
    film = gamma * np.asarray(RATE_GRID) ** delta

    def transmission(thickness: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(np.eye(2, dtype=complex), (len(thickness), 2, 2))
        for n, d in ((n_antenna, np.full_like(thickness, l_antenna)), (n_water, thickness)):
            phase = wave * n * d
            layer = np.empty((len(thickness), 2, 2), dtype=complex)
            layer[:, 0, 0] = layer[:, 1, 1] = np.cos(phase)
            layer[:, 0, 1] = -1j * np.sin(phase) / n
            layer[:, 1, 0] = -1j * np.sin(phase) * n
            total = total @ layer
        return 2.0 / (total[:, 0, 0] + total[:, 0, 1] + total[:, 1, 0] + total[:, 1, 1])

    dry = np.abs(transmission(np.zeros(1)))[0]
    wet = np.abs(transmission(film))
    curve = 20.0 * np.log10(dry / wet)
    return [float(v) for v in np.maximum.accumulate(np.maximum(curve, 0.0))]


def waa_from_observed(a_obs: Column, kl: Column, alpha: Column, curve: Column) -> Column:
    """Wet-antenna part of an observed attenuation.

    The curve is tabulated over RATE_GRID (512 rates), the observed attenuation at rate r being
    kl*r^alpha + curve(r), which grows with r. The enclosing interval is found by halving the
    index range nine times and interpolated linearly, so no join is needed.
    """
    rates = F.array(*[F.lit(r) for r in RATE_GRID])

    def observed(i: Column) -> Column:
        return kl * F.pow(F.get(rates, i), alpha) + F.get(curve, i)

    steps = F.array(*[F.lit(1 << b) for b in range(8, -1, -1)])
    low = F.aggregate(
        steps,
        F.lit(0),
        lambda i, s: F.when(((i + s) < 511) & (observed(i + s) <= a_obs), i + s).otherwise(i),
    )

    def between(i: Column) -> Column:
        a0, a1 = observed(i), observed(i + 1)
        w0, w1 = F.get(curve, i), F.get(curve, i + 1)
        part = F.least(F.lit(1.0), (a_obs - a0) / (a1 - a0))
        return w0 + (w1 - w0) * part

    # One-element transform: the index is computed once and used in several places.
    value = F.get(F.transform(F.array(low), between), F.lit(0))
    return F.when(a_obs <= 0, 0.0).when(a_obs.isNotNull(), value)
