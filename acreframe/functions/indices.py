"""Spectral indices of bands scaled by 10000."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acreframe.functions.numbers import ratio, valid

#: The two bands of each index.
BANDS = {
    "evi2": ("nir", "red"), "ndvi": ("nir", "red"), "gcvi": ("nir", "green"), "savi": ("nir", "red"), "msavi": ("nir", "red"),
    "ndmi": ("nir", "swir1"), "ndwi": ("nir", "green"), "nbr": ("nir", "swir2"), "kndvi": ("nir", "red"), "wi": ("swir1", "red"),
}
PLAIN = ("nir", "swir1", "swir2", "red", "green", "blue")


def spectral_index(name: str, compat: bool = False) -> Column:
    """The index from columns named as the bands, null where a band isn't valid.

    gcvi is nir / green - 1 and msavi the closed form; compat gives gcvi as a normalised difference.
    """
    if name in PLAIN:
        return valid(name, above=None)
    if name not in BANDS:
        raise ValueError(f"unknown index {name}")
    n, b = (valid(x, above=None).cast("double") for x in BANDS[name])
    difference = ratio(n - b, n + b + 1e-9)
    if name == "evi2":
        return 10000 * ratio(2.5 * (n - b) / 10000, n / 10000 + 1 + 2.4 * b / 10000)
    if name == "savi":
        return 10000 * ratio(1.5 * (n - b), n + b + 0.5)
    if name == "msavi":
        r = 2 * n / 10000 + 1
        return 10000 * (r - F.sqrt(r * r - 8 * (n - b) / 10000)) / 2
    if name == "wi":
        return F.when(n + b > 5000, F.lit(1.0)).otherwise(10000 * (1 - (n + b) / 5000))
    if name == "kndvi":
        return 10000 * F.tanh(difference * difference)
    if name == "gcvi" and not compat:
        return 10000 * (ratio(n, b) - 1)
    return 10000 * (-difference if name == "ndwi" else difference)


def whole_ndvi() -> Column:
    """ndvi as a whole number, cut towards zero."""
    return spectral_index("ndvi").cast("int")
