from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard.constants import EARTH_RADIUS_KM


def haversine_km(lat_a, lon_a, lat_b, lon_b) -> Column:
    """Great-circle distance in km between two points in degrees; null if any input is null."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_phi = (phi_b - phi_a) / 2
    half_lambda = (F.radians(lon_b) - F.radians(lon_a)) / 2
    chord = F.pow(F.sin(half_phi), 2) + F.cos(phi_a) * F.cos(phi_b) * F.pow(F.sin(half_lambda), 2)
    # Rounding can push the chord of antipodal points past 1; null still gives null through
    # the first argument.
    rest = F.greatest(F.lit(0.0), 1.0 - chord)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(rest))
