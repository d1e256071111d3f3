"""Column functions: code and text normalisation, distances, hash buckets, source categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
# State abbreviations and their two-digit codes.
STATES = {
    "RO": "11", "AC": "12", "AM": "13", "RR": "14", "PA": "15", "AP": "16", "TO": "17", "MA": "21", "PI": "22", "CE": "23", "RN": "24", "PB": "25", "PE": "26", "AL": "27",
    "SE": "28", "BA": "29", "MG": "31", "ES": "32", "RJ": "33", "SP": "35", "PR": "41", "SC": "42", "RS": "43", "MS": "50", "MT": "51", "GO": "52", "DF": "53",
}
BOUNDS = {"latitude": (-34.0, 5.5), "longitude": (-74.0, -28.0)}


def digits(column: Column, length: int) -> Column:
    """The digits of a value if there are exactly so many, else null."""
    only = F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), r"\D", "")
    return F.when(F.length(only) == length, only)


def postal_code(column: Column) -> Column:
    return digits(column, 8)


def municipality_code(column: Column) -> Column:
    return digits(column, 7)


def clean_text(column: Column) -> Column:
    """Without white space (Unicode's) at the ends; null if nothing is left."""
    return F.nullif(F.regexp_replace(column.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def address_class(street: Column, neighborhood: Column) -> Column:
    known = F.coalesce(F.nullif(street, F.lit("")), F.nullif(neighborhood, F.lit(""))).isNotNull()
    return F.when(known, "urban_address_proxy").otherwise("rural_or_general_address_proxy")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance."""
    h = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(h))


def source_category(source: Column) -> Column:
    return F.trim(F.substring_index(source, ":", 1))


def valid_category(category: Column) -> Column:
    return category.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,63}$")


def hash_bucket(key: Column, modulus: int) -> Column:
    """First eight bytes of the key's SHA-256, as an unsigned number, modulo modulus."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(modulus)).cast("int")


def in_bounds(latitude: Column, longitude: Column) -> Column:
    return latitude.between(*BOUNDS["latitude"]) & longitude.between(*BOUNDS["longitude"])


def state_code(uf: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in STATES.items() for x in pair)), uf)


def valid_digest(column: Column) -> Column:
    return column.rlike("^sha256:[0-9a-f]{64}$")


def evidence_key(evidence_id: Column, code: Column, latitude: Column, longitude: Column, source: Column) -> Column:
    return F.coalesce(evidence_id, F.concat_ws("|", code, F.format_string("%.7f", latitude), F.format_string("%.7f", longitude), source))


def float_hex(value: Column) -> Column:
    """A double in hexadecimal: 13 digits, signed exponent; zero as 0x0.0p+0. Not code-generated: for digests only."""
    java = F.reflect(F.lit("java.lang.Double"), F.lit("toHexString"), value)
    part = lambda i: F.regexp_extract(java, r"^(-?0x[01])\.([0-9a-f]+)p(-?)([0-9]+)$", i)
    fraction = F.when(value == 0, F.lit("0")).otherwise(F.rpad(part(2), 13, "0"))
    return F.concat(part(1), F.lit("."), fraction, F.lit("p"), F.when(part(3) == "", "+").otherwise("-"), part(4))


def round_exact(value: Column, digits: int) -> Column:
    """Round a double's exact binary value to decimal digits, halves to even, as Python does; Spark's own functions round
    its shortest decimal notation. The product with 10 ** digits and its error are exact (split by 2 ** 27 + 1), so the
    side of a tie is known. Beyond 2 ** 51 / 10 ** digits, where doubles lie wider apart, Spark's rounding stays."""
    scale = float(10**digits)
    halves = lambda c: ((c * F.lit(134217729.0)) - ((c * F.lit(134217729.0)) - c))
    s, size = F.lit(scale), F.abs(value)
    high_s = scale * 134217729.0 - (scale * 134217729.0 - scale)
    low_s = scale - high_s
    high = halves(size)
    low = size - high
    product = size * s
    error = ((high * F.lit(high_s) - product) + high * F.lit(low_s) + low * F.lit(high_s)) + low * F.lit(low_s)
    whole = F.floor(product).cast("double")
    side = ((product - whole) - F.lit(0.5)) + error
    # a product just below a whole number may have been rounded up to it: then side is near -0.5 and whole is right all the same
    rounded = F.when(side > 0, whole + 1).when(side < 0, whole).otherwise(whole + whole % 2)
    own = F.when(size < F.lit(2.0**51 / scale), rounded / s).otherwise(F.bround(size, digits))
    return F.when(value < 0, -own).otherwise(own)
