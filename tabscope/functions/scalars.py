"""Column expressions: names, labels, numeric cleaning and port categories. All run in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
UNSAFE_NAME_CHARACTERS = r'[<>:"/\\|?*() ]'
UNSAFE_PATH_CHARACTERS = r"[ /\\]"
BENIGN_WORDS = ("benign", "normal")
LARGEST_DOUBLE = 1.7976931348623157e308
LAST_WELL_KNOWN_PORT = 1023
LAST_REGISTERED_PORT = 49151
LAST_PORT = 65535
WEB_PORTS = (80, 443, 8080, 8443)
EMAIL_PORTS = (25, 465, 587, 110, 143, 993, 995)
FILE_TRANSFER_PORTS = (20, 21, 22, 69)
DNS_PORTS = (53,)
SIMPLE_WEB_PORTS = (80, 443, 8080)
SIMPLE_SECURE_PORTS = (443, 22, 993, 995)


def quoted(name: str) -> str:
    """Column name safe for ``F.col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def sanitize_name(name: Column) -> Column:
    """Replace unsafe characters by ``_``, collapse runs of ``_`` and strip them at both ends."""
    replaced = F.regexp_replace(name, UNSAFE_NAME_CHARACTERS, "_")
    return F.btrim(F.regexp_replace(replaced, "_+", "_"), F.lit("_"))


def sanitize_path(name: Column) -> Column:
    """The weaker rule for plot names: only blanks and slashes become ``_``."""
    return F.regexp_replace(name, UNSAFE_PATH_CHARACTERS, "_")


def encode_label(label: Column, benign: str = "Benign") -> Column:
    """0 for the benign class, 1 for anything else (a missing label counts as 1)."""
    return F.when(label == benign, 0).otherwise(1)


def encode_label_tolerant(label: Column, numeric: bool) -> Column:
    """Numeric labels: 0 stays 0, the rest is 1. Text labels: benign words in any case are 0."""
    if numeric:
        return F.when(label == 0, 0).otherwise(1)
    return F.when(F.lower(label).isin(*BENIGN_WORDS), 0).otherwise(1)


def encode_label_strict(label: Column, mapping: dict[str, int]) -> Column:
    """Code from ``mapping``; a label outside it becomes null."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[label]


def finite(value: Column, largest: float = LARGEST_DOUBLE) -> Column:
    """NaN becomes 0 and the infinities become the largest finite value of their sign; null stays."""
    bounded = F.greatest(F.least(value, F.lit(largest)), F.lit(-largest))
    # least and greatest skip nulls, so a missing value is set aside first.
    return F.when(value.isNull(), F.lit(None)).when(F.isnan(value), F.lit(0.0)).otherwise(bounded)


def fill_zero(value: Column) -> Column:
    """Null and NaN become 0."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def digest(seed: int, keys: Sequence[str]) -> Column:
    """Hex digest of the seed and a row's key: the source of every random choice.

    It depends on nothing but the key, so a choice repeats under any partitioning or retry.
    """
    return F.md5(F.concat_ws("_", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def normalized_difference(a: Column, b: Column) -> Column:
    """|a-b| over the larger magnitude (at least 1); 0 when both are close to 0."""
    scale = F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    tiny = (F.abs(a) <= 0.0001) & (F.abs(b) <= 0.0001)
    return F.when(tiny, F.lit(0.0)).otherwise(F.abs(a - b) / scale)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def _any_of(port: Column, ports: Iterable[int]) -> Column:
    return _flag(port.isin(*ports))


def port_flags(port: Column, name: str) -> list[Column]:
    """Seven 0/1 columns of one port: three ranges and four service families."""
    return [
        _flag(port <= LAST_WELL_KNOWN_PORT).alias(f"{name}_well_known"),
        _flag((port > LAST_WELL_KNOWN_PORT) & (port <= LAST_REGISTERED_PORT)).alias(f"{name}_registered"),
        _flag(port > LAST_REGISTERED_PORT).alias(f"{name}_dynamic"),
        _any_of(port, WEB_PORTS).alias(f"{name}_web"),
        _any_of(port, EMAIL_PORTS).alias(f"{name}_email"),
        _any_of(port, FILE_TRANSFER_PORTS).alias(f"{name}_file_transfer"),
        _any_of(port, DNS_PORTS).alias(f"{name}_dns"),
    ]


def port_category(port: Column, name: str) -> list[Column]:
    """Range number 0/1/2 (null outside 0..65535) with a web and a secure flag."""
    category = (
        F.when((port < 0) | (port > LAST_PORT), None)
        .when(port <= LAST_WELL_KNOWN_PORT, 0)
        .when(port <= LAST_REGISTERED_PORT, 1)
        .when(port <= LAST_PORT, 2)
    )
    return [
        category.alias(f"{name}_category"),
        _any_of(port, SIMPLE_WEB_PORTS).alias(f"{name}_is_web"),
        _any_of(port, SIMPLE_SECURE_PORTS).alias(f"{name}_is_secure"),
    ]
