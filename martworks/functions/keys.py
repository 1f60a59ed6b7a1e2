"""Key-generating Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the X.500 namespace of RFC 4122.
X500_NAMESPACE = "6ba7b814-9dad-11d1-80b4-00c04fd430c8"


def uuid5_digest(name: Column | str, namespace: str = X500_NAMESPACE) -> Column:
    """SHA-1 of namespace and name, as hex text: what a version-5 UUID is cut out of."""
    name = F.col(name) if isinstance(name, str) else name
    return F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name.cast("string"), "UTF-8")))


def uuid5_of_digest(digest: Column) -> Column:
    """The 36 characters of the UUID; null for a null digest."""
    # The variant takes the two top bits of the 17th digit: 8, 9, a or b, repeating every four digits.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4),
        F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3),
        F.lit("-"), F.substring(digest, 21, 12),
    )


def uuid5(name: Column | str, namespace: str = X500_NAMESPACE) -> Column:
    """Name-based UUID (version 5) of a string column; null for a null name.

    Generated code computes the repeated digest once. Inside a lambda, which is interpreted, compute the
    digest in a step of its own.
    """
    return uuid5_of_digest(uuid5_digest(name, namespace))


def link_uuid5(*uuids: Column | str) -> Column:
    """Key of a link: UUID v5 of its members' UUID strings, concatenated."""
    return uuid5(F.concat(*[F.col(u) if isinstance(u, str) else u for u in uuids]))


def row_hash(*cols: str) -> Column:
    """64-bit hash of several columns; compare the columns too where a collision would matter."""
    return F.xxhash64(*cols)


def text_key(*cols: Column | str) -> Column:
    """SHA-1 of the columns joined by '|': a key other engines can reproduce."""
    return F.sha1(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))
