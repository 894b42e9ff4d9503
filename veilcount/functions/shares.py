"""Secret shares over the prime field 2^31 - 1, as column expressions on BIGINT.

Products stay below 2^62, so ``%`` is exact. This models the data flow of threshold reporting for analytics and tests.
It makes no security claim.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilcount.functions.once import once

PRIME = 2**31 - 1
LIMBS = 8


def _p() -> Column:
    return F.lit(PRIME).cast("bigint")


def _big(number: int) -> Column:
    return F.lit(number).cast("bigint")


def share_point(msg_id: Column) -> Column:
    """The x of a message's shares, in 1..p-1."""
    return F.pmod(F.xxhash64(msg_id), _big(PRIME - 1)) + _big(1)


def key_limbs(tag: Column, secret: str) -> Column:
    """The shared secret of a tag. It does not depend on the threshold, so all classes of a tag have one key."""
    digest = F.sha2(F.concat(F.hex(tag), F.lit(f"/{secret}/key")), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * j + 1, 8), 16, 10).cast("bigint") % _p() for j in range(LIMBS)])


def key_of_limbs(limbs: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(limbs.cast("array<string>"), ","), 256))


def class_seed(tag: Column, threshold: Column, secret: str) -> Column:
    """The number that the coefficients of a class come from."""
    return F.xxhash64(tag, threshold, F.lit(secret))


def share_values(tag: Column, threshold: Column, x: Column, secret: str) -> Column:
    """One y per limb: a polynomial of degree threshold-1 whose constant term is the limb.

    ``polynomials.share_values`` gives the same for many messages at once.
    """
    seed = class_seed(tag, threshold, secret)
    degrees = F.sequence(threshold.cast("int") - 1, F.lit(1), F.lit(-1))

    def values(given: Column) -> Column:
        def value(limb: Column, number: Column) -> Column:
            def step(acc: Column, i: Column) -> Column:
                return (acc + F.pmod(F.xxhash64(given["seed"], i, number), _p())) * given["x"] % _p()

            return (F.aggregate(given["degrees"], _big(0), step) + limb) % _p()

        return F.transform(given["limbs"], value)

    limbs = key_limbs(tag, secret)
    return once(
        F.struct(seed.alias("seed"), x.alias("x"), degrees.alias("degrees"), limbs.alias("limbs")), values
    )


def _inverse(number: Column) -> Column:
    """number^(p-2), by squaring along the bits of the exponent."""
    bits = F.array(*[F.lit(b == "1") for b in bin(PRIME - 2)[2:]])
    return F.aggregate(
        bits, _big(1), lambda acc, bit: (acc * acc % _p()) * F.when(bit, number).otherwise(_big(1)) % _p()
    )


def secret_at_zero(shares: Column) -> Column:
    """The limbs that the shares, an array of (x, y) with different x, interpolate at 0."""
    product = F.aggregate(shares, _big(1), lambda acc, s: acc * s["x"] % _p())

    def differences(own: Column) -> Column:
        return F.aggregate(
            shares,
            own["x"],
            lambda acc, s: F.when(s["x"] == own["x"], acc).otherwise(acc * F.pmod(s["x"] - own["x"], _p()) % _p()),
        )

    divided = F.transform(shares, lambda s: F.struct(differences(s).alias("d"), s["y"].alias("y")))
    weighted = F.transform(divided, lambda s: F.struct(_inverse(s["d"]).alias("w"), s["y"].alias("y")))

    def limbs(given: Column) -> Column:
        def limb(j: Column) -> Column:
            total = F.aggregate(given["terms"], _big(0), lambda acc, s: (acc + s["w"] * F.get(s["y"], j)) % _p())
            return total * given["product"] % _p()

        return F.transform(F.sequence(F.lit(0), F.lit(LIMBS - 1)), limb)

    return once(F.struct(weighted.alias("terms"), product.alias("product")), limbs)
