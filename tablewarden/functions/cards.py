"""Card numbers, salted tokens and masked display.

A salted fast hash is weaker than a slow password hash for low-entropy input,
so a token may have a cost: the hash is taken again that many times, and the
number stands in the token, so that it can be raised later. The pepper is a job
secret, passed in and never written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a generated number is 4 followed by a 15-digit number from this range
_LOW, _SPAN = 10**14, 9 * 10**14


def card_number(draw: Column | None = None) -> Column:
    """16 digits starting with 4; ``draw`` is a whole number, random by default."""
    if draw is None:
        draw = F.floor(F.rand() * _SPAN)
    body = (F.pmod(draw, F.lit(_SPAN)) + _LOW).cast("bigint").cast("string")
    return F.concat(F.lit("4"), F.lpad(body, 15, "0"))


def _hashed(number: Column, pepper: str, salt: Column, cost: Column | int) -> Column:
    """The hash of a number, taken again ``cost`` times over itself, pepper and salt.

    Folded by a built-in function, so the work is the JVM's and no row goes
    through Python; about a microsecond for each time.
    """
    rounds = F.lit(cost) if isinstance(cost, int) else cost
    first = F.sha2(F.concat(F.lit(pepper), salt, number), 256)
    # a sequence up to nothing would count down
    times = F.when(rounds > 0, F.sequence(F.lit(1), F.greatest(rounds, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(times, first, lambda h, _: F.sha2(F.concat(h, F.lit(pepper), salt), 256))


def card_token(number: Column, pepper: str, salt: Column | None = None, cost: int = 0) -> Column:
    """``salt$hash``, or ``salt$cost$hash`` with a cost. With the default random salt, write the result once."""
    if cost < 0:
        raise ValueError("a cost is zero or more")
    if salt is None:
        salt = F.replace(F.uuid(), F.lit("-"), F.lit(""))

    def token(s: Column) -> Column:
        if not cost:
            return F.concat(s, F.lit("$"), F.sha2(F.concat(F.lit(pepper), s, number), 256))
        return F.concat(s, F.lit(f"${cost}$"), _hashed(number, pepper, s, cost))

    # the salt is bound once, so the stored one is the hashed one
    return F.transform(F.array(salt), token)[0]


def token_cost(token: Column) -> Column:
    """The cost a token was made with; 0 for one without."""
    parts = F.split(token, r"\$")
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1)).try_cast("int")).when(F.size(parts) == 2, 0)


def matches(token: Column, number: Column, pepper: str) -> Column:
    """Whether a token was made from a number, whatever its cost; false for what is no token."""
    salt = F.substring_index(token, "$", 1)
    made = _hashed(number, pepper, salt, F.coalesce(token_cost(token), F.lit(0)))
    same = F.substring_index(token, "$", -1) == made
    return F.when(token.isNotNull() & number.isNotNull(), same & token_cost(token).isNotNull())


def raised(token: Column, number: Column, pepper: str, cost: int, salt: Column | None = None) -> Column:
    """A token of at least ``cost`` for a number that its token matches; any other token stays as it is.

    A number is at hand when a customer shows it, which is when a stored token
    can be made anew; a token alone cannot.
    """
    weak = matches(token, number, pepper) & (token_cost(token) < cost)
    return F.when(weak, card_token(number, pepper, salt, cost)).otherwise(token)


def masked(token: Column, shown: int = 29) -> Column:
    return F.concat(F.left(token, F.lit(shown)), F.lit("..."))
