"""Small SQL builders shared by the oracle queries."""


def ratio(num: str, den: str, digits: int) -> str:
    """num/den of whole numbers, rounded half away from zero, as double."""
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    return (
        f"(case when {d} = 0 then null else "
        f"cast(sign({n}) * sign({d}) * ((abs({n}) * {2 * 10**digits} + abs({d})) // (2 * abs({d}))) as double)"
        f" / {10**digits} end)"
    )


def mean(value: str, scale: int, digits: int, over: str = "") -> str:
    """Rounded mean of a decimal column of the given scale."""
    whole = f"cast({value} * {10**scale} as bigint)"
    return ratio(f"sum({whole}) {over}", f"nullif(count({value}) {over}, 0) * {10**scale}", digits)


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
