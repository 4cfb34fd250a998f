"""Money and ratios.

Doubles are the surface type. Sums are exact, so that totals (and ranks over them) do not depend on the order in which tasks
finish. An amount goes by its size into one of two decimals, with all its digits in either: one below 1e11 with fifteen
decimals, a larger one with the six that a double of that size can have. Both sums are put together once, at the end. Junk
of 1e27 and more, or infinity, is summed beside them as doubles.
"""

from pyspark.sql import Column, DataFrame, functions as F

from risklake.functions.parse import LONG_MAX

# Where the decimals change, and what the first one can hold of a product.
NEAR, FAR, HELD = 1e11, 1e27, 10**18
#: names of the three parts of a sum
PARTS = ("", "_longe", "_alem")


def parts(amount: Column) -> list[Column]:
    """The amount in one of three columns: below 1e11, larger, or too large for a decimal. The others are NULL."""
    size = F.abs(amount)
    return [
        F.when(size < NEAR, amount.cast("decimal(26,15)")),
        F.when((size >= NEAR) & (size < FAR), amount.cast("decimal(33,6)")),
        F.when(size >= FAR, amount),
    ]


def product(columns: list[Column], times: Column) -> list[Column]:
    """``parts``, or sums of them, ``times`` a count in decimal(20,0). What grows past the first decimal goes into the second."""
    near, far, beyond = columns
    once = times == F.lit(1).cast("decimal(20,0)")  # nearly always
    whole = F.floor(near)
    rest = (near - whole).cast("decimal(15,15)") * times
    whole = whole * times
    held, zero = F.abs(whole) < F.lit(HELD), F.lit(0).cast("decimal(38,6)")
    second = F.when(~held, whole.cast("decimal(38,6)") + rest.cast("decimal(38,6)"))
    both = (F.coalesce(far * times, zero) + F.coalesce(second, zero)).cast("decimal(38,6)")
    return [
        F.when(once, near.cast("decimal(37,15)")).when(held, (whole.cast("decimal(35,15)") + rest).cast("decimal(37,15)")),
        F.when(once, far.cast("decimal(38,6)")).when(far.isNotNull() | ~held, both),
        beyond * times.cast("double"),
    ]


def sums(name: str, columns: list[Column]) -> list[Column]:
    """Aggregates of ``parts``, named after ``name``."""
    return [F.sum(column).alias(name + part) for column, part in zip(columns, PARTS)]


def summed(name: str) -> list[Column]:
    """The columns that ``sums`` has made."""
    return [F.col(name + part) for part in PARTS]


def multiplied(df: DataFrame, name: str, times: Column) -> DataFrame:
    """``df`` with the sums named ``name`` ``times`` a count. Columns of their own keep the expressions over them small."""
    return df.withColumns({name + part: c for part, c in zip(PARTS, product(summed(name), times))})


def total(columns: list[Column]) -> Column:
    """Double total of the sums of ``parts``; NULL if all are."""
    near, far, beyond = columns
    first, zero = F.coalesce(near, F.lit(0).cast("decimal(38,15)")), F.lit(0.0)
    # a sum that has come down again is put together with all its digits
    fine = far.try_cast("decimal(37,15)")
    whole = F.when(fine.isNotNull(), (first + fine).cast("double")).otherwise((first.cast("decimal(38,6)") + far).cast("double"))
    exact = F.when(far.isNull(), near.cast("double")).otherwise(whole)
    return F.when(beyond.isNull(), exact).otherwise(F.coalesce(exact, zero) + beyond)


def count_of(product: Column) -> Column:
    """Count from a product of counts, made as a decimal. One past the long range raises: no view shows a wrong number."""
    fits = product <= F.lit(LONG_MAX)
    failure = F.raise_error(F.concat(F.lit("count past the long range: "), product.cast("string"))).cast("long")
    return F.when(product.isNull() | fits, F.when(fits, product).cast("long")).otherwise(failure)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up; NULL for a zero whole."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)
