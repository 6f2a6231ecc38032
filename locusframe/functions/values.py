"""Tolerant parsing of text cells.

ANSI mode is on by default, so every conversion goes through ``try_cast``; the
regular expressions keep Java-only spellings such as ``1d`` or ``5f`` out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
FLOAT_WORD_PATTERN = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def to_int(text: Column) -> Column:
    """Whole number or null."""
    return F.when(text.rlike(INT_PATTERN), F.trim(text).try_cast("bigint"))


def to_float(text: Column) -> Column:
    """Number or null; ``nan`` and ``inf`` words are numbers."""
    ok = text.rlike(FLOAT_PATTERN) | text.rlike(FLOAT_WORD_PATTERN)
    return F.when(ok, F.trim(text).try_cast("double"))


def to_int_lenient(text: Column, default: int = 0) -> Column:
    """Whole part of a number; blank or unreadable text gives ``default``."""
    return F.coalesce(to_float(text).try_cast("bigint"), F.lit(default).cast("bigint"))


def to_float_lenient(text: Column, default: float | None = 0.0) -> Column:
    value = to_float(text)
    return value if default is None else F.coalesce(value, F.lit(default))


def nonblank(text: Column) -> Column:
    """Null when the text is empty."""
    return F.when(text != "", text)


def first_nonblank(*texts: Column, default: str = "NA") -> Column:
    return F.coalesce(*[nonblank(t) for t in texts], F.lit(default))


def cells(line: Column, sep: str = "\t") -> Column:
    """All separated cells, trailing empty ones included."""
    return F.split(line, sep, -1)


def with_cells(rows: DataFrame, name: str, parts: Column) -> DataFrame:
    """Append a split line; it comes from a generator, so that conditions on its cells do not split the line again."""
    return rows.select("*", F.explode(F.array(parts)).alias(name))


def words(line: Column) -> Column:
    """Cells separated by runs of white space, as a split without arguments gives them."""
    return F.filter(F.split(F.trim(line), r"\s+"), lambda w: w != "")


def cell(parts: Column, index: int, default: str | None = None) -> Column:
    """Cell by zero-based index; missing cells are null or ``default``."""
    value = F.try_element_at(parts, F.lit(index + 1))
    return value if default is None else F.coalesce(value, F.lit(default))


def int_list(text: Column) -> Column:
    """Whole numbers of a comma list; a trailing comma is allowed, bad items count as 0."""
    body = F.rtrim(F.trim(text), F.lit(","))
    items = F.filter(F.split(body, ",", -1), lambda x: x != "")
    plain = lambda x: F.when(x.rlike("^[0-9]{1,15}$"), x.try_cast("bigint")).otherwise(to_int_lenient(x))
    return F.transform(F.coalesce(items, F.array().cast("array<string>")), plain)


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den, null when the denominator is missing or not positive."""
    return F.when(den.cast("double") > 0, F.coalesce(num.cast("double"), F.lit(0.0)) / den.cast("double"))


def normalize_chrom(name: Column) -> Column:
    """``chr`` prefix for plain contig names, ``MT`` becomes ``chrM``."""
    n = F.trim(name)
    return F.when(n.startswith("chr"), n).when(n == "MT", F.lit("chrM")).otherwise(F.concat(F.lit("chr"), n))


def contig_order(name: Column) -> Column:
    """Sort key of contig names: X, Y, M, W, Z and plain numbers first, then embedded numbers, then the rest."""
    stem = F.regexp_replace(name, "(?i)^(chrom|chr)", "")
    up = F.upper(stem)
    # fixed values: ranks of the named contigs
    named = F.when(up == "X", 23).when(up == "Y", 24).when(up.isin("M", "MT"), 25).when(up == "W", 26).when(up == "Z", 27)
    digits = F.regexp_extract(stem, r"([0-9]+)", 1)

    def key(group: int, number: Column) -> Column:
        return F.struct(F.lit(group).alias("g"), number.cast("bigint").alias("n"), name.alias("t"))

    return (
        F.when(named.isNotNull(), key(1, named))
        .when(stem.rlike("^[0-9]+$"), key(1, stem.try_cast("bigint")))
        .when(digits != "", key(2, digits.try_cast("bigint")))
        .otherwise(key(3, F.lit(0)))
    )


def shortest_number(value: Column) -> Column:
    """Shortest text of a double: ``0.0005``, ``5e-08``, ``12.0``, ``1e+16``; exponents only below 1e-4 and from 1e16 on."""
    text = value.cast("double").cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)E", 1)
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "0+$", "")
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).cast("int")
    digits = F.when(digits == "", "0").otherwise(digits)
    whole = F.concat(F.rpad(digits, power + 1, "0"), F.lit("."), F.when(F.length(digits) > power + 1, F.substring(digits, power + 2, F.length(digits))).otherwise("0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    exponent = F.concat(F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"))
    coded = F.concat(F.substring(digits, 1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, F.length(digits)))).otherwise(""), exponent)
    return F.when(~text.contains("E"), text).otherwise(F.concat(sign, F.when((power >= 0) & (power < 16), whole).when((power < 0) & (power >= -4), small).otherwise(coded)))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _rounded_digits(size: Column, power: Column, digits: int) -> Column:
    """``size`` as a whole number of ``digits`` digits when its first digit stands for 10 ** ``power``; ties go to the even number.

    The product with a power of ten is kept as two doubles (Dekker), so that what lies on a tie is told from what lies beside it.
    """
    def nearest(base: Column, side: Column) -> Column:
        return base + F.when((side > 0) | ((side == 0) & (F.pmod(base, F.lit(2.0)) == 1.0)), 1.0).otherwise(0.0)

    def high(x: Column) -> Column:
        big = x * F.lit(134217729.0)  # 2 ** 27 + 1
        return big - (big - x)

    def scaled(t: Column) -> Column:
        product, a, c = size * t, high(size), high(t)
        parts = F.struct(product.alias("p"), F.floor(product).cast("double").alias("whole"), a.alias("a"), (size - a).alias("b"), c.alias("c"), (t - c).alias("d"))
        return _bound(parts, lambda x: nearest(x["whole"], (x["p"] - x["whole"] - 0.5) + (
            ((x["a"] * x["c"] - x["p"]) + x["a"] * x["d"] + x["b"] * x["c"]) + x["b"] * x["d"])))

    def divided(t: Column) -> Column:
        return _bound(F.floor(size / t).cast("double"), lambda whole: nearest(whole, size - whole * t - t / 2))

    ten = F.lit(10.0)
    return F.when(power <= digits - 1, _bound(F.pow(ten, F.lit(digits - 1) - power), scaled)).otherwise(_bound(F.pow(ten, power - (digits - 1)), divided))


def general_number(value: Column, digits: int = 6) -> Column:
    """Text of a double with ``digits`` significant digits and no trailing zeros: ``0.0005``, ``1.25e-05``, ``1.5e+06``.

    Exponents are written below 1e-4 and from 10 ** ``digits`` on. Sizes outside 1e-16 to 1e15 are rounded from their shortest decimal text.
    """
    value = value.cast("double")
    full, ten = 10.0 ** digits, F.lit(10.0)

    def first_power(size: Column) -> Column:
        # the logarithm may be one off next to a power of ten
        reach = lambda p: F.when(p >= 0, size >= F.pow(ten, p)).otherwise(size * F.pow(ten, -p) >= 1.0)
        return _bound(F.floor(F.log10(size)).cast("int"), lambda g: F.when(reach(g + 1), g + 1).when(reach(g), g).otherwise(g - 1))

    def rounded(size: Column) -> Column:
        def figures(power: Column) -> Column:
            return _bound(_rounded_digits(size, power, digits), lambda n: F.struct(
                F.when(n >= full, power + 1).otherwise(power).alias("power"), F.when(n >= full, full / 10).otherwise(n).cast("bigint").cast("string").alias("figures")))

        return _bound(first_power(size), figures)

    def from_text(size: Column) -> Column:
        return _bound(F.format_string(f"%.{digits - 1}e", size), lambda t: F.struct(
            F.regexp_extract(t, r"e([+-][0-9]+)$", 1).try_cast("int").alias("power"),
            F.replace(F.regexp_extract(t, r"^([0-9.]+)e", 1), F.lit("."), F.lit("")).alias("figures")))

    def text(power: Column, figures: Column) -> Column:
        def tail(at: Column) -> Column:
            return F.when(F.length(figures) >= at, F.concat(F.lit("."), F.substring(figures, at, F.length(figures)))).otherwise("")

        steps = F.abs(power).cast("string")
        coded = F.concat(F.substring(figures, 1, 1), tail(F.lit(2)), F.when(power < 0, "e-").otherwise("e+"), F.lpad(steps, F.greatest(F.length(steps), F.lit(2)), "0"))
        return F.when((power >= 0) & (power < digits), F.concat(F.rpad(F.substring(figures, F.lit(1), power + 1), power + 1, "0"), tail(power + 2))).when(
            (power < 0) & (power >= -4), F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), figures)).otherwise(coded)

    def unsigned(size: Column) -> Column:
        parts = F.when(size.between(1e-16, 1e15), rounded(size)).otherwise(from_text(size))
        trimmed = _bound(parts, lambda p: F.struct(p["power"].alias("power"), F.regexp_replace(p["figures"], "0+$", "").alias("figures")))
        return F.when(F.isnan(size), "nan").when(size == float("inf"), "inf").when(size == 0, "0").otherwise(_bound(trimmed, lambda p: text(p["power"], p["figures"])))

    sign = F.when(F.startswith(value.cast("string"), F.lit("-")), "-").otherwise("")
    return F.when(value.isNotNull(), F.concat(sign, _bound(F.abs(value), unsigned)))


# Cody's rational approximations of the error function (1969), highest power first,
# below 0.46875, from there to 4, and beyond.
_NEAR = ((1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
         (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3))
_MIDDLE = ((2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3,
            2.05107837782607147e3, 1.23033935479799725e3),
           (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3,
            1.23033935480374942e3))
_FAR = ((1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4),
        (1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3))


def _quotient(x: Column, parts: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    def value(factors: tuple[float, ...]) -> Column:
        out = F.lit(factors[0])
        for f in factors[1:]:
            out = out * x + F.lit(f)
        return out

    return value(parts[0]) / value(parts[1])


def error_function(x: Column) -> Column:
    """erf of a double to about 1e-15, null for null and nan for nan."""
    def of_size(size: Column) -> Column:
        square = size * size
        near = size * _bound(square, lambda q: _quotient(q, _NEAR))
        middle = 1.0 - F.exp(-square) * _quotient(size, _MIDDLE)
        far = 1.0 - F.exp(-square) / size * _bound(1.0 / square, lambda q: 0.5641895835477562869 - q * _quotient(q, _FAR))
        return F.when(F.isnan(size), size).when(size <= 0.46875, near).when(size <= 4, middle).when(size < 6, far).when(size >= 6, 1.0)

    return F.when(x < 0, -1.0).otherwise(1.0) * _bound(F.abs(x.cast("double")), of_size)
