"""Exact decimals carried as strings: shifting, cutting, ordering and adding without rounding.

A number is digits with an optional sign, point and exponent; its canonical text is
plain and has no needless zeros. Columns here stay in SQL functions. Nothing is rounded:
sums use DECIMAL(37, 18) where all addends fit in it, and are carried out on groups
of digits where one doesn't. Exponents of more than MAX_EXPONENT are no numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
SCIENTIFIC = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)[eE][+-]?0*[0-9]{1,4}$"
#: What only zeros at its end keep from being canonical.
PLAIN = r"^(0|[1-9][0-9]*)([.][0-9]+)?\z"
CANONICAL = r"^(0|-?([1-9][0-9]*(\.[0-9]*[1-9])?|0\.[0-9]*[1-9]))$"
#: Texts of exponents up to this are written out.
MAX_EXPONENT = 9999
#: Digits that are added at once.
GROUP = 15
#: Characters of numbers that DECIMAL(38, 18) holds whatever they are.
SHORT, _WIDE = 19, "decimal(38,18)"
#: One digit less than the widest, whose sums would lose a place.
_SUM = "decimal(37,18)"


def _short(v: Column) -> Column:
    """Whether v has at most SHORT characters, and none but digits, sign and point: a number's cast is then exact."""
    return (F.length(v) <= SHORT) & (F.translate(v, "0123456789+-.", "") == "")


def is_decimal(v: Column) -> Column:
    return F.when(_short(v), v.try_cast(_WIDE).isNotNull()).otherwise(v.rlike(NUMERIC) | v.rlike(SCIENTIFIC))


def number(v: Column) -> Column:
    """Rounded to DECIMAL(38, 18), null beyond: see order_key() and total() for exact order and sums."""
    return v.try_cast("decimal(38,18)")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value reckoned once."""
    return F.transform(F.array(value), use)[0]


def _plain(v: Column) -> Column:
    """Without an exponent and with a point; null if v is no number."""

    def pointed(text: Column) -> Column:
        return F.regexp_replace(text, "^([+-]?[0-9]*)$", "$1.")

    mantissa, exponent = F.regexp_extract(v, "^([^eE]*)", 1), F.regexp_extract(v, "[eE](.*)$", 1).cast("int")
    return F.when(v.rlike(NUMERIC), pointed(v)).when(v.rlike(SCIENTIFIC), _moved(pointed(mantissa), exponent))


def _moved(plain: Column, k: Column) -> Column:
    """A plain number with its point k places further right."""

    def digits(n: Column) -> Column:
        return F.concat(F.lit("([0-9]{"), n.cast("string"), F.lit("})"))

    right = F.regexp_replace(F.concat(plain, F.repeat(F.lit("0"), k)), F.concat(F.lit("[.]"), digits(k)), F.lit("$1."))
    wide = F.regexp_replace(plain, F.lit("^([+-]?)"), F.concat(F.lit("$1"), F.repeat(F.lit("0"), -k)))
    left = F.regexp_replace(wide, F.concat(digits(-k), F.lit("[.]")), F.lit(".$1"))
    return F.when(k >= 0, right).otherwise(left)


def _tidy(text: Column) -> Column:
    """A plain number without plus, needless zeros and a bare point. Each step reads its input once: expressions here nest."""
    for pattern, by in (("^[+]", ""), ("0+$", ""), ("[.]$", ""), ("^(-?)0+(?=[0-9])", "$1"), ("^(-?)(?=[.]|$)", "$10"), ("^-0$", "0")):
        text = F.regexp_replace(text, pattern, by)
    return text


def canonical(v: Column) -> Column:
    """Any zero is "0"; otherwise plain, without trailing zeros, leading zeros or a plus. Numbers without sign and leading zeros, most of all, are cut as text."""
    return F.when(v.rlike(PLAIN), F.when(F.contains(v, F.lit(".")), _trimmed(v)).otherwise(v)).when(_short(v), _trimmed(v.try_cast(_WIDE))).when(v.rlike(CANONICAL), v).otherwise(_tidy(_plain(v)))


def _trimmed(v: Column) -> Column:
    """The canonical text of a DECIMAL with places, or of a PLAIN text: always with a point."""
    return F.rtrim(F.rtrim(v.cast("string"), F.lit("0")), F.lit("."))


def shift(v: Column, k: Column) -> Column:
    """v * 10**k, exactly and canonical; k may be negative or null (0)."""
    return let(canonical(v), lambda c: let(F.coalesce(k, F.lit(0)).cast("int"), lambda n: _shifted(c, n)))


def _shifted(c: Column, k: Column) -> Column:
    """A canonical number with its point k places further right, by pieces of its text."""
    size = F.ltrim(c, F.lit("-"))
    whole = F.substring_index(size, ".", 1)
    part = F.when(F.contains(size, F.lit(".")), F.substring_index(size, ".", -1)).otherwise(F.lit(""))
    # digits on both sides of the new point, and how many of them are before it
    digits = F.concat(F.lpad(whole, F.greatest(F.length(whole), -k), F.lit("0")), F.rpad(part, F.greatest(F.length(part), k), F.lit("0")))
    before = F.greatest(F.length(whole), -k) + k

    def text(x: Column) -> Column:
        def pieces(w: Column, p: Column) -> Column:
            head = F.when(w == "", "0").otherwise(w)
            return F.when(p == "", head).otherwise(F.concat(head, F.lit("."), p))

        return let(F.ltrim(F.substr(x["d"], F.lit(1), x["n"]), F.lit("0")), lambda w: let(F.rtrim(F.substr(x["d"], x["n"] + 1), F.lit("0")), lambda p: pieces(w, p)))

    moved = let(F.struct(digits.alias("d"), before.alias("n")), text)
    return F.when(k == 0, c).otherwise(let(moved, lambda m: F.when(F.startswith(c, F.lit("-")) & (m != "0"), F.concat(F.lit("-"), m)).otherwise(m)))


def order_key(v: Column, falling: Column | bool = False) -> Column:
    """Text whose order is that of canonical numbers (or the reverse), whatever their size and places."""
    falling = F.lit(falling) if isinstance(falling, bool) else falling
    negative, size = F.startswith(v, F.lit("-")), F.ltrim(v, F.lit("-"))
    up = F.concat(F.lpad(F.length(F.substring_index(size, ".", 1)).cast("string"), 5, "0"), size)
    down = F.concat(F.translate(up, "0123456789", "9876543210"), F.lit("~"))  # the more digits follow, the earlier
    return F.when(negative == falling, F.concat(F.lit("1"), up)).otherwise(F.concat(F.lit("0"), down))


def negated(v: Column) -> Column:
    """-v of a canonical number."""
    return F.when(v == "0", v).when(F.startswith(v, F.lit("-")), F.substr(v, F.lit(2))).otherwise(F.concat(F.lit("-"), v))


def total(values: Column) -> Column:
    """The canonical sum of an array of canonical numbers; of none it is "0"."""
    zero = F.lit(0).cast(_SUM)

    def of(values: Column) -> Column:
        fits = F.forall(values, lambda v: (F.length(v) <= 19) | F.coalesce(_trimmed(v.try_cast(_SUM)) == v, F.lit(False)))
        quick = F.aggregate(values, zero, lambda a, v: F.try_add(a, v.try_cast(_SUM)).try_cast(_SUM))
        return let(F.when(fits, quick), lambda q: F.when(F.size(values) == 1, values[0]).when(q.isNotNull(), _trimmed(q)).otherwise(_long_total(values)))

    return let(values, of)


def _long_total(values: Column) -> Column:
    """total() by groups of digits: of equally wide texts the groups are added as numbers, and carries passed on."""

    def groups_of(longest: Column) -> Column:
        return F.ceil(longest / GROUP).cast("int")

    def whole(v: Column) -> Column:
        return F.substring_index(F.ltrim(v, F.lit("-")), ".", 1)

    def part(v: Column) -> Column:
        return F.when(F.contains(v, F.lit(".")), F.substring_index(v, ".", -1)).otherwise(F.lit(""))

    def most(of: Callable[[Column], Column]) -> Column:
        return F.greatest(F.lit(1), groups_of(F.array_max(F.transform(values, lambda v: F.length(of(v))))))

    def added(n: Column, m: Column) -> Column:
        def group(i: Column) -> Column:
            def one(a: Column, v: Column) -> Column:
                wide = F.concat(F.lpad(whole(v), n * GROUP, F.lit("0")), F.rpad(part(v), m * GROUP, F.lit("0")))
                digits = F.substr(wide, i * GROUP + 1, F.lit(GROUP)).cast("bigint")
                return a + F.when(F.startswith(v, F.lit("-")), -digits).otherwise(digits)

            return F.aggregate(values, F.lit(0).cast("bigint"), one)

        return F.transform(F.sequence(F.lit(0), n + m - 1), group)

    base = 10**GROUP

    def carried(sums: Column) -> Column:
        """(carry out of the first group, digits) of the groups, the last one first."""
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))

        def step(a: Column, x: Column) -> Column:
            now = x + a["carry"]
            rest = F.pmod(now, F.lit(base))
            # a small whole number, whatever a double makes of its dividend
            return F.struct(F.round((now - rest) / F.lit(base)).cast("bigint").alias("carry"), F.concat(F.lpad(rest.cast("string"), GROUP, "0"), a["text"]).alias("text"))

        return F.aggregate(F.reverse(sums), start, step)

    def written(n: Column, sums: Column) -> Column:
        def text(sign: str, c: Column) -> Column:
            point = n * GROUP
            return F.concat(F.lit(sign), c["carry"].cast("string"), F.substr(c["text"], F.lit(1), point), F.lit("."), F.substr(c["text"], point + 1))

        return let(carried(sums), lambda c: F.when(c["carry"] >= 0, text("", c)).otherwise(let(carried(F.transform(sums, lambda x: -x)), lambda d: text("-", d))))

    return _tidy(let(most(whole), lambda n: let(most(part), lambda m: let(added(n, m), lambda sums: written(n, sums)))))


def cut(v: Column, places: Column) -> Column:
    """v towards zero to so many decimal places, canonical; null places leave its value."""

    def cut_off(c: Column) -> Column:
        point = F.instr(c, ".")
        kept = F.rtrim(F.rtrim(F.substr(c, F.lit(1), point + places), F.lit("0")), F.lit("."))
        return F.when(places.isNull() | (point == 0), c).otherwise(let(kept, lambda x: F.when(x == "-0", "0").otherwise(x)))

    return let(canonical(v), cut_off)


def places(v: Column) -> Column:
    """Decimal places as written."""
    return F.length(F.regexp_replace(v, "^[^.]*[.]?", ""))


def padded(v: Column, n: Column) -> Column:
    """v with zeros up to n decimal places, for display."""
    point = F.when((n > 0) & ~F.contains(v, F.lit(".")), F.concat(v, F.lit("."))).otherwise(v)
    return F.concat(point, F.repeat(F.lit("0"), F.greatest(n - places(v), F.lit(0))))
