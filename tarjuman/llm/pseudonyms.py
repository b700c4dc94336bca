"""Format-preserving pseudonyms for validated numbers and dates, by keyed Feistel networks.

A value is permuted within its format: two halves, each a number below a modulus, take
turns in adding a keyed hash of the other. That is a bijection for every key, so equal
values get equal pseudonyms in all documents, different ones stay different, and whoever
has the key can go back. Only DataFrame expressions: matches of one pattern are taken
out, replaced, and put between the pieces of the text around them.

* card: 13 to 19 digits with a right Luhn check digit; the first digit stays, the check
  digit is computed anew.
* ipv4: four numbers up to 255.
* phone: an international number of 8 to 15 digits; the country code and all
  punctuation stay.
* ssn: 3-2-4 digits with a valid area, group and serial, and stays valid.
* date: ``yyyy-MM-dd``, ``dd.MM.yyyy`` or ``dd/MM/yyyy`` (else ``MM/dd/yyyy``), if the day exists up to
  year 9600; it moves within its 400-year cycle of the calendar, so it stays a day, and a
  slash date moves among those of the same reading.

Anything that looks alike but does not validate is left as it is. Names, mail addresses
and tokens are not numbers and are not this operator's business.

Defined cases: null and empty texts stay so; repeated rows change alike; an empty table
gives an empty result; other columns are carried along.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarjuman.operators.shape import free_name

ROUNDS = 10
PATTERNS = {
    "ipv4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)",
    "card": r"(?<![\d])\d(?:[ -]?\d){12,18}(?![\d])",
}
ANY = "|".join(PATTERNS.values())
# Country calling codes of one and of two digits; all others have three.
COUNTRY_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
CYCLE_START, CYCLE_DAYS, CYCLE_HALVES = "1601-01-01", 146_097, (189, 773)
#: Days above the twelfth of their month: CYCLE_DAYS - 12 * 4800.
EARLY, LATE_HALVES = 12, (9, 9833)


def feistel(key: str, kind: str, left: Column, right: Column, m: Column, n: Column) -> Column:
    """``struct(left, right)`` permuted within numbers below ``m`` and below ``n``."""
    def mask(turn: Column, other: Column, modulus: Column) -> Column:
        said = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), modulus.cast("string"), other.cast("string"))
        return F.pmod(F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("bigint"), modulus)

    def turn(state: Column, i: Column) -> Column:
        moved = F.pmod(state.left + mask(i, state.right, m), m)
        return F.struct(moved.alias("left"), state.right.alias("right"))

    def other(state: Column, i: Column) -> Column:
        moved = F.pmod(state.right + mask(i, state.left, n), n)
        return F.struct(state.left.alias("left"), moved.alias("right"))

    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start,
        lambda state, i: F.when(i % 2 == 1, turn(state, i)).otherwise(other(state, i)),
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A digit string of the same length."""
    length = F.length(digits)
    half = F.floor(length / 2).cast("int")
    rest = length - half
    left, right = digits.substr(F.lit(1), half), digits.substr(half + 1, rest)
    found = feistel(key, kind, left.cast("bigint"), right.cast("bigint"), power_of_ten(half), power_of_ten(rest))
    return F.concat(F.lpad(found.left.cast("string"), half, "0"), F.lpad(found.right.cast("string"), rest, "0"))


def put_digits(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order."""
    def char(i: Column) -> Column:
        own = value.substr(i, F.lit(1))
        place = F.length(digits_of(value.substr(F.lit(1), i)))
        return F.when(own.rlike("[0-9]"), digits.substr(place, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def card(key: str, value: Column) -> Column:
    digits = digits_of(value)
    length = F.length(digits)
    middle = permute_digits(key, "card", digits.substr(F.lit(2), length - 2))
    body = F.concat(digits.substr(F.lit(1), F.lit(1)), middle)
    check = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: F.call_function("luhn_check", F.concat(body, d.cast("string"))))
    new = put_digits(value, F.concat(body, F.get(check, 0).cast("string")))
    return F.when(F.call_function("luhn_check", digits), new).otherwise(value)


def ipv4(key: str, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("int"))
    pair = lambda i: F.get(parts, i) * 256 + F.get(parts, i + 1)
    found = feistel(key, "ipv4", pair(0), pair(2), F.lit(65536), F.lit(65536))
    octets = [F.floor(found.left / 256), found.left % 256, F.floor(found.right / 256), found.right % 256]
    new = F.concat_ws(".", *[o.cast("int").cast("string") for o in octets])
    return F.when(F.forall(parts, lambda p: p <= 255), new).otherwise(value)


def phone(key: str, value: Column) -> Column:
    country = F.regexp_extract(value, COUNTRY_CODE, 0)
    rest = value.substr(F.length(country) + 1, F.length(value))
    new = F.concat(country, put_digits(rest, permute_digits(key, "phone", digits_of(rest))))
    return F.when(F.length(digits_of(value)).between(8, 15), new).otherwise(value)


def ssn(key: str, value: Column) -> Column:
    area, group, serial = (F.get(F.split(value, "-"), i).cast("int") for i in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    found = feistel(key, "ssn", index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
    index = F.floor(found.left / 99)
    area = F.when(index >= 665, index + 2).otherwise(index + 1)
    padded = [F.lpad(n.cast("int").cast("string"), w, "0") for n, w in ((area, 3), (found.left % 99 + 1, 2), (found.right + 1, 4))]
    return F.when(valid, F.concat_ws("-", *padded)).otherwise(value)


def date(key: str, value: Column) -> Column:
    new = value
    for shape, form in (
        (r"/", "MM/dd/yyyy"), (r"/", "dd/MM/yyyy"), (r"\.", "dd.MM.yyyy"), (r"-", "yyyy-MM-dd"),
    ):
        day = F.try_to_timestamp(value, F.lit(form)).cast("date")
        since = F.datediff(day, F.lit(CYCLE_START).cast("date"))
        within = F.pmod(since, F.lit(CYCLE_DAYS))
        m, n = CYCLE_HALVES
        found = feistel(key, "date", F.floor(within / n), within % n, F.lit(m), F.lit(n))
        moved = F.date_add(day, (found.left * n + found.right).cast("int") - within)
        if form == "MM/dd/yyyy":
            # Read so only where the day is above 12, and the pseudonym must read so too.
            moved = late_day(key, day, within)
        fits = value.rlike(shape) & day.isNotNull() & (F.year(day) <= 9600)
        new = F.when(fits, F.date_format(moved, form)).otherwise(new)
    return new


def late_day(key: str, day: Column, within: Column) -> Column:
    """A day above 12 of some month, permuted among all such days of its 400-year cycle.

    They are numbered by what is left of the days when the first twelve of each month go.
    """
    def before(month: Column) -> Column:
        """Such days before a month of the cycle, counted from 0."""
        start = F.add_months(F.lit(CYCLE_START).cast("date"), month)
        return F.datediff(start, F.lit(CYCLE_START).cast("date")) - EARLY * month

    m, n = LATE_HALVES
    first = F.date_sub(day, within)
    month = (F.year(day) - F.year(first)) * 12 + F.month(day) - 1
    number = before(month) + F.day(day) - EARLY - 1
    found = feistel(key, "late day", F.floor(number / n), number % n, F.lit(m), F.lit(n))
    moved = (found.left * n + found.right).cast("int")
    # Months have 16 to 19 such days, 18.437 in the mean of a cycle.
    guess = F.floor(moved * 4800 / (m * n)).cast("int")
    months = F.filter(
        F.sequence(F.greatest(guess - 2, F.lit(0)), F.least(guess + 2, F.lit(4799))), lambda i: before(i) <= moved)
    own = F.array_max(months)
    return F.date_add(F.add_months(first, own), moved - before(own) + EARLY)


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of a whole matched value, by the first kind whose format it has."""
    kinds = {"ipv4": ipv4, "phone": phone, "ssn": ssn, "date": date, "card": card}
    chosen = value
    for kind, permute in reversed(kinds.items()):
        chosen = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), permute(key, value)).otherwise(chosen)
    return chosen


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the values in ``text`` replaced, and ``n_replaced``."""
    names = [c for c in docs.columns if c != "n_replaced"]
    old = free_name(docs.columns, "_pii_found")
    new = free_name(docs.columns, "_pii_new")
    own = F.col(f"`{text}`")
    found = docs.select(
        *[F.col(f"`{c}`") for c in names],
        F.when(own.rlike(ANY), F.regexp_extract_all(own, F.lit(ANY), F.lit(0))).alias(old),
    )
    changed = found.withColumn(new, F.transform(old, lambda m: pseudonym(key, m)))
    around = F.transform(F.split(own, ANY, -1), lambda gap, i: F.concat(gap, F.coalesce(F.get(new, i), F.lit(""))))
    new_text = F.when(F.col(old).isNotNull(), F.array_join(around, "")).otherwise(own)
    different = F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda d: d)
    n_replaced = F.coalesce(F.size(different), F.lit(0))
    n_replaced = F.when(F.col(old).isNull(), 0).otherwise(n_replaced).cast("long")
    return changed.withColumns({"n_replaced": n_replaced, text: new_text}).select(
        *[F.col(f"`{c}`") for c in names], "n_replaced")
