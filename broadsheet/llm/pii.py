"""Format-preserving Feistel pseudonyms for numbers and dates.

Card numbers, social-security numbers, telephone numbers, IPv4 addresses and dates are found by their form and
validated. Each valid value is permuted among the valid values of its format by a keyed Feistel network, so that
equal values stay equal in all documents, different ones stay different, and who has the key can go back.
Separators, length and whatever else the format shows stay as they are; invalid values stay untouched.

All of it is one DataFrame expression; no row moves and no Python runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# The forms, in the order in which they are tried at a place.
PHONE = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
DATE = r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
# Cards come in one piece or in the groups of their kinds. Fours in a row, with what may be a last group of a card or
# a check value behind it, are one candidate, in which cards are looked for from the left.
FOURS = r"[0-9]{4}(?:[ -][0-9]{4}){3}"
RUN = r"[0-9]{4}(?:[ -][0-9]{4}){3,}(?:[ -][0-9]{3}|-[0-9]{1,2})?"
CARD = r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}[ -][0-9]{5}[ -][0-9]{6}|(?:[0-9]{4}[ -]){3}[0-9]{1,3})"
FORMS = {"phone": PHONE, "address": ADDRESS, "date": DATE, "social": SOCIAL, "run": RUN, "card": CARD}
# What every form holds: a plus and a digit, a point between digits, or three digits in a row.
WORTH = r"[0-9]{3}|[0-9]\.[0-9]|\+[0-9]"
# A candidate is no part of a longer number or word.
CANDIDATE = rf"(?<![0-9A-Za-z+])(?<![0-9][.-])(?:{'|'.join(FORMS.values())})(?![0-9A-Za-z])(?![.-][0-9])"

DATE_FORMATS = ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy")
# The days of 400 years are 27 * 5411; the Gregorian calendar repeats after them.
FIRST_DAY, DAYS = "1800-01-01", (27, 5411)
WALK = 16  # steps to the next number that one in ten is not
SUBSCRIBER = 7  # digits of a telephone number that are permuted
AREAS, GROUPS, SERIALS = 898, 99, 9999  # valid parts of a social-security number: 001-899 but 666, 01-99, 0001-9999


def feistel(left: Column, right: Column, sizes: tuple, key: Column, kind: str, back: bool = False) -> Column:
    """A keyed permutation of the pairs with ``0 <= left < sizes[0]`` and ``0 <= right < sizes[1]``.

    Rounds alternate between the halves: to one a hash of the other is added, modulo its size.
    """
    left_size, right_size = [s if isinstance(s, Column) else F.lit(s).cast("long") for s in sizes]
    sign = F.lit(-1 if back else 1)

    def one_round(state: Column, number: Column) -> Column:
        odd = number % 2 == 1
        seen = F.when(odd, state["right"]).otherwise(state["left"])
        digest = F.sha2(F.concat_ws("|", key, F.lit(kind), number.cast("string"), seen.cast("string")), 256)
        added = sign * F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
        return F.struct(
            F.when(odd, F.pmod(state["left"] + added, left_size)).otherwise(state["left"]).alias("left"),
            F.when(odd, state["right"]).otherwise(F.pmod(state["right"] + added, right_size)).alias("right"),
        )

    numbers = F.array(*[F.lit(i) for i in (range(ROUNDS, 0, -1) if back else range(1, ROUNDS + 1))])
    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(numbers, start, one_round)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _padded(number: Column, length: Column) -> Column:
    return F.lpad(number.cast("string"), length, F.lit("0"))


def permuted_digits(digits: Column, key: Column, kind: str, back: bool) -> Column:
    """A digit string of 2 to 18 digits, permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = n - half
    power = [F.lit(10 ** i) for i in range(10)]
    sizes = tuple(F.get(F.array(*power), length) for length in (half, rest))
    halves = [F.substr(digits, F.lit(1), half).cast("long"), F.substr(digits, half + 1, rest).cast("long")]
    out = feistel(*halves, sizes, key, kind, back)
    # The lambda binds the result once.
    joined = F.transform(F.array(out), lambda p: F.concat(_padded(p["left"], half), _padded(p["right"], rest)))
    return F.get(joined, F.lit(0))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and reduced."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def in_format(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in order."""
    places = F.sequence(F.lit(1), F.length(value))

    def place(i: Column) -> Column:
        char = F.substr(value, i, F.lit(1))
        before = F.length(_digits(F.substr(value, F.lit(1), i)))
        return F.when(char.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(places, place), "")


def _card(value: Column, key: Column, back: bool) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    body = permuted_digits(F.substr(digits, F.lit(1), n - 1), key, "card", back)
    check = F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return F.when((n >= 13) & (luhn_sum(digits) % 10 == 0), in_format(value, F.get(check, F.lit(0))))


def _run(value: Column, key: Column, back: bool) -> Column:
    """Struct of fours with every valid card among them replaced, from the left, and the number of these cards; else
    of all of it as one card."""
    groups = F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0))

    def group(state: Column, i: Column) -> Column:
        four = F.array_join(F.slice(groups, i, F.lit(4)), "")
        card = F.when(state["skip"] == 0, _card(F.regexp_extract(four, f"^{FOURS}", 0), key, back))
        # The lambda binds the card once.
        step = F.transform(
            F.array(card),
            lambda new: F.struct(
                F.concat(
                    state["text"],
                    F.when(state["skip"] > 0, "")
                    .when(new.isNotNull(), F.concat(new, F.regexp_extract(four, "[ -]?$", 0)))
                    .otherwise(F.get(groups, i - 1)),
                ).alias("text"),
                F.when(state["skip"] > 0, state["skip"] - 1).when(new.isNotNull(), 3).otherwise(0).alias("skip"),
                (state["n"] + F.when(new.isNotNull(), 1).otherwise(0)).alias("n"),
            ),
        )
        return F.get(step, F.lit(0))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("skip"), F.lit(0).alias("n"))
    places = F.sequence(F.lit(1), F.size(groups))
    whole = F.when(value.rlike(f"^{FOURS}[ -][0-9]{{3}}$"), _long_card(value, key, back))
    found = F.transform(
        F.array(F.aggregate(places, start, group)),
        lambda s: F.when(s["n"] > 0, F.struct(s["text"].alias("text"), s["n"].alias("n"))).otherwise(_single(whole)),
    )
    return F.get(found, F.lit(0))


def _single(value: Column) -> Column:
    """Struct of a value and 1, or of null and 0."""
    counted = lambda v: F.struct(v.alias("text"), F.when(v.isNull(), 0).otherwise(1).alias("n"))
    return F.get(F.transform(F.array(value), counted), F.lit(0))


def _long_card(value: Column, key: Column, back: bool) -> Column:
    """A card of 19 digits whose first 16 are none, among those of its kind: others are passed over."""

    def is_none(card: Column) -> Column:
        return luhn_sum(F.substr(_digits(card), F.lit(1), F.lit(16))) % 10 != 0

    def walk(card: Column, _: Column) -> Column:
        return F.when(is_none(card), card).otherwise(_card(card, key, back))

    first = _card(value, key, back)
    return F.when(first.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, walk))


def _phone(value: Column, key: Column, back: bool) -> Column:
    """A number of 10 to 15 digits; in a longer one a card behind the prefix, or the number without its last group."""
    card = F.regexp_extract(value, rf"^\+[0-9]{{1,3}}[ .-]({FOURS})$", 1)
    less = F.regexp_extract(value, r"^(.*[0-9)])[ .-][0-9]{2,4}$", 1)
    prefix = F.regexp_extract(value, r"^\+[0-9]{1,3}[ .-]", 0)
    rest = F.substr(value, F.length(less) + 1, F.length(value))
    return F.coalesce(
        _whole_phone(value, key, back),
        F.concat(prefix, _card(card, key, back)),
        F.concat(_whole_phone(less, key, back), rest),
    )


def _whole_phone(value: Column, key: Column, back: bool) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    kept = F.substr(digits, F.lit(1), n - SUBSCRIBER)
    moved = permuted_digits(F.substr(digits, n - SUBSCRIBER + 1, F.lit(SUBSCRIBER)), key, "phone", back)
    return F.when(n.between(10, 15), in_format(value, F.concat(kept, moved)))


def _address(value: Column, key: Column, back: bool) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    halves = [F.get(octets, F.lit(i)) * 256 + F.get(octets, F.lit(i + 1)) for i in (0, 2)]
    out = F.transform(
        F.array(feistel(*halves, (1 << 16, 1 << 16), key, "address", back)),
        lambda p: F.concat_ws(
            ".", *[part.cast("string") for half in ("left", "right") for part in (F.floor(p[half] / 256), p[half] % 256)]
        ),
    )
    valid = F.forall(octets, lambda o: o <= 255) & ~value.rlike(r"(^|\.)0[0-9]")
    return F.when(valid, F.get(out, F.lit(0)))


def _date(value: Column, key: Column, back: bool) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    out = F.lit(None).cast("string")
    for form in DATE_FORMATS:
        shaped = value.rlike("^" + form.replace(".", r"\.").replace("yyyy", "[0-9]{4}").replace("MM", "[0-9]{2}").replace("dd", "[0-9]{2}") + "$")
        day = F.datediff(F.when(shaped, F.try_to_date(value, form)), first)
        valid = day.between(0, DAYS[0] * DAYS[1] - 1)
        halves = [F.floor(day / DAYS[1]), day % DAYS[1]]
        moved = F.transform(
            F.array(feistel(*halves, DAYS, key, "date", back)),
            lambda p: F.date_format(F.date_add(first, (p["left"] * DAYS[1] + p["right"]).cast("int")), form),
        )
        out = F.when(valid, F.get(moved, F.lit(0))).otherwise(out)
    return out


def _social(value: Column, key: Column, back: bool) -> Column:
    area, group, serial = [F.split(value, "-")[i].cast("long") for i in range(3)]
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    halves = [area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * SERIALS + serial - 1]
    parts = lambda p: F.concat_ws(
        "-",
        _padded(p["left"] + 1 + F.when(p["left"] >= 665, 1).otherwise(0), F.lit(3)),
        _padded(F.floor(p["right"] / SERIALS) + 1, F.lit(2)),
        _padded(p["right"] % SERIALS + 1, F.lit(4)),
    )
    moved = F.transform(F.array(feistel(*halves, (AREAS, GROUPS * SERIALS), key, "social", back)), parts)
    return F.when(valid, F.get(moved, F.lit(0)))


KINDS: dict[str, Callable] = {"phone": _phone, "address": _address, "date": _date, "social": _social, "card": _card}


def replaced(value: Column, key: Column, back: bool = False) -> Column:
    """Struct of the value of the same format that stands for a candidate, null if it holds nothing valid, and the
    number of values replaced."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(value.rlike(f"^{FORMS[kind]}$"), KINDS[kind](value, key, back)).otherwise(out)
    return F.when(value.rlike(f"^{RUN}$"), _run(value, key, back)).otherwise(_single(out))


def pseudonymise(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """All columns of ``docs``, the text with pseudonyms, and ``n_replaced``.

    ``key`` is a secret of the caller; ``back`` undoes what the same key did. Null and empty texts have
    nothing to replace. Equal values get equal pseudonyms in all rows. Other columns pass through; the count
    takes a ``_`` more where its name is in use.
    """
    name = "n_replaced"
    while name in docs.columns:
        name += "_"
    text = F.col("text").cast("string")
    secret = F.lit(key)
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    # One struct per candidate: what stands in its place, and how many pseudonyms that holds.
    new = F.transform(found, lambda value: replaced(value, secret, back))
    pieces = F.split(text, CANDIDATE, -1)
    shown = F.zip_with(new, found, lambda a, b: F.coalesce(a["text"], b))
    joined = F.array_join(
        F.zip_with(pieces, F.concat(shown, F.array(F.lit(""))), lambda piece, value: F.concat(piece, value)), ""
    )
    worth = text.rlike(WORTH)
    total = F.aggregate(new, F.lit(0), lambda n, value: n + value["n"])
    staged = docs.withColumn("__new", F.when(worth, F.struct(joined.alias("text"), total.alias("n"))))
    return staged.select(
        *[F.coalesce("__new.text", text).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce("__new.n", F.lit(0)).cast("long").alias(name),
    )
