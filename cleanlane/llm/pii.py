"""Format-preserving pseudonyms for personal numbers, dates and addresses.

One regular expression finds candidates; each kind validates its own (Luhn
check digit, octets, calendar, assigned ranges) and what is not valid stays.
A valid value is ranked within its format's domain, a keyed Feistel network
permutes the domain, and the result is written in the same format.  The
network works on a x b with alternating sums modulo a and b, so it is a
permutation of the very domain without cycle walking.  Equal values
get equal pseudonyms in all documents, different ones different pseudonyms,
and the same key undoes nothing it did not do: the inverse is the same network
backwards (``backwards=True``).

- Payment card (13 to 19 digits, Luhn): the first digit stays, the check
  digit is made anew, the digits between are permuted.  In a run of digit
  groups every stretch in a known grouping (one group, 4-4-4-4, 4-6-4, 4-6-5)
  is tried, then the first 13 to 19 digits of what is left, so a number before
  or behind a card does not hide it.
- Telephone (+country code, or North American): code and punctuation stay.
  +1 has ten digits more; with other codes a number that is complete (8 digits)
  ends before a value of another kind, and at 15 digits.  A bare number behind
  one of those, up to 15 digits in all, counts as part of it.
- IPv4 address: permuted as a whole; no leading zeros.
- Social security number (ddd-dd-dddd): permuted among the assigned ones.
- Date (ISO, also before a time, d.m.y, d/m/y, and m/d/y where d/m/y is no
  date; years 1800 to 2199): permuted by day number among the dates up to
  the 12th or behind it, by walking the cycle until one is met, so a date keeps
  its pseudonym in every format, and m/d/y can still be told from d/m/y.
- E-mail address: letters and digits of the local part are permuted within
  their kind, case by case; the domain stays.

All of it is column expressions: no Python touches the rows.

The network backwards restores all values but cards in a run of groups that
could be cut in several ways (as five groups of four): what is a card there is
up to Luhn's sum, which a new card may also give to a stretch across its ends.

Defined results.  A null text stays null, with no values; an empty one stays
empty.  A value may be its own pseudonym, with a chance of one in its domain.
Repeated rows are treated alike.  An empty table gives no rows.  Other columns
stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the networks (a round changes one half).
ROUNDS = 10
#: Days of a 400-year calendar cycle, as a product; the cycle's first day.
DAYS_A, DAYS_B, FIRST_DAY = 189, 773, "1800-01-01"
#: Steps within which a date meets one of its kind (two of five dates lie up to the 12th; beyond, the chance is 1e-28).
WALK = 128

#: Candidates. Fixed patterns, for Java's regular expressions.  A domain has at most 127 labels (255 bytes), and Java's matcher recurses for each.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}(?![A-Za-z0-9])"
IPV4 = r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[\p{L}\p{N}])"
PHONE_US = r"(?<![\p{L}\p{N}])(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![\p{L}\p{N}-])"
SSN = r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])"
ISO = r"(?<![\p{L}\p{N}-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!(?!T[0-9])[\p{L}\p{N}-])"
DMY = r"(?<![\p{L}\p{N}./])[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4}(?![\p{L}\p{N}/])"
CARD = r"(?<![\p{L}\p{N}])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])"
#: Known groupings of a card's digits; all stretches of a run that have one, also overlapping.
GROUPED = r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![\p{L}\p{N}])"
STRETCHES = rf"(?<![\p{{L}}\p{{N}}])(?=({GROUPED}))"
#: Digit groups up to a value of another kind.
OTHER = "|".join([EMAIL, PHONE_US, IPV4, SSN, ISO, DMY])
RUN = rf"(?<![\p{{L}}\p{{N}}])(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++(?![\p{{L}}\p{{N}}])(?:[ -](?!{OTHER})[0-9]++(?![\p{{L}}\p{{N}}]))*+"
#: A telephone number that has 8 digits ends before another value; +1 has 11 digits, if it can, and no number more than 15.
_DIGIT = "[0-9][ .()-]{0,3}"
_BODY = rf"[0-9]{{1,3}}(?:[ .-]?\([0-9]{{1,4}}\))?(?:[ .-]?(?!(?<={_DIGIT * 8})(?:{OTHER}|{GROUPED}))[0-9]{{2,5}}){{2,5}}(?![\p{{L}}\p{{N}}])"
PHONE = rf"(?<![\p{{L}}\p{{N}}])\+(?:(?=1){_BODY}(?<={_DIGIT * 11})(?<!{_DIGIT * 12})|{_BODY}(?<!{_DIGIT * 16}))"
#: What tells the kind of a candidate, in this order.
KINDS = {"email": "@", "phone": rf"^(?:\+|{PHONE_US}$)", "ipv4": f"^{IPV4}$", "ssn": f"^{SSN}$", "iso": f"^{ISO}$", "dmy": f"^{DMY}$", "card": "^[0-9 -]+$"}
ANY = "|".join([EMAIL, PHONE, PHONE_US, IPV4, SSN, ISO, DMY, RUN])


def _long(c) -> Column:
    return c.cast("long") if isinstance(c, Column) else F.lit(c).cast("long")


def _round_key(key: str, tag: Column, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string")), 256)


def _number(digest: Column) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute(left: Column, right: Column, a, b, key: str, tag: Column, backwards: bool = False) -> Column:
    """The Feistel permutation of (left, right) in a x b, as struct(l, r)."""
    a, b = _long(a), _long(b)
    sign = -1 if backwards else 1
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if backwards else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(s, i):
        even = i % 2 == 0
        add = _number(_round_key(key, tag, i, F.when(even, s["r"]).otherwise(s["l"])))
        return F.struct(F.when(even, F.pmod(s["l"] + sign * (add % a), a)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(F.pmod(s["r"] + sign * (add % b), b)).alias("r"))

    return F.aggregate(steps, F.struct(_long(left).alias("l"), _long(right).alias("r")), step)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(12)]), n + 1)


def permute_digits(digits: Column, key: str, tag: Column, backwards: bool) -> Column:
    """A digit string of 2 to 22 digits permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = (n - u).cast("int")
    named = F.concat(tag, n.cast("string"))
    got = permute(F.substring(digits, F.lit(1), u).cast("long"), F.substring(digits, u + 1, v).cast("long"), _power(u), _power(v), key, named, backwards)
    return F.transform(F.array(got), lambda g: F.concat(F.lpad(g["l"].cast("string"), u, "0"), F.lpad(g["r"].cast("string"), v, "0")))[0]


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit counted once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*[F.lit(2 * d - 9 * (d > 4)) for d in range(10)]), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def _filled(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced by ``digits`` one by one."""
    def place(c, i):
        nth = F.length(digits_of(F.substring(pattern, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(pattern, ""), place), "")


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def card(s: Column, key: str, backwards: bool) -> Column:
    def made(d):
        inner = permute_digits(F.substring(d, F.lit(2), F.length(d) - 2), key, F.lit("card"), backwards)
        body = F.concat(F.substring(d, 1, 1), inner)
        return _let(body, lambda x: F.concat(x, F.pmod(-luhn_sum(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))

    return F.when(luhn_sum(digits_of(s)) % 10 == 0, _filled(s, _let(digits_of(s), made)))


def _found(s: Column, pattern: str, made) -> Column:
    """``s`` with what ``pattern`` finds replaced by ``made`` of it, struct(v, n): the text and the number of values in it."""
    def placed(values):
        pieces = F.zip_with(F.split(s, pattern, -1), F.transform(values, made), lambda a, b: F.struct(F.concat(a, F.coalesce(b["v"], F.lit(""))).alias("v"), F.coalesce(b["n"], F.lit(0)).alias("n")))
        return _let(pieces, lambda p: F.struct(F.array_join(p["v"], "").alias("v"), F.aggregate(p["n"], F.lit(0), lambda x, y: x + y).alias("n")))

    return _let(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), lambda values: F.when(F.size(values) > 0, placed(values)).otherwise(F.struct(s.alias("v"), F.lit(0).alias("n"))))


def _counted(s: Column, made: Column) -> Column:
    return _let(made, lambda x: F.struct(F.coalesce(x, s).alias("v"), x.isNotNull().cast("int").alias("n")))


def cards(s: Column, key: str, backwards: bool) -> Column:
    """The cards of a run of digit groups, as struct(v, n): those in a known grouping from the left, then others before, between and behind."""
    def others(part):
        return _let(part, lambda x: _found(x, CARD, lambda c: _counted(c, card(c, key, backwards))))

    def step(state, w):
        bare = lambda x: F.concat(F.lit(" "), F.translate(x, "-", " "), F.lit(" "))
        rest = state["rest"]

        def placed(at):
            it = F.substring(rest, at, F.length(w))
            moved = _let(others(F.substring(rest, F.lit(1), at - 1)), lambda o: F.struct(F.concat(state["done"], o["v"], F.coalesce(card(it, key, backwards), it)).alias("done"), F.substring(rest, at + F.length(w), F.length(rest)).alias("rest"), (state["n"] + o["n"] + 1).alias("n")))
            return F.when(at > 0, moved).otherwise(state)

        return _let(F.position(bare(w), bare(rest)), placed)

    valid = F.filter(F.regexp_extract_all(s, F.lit(STRETCHES), F.lit(1)), lambda w: luhn_sum(digits_of(w)) % 10 == 0)
    end = F.aggregate(valid, F.struct(F.lit("").alias("done"), s.alias("rest"), F.lit(0).alias("n")), step)
    return _let(end, lambda e: _let(others(e["rest"]), lambda o: F.struct(F.concat(e["done"], o["v"]).alias("v"), (e["n"] + o["n"]).alias("n"))))


def phone(s: Column, key: str, backwards: bool) -> Column:
    code = F.regexp_extract(s, r"^(\+(?:[0-9]{1,3}(?=[ .(-])|[0-9]))", 1)
    rest = F.substring(s, F.length(code) + 1, F.lit(64))
    n = F.length(digits_of(s))
    return F.when((n >= 8) & (n <= 15), F.concat(code, _filled(rest, permute_digits(digits_of(rest), key, F.concat(F.lit("phone"), code), backwards))))


def ipv4(s: Column, key: str, backwards: bool) -> Column:
    o = F.transform(F.split(s, r"\."), lambda x: x.cast("long"))
    valid = F.forall(F.split(s, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]"))
    got = permute(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, F.lit("ipv4"), backwards)
    return F.when(valid, _let(got, lambda g: F.concat_ws(".", F.floor(g["l"] / 256), g["l"] % 256, F.floor(g["r"] / 256), g["r"] % 256)))


def ssn(s: Column, key: str, backwards: bool) -> Column:
    area, group, serial = (F.substring(s, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1
    got = permute(rank, serial - 1, 898 * 99, 9999, key, F.lit("ssn"), backwards)

    def spell(g):
        index = F.floor(g["l"] / 99)
        return F.concat_ws("-", F.lpad((index + 1 + F.when(index >= 665, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((g["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((g["r"] + 1).cast("string"), 4, "0"))

    return F.when(valid, _let(got, spell))


def _day(date: Column, key: str, backwards: bool) -> Column:
    """The pseudonym of a date, null outside of the cycle: the next date on the network's cycle that also lies up to the 12th, or behind it."""
    first = F.lit(FIRST_DAY).cast("date")
    late = lambda n: F.dayofmonth(F.date_add(first, n.cast("int"))) > 12

    def step(s, i):
        moved = _let(permute(F.floor(s["n"] / DAYS_B), s["n"] % DAYS_B, DAYS_A, DAYS_B, key, F.lit("date"), backwards), lambda g: g["l"] * DAYS_B + g["r"])
        return F.when(s["met"], s).otherwise(_let(moved, lambda m: F.struct(m.alias("n"), s["late"].alias("late"), (late(m) == s["late"]).alias("met"))))

    def walked(n):
        got = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(n.alias("n"), late(n).alias("late"), F.lit(False).alias("met")), step)
        return F.when((n >= 0) & (n < DAYS_A * DAYS_B), _let(got, lambda g: F.date_add(first, g["n"].cast("int"))))

    return _let(F.date_diff(date, first).cast("long"), walked)


def iso(s: Column, key: str, backwards: bool) -> Column:
    return _day(F.try_to_date(s, "yyyy-MM-dd"), key, backwards).cast("string")


def dmy(s: Column, key: str, backwards: bool) -> Column:
    mark = F.regexp_extract(s, "([./])", 1)
    p = F.split(s, "[./]")
    date = lambda m, d: F.try_to_date(F.concat_ws("-", p[2], F.lpad(p[m], 2, "0"), F.lpad(p[d], 2, "0")), "yyyy-MM-dd")

    def spelt(day_first):
        month_first = day_first.isNull() & (mark == "/")

        def spell(d):
            day, month = F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lpad(F.month(d).cast("string"), 2, "0")
            return F.concat(F.when(month_first, month).otherwise(day), mark, F.when(month_first, day).otherwise(month), mark, F.year(d).cast("string"))

        return _let(_day(F.when(month_first, date(0, 1)).otherwise(day_first), key, backwards), spell)

    return _let(date(1, 0), spelt)


def email(s: Column, key: str, backwards: bool) -> Column:
    """The local part's letters and digits by a network whose halves are strings."""
    local = F.substring_index(s, "@", 1)
    u = F.ceil(F.length(local) / 2).cast("int")
    sign = -1 if backwards else 1
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if backwards else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def shifted(half, digest):
        def one(c, i):
            by = F.conv(F.substring(digest, i % 15 * 4 + 1, F.lit(4)), 16, 10).cast("int")
            out = c
            for first, size in (("a", 26), ("A", 26), ("0", 10)):
                last = chr(ord(first) + size - 1)
                out = F.when(c.between(first, last), F.char(F.pmod(F.ascii(c) - ord(first) + sign * (by % size), F.lit(size)) + ord(first))).otherwise(out)
            return out

        return F.array_join(F.transform(F.split(half, ""), one), "")

    def step(state, i):
        even = i % 2 == 0
        digest = _round_key(key, F.lit("email"), i, F.when(even, state["r"]).otherwise(state["l"]))
        moved = _let(digest, lambda d: shifted(F.when(even, state["l"]).otherwise(state["r"]), d))
        return F.struct(F.when(even, moved).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise(moved).alias("r"))

    got = F.aggregate(steps, F.struct(F.substring(local, F.lit(1), u).alias("l"), F.substring(local, u + 1, F.length(local)).alias("r")), step)
    return F.concat(_let(got, lambda g: F.concat(g["l"], g["r"])), F.lit("@"), F.substring_index(s, "@", -1))


MAKERS = {"email": email, "phone": phone, "ipv4": ipv4, "ssn": ssn, "iso": iso, "dmy": dmy}


def pseudonym(s: Column, key: str, backwards: bool = False) -> Column:
    """One candidate with its valid values replaced, and their number, as struct(v, n)."""
    out = F.struct(s.alias("v"), F.lit(0).alias("n"))
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(s.rlike(pattern), cards(s, key, backwards) if kind == "card" else _counted(s, MAKERS[kind](s, key, backwards))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None, backwards: bool = False) -> DataFrame:
    """``docs`` with the text's valid values replaced; their number goes into a column ``count``, if named."""
    names = docs.columns
    own = F.col(f"`{text}`")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.regexp_extract_all(own, F.lit(ANY), F.lit(0)), F.array().cast("array<string>")).alias("values"))
    rows = rows.withColumn("made", F.transform("values", lambda s: pseudonym(s, key, backwards)))
    at = names.index(text)
    pieces = F.zip_with(F.split(f"c{at}", ANY, -1), "made", lambda a, b: F.concat(a, F.coalesce(b["v"], F.lit(""))))
    new = F.when(F.size("values") > 0, F.array_join(pieces, "")).otherwise(F.col(f"c{at}"))
    out = [(new if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)]
    return rows.select(*out, *([F.aggregate("made", F.lit(0), lambda n, x: n + x["n"]).cast("long").alias(count)] if count else []))
