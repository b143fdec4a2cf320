"""Operator 2: personal data replaced by format-preserving Feistel pseudonyms.

DataFrame functions only.  Found values are checked (Luhn, IBAN remainder,
calendar, octets, number ranges) and permuted within their own format by a
keyed Feistel network: the cells of a value (digits, letters, octets, day
numbers) have radices, and each round adds to one half of the cells, modulo
their radices, a keyed hash of the other half.  The permutation is one to one
on every format and depends on nothing but key, kind and value, so equal
values stay linked across documents.  Check digits are computed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import unused
from panelforge.llm.quality import let

#: Rounds of the network.
ROUNDS = 8
#: Key of the permutations; a production run passes its own.
KEY = "panelforge"
#: Days of 400 Gregorian years from EPOCH, as two radices (189 * 773).
EPOCH, DAYS = "1800-01-01", (189, 773)

#: What may be personal data, as Java's regular expressions; earlier ones win at a place.
#: Repeated groups recurse in Java's matcher, so all are bounded, as are the values: an
#: address has 64 characters before its @ and 127 labels behind it at most.
KINDS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",
    "date": r"(?<![\d.+/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![\d/-]|\.\d)",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<!\w)[0-9](?:[ -]?[0-9]){12,18}(?!\w)",
    "access_key": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "token": r"(?<!\w)(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,64}(?!\w)",
}
FOUND = "|".join(f"(?:{p})" for p in KINDS.values())


def feistel(values: Column, radices: Column, tweak: str, key: str) -> Column:
    """Permute ``values`` (array of int), each below its radix; of one cell alone
    nothing depends on another, so it is only shifted."""
    half = F.floor(F.size(values) / 2).cast("int")

    def one_round(cells: Column, k: Column) -> Column:
        left = k % 2 == 0
        other = F.when(left, F.slice(cells, half + 1, F.size(cells))).otherwise(F.slice(cells, F.lit(1), half))
        seed = F.concat_ws("|", F.lit(key), F.lit(tweak), F.array_join(radices.cast("array<string>"), ","), k.cast("string"), F.array_join(other.cast("array<string>"), ","))

        def shifted(s: Column) -> Column:
            def add(v: Column, i: Column) -> Column:
                noise = F.conv(F.substring(F.sha2(F.concat_ws("|", s, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
                return F.when((i < half) == left, ((v + noise) % F.get(radices, i)).cast("int")).otherwise(v)

            return F.transform(cells, add)

        return let(seed, shifted)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, one_round)


def permuted(text: Column, tweak: str, key: str, letters: int = 26) -> Column:
    """Letters and digits of ``text`` permuted, each within its class; ``letters``
    of the alphabet are in use.  All other characters stay in place."""

    def by_chars(chars: Column) -> Column:
        first = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65)
        movable = F.filter(chars, lambda c: c.rlike("[0-9A-Za-z]"))
        radix = F.transform(movable, lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(letters))

        def rebuilt(ms: Column) -> Column:
            values = F.transform(ms, lambda c: (F.ascii(c) - first(c)).cast("int"))
            new = let(radix, lambda rs: feistel(values, rs, tweak, key))
            moved = let(new, lambda vs: F.transform(ms, lambda c, i: F.char(first(c) + F.get(vs, i))))
            place = lambda i: F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda c: c.rlike("[0-9A-Za-z]"))) - 1
            return let(moved, lambda vs: F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.get(vs, place(i))).otherwise(c)), ""))

        return let(movable, rebuilt)

    return let(F.split(text, ""), by_chars)


def spread(form: Column, plain: Column) -> Column:
    """The characters of ``plain`` put in place of the letters and digits of ``form``."""
    place = lambda i: F.length(F.regexp_replace(F.substr(form, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
    return F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substr(plain, place(i), F.lit(1))).otherwise(c)), "")


def luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return (total + F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))).cast("int")

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10


def card(m: Column, key: str) -> Column:
    """First digit kept, the others permuted, the check digit computed."""

    def new(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted(F.substr(d, F.lit(2), F.length(d) - 2), "card", key))
        full = let(body, lambda b: F.concat(b, ((10 - luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))
        return F.when((luhn(d) == 0) & ~d.rlike("^0+$"), spread(m, full))

    return let(F.regexp_replace(m, "[^0-9]", ""), new)


def remainder97(text: Column) -> Column:
    """IBAN remainder of letters and digits already in check order."""

    def add(total: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban(m: Column, key: str) -> Column:
    def new(s: Column) -> Column:
        land, body = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(5), F.length(s) - 4)
        moved = permuted(body, "iban", key)
        check = lambda b: F.lpad((98 - remainder97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0")
        full = let(moved, lambda b: F.concat(land, check(b), b))
        return F.when(remainder97(F.concat(body, F.substr(s, F.lit(1), F.lit(4)))) == 1, spread(m, full))

    return let(F.regexp_replace(m, " ", ""), new)


def ip(m: Column, key: str) -> Column:
    def new(octets: Column) -> Column:
        moved = feistel(octets, F.array(*[F.lit(256)] * 4), "ip", key)
        return F.when(F.forall(octets, lambda o: o < 256), F.array_join(moved.cast("array<string>"), "."))

    return let(F.split(m, r"\.").cast("array<int>"), new)


def ssn(m: Column, key: str) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, number 0001 to 9999."""

    def new(p: Column) -> Column:
        area, group, number = (F.get(p, F.lit(i)) for i in range(3))
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (number > 0)
        cells = F.array(area - 1 - (area > 666).cast("int"), group - 1, number - 1)
        moved = feistel(cells, F.array(F.lit(898), F.lit(99), F.lit(9999)), "ssn", key)
        part = lambda v, i, n: F.lpad((F.get(v, F.lit(i)) + 1).cast("string"), n, "0")
        area_of = lambda v: F.get(v, F.lit(0)) + 1 + (F.get(v, F.lit(0)) >= 665).cast("int")
        return F.when(valid, let(moved, lambda v: F.concat_ws("-", F.lpad(area_of(v).cast("string"), 3, "0"), part(v, 1, 2), part(v, 2, 4))))

    return let(F.split(m, "-").cast("array<int>"), new)


def date(m: Column, key: str) -> Column:
    """Calendar dates from 1800 to 2199, year first with ``-``, or day (else
    month) first with ``.`` or ``/``; the order of the parts stays."""
    iso, sep = m.rlike("^[0-9]{4}-"), F.substr(m, F.lit(3), F.lit(1))
    part = lambda at, n: F.substr(m, F.lit(at), F.lit(n))
    month_first = part(4, 2).cast("int") > 12
    a, b = part(1, 2), part(4, 2)
    text = F.when(iso, m).otherwise(F.concat_ws("-", part(7, 4), F.when(month_first, a).otherwise(b), F.when(month_first, b).otherwise(a)))
    number = F.date_diff(F.try_to_date(text, "yyyy-MM-dd"), F.lit(EPOCH).cast("date"))

    def new(n: Column) -> Column:
        cells = F.array(F.floor(n / DAYS[1]).cast("int"), (n % DAYS[1]).cast("int"))
        moved = feistel(cells, F.array(F.lit(DAYS[0]), F.lit(DAYS[1])), "date", key)
        day = let(moved, lambda v: F.date_add(F.lit(EPOCH).cast("date"), F.get(v, F.lit(0)) * DAYS[1] + F.get(v, F.lit(1))))

        def shown(d: Column) -> Column:
            y, mo, da = F.date_format(d, "yyyy"), F.date_format(d, "MM"), F.date_format(d, "dd")
            return F.when(iso, F.concat_ws("-", y, mo, da)).otherwise(F.concat(F.when(month_first, mo).otherwise(da), sep, F.when(month_first, da).otherwise(mo), sep, y))

        return F.when(n.isNotNull() & (n >= 0) & (n < DAYS[0] * DAYS[1]), let(day, shown))

    return let(number, new)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one found value; the value itself if it is not valid."""
    at = F.instr(m, "@")
    country = F.regexp_extract(m, r"^\+[0-9]{1,3}?(?=[ .(-]|[0-9]{9,}$)", 0)
    rest = lambda n: F.substr(m, n + 1, F.length(m))
    is_ = lambda kind: m.rlike(f"^(?:{KINDS[kind]})$")
    new = (
        F.when(at > 0, F.concat(permuted(F.substr(m, F.lit(1), at - 1), "email", key), F.substr(m, at, F.length(m))))
        .when(is_("date"), date(m, key))
        .when(is_("ip"), ip(m, key))
        .when(is_("ssn"), ssn(m, key))
        .when(m.startswith("+"), F.concat(country, permuted(rest(F.length(country)), "phone", key)))
        .when(is_("access_key"), F.concat(F.lit("AKIA"), permuted(rest(F.lit(4)), "access_key", key)))
        .when(is_("iban"), iban(m, key))
        .when(is_("card"), card(m, key))
        .when(is_("token"), permuted(m, "token", key, letters=6))
    )
    return F.coalesce(new, m)


def pseudonymised(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with personal data in column ``text`` replaced, and ``n_replaced``
    (long), the number of replaced values, as a further column (one of that
    name is overwritten).

    Null texts stay null with nothing replaced, empty ones empty.  Values that
    fail their check stay.  Rows are judged one by one: repeated rows, ties and
    all other columns pass through (whatever their names), an empty table gives an
    empty result."""

    def masked(ms: Column) -> Column:
        gaps = F.split(F.col(text), FOUND, -1)
        new = F.transform(ms, lambda m: pseudonym(m, key))

        def joined(ns: Column) -> Column:
            body = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(ns, i), F.lit("")))), "")
            changed = F.size(F.filter(F.zip_with(ms, ns, lambda a, b: a != b), lambda c: c))
            return F.struct(body.alias("text"), changed.cast("long").alias("n"))

        return let(new, joined)

    untouched = F.struct(F.col(text).alias("text"), F.lit(0).cast("long").alias("n"))
    found = F.when(F.col(text).rlike("[0-9@]"), let(F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)), masked)).otherwise(untouched)
    order = [c for c in docs.columns if c != "n_replaced"]
    name = unused(docs.columns, "_found")
    out = docs.withColumn(name, found)
    return out.select(*(F.col(f"{name}.text").alias(text) if c == text else F.col(f"`{c}`") for c in order), F.col(f"{name}.n").alias("n_replaced"))
