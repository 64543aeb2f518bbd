"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel network, in column expressions.

A valid number or date is a pair of numbers below two fixed bounds.  Each round adds a keyed digest of one to the other
modulo its bound, so the whole is a permutation of all values of that format: equal values get equal pseudonyms in every
document, different values different ones, and the key turns them back.

* card numbers: 13 to 19 digits, in one run or in groups of four, that pass the Luhn test; the digits before the check
  digit are permuted and a right check digit is set,
* phone numbers with a country code, or with an area code in brackets: all digits after the country code,
* IPv4 addresses: all 32 bits,
* dates from 1900-01-01 to 2099-11-12 as year-month-day, day.month.year or month/day/year: the day number.

E-mail addresses and labelled secrets are not numbers: their local part or value becomes a keyed digest of like form.
Digits that fail a test (a card number with a wrong check digit, 31 February) stay as they are.

Defined results: null stays null, empty stays empty; separators, letters and the order of the text stay; repeated rows
are treated alike.  Other columns are kept, the text column is replaced in place; count columns replace columns of their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.common import fresh, let

KEY = "treeledger pseudonyms"  # production passes its own
ROUNDS = 8  # of both halves
FIRST_DAY = "1900-01-01"
DAYS = (250, 292)  # 73,000 days

LOCAL = r"\p{L}\p{N}._%+-"
EMAIL = rf"(?<![{LOCAL}])[{LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
SECRET = r"(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b) ?[=:] ?[\"']?[A-Za-z0-9_/+-]{16,}={0,2}"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4})(?!\d)"
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d)"
DATE = r"(?<![\d.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d-])"
KINDS = {"email": EMAIL, "secret": SECRET, "ip": IP, "phone": PHONE, "card": CARD, "date": DATE}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
DATE_FORMS = {r"^\d{4}-": "yyyy-MM-dd", r"^\d{2}\.": "dd.MM.yyyy", r"^\d{2}/": "MM/dd/yyyy"}


def _digest(key: str, label: str, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}\x00{label}\x00"), value.cast("string")), 256)


def feistel(
    first: Column, second: Column, bounds: tuple[Column, Column], key: str, label: str, back: bool = False
) -> Column:
    """Permute pairs below two bounds; ``back`` undoes it.  Gives a struct ``a, b``."""

    def moved(pair: Column, i: int) -> Column:
        a, b = pair["a"], pair["b"]

        def shift(half: str, other: Column, bound: Column) -> Column:
            number = F.conv(F.substring(_digest(key, f"{label}{i}{half}", other), 1, 15), 16, 10).cast("long")
            return (-number if back else number) % bound

        if back:
            b = F.pmod(b + shift("b", a, bounds[1]), bounds[1])
            a = F.pmod(a + shift("a", b, bounds[0]), bounds[0])
        else:
            a = F.pmod(a + shift("a", b, bounds[0]), bounds[0])
            b = F.pmod(b + shift("b", a, bounds[1]), bounds[1])
        return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def stepping(i: int):
        return lambda pair: moved(pair, i)

    out = F.struct(first.cast("long").alias("a"), second.cast("long").alias("b"))
    for i in range(ROUNDS)[:: -1 if back else 1]:
        out = let(out, stepping(i))
    return out


def permuted_digits(digits: Column, key: str, label: str, back: bool = False) -> Column:
    """Permute strings of 2 to 36 digits among those of their length."""

    def swap(d: Column) -> Column:
        n = F.length(d)
        left = F.floor(n / 2).cast("int")
        bounds = (F.pow(F.lit(10.0), left).cast("long"), F.pow(F.lit(10.0), n - left).cast("long"))
        a, b = F.substr(d, F.lit(1), left).cast("long"), F.substr(d, left + 1, n).cast("long")
        return let(
            F.struct(feistel(a, b, bounds, key, label, back).alias("p"), left.alias("left"), n.alias("n")),
            lambda x: F.concat(F.lpad(x["p"]["a"], x["left"], "0"), F.lpad(x["p"]["b"], x["n"] - x["left"], "0")),
        )

    return let(digits, swap)


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _laid_out(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by the given ones, in order."""

    def char(i: Column, x: Column) -> Column:
        own = F.substr(x["form"], i, F.lit(1))
        place = F.length(_only_digits(F.substr(x["form"], F.lit(1), i)))
        return F.when(own.rlike(r"^\d$"), F.substr(x["digits"], place, F.lit(1))).otherwise(own)

    both = F.struct(form.alias("form"), digits.alias("digits"))
    return let(
        both, lambda x: F.array_join(F.transform(F.sequence(F.lit(1), F.length(x["form"])), lambda i: char(i, x)), "")
    )


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Sum of the Luhn test, from the right; the rightmost digit is doubled on request."""

    def add(sum_: Column, x: Column) -> Column:
        return sum_ + x

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == (0 if doubled_first else 1), twice).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), add)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, False) % 10 == 0


def _card(value: Column, key: str) -> Column:
    def changed(d: Column) -> Column:
        body = permuted_digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, True) % 10) % 10).cast("int").cast("string")))

    return let(_only_digits(value), lambda d: F.when(luhn_valid(d), _laid_out(value, changed(d))))


def _phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^(?:\+\d{1,3}(?=[ .(-]))?", 0)
    return let(
        F.struct(code.alias("code"), F.substr(value, F.length(code) + 1, F.length(value)).alias("rest")),
        lambda x: F.concat(
            x["code"], _laid_out(x["rest"], permuted_digits(_only_digits(x["rest"]), key, "phone"))
        ),
    )


def _ip(value: Column, key: str) -> Column:
    def changed(o: Column) -> Column:
        n = [o[i].cast("long") for i in range(4)]
        whole = F.lit(65536)
        out = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], (whole, whole), key, "ip")
        return F.when(
            F.greatest(*n) < 256,
            let(
                out,
                lambda p: F.concat_ws(
                    ".",
                    *(y.cast("long").cast("string") for h in ("a", "b") for y in (F.floor(p[h] / 256), p[h] % 256)),
                ),
            ),
        )

    return let(F.split(value, r"\."), changed)


def _date(value: Column, key: str) -> Column:

    def changing(form: str) -> Callable[[Column], Column]:
        def changed(day: Column) -> Column:
            pair = feistel(F.floor(day / DAYS[1]), day % DAYS[1], (F.lit(DAYS[0]), F.lit(DAYS[1])), key, "date")
            number = let(pair, lambda p: p["a"] * DAYS[1] + p["b"])
            moved = F.date_add(F.lit(FIRST_DAY).cast("date"), number.cast("int"))
            return F.when((day >= 0) & (day < DAYS[0] * DAYS[1]), F.date_format(moved, form))

        return changed

    out = F.lit(None).cast("string")
    for shape, form in DATE_FORMS.items():
        day = F.date_diff(F.try_to_timestamp(value, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        out = F.when(value.rlike(shape), let(day, changing(form))).otherwise(out)
    return out


def _email(value: Column, key: str) -> Column:
    letters = F.translate(F.substring(_digest(key, "email", F.lower(value)), 1, 12), "0123456789", "ghijklmnop")
    return F.concat(letters, F.lit("@"), F.substring_index(value, "@", -1))


def _secret(value: Column, key: str) -> Column:
    head = F.regexp_extract(value, r"^[^=:]*[=:] ?[\"']?", 0)

    def changed(x: Column) -> Column:
        secret = x["secret"]
        code = _digest(key, "secret", secret)
        code = F.substr(F.repeat(code, F.ceil(F.length(secret) / 64).cast("int")), F.lit(1), F.length(secret))
        return F.concat(x["head"], F.when(secret == F.upper(secret), F.upper(code)).otherwise(code))

    return let(
        F.struct(head.alias("head"), F.substr(value, F.length(head) + 1, F.length(value)).alias("secret")), changed
    )


REPLACE = {"email": _email, "secret": _secret, "ip": _ip, "phone": _phone, "card": _card, "date": _date}


def _judged(value: Column, key: str) -> Column:
    """Kind of a match and its pseudonym; both null when the value is not valid."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)

    def replaced(k: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, change in REPLACE.items():
            out = F.when(k == name, change(value, key)).otherwise(out)
        return F.struct(k.alias("kind"), out.alias("new"))

    return let(kind, replaced)


def pseudonymised(docs: DataFrame, text: str = "text", key: str = KEY, counts: bool = True) -> DataFrame:
    """Replace personal data in a text column; add the number of values replaced of each kind, on request."""
    value = F.col(text)
    found = F.regexp_extract_all(value, F.lit(ANY), F.lit(0))

    def rewritten(matches: Column) -> Column:
        def pieces(new: Column) -> Column:
            gaps = F.split(value, ANY, -1)
            shown = F.transform(F.arrays_zip(matches.alias("m"), new.alias("n")), lambda x: F.coalesce(x["n"]["new"], x["m"]))
            joined = F.zip_with(gaps, shown, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
            return F.struct(F.array_join(joined, "").alias("text"), new.alias("new"))

        return let(F.transform(matches, lambda m: _judged(m, key)), pieces)

    nothing = F.struct(value.alias("text"), F.lit(None).cast("array<struct<kind:string,new:string>>").alias("new"))
    # Texts without digits and @ have nothing to find.
    out = F.when(value.rlike("[0-9@]|(?i:token|secret|passw|key)"), let(found, rewritten)).otherwise(nothing)
    own = fresh(docs, "_pii")
    names = [f"n_{k}" for k in KINDS] if counts else []
    kept = [c for c in docs.columns if c not in names]
    columns = [F.col(own)["text"].alias(c) if c == text else F.col(f"`{c}`") for c in kept]
    if counts:
        columns += [_count(F.col(own)["new"], k).alias(f"n_{k}") for k in KINDS]
    return docs.withColumn(own, out).select(*columns)


def _count(new: Column, kind: str) -> Column:
    valid = F.filter(new, lambda x: (x["kind"] == kind) & x["new"].isNotNull())
    return F.when(new.isNull(), 0).otherwise(F.size(valid)).cast("long")
