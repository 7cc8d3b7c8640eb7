"""PII: format-preserving pseudonyms by keyed Feistel permutations, as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import bind

ROUNDS = 8

_START, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
#: Length of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form(length: int, countries: str) -> str:
    """Account numbers of one length, in one piece or in groups of four."""
    groups, rest = divmod(length - 4, 4)
    tail = f" [A-Z0-9]{{{rest}}}" if rest else ""
    return (
        rf"(?:{countries.replace(' ', '|')})\d{{2}}(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{tail})"
    )


_IBANS = "|".join(_iban_form(length, countries) for length, countries in IBAN_LENGTHS.items())
#: What a candidate looks like, by kind. Quantifiers are bounded or possessive, so no text is slow to search.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+"
    r"@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+",
    "phone": r"(?<![A-Za-z0-9+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}" + _END
    + r"|(?<![A-Za-z0-9+])\+\d(?:(?:[ .-]|[ .-]?\(|\)[ .-]?)?\d){7,14}" + _END
    + r"|(?<![A-Za-z0-9(])\(\d{3}\) ?\d{3}-\d{4}" + _END
    + r"|(?<![A-Za-z0-9.-])(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![A-Za-z0-9-])",
    "date": r"(?<![A-Za-z0-9.-])"
    r"(?:(?:19|20)\d\d-\d\d-\d\d|\d\d\.\d\d\.(?:19|20)\d\d|\d\d/\d\d/(?:19|20)\d\d)(?![A-Za-z0-9-])",
    "ssn": r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])",
    "ip": r"(?<![A-Za-z0-9.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?[A-Za-z0-9])",
    # Countries of other lengths last: capitals or digits that follow a number of known length are not part of it.
    "iban": _START + rf"(?=[A-Z]{{2}}\d{{2}})(?:{_IBANS})" + _END
    + r"|" + _START + r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _END,
    "card": _START
    + r"(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})"
    + _END,
    "secret": _START + r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})" + _END,
}
ANY = "|".join(PATTERNS.values())


def _draw(key: str, *parts: Column) -> Column:
    """48 keyed bits that depend on all parts."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def feistel(values: Column, radices: Column, key: str) -> Column:
    """A keyed permutation of numbers, each below its own radix.

    In each round one half is shifted by amounts that depend on the other half,
    which the next round can undo; so different values stay different, and
    equal values always get the same one. The halves take turns.
    """

    def round_(state: Column, number: Column) -> Column:
        half = F.floor(F.size(state) / 2).cast("int")
        left = number % 2 == 1
        other = F.when(left, F.slice(state, half + 1, F.size(state))).otherwise(F.slice(state, F.lit(1), half))
        said = F.array_join(other.cast("array<string>"), ",")

        def move(value: Column, k: Column) -> Column:
            return F.when((k < half) == left, F.pmod(value + _draw(key, number, k, said), F.get(radices, k))).otherwise(value)

        return F.transform(state, move)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), values, round_)


def _characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda k: F.substring(text, k, F.lit(1)))


def permute_text(text: Column, key: str) -> Column:
    """Digits become digits, small letters small letters, capitals capitals; all else stays in place."""

    def base(c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), 48).when(c.rlike("^[a-z]$"), 97).when(c.rlike("^[A-Z]$"), 65).otherwise(F.ascii(c))

    def radix(c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), 10).when(c.rlike("^[A-Za-z]$"), 26).otherwise(1).cast("long")

    def whole(chars: Column) -> Column:
        values = F.transform(chars, lambda c: (F.ascii(c) - base(c)).cast("long"))
        moved = feistel(values, F.transform(chars, radix), key)
        return bind(moved, lambda v: F.array_join(F.transform(chars, lambda c, k: F.char(F.get(v, k) + base(c))), ""))

    return bind(_characters(text), whole)


def permute_hex(text: Column, key: str) -> Column:
    """Hexadecimal digits in the case that the text has."""
    values = F.transform(_characters(text), lambda c: F.conv(c, 16, 10).cast("long"))
    sixteen = F.transform(_characters(text), lambda c: F.lit(16).cast("long"))
    moved = F.array_join(F.transform(feistel(values, sixteen, key), lambda v: F.lower(F.hex(v))), "")
    return F.when(text == F.upper(text), F.upper(moved)).otherwise(moved)


def luhn_sum(digits: Column) -> Column:
    """The sum that card numbers keep divisible by ten; every second digit from the right counts twice."""

    def add(total: Column, pair: Column) -> Column:
        value = pair["digit"] * F.when(pair["at"] % 2 == 1, 2).otherwise(1)
        return total + F.when(value > 9, value - 9).otherwise(value)

    pairs = F.transform(
        F.reverse(_characters(digits)), lambda c, k: F.struct(c.cast("int").alias("digit"), k.alias("at"))
    )
    return F.aggregate(pairs, F.lit(0), add)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(text: Column, key: str) -> Column:
    """A valid number whose payload is permuted and whose last digit is made valid again."""
    payload = F.substring(text, F.lit(1), F.length(text) - 1)

    def closed(moved: Column) -> Column:
        check = F.pmod(F.lit(10) - luhn_sum(F.concat(_digits(moved), F.lit("0"))), F.lit(10))
        return F.concat(moved, check.cast("string"))

    return bind(permute_text(payload, key), closed)


def mod97(text: Column) -> Column:
    """Remainder by 97 of an account number, country and check digits moved to its end, letters as 10 to 35."""
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(value > 9, (rest * 100 + value) % 97).otherwise((rest * 10 + value) % 97).cast("int")

    return F.aggregate(_characters(turned), F.lit(0), add)


def _iban(text: Column, key: str) -> Column:
    """Country and length stay; the account is permuted and gets new check digits."""
    moved = F.concat(F.substring(text, 1, 2), F.lit("00"), permute_text(F.substring(text, F.lit(5), F.length(text)), key))

    def closed(raw: Column) -> Column:
        check = F.lpad((F.lit(98) - mod97(F.replace(raw, F.lit(" "), F.lit("")))).cast("string"), 2, "0")
        return F.concat(F.substring(raw, 1, 2), check, F.substring(raw, F.lit(5), F.length(raw)))

    return bind(moved, closed)


def _octets(text: Column) -> Column:
    return F.transform(F.split(text, r"\."), lambda part: part.cast("long"))


def _ip(text: Column, key: str) -> Column:
    moved = feistel(_octets(text), F.array(*[F.lit(256).cast("long")] * 4), key)
    return F.array_join(moved.cast("array<string>"), ".")


def _ssn_parts(text: Column) -> Column:
    """Area, group and serial, counted from 0 without the areas 000, 666 and 900 to 999."""
    area, group, serial = (F.get(F.split(text, "-"), k).cast("long") for k in range(3))
    return F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)


def _ssn(text: Column, key: str) -> Column:
    moved = feistel(_ssn_parts(text), F.array(*[F.lit(n).cast("long") for n in (898, 99, 9999)]), key)

    def shown(v: Column) -> Column:
        area = F.when(F.get(v, 0) >= 665, F.get(v, 0) + 2).otherwise(F.get(v, 0) + 1)
        return F.format_string("%03d-%02d-%04d", area, F.get(v, 1) + 1, F.get(v, 2) + 1)

    return bind(moved, shown)


# Days of 1900 to 2099 are 17 times 4297.
_DAYS = (17, 4297)


def _day(text: Column) -> Column:
    """The calendar day a date text names, or null; a text with slashes is month first where that is a date."""
    read = lambda form: F.try_to_timestamp(text, F.lit(form)).cast("date")
    return (
        F.when(text.contains("-"), read("yyyy-MM-dd")).when(text.contains("."), read("dd.MM.yyyy"))
        .otherwise(F.coalesce(read("MM/dd/yyyy"), read("dd/MM/yyyy")))
    )


def _date(text: Column, key: str) -> Column:
    day = F.datediff(_day(text), F.lit("1900-01-01").cast("date")).cast("long")
    parts = F.array(F.floor(day / _DAYS[1]).cast("long"), day % _DAYS[1])
    moved = feistel(parts, F.array(*[F.lit(n).cast("long") for n in _DAYS]), key)
    first = F.lit("1900-01-01").cast("date")
    made = bind(moved, lambda v: F.date_add(first, (F.get(v, 0) * _DAYS[1] + F.get(v, 1)).cast("int")))
    month_first = F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).isNotNull()
    return (
        F.when(text.contains("-"), F.date_format(made, "yyyy-MM-dd")).when(text.contains("."), F.date_format(made, "dd.MM.yyyy"))
        .when(month_first, F.date_format(made, "MM/dd/yyyy")).otherwise(F.date_format(made, "dd/MM/yyyy"))
    )


def kind_of(match: Column) -> Column:
    """The kind of a candidate that is valid, else null: checksums, calendar and ranges are tested."""
    whole = {name: match.rlike(f"^(?:{pattern})$") for name, pattern in PATTERNS.items()}
    area, group, serial = (F.get(F.split(match, "-"), k) for k in range(3))
    ssn = ~area.isin("000", "666") & (F.substring(area, 1, 1) != "9") & (group != "00") & (serial != "0000")
    valid = {
        "email": F.lit(True),
        "phone": F.lit(True),
        "date": _day(match).isNotNull(),
        "ssn": ssn,
        "ip": F.forall(F.split(match, r"\."), lambda part: part.cast("int") <= 255),
        "iban": mod97(F.replace(match, F.lit(" "), F.lit(""))) == 1,
        "card": luhn_sum(_digits(match)) % 10 == 0,
        "secret": match.rlike("[0-9]") & match.rlike("[A-Fa-f]"),
    }
    kind = F.lit(None).cast("string")
    for name in reversed(list(PATTERNS)):
        kind = F.when(whole[name], F.when(valid[name], F.lit(name)).otherwise(kind)).otherwise(kind)
    return kind


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """Another value of the same format; what is not valid stays as it is."""
    at = F.instr(match, "@")
    phone_head = F.regexp_extract(match, r"^\+\d{1,3}(?=[ .(-])", 0)
    made = {
        "email": F.concat(
            permute_text(F.substring(match, F.lit(1), at - 1), f"{key}:email"), F.substring(match, at, F.length(match))
        ),
        "phone": F.concat(
            phone_head, permute_text(F.substring(match, F.length(phone_head) + 1, F.length(match)), f"{key}:phone")
        ),
        "date": _date(match, f"{key}:date"),
        "ssn": _ssn(match, f"{key}:ssn"),
        "ip": _ip(match, f"{key}:ip"),
        "iban": _iban(match, f"{key}:iban"),
        "card": _card(match, f"{key}:card"),
        "secret": permute_hex(match, f"{key}:secret"),
    }
    result = match
    for name, value in made.items():
        result = F.when(kind == name, value).otherwise(result)
    return result


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the text's personal values replaced, and ``private_kinds``: the kind of each, in order.

    Equal values get equal pseudonyms in all documents, so records stay linked;
    formats, checksums and country codes stay valid. Numbers that fail their
    checksum, impossible dates and octets over 255 are left alone. Nothing is
    shuffled. A null text stays null, an empty one empty, both without kinds;
    repeated rows are treated alike; other columns pass through, but for one
    named ``private_kinds``, which is replaced.
    """
    text = F.col(text_col)
    gaps = F.split(text, ANY, -1)

    def renewed(found: Column) -> Column:
        def renamed(match: Column) -> Column:
            return bind(
                kind_of(match),
                lambda kind: F.struct(kind.alias("kind"), pseudonym(match, kind, key).alias("now")),
            )

        def joined(made: Column) -> Column:
            parts = F.transform(gaps, lambda gap, k: F.concat(gap, F.coalesce(F.get(made, k)["now"], F.lit(""))))
            kinds = F.filter(F.transform(made, lambda m: m["kind"]), lambda kind: kind.isNotNull())
            return F.struct(F.array_join(parts, "").alias("text"), kinds.alias("kinds"))

        return bind(F.transform(found, renamed), joined)

    untouched = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    matches = bind(found, lambda m: F.when(F.size(m) > 0, renewed(m)).otherwise(untouched))
    made = F.when(text.rlike("[0-9@]"), matches).otherwise(untouched)
    named = docs.drop("private_kinds").withColumn("__made", made)
    return named.withColumns({text_col: F.col("__made.text"), "private_kinds": F.col("__made.kinds")}).drop("__made")
