"""Format-preserving pseudonyms for personal data, with built-in functions only.

One pattern finds the candidates of a text; each is validated by the rules of its kind, and valid
values are permuted within their format by a Feistel network keyed with a secret. The network is a
permutation, so equal values get equal pseudonyms in all documents and different ones stay apart:

==========  =====================================  ============================================
kind        valid                                  permuted
==========  =====================================  ============================================
email       name @ domain with a dot               letters and digits of the name
card        13 to 19 digits, Luhn digit right      all digits but the last, which is set anew
iban        country, check digits modulo 97        the account part, check digits set anew
ssn         no zero field, area 001-899 but 666    area and the rest
phone       North American with area, or +country  area and number, or all digits behind the code
ip          four numbers up to 255                 the 32 bits
date        1900-01-01 to 2099-11-12               the day among all those days
secret      access keys, password= or token=       letters and digits of the value
==========  =====================================  ============================================

Cards and IBANs are looked for from every group of a run of digits and capitals, in all lengths that
end with a group. What is not valid stays as it is, and so does all other text. Defined results: null text stays null
with no values, empty and very long texts are treated whole, repeated rows come out alike, an empty
table gives no rows; other columns pass through :func:`pseudonymised` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.shared import plain_names

KEY = "opinara"
ROUNDS = 8

_EDGE = r"(?<![\p{L}\p{N}_.@+-])"
_END = r"(?![\p{L}\p{N}_])"
# Eight characters or more, of any length; marks at the end are not part of it.
_VALUE = r"(?=[A-Za-z0-9+/_.=~-]{7,}?[A-Za-z0-9+/_-])[.=~]*+[A-Za-z0-9+/_-]++(?:[.=~]++[A-Za-z0-9+/_-]++)*+"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": rf"(?:AKIA[0-9A-Z]{{16}}{_END}|(?i:password|passwd|token|secret|api_key) ?[=:] ?\"?" + _VALUE + ")",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": (
        r"(?:(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}"
        r"|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5})"
    ),
}
# Groups of digits and capitals that may hold cards and IBANs, up to where something else begins.
_ELSE = "(?!" + "|".join(f"{PATTERNS[kind]}{_END}" for kind in ("ip", "date", "ssn", "phone")) + ")"
_RUN = (
    rf"{_ELSE}(?:(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]++{_END}(?:[ -]{_ELSE}[0-9]++{_END})*+"
    rf"|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]*+{_END}(?:[ -]{_ELSE}[A-Z0-9]++{_END})*+)"
)
PATTERNS = {k: p for kind, p in PATTERNS.items() for k, p in ([("run", _RUN)] if kind == "phone" else []) + [(kind, p)]}
# A secret goes as far as its own letters do, whatever follows.
ANY = "|".join(f"{_EDGE}{p}{'' if kind == 'secret' else _END}" for kind, p in PATTERNS.items())
_NO_DIGIT = r"[^0-9]"
_GROUP = "[A-Z0-9]+[ -]?"
_MOST_GROUPS = 34
_CARD, _IBAN = "^[0-9]{13,19}$", "^[A-Z]{2}[0-9]{2}[A-Z0-9]{8,31}$"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: How cards are printed; and an IBAN of a listed country.
_PRINTED = (
    r"^(?:[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?"
    rf"|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}|(?:{'|'.join(' '.join(IBAN_LENGTHS.values()).split())}).*)$"
)
_AREAS, _LINES = 800, 10_000_000
_SSN_AREAS, _SSN_REST = 898, 99 * 9999
_DAYS, _SPANS, _FIRST_DAY = 250, 292, "1900-01-01"


def _draw(kind: str, turn: Column, other: Column) -> Column:
    """The round function: a hash of the key, the kind, the round and the other half, in hex."""
    return F.sha2(F.concat_ws("|", F.lit(KEY), F.lit(kind), turn.cast("string"), other.cast("string")), 256)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("bigint")


def permuted_pair(kind: str, left: Column, right: Column, a: int, b: int) -> Column:
    """Feistel over the numbers below ``a`` and ``b``: a struct ``l, r`` of the same ranges."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(state: Column, i: Column) -> Column:
        l = (state["l"] + _number(F.substring(_draw(kind, i, state["r"]), 1, 12)) % a) % a
        r = (state["r"] + _number(F.substring(_draw(kind, -i, l), 1, 12)) % b) % b
        return F.struct(l.alias("l"), r.alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def permuted_text(kind: str, text: Column) -> Column:
    """Feistel over the halves of a text: letters and digits move within their class, the rest stays."""
    cut = F.ceil(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), cut).alias("l"), F.substring(text, cut + 1, F.length(text)).alias("r")
    )

    def moved(half: Column, stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            step = _number(F.substring(stream, (i % 32) * 2 + 1, F.lit(2)))
            code = F.ascii(c)

            def within(base: int, size: int) -> Column:
                return F.char(((code - base + step) % size + base).cast("bigint"))

            return (
                F.when(c.between("0", "9"), within(48, 10))
                .when(c.between("A", "Z"), within(65, 26))
                .when(c.between("a", "z"), within(97, 26))
                .otherwise(c)
            )

        return F.concat_ws("", F.transform(F.split(half, ""), one))

    # Transforms over one element make the hash and the new half once, not once a character.
    def drawn(half: Column, hashed: Column) -> Column:
        return F.transform(F.array(hashed), lambda stream: moved(half, stream))[0]

    def turn(state: Column, i: Column) -> Column:
        left = drawn(state["l"], _draw(kind, i, state["r"]))
        return F.transform(
            F.array(left), lambda l: F.struct(l.alias("l"), drawn(state["r"], _draw(kind, -i, l)).alias("r"))
        )[0]

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, turn)
    return F.concat(end["l"], end["r"])


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits and capitals replaced by those of ``digits`` in order."""
    start = F.struct(F.lit("").alias("done"), F.lit(1).alias("next"))

    def step(state: Column, c: Column) -> Column:
        fits = c.rlike("^[0-9A-Z]$")
        new = F.when(fits, F.substring(digits, state["next"], F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(state["done"], new).alias("done"), (state["next"] + fits.cast("int")).alias("next")
        )

    return F.aggregate(F.split(shape, ""), start, step)["done"]


def _luhn(digits: Column) -> Column:
    """Luhn sum of the digits, the last one not doubled."""
    weights = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(weights, F.lit(0), lambda s, x: s + x)


def _card(value: Column) -> Column:
    digits = F.regexp_replace(value, _NO_DIGIT, "")
    body = permuted_text("card", F.substring(digits, F.lit(1), F.length(digits) - 1))
    # A transform over one element names the new body once.
    new = F.transform(
        F.array(body), lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))
    )[0]
    return F.when(_luhn(digits) % 10 == 0, _refilled(value, new))


def _mod97(text: Column) -> Column:
    """Remainder modulo 97 of a text of digits and capitals, a capital counting from 10 for A."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c.between("0", "9"), (s * 10 + F.ascii(c) - 48) % 97).otherwise(
            (s * 100 + F.ascii(c) - 55) % 97
        ),
    )


def _iban(value: Column) -> Column:
    plain = F.regexp_replace(value, "[ -]", "")
    land, rest = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(rest, F.substring(plain, 1, 4))) == 1
    new = F.transform(
        F.array(permuted_text("iban", rest)),
        lambda r: F.concat(land, F.lpad((98 - _mod97(F.concat(r, land, F.lit("00")))).cast("string"), 2, "0"), r),
    )[0]
    return F.when(valid, _refilled(value, new))


def _is_number(value: Column) -> Column:
    """Whether groups are a card or an IBAN; a country that is not listed may have any length."""
    plain = F.regexp_replace(value, "[ -]", "")
    other = F.lit(True)
    for length, lands in IBAN_LENGTHS.items():
        other = F.when(plain.rlike(f"^(?:{lands.replace(' ', '|')})"), F.length(plain) == length).otherwise(other)
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    return (
        F.when(plain.rlike(_CARD), _luhn(plain) % 10 == 0)
        .when(plain.rlike(_IBAN) & other, _mod97(turned) == 1)
        .otherwise(F.lit(False))
    )


def _run(value: Column) -> Column:
    """``text, n`` of a run of groups: of the numbers that begin at a group the longest valid one is
    permuted, one in a usual print before others, and the rest is searched on."""

    def joined(groups: Column, at: Column, n: Column) -> Column:
        return F.array_join(F.slice(groups, at + 1, n), "")

    def bare(text: Column) -> Column:
        return F.regexp_replace(text, "[ -]$", "")

    def best(groups: Column) -> Column:
        def at(_: Column, i: Column) -> Column:
            most = F.least(F.lit(_MOST_GROUPS), F.size(groups) - i)
            tries = F.transform(
                F.sequence(F.lit(1), most), lambda n: F.struct(n.alias("n"), bare(joined(groups, i, n)).alias("text"))
            )
            valid = F.filter(tries, lambda x: _is_number(x["text"]))
            return F.array_max(
                F.transform(valid, lambda x: F.struct(x["text"].rlike(_PRINTED).alias("usual"), x["n"].alias("n")))
            )

        return F.transform(groups, at)

    def chosen(found: Column) -> Column:
        """Places and lengths, first to last; an unusual one gives way to a usual one that begins in it."""

        def step(state: Column, i: Column) -> Column:
            own = F.get(found, i)
            within = F.slice(found, i + 2, F.coalesce(own["n"], F.lit(1)) - 1)
            held = ~own["usual"] & F.exists(within, lambda x: F.coalesce(x["usual"], F.lit(False)))
            take = (i >= state["next"]) & own.isNotNull() & ~F.coalesce(held, F.lit(False))
            entry = F.struct(state["next"].alias("past"), i.alias("at"), own["n"].alias("n"))
            return F.when(
                take,
                F.struct((i + own["n"]).alias("next"), F.concat(state["taken"], F.array(entry)).alias("taken")),
            ).otherwise(state)

        kind = "struct<next: int, taken: array<struct<past: int, at: int, n: int>>>"
        start = F.struct(F.lit(0).alias("next"), F.array().alias("taken")).cast(kind)
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, lambda s, i: step(s, i).cast(kind))

    def written(groups: Column, state: Column) -> Column:
        def one(c: Column) -> Column:
            def new(whole: Column) -> Column:
                number = bare(whole)
                moved = F.when(number.rlike("^[0-9]"), _card(number)).otherwise(_iban(number))
                return F.concat(moved, F.substring(whole, F.length(number) + 1, F.length(whole)))

            named = F.transform(F.array(joined(groups, c["at"], c["n"])), new)[0]
            return F.concat(joined(groups, c["past"], c["at"] - c["past"]), named)

        tail = joined(groups, state["next"], F.size(groups) - state["next"])
        text = F.concat(F.array_join(F.transform(state["taken"], one), ""), tail)
        return F.struct(text.alias("text"), F.size(state["taken"]).alias("n"))

    # Transforms over one element name the groups and what was chosen once.
    groups = F.regexp_extract_all(value, F.lit(_GROUP), F.lit(0))
    named = F.transform(F.array(groups), lambda g: F.struct(g.alias("g"), best(g).alias("found")))
    named = F.transform(named, lambda x: F.struct(x["g"].alias("g"), chosen(x["found"]).alias("state")))
    return F.transform(named, lambda x: written(x["g"], x["state"]))[0]


def _ssn(value: Column) -> Column:
    area, group, serial = (F.substring(value, p, n).cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("int")
    pair = permuted_pair("ssn", place, (group - 1) * 9999 + serial - 1, _SSN_AREAS, _SSN_REST)

    def shown(p: Column) -> Column:
        a = p["l"] + 1
        a = a + (a >= 666).cast("int")
        return F.concat_ws(
            "-",
            F.lpad(a.cast("string"), 3, "0"),
            F.lpad((F.floor(p["r"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((p["r"] % 9999 + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, F.transform(F.array(pair), shown)[0])


def _phone(value: Column) -> Column:
    plus_one = value.startswith("+1")
    digits = F.regexp_replace(value, _NO_DIGIT, "")
    own = F.when(plus_one, F.substring(digits, F.lit(2), F.length(digits))).otherwise(digits)
    american = (plus_one | ~value.startswith("+")) & (F.length(own) == 10)
    area, line = F.substring(own, 1, 3).cast("bigint"), F.substring(own, 4, 7).cast("bigint")
    pair = permuted_pair("phone", area - 200, line, _AREAS, _LINES)

    def shown(p: Column) -> Column:
        new = F.concat((p["l"] + 200).cast("string"), F.lpad(p["r"].cast("string"), 7, "0"))
        return _refilled(value, F.concat(F.when(plus_one, F.lit("1")).otherwise(F.lit("")), new))

    code = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    abroad = F.length(digits).between(8, 15) & value.startswith("+")
    return F.when(american & (area >= 200), F.transform(F.array(pair), shown)[0]).when(
        ~american & abroad, F.concat(code, permuted_text("phone", rest))
    )


def _ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("bigint"))
    valid = F.forall(parts, lambda p: p <= 255)
    pair = permuted_pair("ip", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], 1 << 16, 1 << 16)

    def shown(p: Column) -> Column:
        return F.concat_ws(
            ".", *[(F.floor(p[h] / 256) if high else p[h] % 256).cast("string") for h in "lr" for high in (True, False)]
        )

    return F.when(valid, F.transform(F.array(pair), shown)[0])


def _date(value: Column) -> Column:
    """Days move among all valid days; 01/02/2020 is read month first unless that is no month."""
    first, second, year = (F.substring(value, p, n) for p, n in ((1, 2), (4, 2), (7, 4)))
    slash, dot = F.contains(value, F.lit("/")), F.contains(value, F.lit("."))
    month_first = slash & (first.cast("int") <= 12)
    iso = (
        F.when(month_first, F.concat_ws("-", year, first, second))
        .when(slash | dot, F.concat_ws("-", year, second, first))
        .otherwise(value)
    )
    day = F.date_diff(iso.try_cast("date"), F.to_date(F.lit(_FIRST_DAY)))
    pair = permuted_pair("date", F.floor(day / _SPANS), day % _SPANS, _DAYS, _SPANS)

    def shown(p: Column) -> Column:
        new = F.date_add(F.to_date(F.lit(_FIRST_DAY)), (p["l"] * _SPANS + p["r"]).cast("int"))
        # The new date is written in the order the old one was read in.
        return (
            F.when(month_first, F.date_format(new, "MM/dd/yyyy"))
            .when(slash, F.date_format(new, "dd/MM/yyyy"))
            .when(dot, F.date_format(new, "dd.MM.yyyy"))
            .otherwise(F.date_format(new, "yyyy-MM-dd"))
        )

    return F.when(day.between(0, _DAYS * _SPANS - 1), F.transform(F.array(pair), shown)[0])


def _email(value: Column) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(permuted_text("email", name), F.substring(value, F.length(name) + 1, F.length(value)))


def _secret(value: Column) -> Column:
    head = F.regexp_extract(value, r"^(?:AKIA|[A-Za-z_]+ ?[=:] ?\"?)", 0)
    return F.concat(head, permuted_text("secret", F.substring(value, F.length(head) + 1, F.length(value))))


def pseudonym(value: Column) -> Column:
    """``text, n`` of a candidate: the text with its valid values replaced, and their number."""
    rules = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "run": None, "phone": _phone}

    def whole(new: Column) -> Column:
        return F.transform(
            F.array(new), lambda x: F.struct(F.coalesce(x, value).alias("text"), x.isNotNull().cast("int").alias("n"))
        )[0]

    found = F.struct(value.alias("text"), F.lit(0).alias("n"))
    for kind, rule in reversed(rules.items()):
        new = whole(rule(value)) if rule else _run(value)
        found = F.when(value.rlike(f"^{PATTERNS[kind]}$"), new).otherwise(found)
    return found


def pseudonymised(docs: DataFrame, counted: str = "n_values") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and the number of replaced values."""
    names, docs = docs.columns, plain_names(docs, "text")
    own = F.col("text")
    some = own.rlike("[0-9@]|(?i:password|passwd|token|secret|api_key)")
    values = F.when(some, F.regexp_extract_all(own, F.lit(ANY), F.lit(0)))
    values = F.coalesce(values, F.array().cast("array<string>"))
    new = F.transform(values, pseudonym)
    # The found values travel as a column, so that each is permuted once.
    found = docs.select("*", new.alias("_found"))
    parts = F.zip_with(
        F.split(own, ANY, -1),
        F.col("_found"),
        lambda gap, f: F.concat(gap, F.coalesce(f["text"], F.lit(""))),
    )
    replaced = F.when(F.size("_found") > 0, F.concat_ws("", parts)).otherwise(own)
    n = F.aggregate("_found", F.lit(0), lambda s, f: s + f["n"]).cast("bigint")
    columns = [replaced.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return found.select(*columns, n.alias("_n")).toDF(*names, counted)
